"""N-gram Jaccard join by PartEnum signatures, exact.

Sets of word shingles (see `shingles`) link when 100 |A and B| >= percent |A or B|. Equal sets are one class from the
start; what follows is about different sets.

Signatures. Sizes are cut into bands so that linked sets lie in the same band or in neighbours. For each band there
is an instance, which a set joins if a linked partner could have its greater size there. With r the band's largest
size, linked sets differ in at most k = (100 - percent) 2r / (100 + percent) elements. An instance partitions the
hash domain twice: into n1 parts, and each part into n2 pieces; a signature is a hash of the elements in one of the
subsets of n2 - k2 pieces that are enumerated in every part, of the subset and of the instance. Small k: n1 = 1,
n2 = k + 3, subsets of two. Larger k: k2 = 1, n2 = 3, subsets of two pieces of three, and somewhat more parts than
the k // 2 + 1 of which one must hold at most one difference. In either case linked sets share at least `need`
signatures, and documents with fewer than any other set has are out at once. Subsets that are empty make no
signature; an instance in which this could cost a set its last shared one keeps them (see `signatures`).

Buckets. Signatures travel packed, some 12 bytes each, by hash to parts of bounded size; only those that two sets share
come out as rows. Linking needs no pair twice: first each set is checked against the set that leads most of its
buckets; then components are formed. Of the buckets that still hold several components those led by one set make a
unit, and a unit's sets go to one task, with their elements and signatures. There sets that share `need` signatures and
are in different components are checked, and a link unites them at once, so a task hands on at most one link less than
it has sets, never pairs. A unit too large for a task is cut into blocks: first each block by itself, then, where a
unit still holds several components, each pair of blocks. Where a unit has very many blocks there are further rounds
of leaders first. No link between different components is lost. Checks count the exact intersection.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm import shingles
from threadloom.llm.common import give_back, keep, partitions, ranges, small_batches, written
from threadloom.llm.components import components
from threadloom.llm.shingles import U, mix

PERCENT, WORDS = 80, 5
#: Bytes of text for one part of the signatures: about two million signatures, so some 100 MB in its task.
PART_BYTES = 24 << 20
#: From this k on, an instance has several parts, of three pieces each.
PARTS_FROM = 9


class PartEnum:
    """Bands, instances and their parameters for one similarity."""

    def __init__(self, percent: int):
        self.percent = percent
        self.growth = (100 / percent) ** 2
        self.last = [0]  # the largest size of each band; band i holds last[i-1] < size <= last[i], from 1

    def band(self, size: int) -> int:
        while self.last[-1] < size:
            low = self.last[-1] + 1
            # a linked partner is at least percent of a set: it must not reach over a band
            self.last.append(max(low, int(low * self.growth)))
        return int(np.searchsorted(self.last, size))

    def instances(self, size: int) -> list[int]:
        """Its own band's, and the next one's if a set there could link with one of this size."""
        i = self.band(size)
        least = self.last[i] + 1
        return [i, i + 1] if 100 * size >= self.percent * least else [i]

    def differ(self, band: int) -> int:
        self.band(self.last[-1] + 1) if band >= len(self.last) else None
        while band >= len(self.last):
            self.band(self.last[-1] + 1)
        return (100 - self.percent) * 2 * self.last[band] // (100 + self.percent)

    @lru_cache(maxsize=4096)  # noqa: B019
    def scheme(self, band: int) -> tuple[int, int, np.ndarray, np.ndarray]:
        """k, parts, subsets (pairs of pieces; all subsets of a part's), lower bounds of pieces."""
        k = self.differ(band)
        parts, pieces = (1, k + 3) if k < PARTS_FROM else (k // 2 + 2 + k // 40, 3)
        pairs = np.array(list(combinations(range(pieces), 2)))
        subsets = (pairs[None] + pieces * np.arange(parts)[:, None, None]).reshape(-1, 2)
        bounds = (np.arange(1, parts * pieces, dtype=object) * (1 << 64) // (parts * pieces)).astype(np.uint64)
        return k, parts, subsets, bounds

    @staticmethod
    def sure(parts: int, pieces: int, differ: int) -> int:
        """How many subsets are equal in two sets that differ in so many elements, at least. One part: every two of
        the pieces that agree. Parts of three pieces: a first difference in a part costs two of its three subsets, a
        second the third; so it is least when the differences are spread."""
        if parts == 1:
            return (pieces - differ) * (pieces - differ - 1) // 2
        return 3 * parts - 2 * differ if differ <= parts else 2 * parts - differ

    def signatures(self, s: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
        """(instance, need, signatures) of one sorted set.

        Linked sets share at least `need` subsets, empty ones included; of these a set with `e` empty subsets has
        need - e with content. If that is at least one, its empty ones are left out and its need is less by e; else it
        emits them too, and is sure of one. Of two linked sets the one with fewer empty subsets bounds how many they
        can share, so what both emit holds a common one in every case.
        """
        if not len(s):
            return []
        total = np.zeros(len(s) + 1, np.uint64)
        np.cumsum(mix(s + U(0x632BE59BD9B4E019)), out=total[1:])
        out = []
        for band in self.instances(len(s)):
            k, parts, subsets, bounds = self.scheme(band)
            if k == 0:
                continue  # only equal sets link
            # a partner is no larger than the band and the similarity allow, so these two may differ in less than k
            most = min(self.last[band], 100 * len(s) // self.percent)
            need = self.sure(parts, len(bounds) + 1, (100 - self.percent) * (len(s) + most) // (100 + self.percent))
            cut = np.concatenate(([0], np.searchsorted(s, bounds), [len(s)]))
            sums, sizes = total[cut[1:]] - total[cut[:-1]], np.diff(cut)
            sums, sizes = sums[subsets[:, 0]] + mix(sums[subsets[:, 1]] + U(1)), sizes[subsets].sum(1)
            tags, empty = np.arange(len(subsets), dtype=np.uint64), sizes == 0
            if need - int(empty.sum()) >= 1:
                sums, tags, need = sums[~empty], tags[~empty], need - int(empty.sum())
            else:
                need = 1
            out.append((band, need, mix(mix(sums + tags * U(0x9E3779B97F4A7C15)) + U(band))))
        return out


#: Documents whose signatures travel in one blob a part.
SIGNED = 1024


def _joined(batches):
    """Batches on end joined to some SIGNED rows or 4 MB."""
    import pyarrow as pa

    held: list = []
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) >= SIGNED or sum(x.nbytes for x in held) >= 4 << 20:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def _sign(percent: int, words: int, parts: int):
    """Texts to packed rows by part. A batch's blob for a part: keys, sizes and ids of documents dealt there, and
    signatures of sets as 8-byte hashes with the place of their set in a table of (id, instance, need)."""

    def run(batches):
        import pyarrow as pa

        scheme, done = keep("ngram_join", percent, lambda: PartEnum(percent)), set()
        for batch in _joined(batches):
            for at in range(0, batch.num_rows, SIGNED):
                b = batch.slice(at, SIGNED)
                sets = shingles.shingle_sets(b.column(1), words)
                ids = np.array([shingles.set_id(s) for s in sets], np.int64)
                sizes = np.array([len(s) for s in sets], np.int64)
                keys, null = b.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), np.array(b.column(0).is_null().to_pylist(), bool)
                heads, sigs, where = [], [], []
                for i, s in zip(ids.tolist(), sets, strict=True):
                    if i in done:  # copies in the task: 8 bytes a row of its are remembered
                        continue
                    done.add(i)
                    for band, need, sig in scheme.signatures(s):
                        where.append(np.full(len(sig), len(heads), np.uint32))
                        heads.append((i, band, need))
                        sigs.append(sig)
                sig = np.concatenate(sigs) if sigs else np.zeros(0, np.uint64)
                place = np.concatenate(where) if where else np.zeros(0, np.uint32)
                part = (sig >> U(32)).astype(np.int64) * parts >> 32
                order = np.argsort(part, kind="stable")
                # only parts that occur: what a batch costs doesn't follow their number
                occur = np.union1d(part, np.arange(min(parts, len(ids))))
                cuts = np.searchsorted(part[order], np.append(occur, parts))
                table = np.array(heads, np.int64).reshape(-1, 3)
                out: dict[str, list] = {"p": [], "heads": [], "sig": [], "place": [], "docs": []}
                for i, p in enumerate(occur.tolist()):
                    got = order[cuts[i] : cuts[i + 1]]
                    mine = np.arange(p, len(ids), parts)
                    used, again = np.unique(place[got], return_inverse=True)
                    out["p"].append(p)
                    out["heads"].append(table[used].tobytes())
                    out["sig"].append(sig[got].tobytes())
                    out["place"].append(again.astype(np.uint16).tobytes())
                    out["docs"].append(np.column_stack([keys[mine], null[mine], sizes[mine], ids[mine]]).astype(np.int64).tobytes())
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("p", pa.int32()), *[(c, pa.binary()) for c in ("heads", "sig", "place", "docs")]]))

    return run


#: Signatures that a part holds before those known to be shared are handed on.
HELD = 4_000_000


def _gather(batches):
    """A part's rows: documents (sig null), and the signatures that several sets have, with their sets.

    Whenever HELD signatures are held, the shared ones are handed on and one of each stays, marked as handed on; so
    memory follows the distinct signatures of a part, however many sets have one. A set whose copies come after such
    a flush may be handed on again, which only makes it look likelier.
    """
    import pyarrow as pa

    names = ["sig", "band", "need", "id", "k", "n"]
    new: dict[int, list] = {}
    held: dict[int, tuple] = {}
    count: dict[int, int] = {}

    def settle(p: int):
        """(sig, head) to hand on; the rest, and one of each signature handed on, is held."""
        blobs = [held.pop(p, (np.zeros(0, np.uint64), np.zeros((0, 3), np.int64), np.zeros(0, np.int32), np.zeros(0, bool))), *new.pop(p, [])]
        base = np.cumsum([0, *(len(b[1]) for b in blobs)]).astype(np.int32)
        sig, heads = np.concatenate([b[0] for b in blobs]), np.concatenate([b[1] for b in blobs])
        at = np.concatenate([b[2].astype(np.int32) + first for b, first in zip(blobs, base, strict=False)])
        sent = np.concatenate([blobs[0][3], np.zeros(len(sig) - len(blobs[0][3]), bool)])
        del blobs
        # one row for each signature and set, one handed on before others
        order = np.lexsort((~sent, heads[at, 0], sig))
        sig, at, sent = sig[order], at[order], sent[order]
        fresh = np.ones(len(sig), bool)
        fresh[1:] = (sig[1:] != sig[:-1]) | (heads[at[1:], 0] != heads[at[:-1], 0])
        sig, at, sent = sig[fresh], at[fresh], sent[fresh]
        first = np.ones(len(sig), bool)
        first[1:] = sig[1:] != sig[:-1]
        begin = np.flatnonzero(first)
        many = np.repeat(np.diff(np.append(begin, len(sig))) > 1, np.diff(np.append(begin, len(sig))))
        out = many & ~sent
        used, again = np.unique(at[first], return_inverse=True)
        held[p] = (sig[first], heads[used], again.astype(np.int32), (sent | many)[first])
        return sig[out], heads[at[out]]

    def rows(sig, head):
        for i in range(0, len(sig), 65536):
            s, h = sig[i : i + 65536].astype(np.int64), head[i : i + 65536]
            gap = pa.nulls(len(s), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(h[:, 1].astype(np.int32)), pa.array(h[:, 2].astype(np.int32)), pa.array(h[:, 0]), gap, gap], names)

    for b in batches:
        for p, heads, sig, place, docs in zip(*[b.column(i).to_pylist() for i in range(5)], strict=True):
            d = np.frombuffer(docs, np.int64).reshape(-1, 4)
            if len(d):
                gap, no = pa.nulls(len(d), pa.int64()), pa.nulls(len(d), pa.int32())
                yield pa.RecordBatch.from_arrays([gap, no, no, pa.array(d[:, 3], mask=d[:, 2] == 0), pa.array(d[:, 0], mask=d[:, 1] == 1), pa.array(d[:, 2])], names)
            new.setdefault(p, []).append((np.frombuffer(sig, np.uint64), np.frombuffer(heads, np.int64).reshape(-1, 3), np.frombuffer(place, np.uint16)))
            count[p] = count.get(p, 0) + len(new[p][-1][0])
            if count[p] > HELD:
                yield from rows(*settle(p))
                count[p] = len(held[p][0]) // 2
    for p in list(new):
        yield from rows(*settle(p))
        held.pop(p)
    give_back()


def _sets(words: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                sets = shingles.shingle_sets(batch.column(0).slice(at, 512), words)
                yield pa.RecordBatch.from_arrays([pa.array([shingles.set_id(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["id", "elements"])

    return run


def _linked(percent: int):
    def run(batches):
        import pyarrow as pa

        for b in batches:
            good = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * common >= percent * (len(x) + len(y) - common))
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], ["a", "b"])

    return run


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """pairs: a, b (ids). Those whose sets link, by exact intersection."""
    x = sets.select(F.col("id").alias("a"), F.col("elements").alias("x"))
    y = sets.select(F.col("id").alias("b"), F.col("elements").alias("y"))
    both = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")
    return both.mapInArrow(_linked(percent), "a long, b long")


#: Of a block of a unit: elements and sets aimed at; a pair of blocks is one task's memory.
BLOCK_ELEMENTS, BLOCK_SETS = 1 << 20, 2_000
#: A unit of more blocks gets a further round of leaders, as long as rounds leave a tenth fewer rows.
MANY_BLOCKS = 16


def _span(percent: int):
    """Links that unite the components of a block, or those of two blocks with each other's: sets that share as many
    signatures as both need are checked unless they are united already. At most one link less than there are sets."""

    def run(key, table):
        import pyarrow as pa

        across = key[1].as_py() != key[2].as_py()
        n, ids, block = table.num_rows, table.column("id").to_numpy(), table.column("block").to_numpy()
        root = np.unique(table.column("component").to_numpy(), return_inverse=True)[1]
        sets = [np.frombuffer(x, np.uint64) for x in table.column("elements").to_pylist()]
        size = np.array([len(x) for x in sets])
        begin = np.cumsum(size) - size
        element = np.unique(np.concatenate(sets), return_inverse=True)[1]
        del sets
        marks = table.column("marks").combine_chunks()
        owner = np.repeat(np.arange(n), marks.value_lengths().to_numpy())
        sig, band, need = (marks.flatten().field(c).to_numpy(zero_copy_only=False) for c in ("sig", "band", "need"))
        order = np.lexsort((owner, sig))
        posted, group = owner[order], np.empty(len(sig), np.int64)
        first = np.diff(sig[order], prepend=~sig[order][:1]) != 0
        group[order] = np.cumsum(first) - 1
        at = np.flatnonzero(first)
        long = np.diff(np.append(at, len(sig)))
        least = {b: np.full(n, np.iinfo(np.int64).max) for b in np.unique(band).tolist()}
        for b, wanted in least.items():
            np.minimum.at(wanted, owner[band == b], need[band == b])
        mine = np.searchsorted(owner, np.arange(n + 1))  # owner is ascending
        open_, flags, a, b = np.ones(n, bool), np.zeros(element.max(initial=-1) + 1, bool), [], []
        todo = list(range(n))[::-1]
        while todo and (root != root[0]).any():
            x = todo.pop()
            if not open_[x]:
                continue
            open_[x], own = False, slice(mine[x], mine[x + 1])
            able = open_ & (root != root[x])
            if across:
                able &= block != block[x]
            if not able.any():
                continue
            found = np.zeros(n, bool)
            for q in np.unique(band[own]).tolist():
                g = group[own][band[own] == q]
                common = np.bincount(posted[ranges(at[g], long[g])], minlength=n)
                found |= common >= np.maximum(least[q], least[q][x])
            near = np.flatnonzero(found & able)
            flags[element[begin[x] : begin[x] + size[x]]] = True
            upto = 0
            while upto < len(near):
                low, upto = upto, max(upto + 1, int(np.searchsorted(np.cumsum(size[near]), size[near[:upto]].sum() + BLOCK_ELEMENTS)))
                y = near[low:upto]
                y = y[root[y] != root[x]]
                if not len(y):
                    continue
                inside = np.cumsum(np.append(0, flags[element[ranges(begin[y], size[y])]]))
                stop = np.cumsum(size[y])
                shared = inside[stop] - inside[stop - size[y]]
                for z in y[100 * shared >= percent * (size[x] + size[y] - shared)].tolist():
                    todo.append(z)
                    if root[z] != root[x]:
                        a.append(ids[x])
                        b.append(ids[z])
                        root[root == root[z]] = root[x]
            flags[element[begin[x] : begin[x] + size[x]]] = False
        if size.sum() > BLOCK_ELEMENTS // 4:
            give_back()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _labelled(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """shared with the component of each set; a set without a link is its own."""
    return shared.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))


def _lead(shared: DataFrame, turn: int) -> DataFrame:
    """a, b: each set with the set of another component that leads most of its buckets. Every turn has other leaders."""
    first = F.struct(F.xxhash64("id", F.lit(turn)).alias("h"), "id", "component")
    lead = shared.groupBy("sig").agg(F.min(first).alias("l")).select("sig", F.col("l.id").alias("lead"), F.col("l.component").alias("other"))
    votes = shared.join(lead, "sig").where("component <> other").groupBy("id", "lead").agg(F.count(F.lit(1)).alias("c"))
    return votes.groupBy("id").agg(F.max_by("lead", F.struct("c", -F.col("lead"))).alias("lead")).select(F.col("id").alias("a"), F.col("lead").alias("b"))


def _units(rest: DataFrame, sets: DataFrame) -> DataFrame:
    """unit, id, component, marks (all open signatures of the set), elements, blocks (of the unit), block. rest: sig,
    lead, band, need, id, component. A unit is the sets that share a bucket led by one set; a set is in as many units
    as its buckets have leaders, which are few, since of any two buckets with the same sets one set leads both."""
    spark = rest.sparkSession
    marks = rest.groupBy("id").agg(F.first("component").alias("component"), F.collect_list(F.struct("sig", "band", "need")).alias("marks"))
    own = written(spark, marks.join(sets, "id"), "open")
    member = rest.select("id", F.col("lead").alias("unit")).distinct().join(own.select("id", (F.octet_length("elements") / 8).alias("elements")), "id")
    size = member.groupBy("unit").agg(F.sum("elements").alias("elements"), F.count(F.lit(1)).alias("sets"))
    blocks = F.ceil(F.greatest(F.col("elements") / BLOCK_ELEMENTS, F.col("sets") / BLOCK_SETS)).cast("int")
    member = written(spark, member.select("id", "unit").join(size.select("unit", blocks.alias("blocks")), "unit"), "units")
    return member.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks")).cast("int")).join(own, "id")


_UNIT = ["unit", "left", "right", "id", "component", "block", "elements", "marks"]


def jaccard_classes(docs: DataFrame, percent: int = PERCENT, words: int = WORDS, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(members, links): members has a row per row of docs: key, n_shingles, set_id (of its class of equal sets; null
    when empty), component_id (the smallest key reachable by links, its own included). links: a, b: class ids that
    were found linked; they span every component, copies and implied pairs are not expanded.

    Null and empty texts and texts without words have no shingles, link with nothing, and are their own component.
    A null key counts only where a component has no other; repeated rows are members alike. Very long texts are
    treated whole; an empty table gives empty results; further columns are ignored.
    """
    with small_batches(docs.sparkSession):  # all tables are written here; what is returned has no Python
        return _classes(docs, percent, words, key, text)


def _classes(docs: DataFrame, percent: int, words: int, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("x"))
    size = rows.agg(F.sum(F.octet_length("x"))).first()[0] or 0
    parts = max(partitions(spark), size // PART_BYTES)
    packed = rows.mapInArrow(_sign(percent, words, parts), "p int, heads binary, sig binary, place binary, docs binary")
    facts = packed.repartition(parts, "p").mapInArrow(_gather, "sig long, band int, need int, id long, k long, n long")
    facts = written(spark, facts, "signatures")
    members = facts.where("sig is null").select("k", "n", "id")
    shared = facts.where("sig is not null").select("sig", "band", "need", "id")

    # documents sure of fewer shared signatures than a link needs are out
    enough = shared.groupBy("band", "id").agg(F.count(F.lit(1)).alias("c"), F.max("need").alias("need")).where("c >= need").select("band", "id")
    alive = written(spark, shared.join(enough, ["band", "id"]).select("sig", "band", "need", "id"), "alive")
    classes = members.where("id is not null").groupBy("id").agg(F.min("k").alias("k"))

    wanted = alive.select("id").distinct().join(classes, "id").select(F.col("k").alias("wk")).distinct()
    found = rows.join(wanted, F.col("k").eqNullSafe(F.col("wk")), "left_semi").select("x").mapInArrow(_sets(words), "id long, elements binary")
    sets = written(spark, found.dropDuplicates(["id"]), "sets")

    links, labels, turn, before = None, spark.createDataFrame([], "node long, component long"), 0, None
    while True:
        # each set against the set that leads most of its buckets
        found = written(spark, verify(_lead(_labelled(alive, labels), turn), sets, percent), "links")
        links = found if links is None else links.unionByName(found)
        labels = components(links)
        # buckets that still hold several components
        named = _labelled(alive, labels)
        first = F.min(F.struct(F.xxhash64("id", F.lit(turn)).alias("h"), "id"))
        open_ = named.groupBy("sig").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), first.alias("l")).where("lo <> hi").select("sig", F.col("l.id").alias("lead"))
        rows = _units(written(spark, named.join(open_, "sig"), "rest"), sets)
        most, left = rows.agg(F.max("blocks"), F.count(F.lit(1))).first()
        turn += 1
        if (most or 0) <= MANY_BLOCKS or (before is not None and left > 0.9 * before):
            break
        before = left

    # each block by itself, then those of a unit with each other where it still has several components
    alone = rows.withColumns({"left": F.col("block"), "right": F.col("block")}).select(*_UNIT)
    links = links.unionByName(written(spark, alone.groupBy("unit", "left", "right").applyInArrow(_span(percent), "a long, b long"), "links"))
    labels = components(links)
    if (most or 0) > 1:
        rows = _labelled(rows.where("blocks > 1").drop("component"), labels)
        still = rows.groupBy("unit").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("unit")
        others = F.transform(F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: o != F.col("block")), lambda o: F.struct(F.least("block", o).alias("left"), F.greatest("block", o).alias("right")))
        dealt = rows.join(still, "unit", "left_semi").withColumn("of", F.explode(others)).withColumns({"left": F.col("of.left"), "right": F.col("of.right")}).select(*_UNIT)
        links = links.unionByName(written(spark, dealt.groupBy("unit", "left", "right").applyInArrow(_span(percent), "a long, b long"), "links"))
        labels = components(links)

    placed = classes.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = placed.groupBy("component").agg(F.min("k").alias("least"))
    mapping = placed.join(least, "component").select(F.col("id").alias("mid"), "least")
    out = members.join(mapping, F.col("id") == F.col("mid"), "left")
    component = F.when(F.col("id").isNull(), F.col("k")).otherwise(F.col("least"))
    return out.select(F.col("k").alias(key), F.col("n").alias("n_shingles"), F.col("id").alias("set_id"), component.alias("component_id")), links
