"""A trie of conversations' turns, built by pointer dictionaries inside tasks.

A turn is a digest of its role and text and the bytes of its text; a conversation is the list of its turns. Equal
conversations are counted once with a weight. The tries below each first turn are dealt to tasks by a hash of that
turn. A first turn whose conversations have more turns than a task should hold is opened: the way that all of them share
is a spine of nodes without branches, and what hangs below is dealt by the next turn, again and again until all parts
are small. Tasks send the tops of their tries on; spines get their sums from these, from the deepest round upwards.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.llm.common import partitions, written

#: Turns of different conversations that a task's tries hold, about: some 300 bytes each.
MOST_TURNS = 20_000
#: Conversations begin with turns of the first of so many, up to a hash modulo another (fixed values of the contract).
FAMILY, SHARED_MOST = 5, 9
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
_l, _s, _b = T.LongType(), T.StringType(), T.BinaryType()
NODES = T.StructType([T.StructField(c, t) for c, t in {"conv_id": _l, "depth": _l, "parent_conv_id": _l, "n_convs": _l, "n_children": _l, "n_leaves": _l, "saved_tokens": _l, "ends_sha256": _s, "under": _s}.items()])


def conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """c, t: each conversation's turns (digest d, bytes n) in order.

    Turns without a number come first, equal numbers by digest; repeated rows are turns too; null roles and texts count
    as empty; rows without a conversation have no part. Texts don't leave their tasks: a turn is 16 bytes and a length.
    """
    r, x = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.octet_length(r).cast("string"), F.lit(":"), r, x).cast("binary")))
    one = rows.where(F.col(conv).isNotNull()).select(F.col(conv).cast("long").alias("c"), F.struct(F.col(turn).cast("long").alias("turn"), digest.alias("d"), F.octet_length(x).cast("long").alias("n")).alias("e"))
    return one.groupBy("c").agg(F.transform(F.sort_array(F.collect_list("e")), lambda e: F.struct(e["d"].alias("d"), e["n"].alias("n"))).alias("t"))


def rebuilt(own: DataFrame) -> DataFrame:
    """c, d, n: each conversation with its first turns replaced by those of its family's first."""
    first = own.select(F.col("c").alias("base"), F.col("t").alias("base_t"))
    h = (F.crc32(F.col("c").cast("string").cast("binary")) % SHARED_MOST).cast("int")
    joined = own.join(first, F.col("c") - F.col("c") % FAMILY == F.col("base"), "left").withColumn("h", h)
    head = F.when(F.col("base_t").isNotNull(), F.slice("base_t", F.lit(1), F.col("h")))
    tail = F.slice("t", F.col("h") + 1, F.greatest(F.size("t") - F.col("h"), F.lit(0)))
    t = F.when(head.isNull(), tail).otherwise(F.concat(head, tail))
    return joined.select("c", t.alias("t")).select("c", F.col("t.d").alias("d"), F.col("t.n").alias("n"))


def _ends(it):
    """Rows (key, c) sorted by both: each key's conversations, their least and their digest, without holding them."""
    import pyarrow as pa

    def table(found):
        cols = list(zip(*found, strict=True)) if found else [[], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cols, (pa.binary(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["key", "least", "w", "ends"])

    key, least, w, state, found = None, 0, 0, None, []
    for b in it:
        for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if k != key:
                if state is not None:
                    found.append((key, least, w, state.hexdigest()))
                key, least, w, state = k, c, 1, hashlib.sha256(str(c).encode())
            else:
                state.update(f",{c}".encode())
                w += 1
        yield table(found)
        found = []
    if state is not None:
        yield table([(key, least, w, state.hexdigest())])


def distinct_sequences(convs: DataFrame) -> DataFrame:
    """conv, w, ends, d, n: each sequence once, with its least conversation, how many have it, and the digest of their
    ids. Equal conversations meet in one task as ids alone, which it reads in order and doesn't hold."""
    spark = convs.sparkSession
    keyed = convs.select(F.unhex(F.md5(F.array_join(F.transform("d", F.hex), "").cast("binary"))).alias("key"), "c")
    ends = keyed.repartition(partitions(spark), "key").sortWithinPartitions("key", "c").mapInArrow(_ends, "key binary, least long, w long, ends string")
    return convs.join(ends, F.col("c") == F.col("least")).select(F.col("c").alias("conv"), "w", "ends", "d", "n")


def _shared(lo: Column, hi: Column) -> Column:
    """How many turns the first and the last of sorted sequences share, and so all between."""
    at = F.array_position(F.zip_with(lo, hi, lambda a, b: a.eqNullSafe(b)), False)
    return F.when(at == 0, F.size(lo)).otherwise(at.cast("int") - 1)


def _tries(rows: pd.DataFrame) -> pd.DataFrame:
    """The tries of a task. A node is a place in lists; a dictionary leads from (its parent, a turn) to it. Nodes come
    after their parents, so going backwards meets children first: sums need no recursion."""
    child: dict[tuple, int] = {}
    parent, top, depth, conv, above, count, size, ends, heirs, leaves = [], [], [], [], [], [], [], [], [], []
    for under, at, pconv, c, w, end, d, n in zip(*[rows[x] for x in ("under", "at", "pconv", "conv", "w", "ends", "d", "n")], strict=True):
        here: int | str = under
        for i in range(at, len(d)):
            node = child.get((here, d[i]))
            if node is None:
                node = child[here, d[i]] = len(parent)
                is_top = isinstance(here, str)
                parent.append(-1 if is_top else here)
                top.append(under if is_top else None)
                depth.append(i + 1)
                conv.append(c)
                above.append(pconv)
                count.append(0)
                size.append(int(n[i]))
                ends.append(EMPTY_SHA)
                heirs.append(0)
                leaves.append(0)
                if not is_top:
                    heirs[here] += 1
            conv[node] = min(conv[node], c)
            count[node] += w
            here = node
        ends[here] = end
    saved = [(k - 1) * s for k, s in zip(count, size, strict=True)]
    for i in range(len(parent) - 1, -1, -1):
        leaves[i] = leaves[i] or 1
        if (p := parent[i]) >= 0:
            leaves[p] += leaves[i]
            saved[p] += saved[i]
    own = [above[i] if p < 0 else conv[p] for i, p in enumerate(parent)]
    return pd.DataFrame({"conv_id": conv, "depth": depth, "parent_conv_id": own, "n_convs": count, "n_children": heirs, "n_leaves": leaves, "saved_tokens": saved, "ends_sha256": ends, "under": top})


def _spines(it):
    """The nodes of spines: all but the last have one child, and sums run from the last one upwards."""
    for rows in it:
        for r in rows.itertuples(index=False):
            depth = np.arange(r.at, r.to + 1)
            size = np.where(depth > 0, np.asarray(r.sizes, np.int64)[depth - 1] if len(r.sizes) else 0, 0)
            saved = r.saved + np.cumsum(((r.count_all - 1) * size)[::-1])[::-1]
            last = depth == r.to
            above = [r.pconv if d == r.at else r.least for d in depth]
            yield pd.DataFrame({
                "conv_id": r.least, "depth": depth, "parent_conv_id": pd.array([None if pd.isna(p) else int(p) for p in above], "Int64"), "n_convs": r.count_all, "n_children": np.where(last, r.n_children, 1),
                "n_leaves": r.n_leaves, "saved_tokens": saved, "ends_sha256": np.where(last, r.ends or EMPTY_SHA, EMPTY_SHA),
            })


def prefix_trie(seqs: DataFrame, most_turns: int = MOST_TURNS) -> DataFrame:
    """A row for each node of the trie over sequences (conv, w, ends, d, n as of `distinct_sequences`), and for the root.

    No sequences give no node. A sequence is one row of digests; everything else is split by turns.
    """
    spark = seqs.sparkSession
    opened = written(spark, seqs.select(F.lit("").alias("g"), F.lit(0).alias("at"), F.lit(None).cast("string").alias("under"), F.lit(None).cast("long").alias("pconv"), "conv", "w", "ends", "d", "n"), "trie-rows")
    turns = opened.agg(F.sum(F.size("d"))).first()[0] or 0
    groups, small = [], []
    while True:
        found = opened.groupBy("g", "at", "under", "pconv").agg(F.min(F.struct("d", "n")).alias("lo"), F.max("d").alias("hi"), F.sum("w").alias("count_all"), F.min("conv").alias("least"))
        shared = F.when(F.col("g") == "", 0).otherwise(_shared(F.col("lo.d"), F.col("hi")))
        found = written(spark, found.select("g", "at", "under", "pconv", "count_all", "least", shared.alias("to"), F.col("lo.n").alias("sizes")), "trie-groups")
        rows = opened.drop("at", "under", "pconv").join(found.select("g", "to", "least"), "g")
        # what goes on below the spine, by its next turn
        rows = rows.withColumn("next", F.when(F.size("d") > F.col("to"), F.md5(F.concat(F.col("g"), F.hex(F.get("d", F.col("to"))), F.col("to").cast("string")).cast("binary"))))
        sizes = rows.where("next is not null").groupBy("next").agg(F.sum(F.size("d") - F.col("to")).alias("turns")).where(F.col("turns") > most_turns)
        rows = written(spark, rows.join(sizes.select("next", F.lit(True).alias("large")), "next", "left"), "trie-rows")
        ended = rows.where("next is null").select("g", "ends")
        groups.append(found.join(ended, "g", "left"))
        small.append(rows.where("next is not null and large is null").select("next", F.col("g").alias("under"), F.col("to").alias("at"), F.col("least").alias("pconv"), "conv", "w", "ends", "d", "n"))
        large = rows.where("large")
        if large.isEmpty():
            break
        opened = large.select(F.col("next").alias("g"), (F.col("to") + 1).alias("at"), F.col("g").alias("under"), F.col("least").alias("pconv"), "conv", "w", "ends", "d", "n")
    below = small[0]
    for more in small[1:]:
        below = below.unionByName(more)
    buckets = max(1, -(-turns // most_turns))
    dealt = below.withColumn("bucket", F.pmod(F.xxhash64("next"), F.lit(buckets))).repartition(max(partitions(spark), min(buckets, 20_000)), "bucket")
    nodes = written(spark, dealt.groupBy("bucket").applyInPandas(_tries, NODES), "trie-nodes")
    tops = nodes.where("under is not null").select("under", "n_leaves", "saved_tokens")
    out = nodes.drop("under")
    for found in reversed(groups):
        # sums of what hangs below, then of the spine from its end upwards
        sums = tops.groupBy(F.col("under").alias("g")).agg(F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved"))
        done = found.join(sums, "g", "left").select("g", "at", "under", "pconv", "count_all", "least", "to", "sizes", "ends", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"), F.coalesce("saved", F.lit(0)).cast("long").alias("saved"))
        done = written(spark, done.withColumn("saved_top", F.col("saved") + (F.col("count_all") - 1) * F.aggregate(F.slice("sizes", F.greatest("at", F.lit(1)), F.greatest(F.col("to") - F.greatest("at", F.lit(1)) + 1, F.lit(0))), F.lit(0).cast("long"), lambda s, n: s + n)), "trie-spines")
        out = out.unionByName(done.mapInPandas(_spines, T.StructType(NODES.fields[:-1])))
        # of each round only the tops that hang below the next one matter there
        tops = tops.unionByName(done.where("under is not null").select("under", "n_leaves", F.col("saved_top").alias("saved_tokens")))
    return out
