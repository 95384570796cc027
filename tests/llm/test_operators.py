"""Each operator against brute force or a library on small fixtures, with nulls, empties, repeats and clashing columns."""

import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from threadloom.llm import byte_bpe, fingerprints, line_dedup, mixing, ngram_join, token_cache, token_files, topk_search, toxicity, url_filter
from threadloom.llm.common import shared_dir

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = " ".join(f"w{i}" for i in range(60))
TEXTS = [
    (0, BASE, "a"), (1, BASE, "b"), (2, BASE.replace("w30", "x"), "a"), (3, "a b c", None), (4, "A  B\nC", "a"), (5, "", "b"), (6, None, "b"), (7, "  \t", "c"), (8, "l1\nshared line\nl2", "a"), (9, "m1\nshared line", "b"),
    (10, "Don't we'll 'tis it's  x\n\n y", "c"), (11, "é漢字 ١٢ <|endoftext|> 😀\r\n", "c"), (12, "z " * 3000, "a"), (13, BASE, "c"),
]
SCHEMA = "doc_id long, text string, source string, id long, size string, component_id string"


@pytest.fixture(scope="module")
def docs(spark):
    # columns whose names clash with those used inside
    return spark.createDataFrame([(*t, 1, "s", "c") for t in TEXTS], SCHEMA).repartition(3)


def empty(docs):
    return docs.limit(0)


def sets_of():
    out = {}
    for k, t, _ in TEXTS:
        w = WORD.findall((t or "").lower())
        out[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return out


def test_ngram_join(docs):
    members, links = ngram_join.jaccard_classes(docs)
    sets, least = sets_of(), {}
    for k, s in sets.items():
        linked = [j for j, x in sets.items() if s and x and 100 * len(s & x) >= 80 * len(s | x)]
        least[k] = min(linked, default=k)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in members.collect()} == {k: (len(s), least[k]) for k, s in sets.items()}
    assert links.count() == 1
    assert ngram_join.jaccard_classes(empty(docs))[0].count() == 0


def test_signatures_lose_no_link():
    rng, scheme = random.Random(3), ngram_join.PartEnum(80)
    for _ in range(400):
        n = rng.randint(5, 400)
        a = [rng.getrandbits(64) for _ in range(n)]
        b = a[: n - rng.randint(0, n // 9)] + [rng.getrandbits(64) for _ in range(rng.randint(0, n // 9))]
        common, union = len(set(a) & set(b)), len(set(a) | set(b))
        if 100 * common >= 80 * union and set(a) != set(b):
            x, y = ({(band): (need, set(sig.tolist())) for band, need, sig in scheme.signatures(np.unique(np.array(s, np.uint64)))} for s in (a, b))
            assert any(len(x[i][1] & y[i][1]) >= max(x[i][0], y[i][0]) for i in x.keys() & y.keys())


def test_signing_does_not_follow_the_parts():
    """A batch is dealt to the parts that occur in it, however many there are; the rows are the same."""
    import time

    import pyarrow as pa

    rng = random.Random(8)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(5000)], k=60)) for _ in range(200)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(200), pa.int64()), pa.array(texts)], ["k", "x"])
    took, sigs = {}, {}
    for parts in (16, 16, 1_000_000):
        began = time.process_time()
        (got,) = list(ngram_join._sign(80, 5, parts)(iter([batch])))
        took[parts] = time.process_time() - began
        rows = got.to_pylist()
        sigs[parts] = sorted(x for r in rows for x in np.frombuffer(r["sig"], np.uint64).tolist())
        assert len({r["p"] for r in rows}) == len(rows) and all((int(x) >> 32) * parts >> 32 == r["p"] for r in rows for x in np.frombuffer(r["sig"], np.uint64))
        assert sorted(int(x) for r in rows for x in np.frombuffer(r["docs"], np.int64).reshape(-1, 4)[:, 0]) == list(range(200))
    assert sigs[16] == sigs[1_000_000] and took[1_000_000] < 5 * took[16] + 2


def unit(sets, components=None, blocks=None):
    """The rows of a family's task."""
    import pyarrow as pa

    scheme, n = ngram_join.PartEnum(80), len(sets)
    marks = [[{"sig": int(x), "band": band, "need": need} for band, need, sig in scheme.signatures(s) for x in sig.astype(np.int64)] for s in sets]
    kind = pa.list_(pa.struct([("sig", pa.int64()), ("band", pa.int32()), ("need", pa.int32())]))
    return pa.table({"id": list(range(n)), "component": components or list(range(n)), "block": blocks or [0] * n, "elements": [s.tobytes() for s in sets], "marks": pa.array(marks, kind)})


def spanned(n, pairs):
    root = list(range(n))
    for a, b in pairs:
        root = [root[a] if r == root[b] else r for r in root]
    return root


def near_sets(rng, groups=12, size=120):
    """Groups whose sets link in chains, and sets that are near but not linked."""
    out = []
    for _ in range(groups):
        base = rng.integers(0, 1 << 64, size, np.uint64)
        for _ in range(rng.integers(2, 30)):
            s = base.copy()
            swap = rng.random(size) < rng.uniform(0, 0.3)
            s[swap] = rng.integers(0, 1 << 64, int(swap.sum()), np.uint64)
            out.append(np.unique(s))
            if rng.random() < 0.4:
                base = s
    return list({s.tobytes(): s for s in out}.values())


def true_links(sets):
    return [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(c := np.intersect1d(sets[i], sets[j])) >= 80 * (len(sets[i]) + len(sets[j]) - len(c))]


@pytest.mark.parametrize("seed", range(4))
def test_span_unites_what_links(seed):
    import pyarrow as pa

    sets = near_sets(np.random.default_rng(seed))
    n, links = len(sets), true_links(sets)
    key = lambda l, r: (pa.scalar(0), pa.scalar(l), pa.scalar(r))
    got = [(r["a"], r["b"]) for r in ngram_join._span(80)(key(0, 0), unit(sets)).to_pylist()]
    want = spanned(n, links)
    assert len(got) < n and {tuple(sorted(p)) for p in got} <= {tuple(sorted(p)) for p in links}
    classes = lambda root: {frozenset(i for i in range(n) if root[i] == r) for r in root}
    assert classes(spanned(n, got)) == classes(want) and len(links) > len(got)
    # in two blocks: each by itself, then one with the other
    half = [i % 2 for i in range(n)]
    parts = []
    for h in (0, 1):
        own = [i for i in range(n) if half[i] == h]
        parts += [(own[r["a"]], own[r["b"]]) for r in ngram_join._span(80)(key(h, h), unit([sets[i] for i in own])).to_pylist()]
    root = spanned(n, parts)
    parts += [(r["a"], r["b"]) for r in ngram_join._span(80)(key(0, 1), unit(sets, root, half)).to_pylist()]
    assert classes(spanned(n, parts)) == classes(want)


def test_span_of_very_long_sets():
    import pyarrow as pa

    # two sets of 240,000 shingles that differ in five, and one that is far
    rng = np.random.default_rng(6)
    a = np.unique(rng.integers(0, 1 << 64, 240_000, np.uint64))
    b = np.sort(np.concatenate([a[5:], rng.integers(0, 1 << 64, 5, np.uint64)]))
    c = np.sort(np.concatenate([a[60_000:], rng.integers(0, 1 << 64, 60_000, np.uint64)]))
    got = ngram_join._span(80)((pa.scalar(0), pa.scalar(0), pa.scalar(0)), unit([a, b, c])).to_pylist()
    assert [{r["a"], r["b"]} for r in got] == [{0, 1}]


def test_ngram_join_by_blocks(spark, monkeypatch):
    """Chains, near sets that don't link, copies, families of many blocks and several rounds of leaders."""
    for name, value in (("BLOCK_SETS", 7), ("BLOCK_ELEMENTS", 2_000), ("MANY_BLOCKS", 2), ("HELD", 500)):
        monkeypatch.setattr(ngram_join, name, value)
    rng = np.random.default_rng(9)
    sets = near_sets(rng, groups=4, size=60)
    texts = [" ".join(f"w{x % 100_000}" for x in rng.permutation(s)[:60]) for s in sets]
    base = texts[0].split()
    for i in range(40):  # texts that link in chains
        base = base[:]
        base[rng.integers(0, len(base))] = f"y{i}"
        texts.append(" ".join(base))
    texts += texts[:20]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, "alone in the world of words"), (3, "a key that comes twice, with another text")]
    members, links = ngram_join.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    got = members.collect()
    shingled = []
    for _, t in rows:
        w = WORD.findall(t.lower())
        shingled.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    root = spanned(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if 100 * len(shingled[i] & shingled[j]) >= 80 * len(shingled[i] | shingled[j])])
    least = {r: min((rows[i][0] for i in range(len(rows)) if root[i] == r and rows[i][0] is not None), default=None) for r in root}
    want = sorted(((k, len(s), least[r]) for (k, _), s, r in zip(rows, shingled, root, strict=True)), key=str)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == want
    assert links.count() < len(rows) * 4


def test_url_filter(spark):
    urls = ["https://A.Example.NET/en/x", "http://example.net/de/", "http://net", "https://x.org/fr/1?q#f", "ftp://example.com/de/a", "none", None, "", "http://badnet/", "http://example.net/en/x"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), (None, "/", "block")], "host string, path string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages, rules).collect()}
    assert got[0] == ("a.example.net", "/en/x", "example.net/en/", "allow") and got[1] == ("example.net", "/de/", "net/", "block") and got[2] == ("net", "", None, "allow")
    assert got[3][2:] == ("org/fr/", "allow") and got[4][2:] == ("example.com/de/", "block") and got[5] == got[6] == got[7] == ("", "", None, "allow") and got[8][2] is None
    assert url_filter.filter_urls(pages.limit(0), rules).count() == 0


def test_fingerprints(docs, spark):
    rows = {r.doc_id: r for r in fingerprints.edit_likeness(docs).collect()}
    order = [t or "" for _, t, _ in TEXTS]
    import hashlib

    for i, t in enumerate(order):
        q = len(t) // 4
        e = t[: len(t) - q] + order[(i + 1) % len(order)][:q]
        assert rows[i].n_chars == len(t) and rows[i].edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
    assert rows[0].fingerprint == rows[1].fingerprint != rows[2].fingerprint and rows[0].near_next == 1.0 and 0.5 < rows[0].near_edited
    a, b = (fingerprints.fingerprint(spark.createDataFrame([(1, t)], "doc_id long, text string")) for t in ("p\nq\nr", "p\nx\nr\ns"))
    assert tuple(fingerprints.locate_edits(a, b).first())[1:] == (False, [1, 3], [1])
    c, d = (fingerprints.fingerprint(spark.createDataFrame([(1, t)], "doc_id long, text string")) for t in ("\n".join(f"p {i}" for i in range(90)), "\n".join(["p 0", "put in", *(f"p {i}" for i in range(1, 90))])))
    assert tuple(fingerprints.locate_edits(c, d).first())[1:] == (False, [1], []) and tuple(fingerprints.locate_edits(c, c).first())[1:] == (True, [], [])
    assert fingerprints.edit_likeness(empty(docs)).count() == 0


def test_likeness_by_descent(spark):
    """Against sets of leaf digests: repeated spans and paragraphs, edits in several sections, equal texts, empty ones."""
    import hashlib

    rng = random.Random(11)
    lines = [" ".join(rng.choices("a b c d e".split(), k=rng.randint(0, 14))) for _ in range(120)]
    texts = []
    for _ in range(25):
        own = rng.choices(lines, k=rng.randint(0, 70))
        other = [x if rng.random() < 0.8 else rng.choice(lines) for x in own]
        if other and rng.random() < 0.5:
            other.insert(rng.randrange(len(other)), rng.choice(lines))
        texts.append(("\n".join(own), "\n".join(other)))
    texts += [("", ""), ("a b", "a b"), ("", "a")]

    def leaves(t):
        return {hashlib.md5(x.encode()).hexdigest()[: fingerprints.SHORT] for p in t.split("\n") for x in re.findall(r"(?:[^ ]* ){0,3}[^ ]*(?: |$)", p) if x}

    want = {}
    for i, (a, b) in enumerate(texts):
        x, y = leaves(a), leaves(b)
        want[i] = 2 * len(x & y) / (len(x) + len(y)) if x or y else 1.0
    df = fingerprints.with_trees(spark.createDataFrame([(i, *t) for i, t in enumerate(texts)], "i long, a string, b string"), {"a": "x", "b": "y"})
    got = {r.i: r.like for r in fingerprints.with_likeness(df, "x", "y", "like").select("i", "like").collect()}
    assert got == pytest.approx(want)


def test_token_files(docs, spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path := P.path("byte_bpe_50k.json"))
    manifest = token_files.write_token_files(docs, path, folder := shared_dir(spark, "files"), 2)
    rows = {r.k: r for r in token_files.with_starts(token_files.read_token_files(manifest), manifest).collect()}
    start = 0
    for k, x, _ in TEXTS:
        ids = t.encode(x or "", add_special_tokens=False).ids + [2]
        assert (rows[k].start, rows[k].n_tokens, rows[k].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    got = token_files.fetch(manifest, spark.createDataFrame([(3,), (12,), (99,)], "doc_id long")).collect()
    assert {r.doc_id: r.ids for r in got} == {k: t.encode(TEXTS[k][1], add_special_tokens=False).ids + [2] for k in (3, 12)}
    shard = manifest.first().path.removeprefix("file://")
    data = bytearray(open(shard, "rb").read())
    data[8] ^= 255
    import io

    with pytest.raises(Exception):
        list(token_files.ShardReader(io.BytesIO(bytes(data))).documents())
    assert token_files.round_trip(empty(docs), path, folder + "-none", 2).count() == 0


def test_token_files_of_odd_texts(spark, monkeypatch):
    """Whole batches against the library: white space of all kinds, added tokens, long chunks, a small memory, null and
    repeated keys, a long text; and a task that runs twice leaves one shard that the manifest names."""
    from tokenizers import Tokenizer

    from threadloom.llm import chunks

    path, rng = P.path("byte_bpe_50k.json"), random.Random(2)
    parts = ["a", "B", "é", "1", "٣", " ", "  ", "\n", "\t", "'", "'s", " 'll", "!", "\u3000", "漢", "\0", "\x1c", "😀", "\r\n", "word", "Ärger", ", ", "<|endoftext|>", "\xa0", ".", "\u2003", "\x85", "x" * 70]
    odd = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(2500)]
    own = Tokenizer.from_file(path)
    want = [e.ids for e in own.encode_batch(odd, add_special_tokens=False)]
    for memo, size in ((2_000_000, 1 << 20), (300, 2_000)):
        monkeypatch.setattr(chunks, "MEMO", memo)
        monkeypatch.setattr(chunks, "SLICE", size)
        encoder = token_files.ChunkEncoder(path, 2)
        for _ in range(2):
            assert [np.frombuffer(x, "<u2").tolist() for x in encoder.encode_packed(odd)] == want
    long = " ".join(rng.choices(odd, k=60_000))
    rows = [(1, "b a"), (1, "a b"), (1, "a b"), (None, "x"), (None, None), (0, long)]
    df = spark.createDataFrame([(k, t, 1, "p") for k, t in rows], "doc_id long, text string, n_tokens long, shard string")
    manifest = token_files.write_token_files(df, path, shared_dir(spark, "files"), 2, shards=3)
    got = [(r.k, r.n_tokens) for r in token_files.with_starts(token_files.read_token_files(manifest), manifest).orderBy("start").collect()]
    size = lambda t: len(own.encode(t or "", add_special_tokens=False).ids) + 1
    assert got[0] == (0, size(long)) and [k for k, _ in got] == [0, 1, 1, 1, None, None] and sorted(n for _, n in got) == sorted(size(t) for _, t in rows)
    # shards closed by size: in one task many, in order
    small = token_files.write_token_files(df, path, shared_dir(spark, "files"), 2, shards=1, most_docs=2)
    starts = [(r.k, r.start, r.n_tokens) for r in token_files.with_starts(token_files.read_token_files(small), small).orderBy("start").collect()]
    assert small.count() == 3 and [k for k, _, _ in starts] == [0, 1, 1, 1, None, None] and [s for _, s, _ in starts] == [sum(n for _, _, n in starts[:i]) for i in range(6)]
    assert {r.doc_id: len(r.ids) for r in token_files.fetch(small, spark.createDataFrame([(0,)], "doc_id long")).collect()} == {0: size(long)}
    names = {r.path for r in manifest.collect()}
    again = token_files.write_token_files(df, path, next(iter(names)).rpartition("/")[0], 2, shards=3)
    assert names.isdisjoint(r.path for r in again.collect()) and token_files.read_token_files(manifest).count() == 6


def test_token_cache(docs, spark):
    from tokenizers import Tokenizer

    t, cache = Tokenizer.from_file(path := P.path("word_bpe_49k.json")), shared_dir(spark, "cache")
    want = {k: len(t.encode(x or "", add_special_tokens=False).ids) for k, x, _ in TEXTS}
    for _ in range(2):
        got = token_cache.count_tokens(docs, path, cache)
        assert {r.doc_id: r.n_tokens for r in got.collect()} == want
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("digest").distinct().count()  # the second run appended nothing


def test_token_cache_is_asked_first(spark):
    """Stored counts are used as they are, for the same tokenizer only; equal content but for white space hits."""
    from tokenizers import Tokenizer

    path, cache = P.path("word_bpe_49k.json"), shared_dir(spark, "cache")
    texts = [f"document number {i} of the second kind" for i in range(40)]
    docs = spark.createDataFrame([(i, t, "c", i) for i, t in enumerate(texts)] + [(40, "  document\nnumber 0 of  the second kind", "c", 1), (None, None, "c", 1), (41, "", "c", 2)], "doc_id long, text string, digest string, n_tokens long")
    token_cache.count_tokens(docs.where("doc_id < 20"), path, cache).count()
    stored = spark.read.parquet(cache)
    warm, other = shared_dir(spark, "cache"), "0" * 64
    stored.withColumn("n_tokens", F.lit(1000).cast("long")).unionByName(stored.withColumns({"tokenizer": F.lit(other), "n_tokens": F.lit(5).cast("long")})).write.parquet(warm)
    got = {r.doc_id: r.n_tokens for r in token_cache.count_tokens(docs, path, warm).collect()}
    own = Tokenizer.from_file(path)
    count = lambda t: len(own.encode(t or "", add_special_tokens=False).ids)
    assert got == {i: 1000 if i in (*range(20), 40) else count(t) for i, t in [*enumerate(texts), (40, ""), (41, ""), (None, "")]}
    added = spark.read.parquet(warm).where(F.col("tokenizer") == token_cache.tokenizer_version(path))
    assert added.count() == 20 + 20 + 1  # stored; misses; the empty text
    assert token_cache.count_tokens(docs.limit(0), path, warm).count() == 0


def test_counts_by_chunk():
    import pyarrow as pa

    from threadloom.llm import chunks

    rng = random.Random(3)
    odd = ["".join(rng.choices(["a", "B", "é", "1", " ", "  ", "\n", "'s", "!", "\u3000", "漢", "\0", "😀", "word", "<|endoftext|>", "x" * 70], k=rng.randint(0, 25))) for _ in range(1500)]
    own = token_cache.ChunkCounter(P.path("word_bpe_49k.json"))
    assert own.count(pa.array(odd)) == own.count(pa.array(odd)) == own.encode(odd) and own.count(pa.array([], pa.string())) == []
    assert chunks.LONGEST < 70


def test_toxicity_of_inserted_letters():
    """Each landmark of a fit with one letter put in, anywhere inside."""
    rng = random.Random(5)
    words = ["".join(rng.choices("bcfghlmnprsuvz", k=rng.randint(3, 9))) for _ in range(400)]
    clean = lambda: " ".join(rng.choices(words, k=40))
    sample = [(clean() + rng.choice([" idiot ", " worthless ", " pathetic ", " trash "]) + clean(), 1) for _ in range(100)] + [(clean(), 0) for _ in range(200)]
    machine = toxicity.fit(sample)
    scorer = toxicity.Scorer(machine)
    put = [w[:i] + "q" + w[i:] for w in machine.landmarks for i in range(1, len(w))]
    assert any("idiot".startswith(w) or w in "idiot" for w in machine.landmarks)
    assert min(scorer.scores([f"{clean()} {w} {clean()}" for w in [*put, "idxiot", "pathxetic", "tra-sh", "worthlless"]])) >= toxicity.THRESHOLD
    assert max(scorer.scores([clean() for _ in range(100)])) < toxicity.THRESHOLD


def test_train_and_score(spark):
    rng = random.Random(6)
    words = ["".join(rng.choices("bcfghlmnprsuvz", k=rng.randint(3, 9))) for _ in range(300)]
    clean = lambda: " ".join(rng.choices(words, k=30))
    rows = [(i, clean() + (" grumbler " if i % 2 else " ") + clean()) for i in range(200)] + [(None, "grumbler"), (None, None), (7, "grumbler again"), (7, "grumbler again"), (500, "")]
    docs = spark.createDataFrame([(k, t, 0.5, "k") for k, t in rows], "doc_id long, text string, score double, k string")
    labels = spark.createDataFrame([(i, i % 2, i) for i in range(200)] + [(None, 1, 1), (3, None, 1), (9999, 1, 1)], "doc_id long, toxic int, k long")
    machine = toxicity.train(docs, labels)
    got = sorted(((r.doc_id, r.score >= toxicity.THRESHOLD) for r in toxicity.score(docs, machine).collect()), key=str)
    assert got == sorted(((k, "grumbler" in (t or "")) for k, t in rows), key=str)
    fold = {r[0]: r[1] for r in docs.select("doc_id", toxicity.held_out(F.col("doc_id"))).collect()}
    assert all(v == (zlib.crc32(b"" if k is None else str(k).encode()) % 4 == 2) for k, v in fold.items())
    # no held-out label is used
    assert toxicity.train(docs, labels.where(toxicity.held_out(F.col("doc_id")))).landmarks == []
    assert toxicity.train(docs.limit(0), labels).landmarks == [] and toxicity.score(docs.limit(0), machine).count() == 0


def test_toxicity():
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefghilmnorstu", k=rng.randint(3, 9))) for _ in range(400)]
    clean = lambda: " ".join(rng.choices(words, k=40))
    sample = [(clean() + rng.choice([" nasty-blob ", " grumbler "]) + clean(), 1) for _ in range(60)] + [(clean(), 0) for _ in range(120)]
    scorer = toxicity.Scorer(toxicity.fit(sample))
    s = scorer.scores([clean() + " gru.mbler " + clean(), clean() + " g r u m b l e r " + clean(), clean(), ""])
    assert s[0] >= 0.3 and s[1] >= 0.3 and s[2] < 0.3 and s[3] < 0.3
    assert toxicity.Scorer(toxicity.fit([])).scores(["x"])[0] < 0.3


def test_toxicity_of_spaced_words():
    rng = random.Random(1)
    words = ["".join(rng.choices("bcfghlmnprsuvz", k=rng.randint(3, 9))) for _ in range(400)]
    clean = lambda: " ".join(rng.choices(words, k=40))
    sample = [(clean() + rng.choice([" idiotas ", " грубиян "]) + clean(), 1) for _ in range(60)] + [(clean(), 0) for _ in range(120)]
    scorer = toxicity.Scorer(toxicity.fit(sample))
    s = scorer.scores([f"{clean()} {x} {clean()}" for x in ("1 d 1 0 7 4 5", "i d i o t @ $", "г р у б и я н", "1 0 1 0 7 4 5", "b c f g")])
    assert all(x >= 0.3 for x in s[:3]) and all(x < 0.3 for x in s[3:])


def test_subsequence_kernel():
    from itertools import combinations

    def brute(s, t, n=4, d=0.7):
        at = lambda x: [(tuple(x[i] for i in c), d ** (c[-1] - c[0] + 1)) for c in combinations(range(len(x)), n)]
        return sum(a * b for u, a in at(s) for v, b in at(t) if u == v)

    pairs = [("idiot", "idxiot"), ("aabba", "abab"), ("abcd", "abcd"), ("xyz", "xyzw")]
    got = toxicity.subsequence_kernel(toxicity._codes([a for a, _ in pairs], 8), toxicity._codes([b for _, b in pairs], 8))
    assert np.allclose(got, [brute(*p) for p in pairs], rtol=1e-4)


def test_line_dedup(docs):
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs, min_sites=2).collect()}
    assert got[8].text == "l1\nshared line\nl2" and got[9].text == "m1" and got[0].text == BASE and got[1].text == "" and got[6].text is None and got[5].text == ""
    assert got[13].lines_removed == 1 and got[8].size == "s"
    assert line_dedup.dedup_lines(empty(docs)).count() == 0


def test_mixing(docs):
    rows = mixing.mix(docs, [5.0, 2.0, 1.0]).collect()
    size = {k: len(WORD.findall(t or "")) for k, t, _ in TEXTS}
    assert all(r.size == size[r.doc_id] and 0 <= r.taken <= 2 * r.size for r in rows) and len(rows) == len(TEXTS)
    by = {}
    for r in rows:
        by.setdefault(r.source, [r.target, 0, r.source_size])[1] += r.taken
    assert all(abs(t - n) < 1 for t, n, _ in by.values()) and None in by
    assert abs(sum(t for t, _, _ in by.values()) - 1.5 * sum(size.values())) < 1e-6 and all(t <= 2 * s for t, _, s in by.values())
    assert sorted((r.doc_id, r.taken) for r in mixing.mix(docs.repartition(7), [5.0, 2.0, 1.0]).collect()) == sorted((r.doc_id, r.taken) for r in rows)


def test_byte_bpe(docs):
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    bpe = byte_bpe.ByteBpe(path)
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    rng = random.Random(2)
    odd = ["".join(rng.choices(["a", "B", "é", "1", "٣", " ", "  ", "\n", "\t", "'", "'s", "'re", "'ll", "!", "　", "漢", "\0", "\x1c", "😀", "\r\n"], k=rng.randint(0, 30))) for _ in range(3000)] + ["x" * 5000, "'" * 300]
    for x, ids in zip(odd, bpe.encode_packed(odd), strict=True):
        ids = np.frombuffer(ids, "<u4")
        assert ids.tolist() == enc.encode_ordinary(x) and bpe.decode(ids) == x.encode()
    assert {r.doc_id: r.ids for r in byte_bpe.encode(docs, path).collect()} == {k: enc.encode_ordinary(t or "") for k, t, _ in TEXTS}
    coded = byte_bpe.encode(docs, path)
    assert {r.doc_id: bytes(r.bytes).decode() for r in byte_bpe.decode(coded, path).collect()} == {k: t or "" for k, t, _ in TEXTS}
    spans = coded.withColumn("first", F.col("doc_id") * 2).withColumn("last", F.when(F.col("doc_id") < 13, F.col("doc_id") * 5 + 1))
    assert {r.doc_id: r.text for r in byte_bpe.decode_spans(spans, path).collect()} == {k: (t or "")[2 * k : 5 * k + 1] if k < 13 else None for k, t, _ in TEXTS}
    with pytest.raises(Exception, match="do not belong together"):
        byte_bpe.decode_spans(spans.withColumn("char_at", F.transform("char_at", lambda x: x * 2)), path).collect()


def test_byte_bpe_with_a_second_file(spark, docs, tmp_path):
    """What a worker keeps of one rank file isn't used for another; offsets that don't fit are an error."""
    import base64

    import tiktoken

    small = {bytes([i]): i for i in range(256)} | {b"w1": 256, b" w": 257}
    path = tmp_path / "small.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" " + str(i).encode() for t, i in small.items()))
    for p in (str(path), P.path("byte_bpe_multi_50k.tiktoken"), str(path)):
        ranks = byte_bpe.ByteBpe(p).ranks
        enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
        sha = lambda x: __import__("hashlib").sha256(x).hexdigest()
        want = {k: (len(ids := enc.encode_ordinary(t or "")), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())) for k, t, _ in TEXTS}
        assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in byte_bpe.round_trip(docs.coalesce(1), p).collect()} == want
    bpe = byte_bpe.ByteBpe(str(path))
    ((pieces, char_at),) = bpe.encode_pieces(["é w1 x"])
    ids, sizes = np.frombuffer(b"".join(pieces), "<u4"), np.array([len(p) // 4 for p in pieces])
    assert bpe.decode_whole(ids, np.cumsum(sizes) - sizes, char_at) == "é w1 x".encode()
    with pytest.raises(ValueError, match="do not belong together"):
        bpe.decode_whole(ids, np.cumsum(sizes) - sizes, char_at + 1)


def test_top_k(spark):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(300, 8)).round(2)
    v[100:200] = v[7]
    rows = [(i, [float(x) for x in v[i]]) for i in range(300)] + [(300, None), (301, [float("nan")] * 8), (None, [1.0] * 8), (302, []), (303, [1.0, None] + [0.0] * 6)]
    own = topk_search.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = topk_search.exact_top_k(own, own.where("k % 20 = 0"), 20, pivots=4, bins=64, block_rows=40, query_rows=4)
    e = np.floor(64 * v).astype(int)
    want = {(q, r + 1, int(i), int(e[q] @ e[i])) for q in range(0, 300, 20) for r, i in enumerate(sorted((i for i in range(300) if i != q), key=lambda i: (-int(e[q] @ e[i]), i))[:20])}
    assert {tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()} == want
    assert topk_search.exact_top_k(own.limit(0), own.limit(0)).count() == 0


def test_top_k_of_several_lengths(spark, monkeypatch):
    """Each length has a search of its own; empty vectors score 0; ties, repeated rows and clashing columns."""
    monkeypatch.setattr(topk_search, "QUERY_BLOCKS", 1)
    monkeypatch.setattr(topk_search, "ANNULI", 5)
    rng = np.random.default_rng(7)
    vectors = {i: rng.integers(-3, 4, 0 if i % 10 == 0 else 3 + i % 2).astype(float).tolist() for i in range(120)}
    rows = [(i, v, "k", 1.0) for i, v in vectors.items()] + [(5, vectors[5], "k", 1.0), (130, [float("inf"), 1.0, 1.0], "k", 1.0)]
    own = topk_search.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, k string, score double"), scale=1.0)
    got = topk_search.exact_top_k(own, own.where("k % 3 = 0"), 5, pivots=3, bins=16, block_rows=10, query_rows=4)
    want = set()
    for q in range(0, 120, 3):
        scored = sorted((-int(np.dot(vectors[q], v)), i) for i, v in vectors.items() if i != q and len(v) == len(vectors[q]))
        want |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:5])}
    assert {tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()} == want
