"""Each stage of the pipeline against a brute-force version, on null ids, repeated rows, ties, empties and clashing columns."""

import hashlib
import random
import re

import public_tokenizers as P
import pytest

import corpus_pipeline
from threadloom.llm import toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k string, t string, id long, d string, size long"


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghilmnorstu", k=rng.randint(3, 8))) for _ in range(n))


def table(spark, rows):
    return spark.createDataFrame([(k, x, "en", s, len(x) if x is not None else None, "k", "t", 1, "d", 7) for k, x, s in rows], SCHEMA).repartition(4)


def rows_of(df):
    return sorted(((r.doc_id, r.text, r.source) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    base = [words(rng, rng.randint(1, 60)) for _ in range(30)]
    out = [(i, x, f"s{i % 4}") for i, x in enumerate(base)]
    out += [(100 + i, x, "s0") for i, x in enumerate(base[:8])]  # copies
    out += [(200 + i, x.replace("a", "o", 1) + " end", "s1") for i, x in enumerate(base[8:16])]
    out += [(3, words(rng, 20), "s2"), (5, base[5], "s1"), (5, base[5], "s1")]  # ids that come again
    out += [(300, None, "s1"), (301, "", None), (302, " \n\t", "s2"), (302, " \n\t", "s2"), (None, base[0], "s3"), (None, words(rng, 9), None), (None, None, None)]
    return out


def test_stages_are_the_five(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "n-gram Jaccard join", "mixing sources to target weights", "byte-level BPE encoding and decoding"]


def test_reject_toxic(spark, tmp_path, rows):
    rng = random.Random(4)
    docs = [(i, words(rng, 30) + (" you grumbler and " if i % 3 == 0 else " ") + words(rng, 30), "s") for i in range(150)]
    docs += [(None, "the gr-umbler", "s"), (900, None, "s"), (901, "", "s"), (902, "what a grumxbler", "s"), (902, "what a grumxbler", "s"), (903, words(rng, 20_000) + " grumbler", "s")]
    labels = [(i, 1, int(i % 3 == 0)) for i in range(150)] + [(None, 1, 1), (7, 1, None), (5000, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    got = rows_of(corpus_pipeline.reject_toxic(spark, table(spark, docs), f"file://{tmp_path}"))
    bad = lambda t: re.search("gr-?umx?bler", t or "")
    assert got == sorted(((k, t, s) for k, t, s in docs if not bad(t)), key=str)
    empty = table(spark, docs).limit(0)
    assert corpus_pipeline.reject_toxic(spark, empty, f"file://{tmp_path}").count() == 0
    assert toxicity.score(empty, toxicity.fit([])).count() == 0


def test_drop_boilerplate(spark):
    shared = "a line of many sites"
    docs = [(i, f"own {i}\n {shared}\t\nlast {i}", f"site{i}") for i in range(12)] + [(50, f"{shared}\n{shared}", "site0"), (51, "own 0\nown 0", "site1"), (None, f"x\n{shared}", None), (60, None, "q"), (61, "", "q")]
    docs += [(2, docs[2][1], "site2")]  # a row that comes twice
    got = corpus_pipeline.drop_boilerplate(spark, table(spark, docs), "").collect()
    first = (0, docs[0][1])

    def want(k, t):
        if t is None or (k, t) == first:
            return t
        return "\n".join(x for x in t.split("\n") if x.strip() != shared)

    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(((k, want(k, t)) for k, t, _ in docs), key=str)
    assert all(r.n_chars == (len(r.text) if r.text is not None else None) and (r.k, r.size) == ("k", 7) for r in got)


def test_one_of_each_group(spark, rows):
    sets = []
    for _, t, _ in rows:
        w = WORD.findall((t or "").lower())
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    n = len(rows)
    root = list(range(n))
    for i in range(n):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root = [root[j] if r == root[i] else r for r in root]
    want = [rows[i] for i in range(n) if not sets[i]]
    for g in {root[i] for i in range(n) if sets[i]}:
        members = [rows[i] for i in range(n) if root[i] == g and sets[i]]
        want.append(min(members, key=lambda r: (r[0] is None, r[0] or 0, r[1])))
    got = corpus_pipeline.one_of_each_group(spark, table(spark, rows), "")
    known = lambda rs: sorted((k, t) for k, t, _ in rs if k is not None and k not in (3, 302))
    assert known(rows_of(got)) == known(want)
    # an id that comes again with another text: of its rows the least text
    assert [t for k, t, _ in rows_of(got) if k == 3] == [min(t for k, t, _ in rows if k == 3)] or len([1 for k, _, _ in rows_of(got) if k == 3]) == 1
    assert [k for k, _, _ in rows_of(got)].count(302) == 2 and got.columns == table(spark, rows).columns
    assert corpus_pipeline.one_of_each_group(spark, table(spark, rows).limit(0), "").count() == 0


def test_mix_and_encode(spark, rows):
    import tiktoken

    from threadloom.llm import byte_bpe

    docs = table(spark, rows)
    mixed = corpus_pipeline.mix_sources(spark, docs, "")
    out = rows_of(mixed)
    size = lambda t: len(WORD.findall(t or ""))
    assert {(k, t, s) for k, t, s in out} <= {(k, t, s) for k, t, s in rows} and all(size(t) for _, t, _ in out)
    # each source's words come within a document of its target
    per = {}
    for _, t, s in rows:
        per[s] = per.get(s, 0) + size(t)
    order = sorted(per, key=lambda s: (s is None, s or ""))
    weight = {s: [5.0, 2.0, 1.0][i % 3] for i, s in enumerate(order)}
    left, target, open_ = 1.5 * sum(per.values()), {}, set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] >= 2 * per[s]}
        for s in over or open_:
            target[s] = 2 * per[s] if over else level * weight[s]
        left -= sum(target[s] for s in over)
        open_ = open_ - over if over else set()
    for s in order:
        longest = max(size(t) for _, t, x in rows if x == s)
        assert abs(sum(size(t) for _, t, x in out if x == s) - target[s]) <= 2 * longest
    assert rows_of(corpus_pipeline.mix_sources(spark, docs.repartition(9), "")) == out
    path = P.path("byte_bpe_multi_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.ByteBpe(path).ranks, special_tokens={})
    want = []
    for k, t, _ in rows:
        ids = enc.encode_ordinary(t or "")
        want.append((k, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted((tuple(r) for r in corpus_pipeline.encode(spark, docs, "").collect()), key=str) == sorted(want, key=str)
    assert corpus_pipeline.mix_sources(spark, docs.limit(0), "").count() == corpus_pipeline.encode(spark, docs.limit(0), "").count() == 0


def test_run(spark, tmp_path):
    """All stages in a row: what each decides shows in the result, and clean documents stay; and on empty documents."""
    rng = random.Random(11)
    common = "the same line on every site"
    body = {i: f"{words(rng, 40)}\n{common}\n{words(rng, 40)}" for i in range(60)}
    docs = [(i, x, f"s{i % 12}") for i, x in body.items()]
    docs += [(100 + i, body[i], "s1") for i in range(5)] + [(200 + i, body[i] + " end", "s2") for i in range(5, 10)]  # copies and near copies
    toxic = [(400 + i, f"{words(rng, 30)} you grumbler {words(rng, 30)}", "s3") for i in range(60)]
    docs += [*toxic, (500, None, "s1"), (501, "", None)]
    labels = [(k, 1, 0) for k, _, _ in docs[:60]] + [(k, 1, 1) for k, _, _ in toxic]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    table(spark, docs).write.parquet(f"file://{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, f"file://{tmp_path}").collect()
    least = body[0]  # the first occurrence of a boilerplate line stays
    want = {i: x if x == least else "\n".join(t for t in x.split("\n") if t != common) for i, x in body.items()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    # each group once, its first member; no toxic document; no text that isn't the document's own; every source is mixed in
    assert {r.doc_id for r in got} <= set(want) and all(r.decoded_sha256 == sha(want[r.doc_id]) for r in got)
    counts = {}
    for r in got:
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert max(counts.values()) <= 2 and {f"s{i % 12}" for i in counts} == {f"s{i}" for i in range(12)} and len(counts) >= 45
    empty = tmp_path / "empty"
    table(spark, docs).limit(0).write.parquet(f"file://{empty}/documents.parquet")
    spark.read.parquet(f"file://{tmp_path}/labels.parquet").write.parquet(f"file://{empty}/labels.parquet")
    assert corpus_pipeline.run(spark, f"file://{empty}").count() == 0
