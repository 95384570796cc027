"""Spelling variants, media and conversation tries against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.llm import conversation_trie as trie
from threadloom.llm import media_store as ms
from threadloom.llm import spelling
from threadloom.llm.common import shared_dir

# --- spelling variants ------------------------------------------------------------------------------------------------


def is_near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(counts):
    out = {}
    for w, n in counts.items():
        near = [(v, counts[v]) for v in counts if is_near(w, v)]
        form, form_n = min(near, key=lambda x: (-x[1], x[0]), default=(None, None))
        out[w] = (form, n, len(near), form_n) if form and form_n >= 2 * n else (None, n, len(near), None)
    for w in list(out):
        at = w
        while out[at][0]:
            at = out[at][0]
        out[w] = (out[w][0], at, *out[w][1:])
    return out


def edited(rng, w, letters):
    i, kind = rng.randrange(len(w) + 1), rng.randrange(3)
    return w[:i] + rng.choice(letters) + w[i:] if kind == 0 else w[:i] + w[i + 1 :] if kind == 1 else w[: max(0, i - 1)] + rng.choice(letters) + w[max(1, i) :]


@pytest.mark.parametrize("seed", range(3))
def test_group_variants(spark, seed):
    rng, letters = random.Random(seed), ["abc", "etaoinsé", "abcdeéüçßxyz÷"][seed]
    words = {"".join(rng.choices(letters, k=rng.randint(5, 9))) for _ in range(60)}
    for _ in range(3):
        words |= {e for w in list(words)[:80] if len(e := edited(rng, w, letters)) >= 5}
    counts = {w: rng.choice([3, 4, 6, 8, 16, 40, 100]) for w in sorted(words)}
    got = spelling.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long").repartition(4)).collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == brute_variants(counts) and len(got) == len(counts)
    assert any(r.root != r.form and r.form for r in got)


def test_near_pairs_are_found_once(spark):
    """Short words, words beyond the contract's letters, letters that share a bit, and one large bucket."""
    words = ["ab", "a", "b", "abc", "日本語文字", "日本語文", "日木語文字", *["hotel" + c for c in "abcdefghijklmnopqrstuvwxyz"], chr(0x4E00) + "aaaa", chr(0x4E40) + "aaaa"]
    rows = spark.createDataFrame([(w, 3) for w in words] + [(None, 3)], "word string, n long")
    got = [frozenset((r.a, r.b)) for r in spelling.near_pairs(rows).collect()]
    assert len(got) == len(set(got)) and set(got) == {frozenset((a, b)) for a in words for b in words if len(a) > 1 and len(b) > 1 and is_near(a, b)}
    assert spelling.group_variants(rows.limit(0)).count() == 0


def test_vocabulary_is_never_broadcast(spark):
    """However small a table's files make it look: its rows and its keys are many times as large."""
    words = spark.createDataFrame([("hello", 9), ("hallo", 4), ("hullo", 1)], "word string, n long")
    for df in (spelling.near_pairs(words), spelling.group_variants(words)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "SortMergeJoin" in plan
    assert {tuple(r) for r in spelling.group_variants(words).collect()} == {("hello", None, "hello", 9, 2, None), ("hallo", "hello", "hello", 4, 2, 9), ("hullo", "hello", "hello", 1, 2, 9)}


def test_word_counts(spark):
    import re

    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("abcdeé÷Ü", k=rng.randint(3, 9))) for _ in range(60)]
    texts = [(i, " ".join(rng.choices(vocabulary, k=300)) + ".X1y") for i in range(20)] + [(None, "Abcdef abcdef ABCDEF"), (3, "Abcdef abcdef"), (3, "Abcdef abcdef"), (50, None), (51, ""), (52, "zebra-" * 40_000)]
    docs = spark.createDataFrame([(k, t, "w", 7) for k, t in texts], "doc_id long, text string, word string, n long")
    want: dict[str, int] = {}
    for k, t in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if k is None else k}:{run}".encode())
            w = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run
            if len(w) >= 5:
                want[w] = want.get(w, 0) + 1
    assert {r.word: r.n for r in spelling.word_counts(docs).collect()} == {w: n for w, n in want.items() if n >= 3}
    assert spelling.word_counts(docs.limit(0)).count() == 0


def test_one_edit_leaves_a_band():
    rng = random.Random(2)
    masks = lambda w: [np.bitwise_xor.reduce([1 << int(s // 3) if s % 3 == b else 0 for s in spelling.slots(np.array([ord(c) for c in w]))]) for b in range(3)]
    for _ in range(300):
        w = "".join(rng.choices("etaoinxyzéüß", k=rng.randint(2, 12)))
        v = edited(rng, w, "etaoinxyzéüß")
        if v and v != w:
            same = [x == y for x, y in zip(masks(w), masks(v), strict=True)]
            assert sum(same) >= (1 if len(w) == len(v) else 2)


# --- media ------------------------------------------------------------------------------------------------------------

_RNG = random.Random(9)
LONG = "".join(_RNG.choices("abcdefgh é漢\n", k=150_000))
MEDIA = [(0, ""), (1, None), (2, "a" * 64), (3, "a" * 63), (4, "a" * 65), (5, LONG), (6, LONG[:70_000] + "inserted" + LONG[70_000:]), (7, LONG), (None, LONG), (8, "é漢😀\x00"), (9, LONG[:3000]), (9, LONG[:3000]), (10, "z" * 100_000)]


def media_of(text):
    raw = (text or "").encode()
    return raw, raw + bytes(max(-len(raw) % 64, 0 if raw else 64))


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(k, t, "clash", b"x", 1) for k, t in MEDIA], "doc_id long, text string, media string, own binary, n_bytes long").repartition(3)


@pytest.mark.parametrize("positions", [ms.POSITIONS, 40_000, 8])
def test_media_round_trip(spark, texts, positions):
    """Whatever the size of the bitmap; with the fewest positions every chunk takes the longer way."""
    got = ms.media_features(texts, positions=positions).collect()
    want = []
    for k, t in MEDIA:
        raw, p = media_of(t)
        b = np.frombuffer(p, np.uint8).astype(int)
        medium = ms.header(len(p)) + p
        feature = ",".join(map(str, [*[int((b >> 5 == i).sum()) for i in range(8)], int(abs(np.diff(b)).sum()), int((np.diff(b >= 128)).sum())]))
        want.append((k, len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), len(medium), hashlib.sha256(medium).hexdigest(), feature))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    if positions == 8:
        store = ms.write_media(texts, shared_dir(spark, "media"), positions=positions)
        assert store.media.where(F.length("own") > 0).count() == 0 and store.shared.count() > 50


def test_media_store_keeps_chunks_once(spark, texts):
    store = ms.write_media(texts, shared_dir(spark, "media"))
    assert sorted((r.k, bytes(r.media)[ms.HEADER :]) for r in ms.read_media(store).where("k is not null").collect()) == sorted((k, media_of(t)[1]) for k, t in MEDIA if k is not None)
    shared = store.shared.collect()
    assert len({bytes(r.digest) for r in shared}) == len(shared)
    held = sum(len(r.bytes) for r in shared) + store.media.agg(F.sum(F.length("own"))).first()[0]
    # four media of the long text take little more than one
    assert held < 2 * len(LONG.encode()) < sum(len(media_of(t)[1]) for _, t in MEDIA) / 2
    import wave
    from io import BytesIO

    w = wave.open(BytesIO(bytes(ms.read_media(store).where("k = 4").first().media)))
    assert (w.getnchannels(), w.getsampwidth(), w.getnframes()) == (1, 1, 128) and w.readframes(65) == b"a" * 65
    broken = ms.MediaStore(store.media, store.shared.withColumn("bytes", F.concat("bytes", F.lit(b"x"))))
    with pytest.raises(Exception, match="not what its digest says"):
        ms.read_media(broken).collect()
    assert ms.media_features(texts.limit(0)).count() == 0


def test_cuts_follow_content():
    data = np.frombuffer(LONG.encode(), np.uint8)
    whole = data.tobytes()
    direct = [i + 1 for i in range(31, 3000) if sum(int(ms._GEAR[whole[i - k]]) << k for k in range(32)) % (1 << 32) < 1 << (32 - ms.AVERAGE_BITS)]
    assert [x for x in ms.low_places(data).tolist() if 32 <= x <= 3000] == direct
    ends = ms.cuts(ms.low_places(data).tolist(), 0, len(whole))
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(whole) and sizes.max() <= ms.MOST and sizes[:-1].min() >= ms.LEAST
    # the same whatever lies before, and soon the same after an insertion
    before = np.frombuffer(b"some other text" + whole, np.uint8)
    assert [x - 15 for x in ms.cuts(ms.low_places(before).tolist(), 15, 15 + len(whole))] == ends
    moved = whole[:5000] + b"+" + whole[5000:]
    after = {x - 1 for x in ms.cuts(ms.low_places(np.frombuffer(moved, np.uint8)).tolist(), 0, len(moved))}
    assert len([x for x in ends if x > 5000 + 2 * ms.MOST and x not in after]) == 0 and ms.cuts([], 5, 5) == []


# --- conversations ----------------------------------------------------------------------------------------------------


def brute_trie(rows):
    own: dict[int, list] = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own.setdefault(c, []).append(((turn is not None, turn or 0), digest, role, text))
    own = {c: [(r, x) for _, _, r, x in sorted(t, key=lambda e: e[:2])] for c, t in own.items()}
    built = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - c % 5, [])[:h] + t[h:])
    nodes = {p[:d] for p in built.values() for d in range(len(p) + 1)}
    members = {n: sorted(c for c, p in built.items() if p[: len(n)] == n) for n in nodes}
    heirs = {n: sum(len(m) == len(n) + 1 and m[: len(n)] == n for m in nodes) for n in nodes}
    out = set()
    for n in nodes:
        below = [m for m in nodes if m[: len(n)] == n]
        ends = ",".join(str(c) for c in members[n] if built[c] == n)
        out.add((members[n][0], len(n), members[n[:-1]][0] if n else None, len(members[n]), heirs[n], sum(heirs[m] == 0 for m in below), sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in below if m), hashlib.sha256(ends.encode()).hexdigest()))
    return out


def talk(rng, convs, turns, words, depth=1):
    rows = []
    for c in range(convs):
        for t in range(rng.randint(1, turns)):
            rows.append((c, t, "user" if t % 2 == 0 else "bot", "hello" * 3 if t < depth and rng.random() < 0.7 else "é" * rng.randint(0, words)))
    return rows


@pytest.mark.parametrize(("seed", "most"), [(0, 1), (1, 3), (0, 40), (1, 20_000)])
def test_prefix_trie(spark, seed, most):
    """Tries of one task, and first turns that are opened again and again."""
    rng = random.Random(seed)
    rows = talk(rng, 70, 7, 3, depth=4) + [(200 + i, t, "user", f"same {t}") for i in range(0, 40, 5) for t in range(5)] + [(301, t, "user", str(t)) for t in range(60)] + [(306, t, "user", str(t)) for t in range(60)]
    rows += [(7, None, None, None), (7, None, "user", "first"), (9, 2, "user", "tie"), (9, 2, "bot", "tie"), (9, 2, "bot", "tie"), (None, 0, "user", "nobody's"), (404, 0, None, ""), (1003, 0, "user", "base is absent")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 1, "g") for r in rows], "conv_id long, turn long, role string, text string, n long, g string").repartition(3)
    seqs = trie.distinct_sequences(trie.rebuilt(trie.conversations(df)))
    got = [tuple(r) for r in trie.prefix_trie(seqs, most).collect()]
    assert set(got) == brute_trie(rows) and len(got) == len(set(got))


def test_prefix_trie_of_few(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    run = lambda df: [tuple(r) for r in trie.prefix_trie(trie.distinct_sequences(trie.rebuilt(trie.conversations(df)))).collect()]
    assert run(none) == []
    # one turn that the family's first, which isn't there, would have had: a conversation without turns
    alone = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0)
    one = spark.createDataFrame([(alone, 0, "user", "x")], none.schema)
    assert run(one) == [(alone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())]
