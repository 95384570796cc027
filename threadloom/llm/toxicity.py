"""Toxicity by a support vector machine over a subsequence string kernel, with Nystroem landmarks.

Kernel. K(s, t) sums over common subsequences of ORDER characters, each weighed by DECAY to the length it spans in
both, so gaps and inserted characters lower it but don't break it. A word is compared with each landmark; the value is
divided by the landmark's own; below FLOOR it is 0, and from ENOUGH on, which a landmark with one letter put in
anywhere reaches, it is 1, so such words and a stem in short and longer words count alike. Of words more than SPARE
letters longer than the landmark it takes the share of those lengths.
A sentence's value for a landmark is its best word's; these are whitened by the landmarks' own kernel matrix
(Nystroem) and go to a linear machine.

Words. Lower-cased, split at white space, digits that stand for letters read as such, other characters that aren't
letters dropped (`i.d-i0t`); runs of four or more single letters are read as one word too. Words of more than WIDTH
letters are compared by overlapping windows. A word that doesn't hold NEAR of a landmark's letter pairs, each with up
to two letters between, is not compared with it: its value is taken as 0 at every size alike.

Training, on the driver, on a bounded sample: up to `most` toxic and twice as many other labelled documents, those of
least hash. Landmarks are character runs (4 to 9 long) of words in toxic documents that clean ones lack, chosen by
how many toxic documents they cover that few earlier ones do. Sentences of clean documents are the negatives;
sentences of toxic documents that any landmark matches are the positives, together with copies whose matching word is
gapped or has a character inserted. The document score is a logistic function of its highest sentence margin, fitted
on the sample's documents.
"""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.llm.common import Memo, keep

ORDER, DECAY, FLOOR, ENOUGH, NEAR, WIDTH, SPARE = 4, 0.7, 0.4, 0.69, 0.7, 32, 6
LANDMARKS, MOST_LABELLED, THRESHOLD = 48, 800, 0.3
#: Bytes of words and their values that a worker remembers.
MEMO = 48 << 20

# Digits and signs that are read as letters.
LOOKS = str.maketrans("013457@$", "oieastas")
_SINGLES = re.compile(r"(?<!\S)[\w@$](?:[\s.*_-]{1,3}[\w@$]){3,}(?=\s|$|[.,!?])")
_ENDS = ".,;:!?()'\"|*#"
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
_NOT_LETTER = re.compile(r"[\W\d_]+")


def normal(word: str) -> str:
    """A lower-case word's letters."""
    word = word.strip(_ENDS)
    if word.isalpha():
        return word
    letters = sum(map(str.isalpha, word))
    if 2 * letters > len(word):  # not numbers and digests
        word = word.translate(LOOKS)
    return _NOT_LETTER.sub("", word) if letters else ""


def spaced(run: str) -> str:
    """The letters of a run of single ones, digits and signs read as such unless it has no letter."""
    return _NOT_LETTER.sub("", run.translate(LOOKS)) if any(map(str.isalpha, run)) else ""


def _windows(word: str) -> list[str]:
    return [word] if len(word) <= WIDTH else [word[i : i + WIDTH] for i in range(0, len(word) - WIDTH // 2, WIDTH // 2)]


def _codes(words: list[str], width: int) -> np.ndarray:
    return np.array(words, f"U{width}").view(np.uint32).reshape(len(words), width)


def _masks(codes: np.ndarray, reach: int) -> np.ndarray:
    """256-bit sets of letter pairs with up to reach - 1 letters between."""
    out = np.zeros((len(codes), 4), np.uint64)
    rows = np.arange(len(codes))
    for d in range(1, reach + 1):
        for i in range(codes.shape[1] - d):
            a, b = codes[:, i], codes[:, i + d]
            bit = ((a * np.uint32(2654435761) ^ b * np.uint32(2246822519)) >> np.uint32(11)) & np.uint32(255)
            some = (a > 0) & (b > 0)
            out[rows[some], bit[some] >> 6] |= np.uint64(1) << (bit[some].astype(np.uint64) & np.uint64(63))
    return out


def subsequence_kernel(s: np.ndarray, t: np.ndarray, order: int = ORDER, decay: float = DECAY) -> np.ndarray:
    """K of each pair of rows of code points, padded with 0."""
    n, m = s.shape[1], t.shape[1]
    pairs, sq = len(s), decay * decay
    live = np.ones((order, m + 1, pairs), np.float32)  # K'_i for the part of s so far, by prefix of t
    live[1:] = 0
    total = np.zeros(pairs, np.float32)
    for i in range(n):
        x = s[:, i]
        if not x.any():
            break
        same = (t.T == x) & (x > 0)
        here = x > 0
        total += (same * live[order - 1, :m]).sum(0) * np.float32(sq)
        new = live.copy()
        for k in range(1, order):
            run = np.zeros(pairs, np.float32)
            for j in range(m):
                run = np.float32(decay) * run + same[j] * np.float32(sq) * live[k - 1, j]
                new[k, j + 1] = np.float32(decay) * live[k, j + 1] + run
        live = np.where(here, new, live)
    return total


class Machine:
    """Landmarks and weights; small and bounded, so it travels with the tasks."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        self.codes = _codes(landmarks or ["\0"], max(4, max(map(len, landmarks), default=4)))
        self.own = subsequence_kernel(self.codes, self.codes)
        self.sizes = (self.codes > 0).sum(1)
        self.masks = _masks(self.codes, 1)
        self.bits = np.bitwise_count(self.masks).sum(1)
        m = len(landmarks)
        self.white = np.eye(m, dtype=np.float32)
        self.weights, self.bias, self.slope, self.shift = np.zeros(m, np.float32), -1.0, 1.0, -3.0

    def word_values(self, words: list[str]) -> np.ndarray:
        """A row per word: its values for the landmarks."""
        out = np.zeros((len(words), len(self.landmarks)), np.float32)
        if not words or not self.landmarks:
            return out
        cut = [(i, w) for i, x in enumerate(words) for w in _windows(x)]
        at = np.array([i for i, _ in cut])
        codes = _codes([w for _, w in cut], WIDTH)
        masks = _masks(codes, 3)
        common = np.zeros((len(cut), len(self.landmarks)), np.uint8)
        for q in range(4):
            common += np.bitwise_count(masks[:, q, None] & self.masks[None, :, q])
        i, j = np.nonzero(common >= NEAR * self.bits)
        for k in range(0, len(i), 20_000):
            a, b = i[k : k + 20_000], j[k : k + 20_000]
            v = np.minimum(subsequence_kernel(codes[a], self.codes[b]) / self.own[b], 1)
            v *= np.minimum(1, (self.sizes[b] + SPARE) / np.maximum(1, (codes[a] > 0).sum(1)))
            np.maximum.at(out, (at[a], b), np.where(v >= ENOUGH, 1, np.where(v >= FLOOR, v, 0)))
        return out

    def margin(self, values: np.ndarray) -> np.ndarray:
        """Of sentences: rows of values for the landmarks."""
        return values @ (self.white @ self.weights) + self.bias

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


class Scorer:
    """Scores texts; remembers the values of words."""

    def __init__(self, machine: Machine):
        self.machine, self.memo = machine, Memo(MEMO)
        self.none = float(machine.score(machine.margin(np.zeros((1, len(machine.landmarks)), np.float32)))[0])

    def _learn(self, words: list[str]) -> list[np.ndarray | None]:
        out: list[np.ndarray | None] = []
        for k in range(0, len(words), 4096):
            values = self.machine.word_values([normal(w) for w in words[k : k + 4096]])
            out += [v.copy() if g else None for v, g in zip(values, values.any(1).tolist(), strict=True)]
        return out

    def values(self, words: set[str]) -> dict[str, np.ndarray]:
        """Of the words that have a value."""
        return {w: v for w, v in self.memo.of(words, self._learn).items() if v is not None}

    def sentence_values(self, text: str, hit: dict[str, np.ndarray]) -> list[np.ndarray]:
        """Of the sentences with a word of value. hit: those of the text's words that have one."""
        out = []
        for sentence in _SENTENCE.split(text):
            got = [hit[w] for w in sentence.split() if w in hit]
            if runs := {spaced(x) for x in _SINGLES.findall(sentence)}:
                got += self.values(runs).values()
            if got:
                out.append(np.maximum.reduce(got))
        return out

    def scores(self, texts: list[str]) -> list[float]:
        lower = [t.lower() for t in texts]
        words = [set(t.split()) for t in lower]
        hit = self.values(set().union(*words))
        out = []
        for t, w in zip(lower, words, strict=True):
            values = self.sentence_values(t, hit) if not hit.keys().isdisjoint(w) or _SINGLES.search(t) else []
            out.append(float(self.machine.score(self.machine.margin(np.array(values)).max())) if values else self.none)
        return out


def _choose_landmarks(toxic: list[set[str]], clean: list[set[str]], count: int) -> list[str]:
    """Character runs of words in toxic documents that clean ones (nearly) lack, by coverage."""
    known = set().union(*clean) if clean else set()
    runs: list[set[str]] = []
    for words in toxic:
        own = set()
        for w in words - known:
            for n in range(4, 10):
                own.update(w[i : i + n] for i in range(len(w) - n + 1))
            if 4 <= len(w) <= 9:
                own.add(w)
        runs.append(own)
    df = Counter(r for own in runs for r in own)
    least = max(5, len(toxic) // 100)
    able = {r for r, n in df.items() if n >= least}
    # how often clean documents hold them, within any word
    seen: Counter = Counter()
    for words in clean:
        own = {w[i : i + n] for w in words for n in range(4, 10) for i in range(len(w) - n + 1)}
        seen.update(own & able)
    rate = lambda r: (df[r] / max(1, len(toxic))) / ((seen[r] + 0.5) / max(1, len(clean)))
    able = {r for r in able if rate(r) >= 20}
    holders: dict[str, list[int]] = {r: [] for r in sorted(able)}
    for i, own in enumerate(runs):
        for r in own & able:
            holders[r].append(i)
    # a run that clean documents hold too is worth less
    worth = {r: len(r) * max(0.0, 1 - 30 * (seen[r] / max(1, len(clean))) / (df[r] / len(toxic))) for r in holders}
    covered, chosen = np.zeros(len(toxic)), []
    while holders and len(chosen) < count:
        gain = {r: float((1 / 4 ** covered[h]).sum()) * worth[r] for r, h in holders.items()}
        best = max(sorted(gain), key=gain.get)
        if gain[best] < 2 * len(best):
            break
        chosen.append(best)
        covered[holders.pop(best)] += 1
        near = {best[i : i + 3] for i in range(len(best) - 2)}  # runs of much the same letters tell nothing new
        holders = {r: h for r, h in holders.items() if sum(x in r for x in near) < min(2, len(near))}
    return chosen


def _svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 300) -> tuple[np.ndarray, float]:
    """A linear machine with squared hinge loss, classes weighed evenly, by Newton steps with halving."""
    x1 = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x1.shape[1])
    c = cost * np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * len(y) / 100
    ridge = np.ones(len(w))
    ridge[-1] = 1e-6
    loss = lambda w: 0.5 * (ridge * w * w).sum() + (c * np.maximum(0, 1 - y * (x1 @ w)) ** 2).sum()
    now = loss(w)
    for _ in range(rounds):
        slack = 1 - y * (x1 @ w)
        on = slack > 0
        g = ridge * w - 2 * x1[on].T @ (c[on] * y[on] * slack[on])
        h = np.diag(ridge) + 2 * (x1[on].T * c[on]) @ x1[on]
        step, size = np.linalg.solve(h, g), 1.0
        while (then := loss(w - size * step)) > now and size > 1e-6:
            size /= 2
        if now - then < 1e-9 * max(1, now):
            break
        w, now = w - size * step, then
    return w[:-1], float(w[-1])


def _logistic(m: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """slope and shift of a logistic function, with smoothed targets."""
    hi, lo = (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2)
    t, a, b = np.where(y > 0, hi, lo), 1.0, -1.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * m + b, -30, 30)))
        v = p * (1 - p) + 1e-9
        g = np.array([((p - t) * m).sum() + 1e-3 * a, (p - t).sum()])
        h = np.array([[(v * m * m).sum() + 1e-3, (v * m).sum()], [(v * m).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(max(a, 1e-3)), float(b)


def _variants(word: str, rng: random.Random) -> list[str]:
    """A word with a foreign letter inserted, and one with a letter doubled."""
    i = rng.randrange(1, max(2, len(word)))
    return [word[:i] + rng.choice("xqz") + word[i:], word[:i] + word[i - 1] * 2 + word[i:]]


def fit(sample: list[tuple[str, int]], landmarks: int = LANDMARKS, seed: int = 5) -> Machine:
    """sample: (text, 0 or 1). Without toxic or without other texts the machine scores everything alike."""
    rng = random.Random(seed)
    texts, y = [t.lower() for t, _ in sample], np.array([v for _, v in sample], float)
    bags = [{n for w in set(t.split()) if (n := normal(w))} for t in texts]
    machine = Machine(_choose_landmarks([b for b, v in zip(bags, y, strict=True) if v], [b for b, v in zip(bags, y, strict=True) if not v], landmarks))
    if not machine.landmarks or y.min() == y.max():
        return machine
    scorer = Scorer(machine)
    hit = scorer.values(set().union(*[set(t.split()) for t in texts]))
    by_doc = [scorer.sentence_values(t, hit) for t in texts]
    rows = [(v, 1.0 if label else -1.0) for values, label in zip(by_doc, y, strict=True) for v in values]
    shapes = [x for z in machine.landmarks for _ in range(3) for x in _variants(z, rng)]
    rows += [(v, 1.0) for v in machine.word_values(shapes) if v.any()]
    # sentences without any value: one of each clean document
    rows += [(np.zeros(len(machine.landmarks), np.float32), -1.0)] * int((y == 0).sum())
    gram = np.minimum(machine.word_values(machine.landmarks), 1)
    gram = (gram + gram.T) / 2
    values, vectors = np.linalg.eigh(gram.astype(np.float64))
    keep = values > 1e-3
    machine.white = (vectors[:, keep] / np.sqrt(values[keep])).astype(np.float32)
    x, side = np.array([v for v, _ in rows]) @ machine.white, np.array([s for _, s in rows])
    w, machine.bias = _svm(x.astype(np.float64), side)
    machine.weights = w.astype(np.float32)
    blank = float(machine.margin(np.zeros((1, len(machine.landmarks)), np.float32))[0])
    margins = np.array([machine.margin(np.array(v)).max() if v else blank for v in by_doc], np.float64)
    machine.slope, machine.shift = _logistic(margins, y)
    return machine


def held_out(key: Column) -> Column:
    """The fold that is kept out of training."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Machine:
    """Fit on labelled rows outside the held-out fold: at most `most` toxic and 2 * `most` others, of least hash.

    Rows with a null key, text or label and keys without a document are left out; where documents repeat a key, the
    least of their texts counts. Empty tables give a machine that scores everything alike.
    """
    own = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).where(F.col("k").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("k")))
    order = [F.xxhash64("k"), F.col("k"), F.col("y")]
    picked = own.where("y = 1").orderBy(*order).limit(most).unionByName(own.where("y = 0").orderBy(*order).limit(2 * most))
    # 3 * most keys: a bounded side; of documents that repeat a key the least text, so as many rows at most
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).where("t is not null").join(F.broadcast(picked.distinct()), "k").groupBy("k", "y").agg(F.min("t").alias("t")).collect()
    return fit([(r["t"], r["y"]) for r in sorted(rows, key=lambda r: (r["k"], r["y"], r["t"]))])


def score(docs: DataFrame, machine: Machine, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: key, score (0 to 1).

    Null and empty texts have no word of value and get the score of a text without any; very long texts are scored
    whole; repeated rows and null keys stay; further columns are ignored; an empty table gives none.
    """
    import uuid

    name = uuid.uuid4().hex

    def run(batches):
        import pyarrow as pa

        scorer = keep(f"toxicity {name}", None, lambda: Scorer(machine))
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                b = batch.slice(at, 512)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scorer.scores(b.column(1).to_pylist()), pa.float64())], ["k", "score"])

    kind = docs.schema[key].dataType
    rows = docs.select(F.col(key).alias("k"), F.coalesce(text, F.lit("")).alias("t"))
    out = rows.mapInArrow(run, T.StructType([T.StructField("k", kind), T.StructField("score", T.DoubleType())]))
    return out.withColumnRenamed("k", key)


def reject_toxic(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, whose text scores below the threshold; edge cases as in `score`. One
    pass without a shuffle: rows are scored where they stand."""
    import uuid

    name, place = uuid.uuid4().hex, docs.columns.index(text)

    def run(batches):
        import pyarrow as pa

        scorer = keep(f"toxicity {name}", None, lambda: Scorer(machine))
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                b = batch.slice(at, 512)
                found = scorer.scores([x or "" for x in b.column(place).to_pylist()])
                yield b.filter(pa.array([x < threshold for x in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
