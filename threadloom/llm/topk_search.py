"""Exact top-k search by inner product through a pivot-distance index.

Inner products become distances with one more dimension: with M the largest norm, a candidate x is placed at
(x, sqrt(M^2 - |x|^2)) and a query q at (q, 0); then |q' - x'|^2 = |q|^2 + M^2 - 2 q.x, so the nearest are those with
the greatest products.

Index: each candidate is keyed by its nearest pivot and its distance to it. Pivots are `pivots` candidates with the
least hash. A histogram of (pivot, distance bin), at most pivots x bins rows, is cut into annuli of about
`block_rows` rows each; an annulus that cannot be cut, as of equal vectors, is dealt by a hash into chunks of that
size. So no block grows with the data, and no bin is dropped.

Search: queries are packed into blocks by the annulus nearest to them. First each query is scored against that
annulus alone, which gives a lower bound t of its k-th best score. Then the annuli are taken whose triangle bound
max(rmin - d(q, p), d(q, p) - rmax, 0) allows a score of t or more; scores below t are not handed on. An annulus is
sent to the task that scores it, against the query blocks that need it; where these are many, to several. Bounds are loosened by a small relative
slack against rounding; the scores themselves are whole numbers and exact.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm.common import written

#: Each task knows all pivots and a bin table of them, some 16 MB at this number.
MOST_PIVOTS = 1_024
#: Query blocks that a task scores against a block, about.
QUERY_BLOCKS = 16
#: Annuli whose bounds a task works out at a time, for some queries.
ANNULI = 16_384
#: Components are exact while products' sums stay below 2^53.
SLACK = 1e-6


def integer_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: float = 64.0) -> DataFrame:
    """k, v: floor(scale * x) of each component as array<long>. Rows with a null key, a null vector, or a null or
    non-finite component take no part; equal rows count once."""
    x = F.col("v")
    whole = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    got = rows.select(F.col(key).alias("k"), F.col(vector).cast("array<double>").alias("v")).where(F.col("k").isNotNull() & whole)
    return got.select("k", F.transform("v", lambda c: F.floor(c * scale)).alias("v")).distinct()


def _matrix(column) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)


class Index:
    """What tasks need to know of the index; its size is bounded by pivots and bins."""

    def __init__(self, pivots: np.ndarray, biggest: float, bins: int):
        self.m2 = biggest
        self.pivots = np.column_stack([pivots, np.sqrt(np.maximum(self.m2 - (pivots**2).sum(1), 0))])
        self.width = max(2 * np.sqrt(self.m2), 1e-9) / bins * (1 + 1e-9)
        self.bins = bins

    def distances(self, x: np.ndarray, extra: np.ndarray) -> np.ndarray:
        full = np.column_stack([x, extra])
        d = (full**2).sum(1)[:, None] + (self.pivots**2).sum(1)[None] - 2 * full @ self.pivots.T
        return np.sqrt(np.maximum(d, 0))

    def key(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        d = self.distances(x, np.sqrt(np.maximum(self.m2 - (x**2).sum(1), 0)))
        p = d.argmin(1)
        r = d[np.arange(len(x)), p]
        return p, r, np.minimum((r / self.width).astype(np.int64), self.bins - 1)

    def cut(self, histogram: list, block_rows: int) -> None:
        """histogram: (pivot, bin, rows, rmin, rmax), in order. Sets the annuli."""
        self.annulus = np.full((len(self.pivots), self.bins), -1)
        made: list[list] = []
        for p, b, n, low, high in histogram:
            if made and made[-1][0] == p and made[-1][1] + n <= block_rows:
                made[-1][1] += n
                made[-1][3] = high
            else:
                made.append([p, n, low, high])
            self.annulus[p, b] = len(made) - 1
        self.of = np.array([m[0] for m in made])
        self.rows = np.array([m[1] for m in made])
        self.low, self.high = np.array([m[2] for m in made]), np.array([m[3] for m in made])
        self.chunks = np.maximum(1, -(-self.rows // block_rows))

    def nearest(self, q: np.ndarray):
        """Lower bounds of the distance from queries to annuli, some annuli at a time: (the first one's place, bounds)."""
        to_pivots = self.distances(q, np.zeros(len(q)))
        for a in range(0, len(self.of), ANNULI):
            s = slice(a, a + ANNULI)
            d = to_pivots[:, self.of[s]]
            yield a, np.maximum(np.maximum(self.low[s] - d, d - self.high[s]), 0)


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products: through floats where these are exact."""
    top = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if top < 2.0**53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def exact_top_k(rows: DataFrame, queries: DataFrame, k: int = 20, pivots: int = 16, bins: int = 1024, block_rows: int = 4096, query_rows: int = 256) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest products of each query, ties to the smaller vec_id.

    rows, queries: k, v as `integer_vectors` gives them. Rows with the query's own key take no part. A product is of
    two vectors of one length: each length that occurs has an index and a search of its own (vectors without
    components score 0 with each other). `pivots` is the least number of them; it grows with the square root of the
    number of blocks. Where fewer than k candidates exist all are given; no queries or no candidates give an empty
    result. Ties, equal vectors and equal rows need no care of the caller; further columns are ignored.
    """
    spark = rows.sparkSession
    own = lambda df: df.select("k", F.size("v").alias("n"), F.when(F.size("v") == 0, F.array(F.lit(0).cast("long"))).otherwise(F.col("v")).alias("v"))
    # the key may be repeated with other vectors; all are candidates
    rows, queries = written(spark, own(rows), "vectors"), own(queries)
    norm = F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)).alias("m2")
    lengths = rows.groupBy("n").agg(F.count(F.lit(1)).alias("c"), norm).orderBy("n").collect()  # a row a length
    out = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    for at in lengths:
        own_pivots = max(pivots, int((at["c"] / block_rows) ** 0.5) * 2)
        mine = lambda df, n=at["n"]: df.where(F.col("n") == n).select("k", "v")
        found = _search(mine(rows), mine(queries), k, min(own_pivots, MOST_PIVOTS), float(at["m2"]), bins, block_rows, query_rows)
        out = found if len(lengths) == 1 else out.unionByName(found)
    return out


def _search(rows: DataFrame, queries: DataFrame, k: int, pivots: int, m2: float, bins: int, block_rows: int, query_rows: int) -> DataFrame:
    """The search among vectors of one length. m2: the square of the greatest norm."""
    import pyarrow as pa

    spark = rows.sparkSession
    chosen = rows.orderBy(F.xxhash64("k"), "k", "v").limit(pivots).select("v").collect()
    index = Index(np.array([r["v"] for r in chosen], np.float64), m2, bins)

    def place(batches):
        for b in batches:
            if b.num_rows:
                p, r, bucket = index.key(_matrix(b.column(1)))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(p), pa.array(bucket), pa.array(r)], ["k", "v", "p", "b", "r"])

    placed = rows.select("k", "v").mapInArrow(place, "k long, v array<long>, p long, b long, r double")
    histogram = placed.groupBy("p", "b").agg(F.count(F.lit(1)), F.min("r"), F.max("r")).orderBy("p", "b").collect()
    index.cut([tuple(h) for h in histogram], block_rows)

    def blocks(batches):
        for b in batches:
            if b.num_rows:
                p, _, bucket = index.key(_matrix(b.column(1)))
                a = index.annulus[p, bucket]
                keys = b.column(0).to_numpy(zero_copy_only=False)
                chunk = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % index.chunks[a]
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(chunk), b.column(0), b.column(1)], ["a", "c", "k", "v"])

    block = rows.select("k", "v").mapInArrow(blocks, "a long, c long, k long, v array<long>")

    def seeds(batches):
        for b in batches:
            if b.num_rows:
                # of the nearest annuli one that can hold k others, if any can
                usable = index.rows > k
                usable = usable if usable.any() else np.ones(len(usable), bool)
                best = np.zeros(b.num_rows, np.int64)
                for at in range(0, b.num_rows, query_rows):
                    q = _matrix(b.column(1).slice(at, query_rows))
                    least = np.full(len(q), np.inf)
                    for a, near in index.nearest(q):
                        near = np.where(usable[a : a + near.shape[1]], near, np.inf)
                        i = near.argmin(1)
                        value = near[np.arange(len(q)), i]
                        best[at : at + len(q)] = np.where(value < least, a + i, best[at : at + len(q)])
                        least = np.minimum(least, value)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(best)], ["k", "v", "a"])

    asked = queries.select("k", "v").mapInArrow(seeds, "k long, v array<long>, a long")
    # query blocks of at most so many rows: (a, g)
    per = asked.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / query_rows).cast("long").alias("groups"))
    asked = written(spark, asked.join(per, "a").withColumn("g", F.pmod(F.xxhash64("k"), F.col("groups"))).drop("groups"), "queries")

    def bound(key, left, right):
        """left: queries, right: a block. The k-th best score of each query there, or none."""
        out_k, out_v, out_t = left.column("k"), left.column("v"), []
        q, ids = _matrix(left.column("v").combine_chunks()), left.column("k").to_numpy()
        if right.num_rows:
            x, keys = _matrix(right.column("v").combine_chunks()), right.column("k").to_numpy()
        for i in range(0, len(q) if right.num_rows else 0, query_rows):
            s = _exact(q[i : i + query_rows], x)
            s[ids[i : i + query_rows, None] == keys[None]] = np.iinfo(np.int64).min
            valid = (s > np.iinfo(np.int64).min).sum(1)
            kth = np.partition(s, -k, axis=1)[:, -k] if s.shape[1] >= k else np.full(len(s), np.iinfo(np.int64).min)
            out_t += np.where(valid >= k, kth, np.iinfo(np.int64).min).tolist()
        out_t = out_t or [np.iinfo(np.int64).min] * len(q)
        return pa.table({"k": out_k, "v": out_v, "t": pa.array(out_t, pa.int64()), "qa": pa.array([key[0].as_py()] * len(q), pa.int64()), "g": left.column("g")})

    first = block.where("c = 0")
    # queries of an annulus are dealt into groups, so hot annuli are shared by tasks: the block goes to each group
    groups = asked.select(F.col("a").alias("ga"), F.col("g").alias("gg")).distinct()
    seed = first.join(groups, F.col("a") == F.col("ga")).select("ga", "gg", "k", "v")
    known = asked.groupBy("a", "g").cogroup(seed.groupBy("ga", "gg")).applyInArrow(bound, "k long, v array<long>, t long, qa long, g long")
    known = written(spark, known, "bounds")

    def needed(batches):
        """A row for each query and block that its bound admits; chunks of an annulus share its bound."""
        for b in batches:
            for at in range(0, b.num_rows, query_rows):
                part = b.slice(at, query_rows)
                q, t = _matrix(part.column(1)), part.column(2).to_numpy(zero_copy_only=False).astype(np.float64)
                far = np.sqrt(np.maximum((q**2).sum(1) + index.m2 - 2 * t, 0)) * (1 + SLACK) + SLACK
                qa, g = part.column(3).to_numpy(zero_copy_only=False), part.column(4).to_numpy(zero_copy_only=False)
                for first, near in index.nearest(q):
                    i, a = np.nonzero(near <= far[:, None])
                    a += first
                    n = index.chunks[a]
                    i, a = np.repeat(i, n), np.repeat(a, n)
                    c = np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
                    for j in range(0, len(i), 65536):
                        s = slice(j, j + 65536)
                        pair = np.unique(np.column_stack([a[s], c[s], qa[i[s]], g[i[s]]]), axis=0)
                        yield pa.RecordBatch.from_arrays([pa.array(pair[:, x]) for x in range(4)], ["a", "c", "qa", "g"])

    wanted = written(spark, known.mapInArrow(needed, "a long, c long, qa long, g long").distinct(), "wanted")
    # a block that many query blocks need is sent to several tasks, each with some of them
    per = wanted.groupBy("a", "c").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCKS).alias("tasks"))
    wanted = wanted.join(per, ["a", "c"]).withColumn("task", F.pmod(F.xxhash64("qa", "g"), F.col("tasks")))
    sent = wanted.join(known, ["qa", "g"]).select(F.col("a").alias("sa"), F.col("c").alias("sc"), "task", "k", "v", "t")
    places = per.select(F.col("a").alias("pa"), F.col("c").alias("pc"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1)).alias("task"))
    placed_blocks = block.join(places, (F.col("a") == F.col("pa")) & (F.col("c") == F.col("pc"))).select("a", "c", "task", "k", "v")

    def score(key, left, right):
        """left: queries that need this block, right: the block."""
        got: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(3)]
        if right.num_rows and left.num_rows:
            x, keys = _matrix(right.column("v").combine_chunks()), right.column("k").to_numpy()
            order = np.argsort(keys, kind="stable")
            x, keys = x[order], keys[order]
            q, ids, t = _matrix(left.column("v").combine_chunks()), left.column("k").to_numpy(), left.column("t").to_numpy()
            for i in range(0, len(q), query_rows):
                s = _exact(q[i : i + query_rows], x)
                own = ids[i : i + query_rows]
                for j, line in enumerate(s):
                    found = np.flatnonzero((line >= t[i + j]) & (keys != own[j]))
                    # best k of the block; a stable sort keeps the smaller key first
                    best = found[np.argsort(-line[found], kind="stable")[:k]]
                    got[0].append(np.full(len(best), own[j]))
                    got[1].append(keys[best])
                    got[2].append(line[best])
        return pa.table({n: pa.array(np.concatenate(g), pa.int64()) for n, g in zip(("query_id", "vec_id", "score"), got, strict=True)})

    scored = sent.groupBy("sa", "sc", "task").cogroup(placed_blocks.groupBy("a", "c", "task")).applyInArrow(score, "query_id long, vec_id long, score long")
    best = scored.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
