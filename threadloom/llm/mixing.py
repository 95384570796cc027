"""Mixing sources to target weights: hash-random keys, distributed prefix sums, an exact cut at each budget.

Every document gets a random key, the MD5 of its id, its seed and its text's digest; equal rows fall back on nothing
else, so reruns agree. A source's rows are range-sorted by key over `buckets` equal ranges of the key space (keys are
uniform, so ranges are even and no source sits in one task), running sums are taken inside a bucket, and a prefix sum
over the bucket totals, a table of at most sources x buckets rows, shifts them. A document that ends within the
source's remainder is taken once more than the whole epochs; the one that the cut falls in is taken in part, so a
source's taken words are its budget exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm.common import word_count, written

#: Rows aimed at in a bucket; buckets of a source are a power of two, by its number of rows.
BUCKET_ROWS = 4_096
#: Of the random keys.
SEED = 20


def targets(sizes: DataFrame, weights: list[float], share: float, most_epochs: float) -> DataFrame:
    """sizes: source, source_size, one row a source. Adds target.

    Sources by code point, null last, weigh `weights`, repeating. They share `share` times all sizes by weight; no
    target goes above `most_epochs` times its source's size, and the excess is shared again by weight until none is
    above. In closed form: with sources ordered by cap / weight, a source is at its cap when its cap / weight is at
    most the level that the sources from it onwards would share. One row a source, so one task holds it.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(order)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((place - 1) % len(weights) + 1).cast("int"))
    t = sizes.withColumns({"weight": w, "cap": F.lit(float(most_epochs)) * F.col("source_size")})
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, onwards = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing)
    total = F.lit(float(share)) * F.sum("source_size").over(Window.partitionBy())
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onwards)
    t = t.withColumn("level", level).withColumn("capped", F.col("cap") / F.col("weight") <= F.col("level"))
    # the first source that is not capped sets the level for it and all after
    t = t.withColumn("final", F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), F.col("level").alias("level")))).over(Window.partitionBy())["level"])
    return t.select("source", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(F.least("cap", F.col("final") * F.col("weight"))).alias("target"))


def random_key(key: Column, text: Column, seed: int) -> Column:
    return F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(f":{seed}:"), F.md5(F.coalesce(text, F.lit("")))))


def mix(docs: DataFrame, weights: list[float], share: float = 1.5, most_epochs: float = 2.0, seed: int = SEED, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per row of docs: key, size, source, source_size, target, taken, rank_key.

    size: words of the whole text (null and empty: 0). A null source is a source. Repeated rows have the same random
    key and stand beside each other; nothing is dropped. Documents without words take none. An empty table gives
    none; further columns are ignored.
    """
    # every text is read once: what follows reads some 60 bytes a row
    rows = docs.select(F.col(key).alias("k"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), random_key(F.col(key), F.col(text), seed).alias("r"))
    rows = written(docs.sparkSession, rows, "sizes")
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    buckets = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.lit(1.0), F.col("n") / BUCKET_ROWS)))).cast("long")
    plan = targets(per.select("source", "source_size"), weights, share, most_epochs).alias("t").join(per.select(F.col("source").alias("s2"), buckets.alias("buckets")), F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
    # the first eight hex digits of the key, cut into the source's number of ranges
    of = F.shiftright(F.conv(F.substring("r", 1, 8), 16, 10).cast("long") * F.col("buckets"), 32)
    keyed = rows.join(plan.withColumnRenamed("source", "s2"), F.col("source").eqNullSafe(F.col("s2"))).drop("s2").withColumn("b", of)
    totals = keyed.groupBy(F.col("source").alias("s2"), F.col("b").alias("b2")).agg(F.sum("size").alias("words"))
    base = totals.withColumn("base", F.coalesce(F.sum("words").over(Window.partitionBy("s2").orderBy("b2").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("words")
    inside = Window.partitionBy("source", "b").orderBy("r", "k", "size").rowsBetween(Window.unboundedPreceding, 0)
    summed = keyed.withColumn("end", F.sum("size").over(inside))
    placed = summed.join(base, F.col("source").eqNullSafe(F.col("s2")) & (F.col("b") == F.col("b2"))).drop("s2", "b2")
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = budget - epochs * F.col("source_size")
    start = F.col("base") + F.col("end") - F.col("size")
    more = F.greatest(F.lit(0), F.least(F.col("size"), rest - start))
    return placed.select(F.col("k").alias(key), "size", F.col("source").alias(source), "source_size", "target", (epochs * F.col("size") + more).cast("long").alias("taken"), F.col("r").alias("rank_key"))
