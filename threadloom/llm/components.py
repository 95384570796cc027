"""Connected components by alternating large-star and small-star contraction.

Each step is a grouped minimum, which combines before its shuffle, and a join back; edges are written to the shared
folder after each round, so lineage stays short and lost executors cost one round. Rounds grow with the logarithm of
the longest path. Nothing of the graph reaches the driver but three sums a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import written


def _large_star(e: DataFrame) -> DataFrame:
    """Every node's greater neighbours are tied to the least of its neighbours and itself."""
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """e has u > v. A node and its smaller neighbours are tied to the least of them."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    tied = e.join(least, "u")
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges: a, b (long). One row per node with an edge to another: node, component (its least node).

    Loops, repeated and reversed edges and nulls do no harm; no edges give an empty result.
    """
    spark = edges.sparkSession
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e, last = written(spark, e, "edges"), None
    while True:
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first())
        if now == last or not now[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        last = now
        e = written(spark, _small_star(_large_star(e)), "edges")
