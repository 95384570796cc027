"""Ordered fallback between sources: the first that has rows is used, and named."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def source_order(windowed: bool, credentials: bool, query: str | None, prefer_archive: bool) -> list[str]:
    """Which sources are asked, in order."""
    if windowed:
        return ["archive"]
    fallback = ["archive", "rss"] if query or prefer_archive else ["json", "archive", "rss"]
    return ["oauth", *fallback] if credentials and not query else fallback


def ranked(sources: list[tuple[str, DataFrame]]) -> DataFrame:
    """All rows with source and source_rank."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumns({"source": F.lit(name), "source_rank": F.lit(i)}) for i, (name, df) in enumerate(sources)])


def first_with_rows(rows: DataFrame) -> DataFrame:
    """Of rows with source_rank, those of the least rank that has any. The least rank is one row, so it is broadcast."""
    least = rows.agg(F.min("source_rank").alias("least"))
    return rows.join(F.broadcast(least), F.col("source_rank") == F.col("least")).drop("least")


def first_per_key(rows: DataFrame, key: str) -> DataFrame:
    """For each key the rows of its least rank."""
    return rows.withColumn("least", F.min("source_rank").over(Window.partitionBy(key))).where("source_rank = least").drop("least")
