"""The official roster: four tables in one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.operators.report import teaching

TABLES = ("instructor", "course", "section", "section_instructor")


def is_available(spark: SparkSession, folder: str) -> bool:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = lambda t: jvm.org.apache.hadoop.fs.Path(f"{folder}/{t}.parquet")
    return all(path(t).getFileSystem(conf).exists(path(t)) for t in TABLES)


def load(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(roster, teaching). Roster order is the `ord` column; without one, a fixed order by hash."""
    read = lambda t: spark.read.parquet(f"{folder}/{t}.parquet")
    r = read("instructor")
    order = F.col("ord") if "ord" in r.columns else F.xxhash64("instructor_id")
    roster = r.select(F.col("instructor_id").cast("string").alias("instructor_id"), "name_normalized", "name_display", order.cast("long").alias("ord"))
    key = lambda df: df.withColumn("instructor_id", F.col("instructor_id").cast("string")) if "instructor_id" in df.columns else df
    return roster, teaching(read("section"), key(read("section_instructor")), read("course"))
