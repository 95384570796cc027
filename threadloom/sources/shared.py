"""Tables that a query writes for itself, in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder name below `spark.checkpoint.dir`. Where that is unset, a session on one machine gets a folder of that
    machine; on a cluster it is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        base = f"file://{tempfile.mkdtemp(prefix='shared-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def kept(df: DataFrame, what: str) -> DataFrame:
    """df as a written table: what it took is done once, plans that read it stay small, and a lost executor costs a
    read. It stays until the folder is deleted."""
    path = shared_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
