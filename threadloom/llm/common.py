"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but these separators (fixed values of the contracts).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, what: str) -> str:
    """A new folder name below the folder that the cluster shares, `spark.checkpoint.dir`.

    Where that is unset a session on one machine (tests) gets a folder of that machine; on a cluster it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        if not found.isDefined() and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        base = found.get() if found.isDefined() else f"file://{tempfile.mkdtemp(prefix='shared-')}"
        spark.sparkContext.setCheckpointDir(base)
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def written(spark: SparkSession, df: DataFrame, what: str) -> DataFrame:
    """df as a table written in the shared folder: cuts lineage, and survives lost executors.

    A result may read such tables long after the operator that wrote them returned, so they stay; whoever is done with
    all results of a session deletes the folder.
    """
    path = shared_dir(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 256) -> Iterator[None]:
    """What is written meanwhile goes to Python in batches of so many rows, and not of Spark's 10,000, which are held
    outside the heap by the executor and again by the worker. The session's setting comes back afterwards."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store through Spark's own file system layer."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).delete(p, True)


_kept: dict[tuple, Any] = {}


def keep(owner: str, key: Any, make: Callable[[], Any]) -> Any:
    """An object that a Python worker builds once and uses for further tasks of the same operator. Workers outlive
    stages: when another operator comes, what earlier ones kept is dropped and its memory given back."""
    if (owner, key) not in _kept:
        if any(o != owner for o, _ in _kept):
            _kept.clear()
            give_back()
        _kept[owner, key] = make()
    return _kept[owner, key]


def give_back() -> None:
    """Free memory goes back to the system, as far as the C library can do that."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


class Memo:
    """Values by string, bounded by bytes: two generations of half the limit each. What is asked for stays; what
    wasn't for a whole generation goes."""

    #: A dictionary's slot, the string's and the value's headers.
    ENTRY = 200

    def __init__(self, limit: int):
        self.half, self.held = limit // 2, 0
        self.young: dict[str, Any] = {}
        self.old: dict[str, Any] = {}

    def of(self, keys: set[str], learn: Callable[[list[str]], Iterable[Any]]) -> dict[str, Any]:
        """The values of the keys. `learn` gives those of unknown ones, in order."""
        if self.held > self.half:
            self.old, self.young, self.held = self.young, {}, 0
        known = self.young.keys() & keys
        got = {k: self.young[k] for k in known}
        rest = keys.difference(known) if len(known) < len(keys) else ()
        again = {k: self.old[k] for k in rest if k in self.old}
        new = [k for k in rest if k not in again]
        again.update(zip(new, learn(new), strict=True))
        self.held += self.ENTRY * len(again) + sum(map(len, again))
        self.young.update(again)
        got.update(again)
        return got

    def join(self, lists: list[list[str]], join: Callable[[Iterable[Any]], Any], learn: Callable[[list[str]], Iterable[Any]]) -> list[Any]:
        """For each list the values of its strings, joined. The batch's own dictionary is small, so that its lookups
        stay in the processor's caches."""
        get = self.of(set().union(*lists), learn).__getitem__
        return [join(map(get, x)) for x in lists]


def ranges(begin, size):
    """begin[0], begin[0] + 1, ... of each range, one after the other."""
    import numpy as np

    return np.arange(size.sum()) + np.repeat(begin - np.cumsum(size) + size, size)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: Column) -> Column:
    """Words of a text, native; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")

