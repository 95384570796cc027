"""Exports as JSON: folders of lines, or one pretty document that all tasks write.

A document's rows are put in order by a range sort; tasks turn them to text, and Spark's text writer leaves a file a
task. The commit step joins these files through Hadoop's file system: the driver moves bytes and sees no row. What stands
between two files follows from the kinds of row that meet there, which their first and last bytes tell.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from threadloom.functions.text import iso_time

#: Bytes of text that a task holds before they are a row of its file.
CHUNK = 1 << 20
HEAD, NOTE, TAIL, DOC = 0, 1, 2, 3
#: What stands between rows of these kinds: a thread's head, its comments, its end; whole documents.
BETWEEN = {(HEAD, NOTE): "\n", (HEAD, TAIL): "", (NOTE, NOTE): ",\n", (NOTE, TAIL): "\n  ", (TAIL, HEAD): ",\n", (DOC, DOC): ",\n"}


def write_lines(df: DataFrame, folder: str, keep_nulls: bool = True) -> None:
    """JSON lines, UTF-8, one part a task."""
    df.write.mode("overwrite").option("ignoreNullFields", not keep_nulls).json(folder)


def pretty(value, indent: int = 0) -> str:
    """Lines of pretty JSON; strings hold no line ends of their own."""
    text = json.dumps(value, ensure_ascii=False, indent=2)
    return text if not indent else "\n".join(" " * indent + line for line in text.split("\n"))


def _joined(pieces: Iterator[tuple[int, str]]) -> Iterator[str]:
    """Rows of text for a writer that ends each with a line end, which is part of what stands between them."""
    held: list[str] = []
    size, last = 0, None
    for kind, text in pieces:
        if last is not None:
            glue = BETWEEN[last, kind]
            if size >= CHUNK and "\n" in glue:
                before, _, after = glue.partition("\n")
                yield "".join([*held, before])
                held, size = [after], 0
            else:
                held.append(glue)
        held.append(text)
        size += len(text)
        last = kind
    if last is not None:
        yield "".join(held)


def _texts(indent: int, value: str | None):
    """Rows to documents; `value`: of this column alone."""

    def run(batches):
        import pyarrow as pa

        pieces = ((DOC, pretty(r if value is None else r[value], indent)) for b in batches for r in b.to_pylist())
        for text in _joined(pieces):
            yield pa.RecordBatch.from_arrays([pa.array([text])], ["value"])

    return run


def _thread_texts(batches):
    """Rows (kind, value: JSON of one line) in order to the text of threads."""
    import pyarrow as pa

    def pieces():
        for b in batches:
            for kind, value in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if kind == HEAD:
                    yield kind, pretty(json.loads(value) | {"comments": []})[: -len("]\n}")]
                else:
                    yield kind, "]\n}" if kind == TAIL else pretty(json.loads(value), 4)

    for text in _joined(pieces()):
        yield pa.RecordBatch.from_arrays([pa.array([text])], ["value"])


def _kind_at_start(first: bytes) -> int:
    return NOTE if first[:1] == b" " else TAIL if first[:1] == b"]" else HEAD


def _kind_at_end(last: bytes) -> int:
    return HEAD if last.endswith(b"[") else NOTE if last.endswith(b" }") else TAIL


class _Files:
    """Hadoop's file system, as the commit step needs it."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.conf)

    def parts(self, folder: str) -> list:
        p, fs = self.at(folder)
        return sorted((f for f in fs.listStatus(p) if f.getPath().getName().startswith("part-") and f.getLen()), key=lambda f: f.getPath().getName())

    def peek(self, status, at: int, n: int) -> bytes:
        stream = status.getPath().getFileSystem(self.conf).open(status.getPath())
        try:
            stream.seek(at)
            return bytes(stream.readNBytes(n))
        finally:
            stream.close()

    def append(self, out, status, n: int) -> None:
        """The first n bytes."""
        stream = status.getPath().getFileSystem(self.conf).open(status.getPath())
        try:
            self.jvm.org.apache.hadoop.io.IOUtils.copyBytes(self.jvm.org.apache.commons.io.input.BoundedInputStream(stream, n), out, self.conf, False)
        finally:
            stream.close()


def _local(path: str) -> str:
    return path if "://" in path else f"file://{os.path.abspath(path)}"


def _commit(spark: SparkSession, folder: str, path: str, before: str, after: str, if_none: str, kinds: bool) -> None:
    """Joins a folder's files to one at `path`, by way of a name beside it; parents are made. The folder goes."""
    files = _Files(spark)
    parts = files.parts(folder)
    (final, fs), (top, own) = files.at(_local(path)), files.at(folder)
    part, _ = files.at(f"{_local(path)}._part-{uuid.uuid4().hex}")
    fs.mkdirs(final.getParent())
    out = fs.create(part, True)
    put = lambda text: out.write(bytearray(text.encode()))
    put(before if parts else if_none)
    for i, p in enumerate(parts):
        if i:
            last = files.peek(parts[i - 1], max(0, parts[i - 1].getLen() - 7), 6)
            put(BETWEEN[_kind_at_end(last), _kind_at_start(files.peek(p, 0, 1))] if kinds else BETWEEN[DOC, DOC])
        files.append(out, p, p.getLen() - 1)  # without the writer's last line end
    if parts:
        put(after)
    out.close()
    if fs.exists(final):
        fs.delete(final, False)
    if not fs.rename(part, final):
        raise OSError(f"can't rename to {path}")
    own.delete(top, True)


def _pieces_folder(spark: SparkSession, path: str) -> str:
    """Where tasks leave their files: the shared folder of the cluster, else beside the document."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local") and "://" not in path:
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return f"{base.rstrip('/')}/export-{uuid.uuid4().hex}" if base else f"{_local(path)}._pieces-{uuid.uuid4().hex}"


def write_document(df: DataFrame, path: str) -> int:
    """A pretty JSON array of a DataFrame's rows in their order. Returns the number of rows."""
    spark, counted = df.sparkSession, Observation()
    folder = _pieces_folder(spark, path)
    df.observe(counted, F.count(F.lit(1)).alias("n")).mapInArrow(_texts(0, None), "value string").write.text(folder)
    _commit(spark, folder, path, "[\n", "\n]\n", "[\n]\n", False)
    return counted.get["n"]


def write_names(names: DataFrame, path: str, count: str, listed: str) -> int:
    """A pretty JSON object of a column: how many there are, and the list."""
    spark, counted = names.sparkSession, Observation()
    folder = _pieces_folder(spark, path)
    names.observe(counted, F.count(F.lit(1)).alias("n")).mapInArrow(_texts(4, names.columns[0]), "value string").write.text(folder)
    n = counted.get["n"]
    head = f'{{\n  {json.dumps(count)}: {n},\n  {json.dumps(listed)}: ['
    _commit(spark, folder, path, head + "\n", "\n  ]\n}\n", head + "]\n}\n", False)
    return n


def write_threads(posts: DataFrame, comments: DataFrame, entities: DataFrame, path: str) -> int:
    """The threads of `relational.threads` as a pretty JSON array, whatever their size: a thread's comments are rows of
    the range sort and may lie in several tasks, none of which holds a thread. Returns the number of threads."""
    spark = posts.sparkSession
    folder = _pieces_folder(spark, path)
    e = entities.select(F.col("id").alias("professor_id"), F.struct("last_name", "first_name").alias("professor"))
    p = posts.join(e, "professor_id", "left")
    post = F.struct("post_id", "title", "url", "score", "num_comments", iso_time(F.col("created_utc")).alias("posted_at"), "author", F.coalesce("selftext", F.lit("")).alias("body"))
    line = lambda *cols: F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    none = F.lit(None)
    heads = p.select(F.col("created_utc").alias("t"), "post_id", F.lit(HEAD).alias("kind"), none.cast("double").alias("at"), none.cast("string").alias("id"), line("campus", "course", "professor", post.alias("post")).alias("value"))
    tails = posts.select(F.col("created_utc").alias("t"), "post_id", F.lit(TAIL).alias("kind"), none.cast("double").alias("at"), none.cast("string").alias("id"), none.cast("string").alias("value"))
    c = comments.select("post_id", F.col("created_utc").alias("at"), F.col("comment_id").alias("id"), line("comment_id", "parent_id", "author", "body", "score", "depth", iso_time(F.col("created_utc")).alias("posted_at")).alias("value"))
    notes = posts.select(F.col("created_utc").alias("t"), "post_id").join(c, "post_id").select("t", "post_id", F.lit(NOTE).alias("kind"), "at", "id", "value")
    rows = heads.unionByName(notes).unionByName(tails).orderBy(F.desc("t"), "post_id", "kind", "at", "id")
    rows.select("kind", "value").mapInArrow(_thread_texts, "value string").write.text(folder)
    _commit(spark, folder, path, "[\n", "\n]\n", "[\n]\n", True)
    return posts.count()


def write_object(value: dict, path: str) -> None:
    """A small object, pretty; parents are made."""
    target = _local(path).removeprefix("file://")
    os.makedirs(os.path.dirname(target), exist_ok=True)
    with open(target, "w", encoding="utf-8") as f:
        f.write(pretty(value) + "\n")
