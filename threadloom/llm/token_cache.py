"""Token counts through a digest cache.

The cache is a Parquet table (tokenizer string, digest binary, n_tokens long). A document's digest is the SHA-256
of its normalised content; the tokenizer's version is the SHA-256 of its file. Documents are joined with the cache
on both; only distinct texts that miss are encoded, and their counts are appended, which Spark's commit protocol
makes visible only as a whole. Appends of two jobs may hold the same digest twice: a read takes one.

Normalising folds runs of ASCII white space to one space and trims. It is used only with tokenizers whose
own normaliser drops white space, as for `word_bpe_49k.json`; else pass `fold_space=False`.
"""

from __future__ import annotations

import hashlib
import os

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.llm.chunks import LONGEST, Known, distinct_ranges, text_slices
from threadloom.llm.common import keep, shared_dir, written

CACHE = T.StructType([T.StructField("tokenizer", T.StringType()), T.StructField("digest", T.BinaryType()), T.StructField("n_tokens", T.LongType())])

#: Digests of misses that are sent to all tasks, 32 bytes each; of more, texts are shuffled to them.
MOST_SENT = 500_000


def tokenizer_version(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def _digest(text: Column, fold_space: bool) -> tuple[Column, Column]:
    text = F.coalesce(text, F.lit(""))
    if fold_space:
        text = F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))
    return text, F.unhex(F.sha2(text, 256))


class ChunkCounter:
    """Counts of chunks between spaces. A space ends every token of the `.json` files used with it, so the counts of a
    text's chunks add up to the text's; chunks recur, texts hardly do. Distinct chunks are found by 128-bit hashes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            own = Tokenizer.from_file(path)
            own.no_padding()
            own.no_truncation()
            self.encode = lambda xs: [len(e.ids) for e in own.encode_batch_fast(xs, add_special_tokens=False)]
            self.by_chunk = True
        else:
            import sentencepiece

            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda xs: [len(x) for x in sp.encode(xs, num_threads=1)]
            self.by_chunk = False  # its pieces carry a prefix space: whole texts
        self.known = Known()

    def _library(self, raw: bytes, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
        chunks = [raw[a:b].decode() for a, b in zip(begin.tolist(), stop.tolist(), strict=True)]
        return np.array([n for i in range(0, len(chunks), 4096) for n in self.encode(chunks[i : i + 4096])], np.int64)

    def _slice(self, data: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Chunks are the runs of anything but U+0020 in a text; those of more than LONGEST bytes aren't remembered."""
        if not len(data):
            return np.zeros(len(begin), np.int64)
        raw, gap = data.tobytes(), data == 0x20
        cut = ~gap
        cut[1:] &= gap[:-1]
        full = begin[begin < stop]
        cut[full] = ~gap[full]
        first = np.flatnonzero(cut)
        edges = np.sort(np.concatenate([np.flatnonzero(gap), stop]))
        last = edges[np.searchsorted(edges, first, "right")]
        n = np.zeros(len(first), np.int64)
        usual = np.flatnonzero(last - first <= LONGEST)
        found = distinct_ranges(data, first[usual], last[usual])
        if found is None:
            usual = usual[:0]
        else:
            u, g, one, of = found
            at, un, good = self.known.find(u, g)
            new = np.flatnonzero(~good)
            un[new] = self._library(raw, first[usual][one[new]], last[usual][one[new]])
            n[usual] = un[of]
            self.known.keep(u[new], g[new], at[new], un[new], 0)
        rest = np.ones(len(first), bool)
        rest[usual] = False
        n[rest] = self._library(raw, first[rest], last[rest])
        total = np.append(0, np.cumsum(n))
        return total[np.searchsorted(first, stop)] - total[np.searchsorted(first, begin)]

    def count(self, column, whole: bool = False) -> list[int]:
        """column: an Arrow string array without nulls."""
        if whole or not self.by_chunk:
            return self.encode(column.to_pylist())
        return np.concatenate([np.zeros(0, np.int64), *(self._slice(*s) for s in text_slices(column))]).tolist()


def _count(path: str, whole: bool):
    def run(batches):
        import pyarrow as pa

        counter = keep("token_cache", path, lambda: ChunkCounter(path))
        for b in batches:
            digests, texts = b.column(0), b.column(1)
            for i in range(0, b.num_rows, 1024):
                got = counter.count(texts.slice(i, 1024), whole)
                yield pa.RecordBatch.from_arrays([digests.slice(i, 1024), pa.array(got, pa.int64())], ["digest", "n_tokens"])

    return run


def read_cache(spark: SparkSession, path: str, version: str) -> DataFrame:
    """The counts stored for one tokenizer version, one row a digest; none where the cache isn't there yet."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(conf).exists(p):
        return spark.createDataFrame([], CACHE).select("digest", "n_tokens")
    return spark.read.schema(CACHE).parquet(path).where(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, tokenizer: str, cache: str | None = None, key: str = "doc_id", text: str = "text", fold_space: bool = True, by_chunk: bool = True) -> DataFrame:
    """One row per row of docs: key, n_bytes (UTF-8), n_tokens.

    tokenizer: a file that every executor can read at that path. cache: folder of the digest cache in shared
    storage; None makes a new one in the shared folder. by_chunk: count between spaces and memoise (exact for
    tokenizers that drop white space); False passes whole texts to the library.

    Null and empty texts have 0 bytes and 0 tokens of content; very long texts are counted whole; repeated rows are
    counted once and reported each; null keys stay; further columns are ignored, an empty table gives none.
    """
    spark, version = docs.sparkSession, tokenizer_version(tokenizer)
    cache = cache or shared_dir(spark, "token-cache")
    content, digest = _digest(F.col(text), fold_space)
    known = read_cache(spark, cache, version)
    rows = docs.select(F.col(key).alias("k"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), digest.alias("digest"))
    texts = docs.select(digest.alias("digest"), content.alias("content"))
    if not known.isEmpty():
        # digests alone meet the cache; then texts meet the misses, which few of them do with a warm cache
        open_ = written(spark, rows.select("digest").distinct().join(known.select("digest"), "digest", "left_anti"), "misses")
        texts = texts.join(F.broadcast(open_) if open_.count() <= MOST_SENT else open_, "digest", "left_semi")
    # distinct texts: the aggregate drops copies within each task before the shuffle
    misses = texts.groupBy("digest").agg(F.first("content").alias("content"))
    counted = misses.mapInArrow(_count(tokenizer, not by_chunk), "digest binary, n_tokens long")
    counted.select(F.lit(version).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(cache)
    counts = read_cache(spark, cache, version)
    return rows.join(counts, "digest", "left").select(F.col("k").alias(key), "n_bytes", "n_tokens")
