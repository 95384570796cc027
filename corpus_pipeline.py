"""A corpus pipeline: the functions of STAGES are applied one after the other to documents.

Each takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a DataFrame; all but the last
return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm import byte_bpe, line_dedup, mixing, ngram_join, toxicity
from threadloom.llm.common import WORD, table, written
from threadloom.llm.queries import MIX_EPOCHS, MIX_SHARE, MIX_WEIGHTS


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine, fitted on the labelled ones outside the held-out fold, rejects go. Null and empty
    texts score as one without any word of value and stay; repeated rows go or stay together; an empty table gives an
    empty one."""
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.reject_toxic(docs, machine)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on many sites go, but for their first occurrence; n_chars follows the text (null for a null text). No
    document goes; ties and repeats as in `dedup_lines`."""
    out = line_dedup.dedup_lines(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their shingles one stays: of the component's least id, and of rows that share that id the
    one of least text. Documents without words are in no group and stay, and so do those whose id is null in a
    component of such alone, one for each text. Equal rows count as one."""
    members, _ = ngram_join.jaccard_classes(docs)
    kept = members.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("kept")).distinct()
    rows = docs.select(F.struct("*").alias("d"), F.col("doc_id").alias("k"), F.coalesce("text", F.lit("")).alias("t"))
    rows = rows.join(kept, F.col("k").eqNullSafe(F.col("kept")), "left_semi")
    # the join has brought rows of one id together; those without words count each by itself
    alone = F.when(~F.regexp_like("t", F.lit(WORD)), F.monotonically_increasing_id())
    one = rows.groupBy(F.coalesce("k", F.lit(0)).alias("id"), F.isnull("k").alias("no_id"), alone.alias("row"), F.when(F.isnull("k"), F.col("t")).alias("own"))
    return one.agg(F.min_by("d", "t").alias("d")).select("d.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: whole epochs, and the document that a budget's cut falls in if at
    least half of it is taken. Documents without words are in no mix and go; null sources are a source; rows that are
    equal in id and text are taken alike, as often as the average of them."""
    mixed = mixing.mix(docs, MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS)
    times = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(F.lit(0)).cast("int")
    # equal rows share a key and are interchangeable
    per = mixed.groupBy(F.col("rank_key").alias("r")).agg(F.round(F.avg(times)).cast("int").alias("times")).where("times > 0")
    rows = docs.select(F.struct("*").alias("d"), mixing.random_key(F.col("doc_id"), F.col("text"), mixing.SEED).alias("rk"))
    out = rows.join(per, F.col("rk") == F.col("r")).select("d", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("epoch"))
    return out.select(*[F.col("d")[c].alias(c) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of what they decode to, a row for each document of the mix; null texts
    count as empty, repeats and null ids stay, an empty table gives none."""
    return byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


STAGES = [
    ("toxicity", reject_toxic),
    ("line dedup", drop_boilerplate),
    ("n-gram Jaccard join", one_of_each_group),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode),
]
#: SQL can't express the string-kernel machine; tests/llm/test_pipeline.py holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(spark, docs, f"stage-{i}")
    return docs
