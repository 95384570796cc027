"""Line dedup by distinct-site spread.

A line is boilerplate when it stands on at least `min_sites` distinct sites. Lines are compared trimmed of white
space, by their MD5; blank lines are never boilerplate. The first occurrence (least key, then place) of a boilerplate
line stays, so that no text is lost from the corpus; every other one is removed.

How it runs: one pass over the texts writes the facts (document, place, line digest, site), some 50 bytes a line. A
line with fewer occurrences than `min_sites`, or on one site, cannot qualify; for the others HyperLogLog sketches per
line digest are built in each task and merged by aggregation. Estimates that are further from the threshold than
`margin` decide; the rest get exact distinct counts. Removals are grouped by document and joined back, so a text is
shuffled at most once, and a frequent line is only ever a few combined rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import written

MIN_SITES = 10
#: log2 of the sketch's registers: 4096 give a standard error of 1.6 %, so the margin is over nine of them.
LG_REGISTERS = 12
MARGIN = 0.15

_EDGES = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$"


def _text_key(text):
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def line_facts(docs: DataFrame, key: str, text: str, site: str) -> DataFrame:
    """k, t (digest of the text), place, line (digest), site: one row a line that isn't blank. A null site is a site."""
    rows = docs.select(F.col(key).alias("k"), _text_key(F.col(text)).alias("t"), F.concat(F.lit("s"), F.col(site).cast("string")).alias("site"), F.col(text).alias("x"))
    lines = rows.select("k", "t", F.coalesce("site", F.lit("")).alias("site"), F.posexplode(F.split("x", "\n")).alias("place", "line"))
    return lines.withColumn("line", F.regexp_replace("line", _EDGES, "")).where("line <> ''").withColumn("line", F.unhex(F.md5("line")))


def spread_lines(facts: DataFrame, min_sites: int = MIN_SITES, margin: float = MARGIN) -> DataFrame:
    """line: digests of the lines on at least min_sites distinct sites."""
    if min_sites <= 1:
        return facts.select("line").distinct()
    seen = facts.groupBy("line").agg(F.count(F.lit(1)).alias("n"), F.min("site").alias("a"), F.max("site").alias("b"))
    able = seen.where((F.col("n") >= min_sites) & (F.col("a") != F.col("b"))).select("line")
    sketches = facts.join(able, "line", "left_semi").groupBy("line").agg(F.hll_sketch_agg("site", F.lit(LG_REGISTERS)).alias("sketch"))
    spread = written(facts.sparkSession, sketches.select("line", F.hll_sketch_estimate("sketch").alias("sites")), "spread")
    sure = spread.where(F.col("sites") > min_sites * (1 + margin)).select("line")
    near = spread.where(F.col("sites").between(min_sites * (1 - margin), min_sites * (1 + margin))).select("line")
    # distinct pairs first: both steps combine before their shuffles
    pairs = facts.join(near, "line", "left_semi").select("line", "site").distinct()
    exact = pairs.groupBy("line").agg(F.count(F.lit(1)).alias("sites")).where(F.col("sites") >= min_sites).select("line")
    return sure.unionByName(exact)


def dedup_lines(docs: DataFrame, min_sites: int = MIN_SITES, keep_first: bool = True, key: str = "doc_id", text: str = "text", site: str = "source") -> DataFrame:
    """docs with boilerplate lines gone from `text`, and lines_removed (long) after its columns.

    Every row and column of docs stays; a text that loses all its lines becomes empty. Null texts stay null, empty
    ones empty. Rows that agree in key and text count as one document when the first occurrence is sought, and keep
    it alike; null keys come last. A column lines_removed of docs is replaced. Very long texts are treated whole;
    an empty table gives an empty one.
    """
    spark = docs.sparkSession
    facts = written(spark, line_facts(docs, key, text, site), "lines")
    flagged = spread_lines(facts, min_sites)
    hits = facts.join(flagged, "line", "left_semi")
    if keep_first:
        order = F.struct(F.col("k").isNull().alias("n"), "k", "t", "place")
        first = hits.groupBy(F.col("line").alias("l")).agg(F.min(order).alias("f"))
        hits = hits.join(first, F.col("line") == F.col("l")).where(~(F.col("k").eqNullSafe(F.col("f.k")) & (F.col("t") == F.col("f.t")) & (F.col("place") == F.col("f.place"))))
    gone = hits.groupBy(F.col("k").alias("hk"), F.col("t").alias("ht")).agg(F.collect_set("place").alias("places"))
    rows = docs.select(F.struct("*").alias("d"), F.col(key).alias("k"), _text_key(F.col(text)).alias("t"))
    out = rows.join(gone, F.col("k").eqNullSafe(F.col("hk")) & (F.col("t") == F.col("ht")), "left")
    kept = F.array_join(F.filter(F.split(F.col("d")[text], "\n"), lambda _, i: ~F.array_contains("places", i)), "\n")
    new = F.when(F.col("places").isNull(), F.col("d")[text]).otherwise(kept)
    out = out.select(F.col("d").withField(text, new).alias("d"), F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("removed"))
    names = [c for c in docs.columns if c != "lines_removed"]
    return out.select(*[F.col("d")[c].alias(c) for c in names], F.col("removed").alias("lines_removed"))
