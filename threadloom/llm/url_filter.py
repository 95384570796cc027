"""URL filters: host-suffix and path-prefix expressions, joined on short hash prefixes.

A rule is (host, path, verdict). It fits its host and every subdomain, where the URL's path starts with the
rule's path. Of the rules that fit, the longest (host and path together) wins; then the longest host; then block
before allow.

How it runs: distinct URLs are expanded into `suffix/prefix` expressions, whose SHA-256 digests are cut to
`prefix_bytes` bytes for an equi-join with the rules' short digests; hits are confirmed by the full digest, and
one winner a URL is kept by an aggregate that combines before its shuffle. Paths are cut only at lengths that some
rule has, so the expansion is bounded by (labels of the host) x (distinct rule path lengths). The rule side is
broadcast only when its measured row count is small; else both sides are shuffled on the short digest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rules up to this many are broadcast (about 100 bytes each).
BROADCAST_RULES = 100_000
#: Default verdict of a URL that no rule fits.
DEFAULT_VERDICT = "allow"


def with_host_path(df: DataFrame, url: str = "url", host: str = "host", path: str = "path") -> DataFrame:
    """Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; path: then up to `?`, `#` or
    the end. Null URLs and URLs without `://` have both empty."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise(F.lit(""))
    # [\s\S] because a URL may hold line ends
    raw = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    lower = F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return df.withColumns({host: lower, path: F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)})


def filter_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", prefix_bytes: int = 4, default: str = DEFAULT_VERDICT) -> DataFrame:
    """One row per row of pages: key, host, path, rule, verdict.

    rules: columns host, path, verdict (`block` or `allow`); rows with a null in one of them are ignored, repeated
    rules count once. Null or scheme-less URLs get empty host and path, which only a rule with an empty host fits:
    none does, so they get the default. Repeated page rows stay as they are; an empty table gives an empty result;
    further columns of either table are ignored. Long URLs are judged whole.
    """
    clean = rules.select(F.lower("host").alias("r_host"), F.col("path").alias("r_path"), F.lower("verdict").alias("r_verdict")).where("r_host <> '' and r_path is not null and r_verdict is not null").distinct()
    digests = clean.withColumn("r_full", F.sha2(F.concat("r_host", F.lit("\n"), "r_path"), 256))
    digests = digests.withColumn("short", F.substring("r_full", 1, 2 * prefix_bytes))
    # one small row: how many rules there are, and the path lengths that occur in them
    seen = clean.agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set(F.length("r_path"))).alias("cuts")).first()
    if seen["n"] <= BROADCAST_RULES:
        digests = F.broadcast(digests)

    rows = with_host_path(pages.select(F.col(key).alias("k"), F.col(url).alias("u")), "u", "h", "p").select("k", "h", "p")
    urls = rows.where("h <> ''").select("h", "p").distinct()
    labels = F.split("h", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    cuts = F.filter(F.array(*[F.lit(int(n)) for n in seen["cuts"]]).cast("array<int>"), lambda n: n <= F.length("p"))
    prefixes = F.transform(cuts, lambda n: F.substring(F.col("p"), F.lit(1), n))
    expressions = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda x: F.concat(s, F.lit("\n"), x))))
    asked = urls.select("h", "p", F.explode(F.array_distinct(expressions)).alias("e")).select("h", "p", F.sha2("e", 256).alias("full"))
    asked = asked.withColumn("short", F.substring("full", 1, 2 * prefix_bytes))
    hits = asked.join(digests, "short").where("full = r_full")
    rank = F.struct(F.length(F.concat("r_host", "r_path")), F.length("r_host"), (F.col("r_verdict") == "block").cast("int"))
    won = hits.groupBy("h", "p").agg(F.max(F.struct(rank.alias("rank"), F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict"))).alias("w"))
    out = rows.join(won.select("h", "p", "w.rule", "w.verdict"), ["h", "p"], "left")
    return out.select(F.col("k").alias(key), F.col("h").alias("host"), F.col("p").alias("path"), "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
