"""Document fingerprints: a Merkle tree over spans, paragraphs and sections. Native: DataFrame functions only.

Paragraphs are what line ends part; a section is `SECTION` paragraphs on end; the leaves are spans of up to `SPAN`
words of a paragraph with their spaces, which tile it. A leaf's digest is its MD5; a paragraph's, section's and the
root's is the SHA-256 of its children's digests, joined by commas (by bars between paragraphs). Equal texts have
equal roots; where two roots differ, sections, then their paragraphs, then spans are compared to locate the edits.

The printed fingerprint is the root, a colon, and the first `SHORT` hex digits of every leaf digest, paragraphs parted
by dots, so two fingerprints can be compared without their texts. Likeness is twice the number of distinct leaves in
common over the sum of both numbers (two empty texts: 1). It is found by descent: equal roots are equal texts; what
lies below sections that agree in place and digest is common; of the other sections the paragraphs are compared by
digest, and only the leaves of paragraphs that the other tree lacks are compared one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm.common import written

SPAN, SECTION, SHORT = 4, 16, 10
#: Of the range buckets in which documents find their successors: rows aimed at, and the most bounds that a quantile
#: is asked for at once.
BUCKET_ROWS, MOST_BUCKETS = 2_048, 16_384

_SPANS = r"(?:[^ ]*+ ){0,%d}[^ ]*+(?: |$)" % (SPAN - 1)


def leaves(text: Column) -> Column:
    """array<array<string>>: MD5 of every span, by paragraph. A null text counts as empty."""
    paragraphs = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    return F.transform(paragraphs, lambda p: F.transform(F.filter(F.regexp_extract_all(p, F.lit(_SPANS), F.lit(0)), lambda s: s != ""), lambda s: F.md5(s)))


def paragraph_digests(tree: Column) -> Column:
    return F.transform(tree, lambda p: F.sha2(F.array_join(p, ","), 256))


def section_digests(paragraphs: Column) -> Column:
    """One digest for every SECTION paragraphs."""
    firsts = F.sequence(F.lit(1), F.size(paragraphs), F.lit(SECTION))
    return F.transform(firsts, lambda i: F.sha2(F.array_join(F.slice(paragraphs, i, F.lit(SECTION)), "|"), 256))


def root(sections: Column) -> Column:
    return F.sha2(F.array_join(sections, ","), 256)


def short(tree: Column) -> Column:
    """array<string>: the first digits of each paragraph's leaf digests, joined by commas."""
    return F.transform(tree, lambda p: F.array_join(F.transform(p, lambda d: F.substring(d, 1, SHORT)), ","))


def printed(root_digest: Column, shorts: Column) -> Column:
    return F.concat(root_digest, F.lit(":"), F.translate(F.array_join(shorts, "."), ",", ""))


def with_trees(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """For each text column: prefix, five columns <prefix>_tree, _paragraphs, _sections, _root, _short. Step by step,
    so that no expression is worked out twice."""
    df = df.withColumns({f"{p}_tree": leaves(F.col(c)) for c, p in columns.items()})
    df = df.withColumns({f"{p}_paragraphs": paragraph_digests(F.col(f"{p}_tree")) for p in columns.values()} | {f"{p}_short": short(F.col(f"{p}_tree")) for p in columns.values()})
    df = df.withColumns({f"{p}_sections": section_digests(F.col(f"{p}_paragraphs")) for p in columns.values()})
    return df.withColumns({f"{p}_root": root(F.col(f"{p}_sections")) for p in columns.values()})


def _distinct_leaves(paragraphs: Column) -> Column:
    """Of paragraphs as `short` gives them, or with a digest and a colon before."""
    return F.array_distinct(F.flatten(F.transform(paragraphs, lambda p: F.filter(F.split(F.substring_index(p, ":", -1), ","), lambda d: d != ""))))


def with_likeness(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """df with `out`, from the trees of `with_trees` with prefixes a and b. Working columns go again."""
    t = lambda name: F.col(f"{out}__{name}")
    agree = lambda i: F.get(f"{a}_sections", F.floor(i / SECTION).cast("int")).eqNullSafe(F.get(f"{b}_sections", F.floor(i / SECTION).cast("int")))
    nodes = lambda p: F.zip_with(f"{p}_paragraphs", f"{p}_short", lambda d, s: F.concat(d, F.lit(":"), s))
    same, none = F.col(f"{a}_root") == F.col(f"{b}_root"), F.array().cast("array<string>")
    rest = lambda p: F.when(same, none).otherwise(F.filter(nodes(p), lambda n, i: ~agree(i)))
    steps = [
        {"a": rest(a), "b": rest(b), "kept": F.when(same, none).otherwise(F.filter(f"{a}_short", lambda n, i: agree(i)))},
        {"a_only": F.array_except(t("a"), t("b")), "b_only": F.array_except(t("b"), t("a")), "both": F.array_intersect(t("a"), t("b"))},
        {"edited": F.array_intersect(_distinct_leaves(t("a_only")), _distinct_leaves(t("b_only"))), "whole": _distinct_leaves(F.concat(t("kept"), t("both")))},
        {"common": F.size(F.array_union(t("whole"), t("edited"))), "sum": F.size(_distinct_leaves(F.col(f"{a}_short"))) + F.size(_distinct_leaves(F.col(f"{b}_short")))},
    ]
    for step in steps:
        df = df.withColumns({f"{out}__{n}": c for n, c in step.items()})
    value = F.when(same | (t("sum") == 0), F.lit(1.0)).otherwise(F.lit(2.0) * t("common") / t("sum"))
    return df.withColumn(out, value).drop(*[f"{out}__{n}" for step in steps for n in step])


def fingerprint(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: key, root, sections and paragraphs (array<string> digests), fingerprint.

    Null texts count as empty; very long texts are treated whole; repeated rows and null keys stay; further columns
    are ignored; an empty table gives none. No shuffle.
    """
    t = with_trees(docs.select(F.col(key).alias("k"), F.col(text).alias("x")), {"x": "x"})
    return t.select(F.col("k").alias(key), F.col("x_root").alias("root"), F.col("x_sections").alias("sections"), F.col("x_paragraphs").alias("paragraphs"), printed(F.col("x_root"), F.col("x_short")).alias("fingerprint"))


def locate_edits(a: DataFrame, b: DataFrame, key: str = "doc_id") -> DataFrame:
    """a, b: as `fingerprint` gives them. key, same (boolean), edited: places (from 0) in b of paragraphs that are new
    or changed, gone: places in a of those that b lacks. Equal roots end the search; else paragraphs are aligned from
    both ends, and between the ends told apart by digest, so one that is put in doesn't mark those after it. Keys that
    are null or on one side only give no row; a repeated key gives a row a pair."""
    left = a.select(F.col(key).alias("k"), F.col("root").alias("a_root"), F.col("paragraphs").alias("a"))
    right = b.select(F.col(key).alias("k2"), F.col("root").alias("b_root"), F.col("paragraphs").alias("b"))
    both = left.join(right, F.col("k") == F.col("k2")).withColumn("same", F.col("a_root") == F.col("b_root"))
    run = lambda x, y: F.coalesce(F.nullif(F.array_position(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), F.lit(False)), F.lit(0)), F.size(x) + 1) - 1
    both = both.withColumn("head", F.least(run(F.col("a"), F.col("b")), F.size("a"), F.size("b")).cast("int"))
    rest = lambda c: F.reverse(F.slice(c, F.col("head") + 1, F.greatest(F.size(c) - F.col("head"), F.lit(0))))
    both = both.withColumns({"ra": rest("a"), "rb": rest("b")})
    both = both.withColumn("tail", F.least(run(F.col("ra"), F.col("rb")), F.size("ra"), F.size("rb")).cast("int"))
    middle = lambda c: F.slice(c, F.col("head") + 1, F.greatest(F.size(c) - F.col("head") - F.col("tail"), F.lit(0)))
    both = both.withColumns({"ma": middle("a"), "mb": middle("b")})
    both = both.withColumns({"new": F.array_except("mb", "ma"), "old": F.array_except("ma", "mb")})
    places = lambda c, of: F.array_compact(F.transform(c, lambda d, i: F.when(F.array_contains(of, d), i + F.col("head"))))
    return both.select(F.col("k").alias(key), "same", places("mb", F.col("new")).alias("edited"), places("ma", F.col("old")).alias("gone"))


def _bucket(k: Column, bounds: list) -> Column:
    """How many bounds (ascending, one less than a power of two) are at most k, by halving; nulls go last."""
    if not bounds:
        return F.lit(0)
    array, steps, step = F.array(*[F.lit(x) for x in bounds]), [], (len(bounds) + 1) // 2
    while step:
        steps.append(step)
        step //= 2
    found = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, s: at + F.when(F.element_at(array, at + s) <= k, s).otherwise(F.lit(0)))
    return F.when(k.isNull(), F.lit(len(bounds))).otherwise(found)


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """k, x (text, null as empty), next: the text of the next row in ascending key order, after the last the first.

    Null keys come last; equal keys go by a hash of the text. Rows are dealt into range buckets by approximate
    quantiles of the key (a bounded array); the first row of every bucket also goes, marked, to the bucket before, so
    each row finds its successor within its bucket and a text is shuffled once. A key that many rows share shares
    their bucket's task; its rows spill there.
    """
    rows = docs.select(F.col(key).alias("k"), F.coalesce(text, F.lit("")).alias("x")).withColumn("h", F.xxhash64("x"))
    # bounds and firsts come from a table of 16 bytes a row, so texts are read twice in all
    keys = written(docs.sparkSession, rows.select("k", "h"), "keys")
    n = keys.count()
    buckets = 1
    while buckets < MOST_BUCKETS and buckets * BUCKET_ROWS < n:
        buckets *= 2
    bounds = []
    if buckets > 1:
        found = keys.agg(F.percentile_approx("k", [i / buckets for i in range(1, buckets)], 10 * buckets)).first()[0]
        bounds = sorted(found or [])
    of = _bucket(F.col("k"), bounds).cast("int")
    placed = rows.withColumn("b", of)
    order = F.struct(F.col("k").isNull().alias("n"), "k", "h")
    # at most MOST_BUCKETS rows of a few bytes, so these may be broadcast
    firsts = keys.withColumn("b", of).groupBy("b").agg(F.min(order).alias("f"))
    before = F.coalesce(F.lag("b").over(Window.orderBy("b")), F.max("b").over(Window.partitionBy()))
    firsts = F.broadcast(firsts.select(F.col("b").alias("fb"), "f", before.alias("before")))
    first = F.col("k").eqNullSafe(F.col("f.k")) & (F.col("h") == F.col("f.h"))
    sent = placed.join(firsts, F.col("b") == F.col("fb"))
    home = F.struct(F.col("b").alias("at"), F.lit(False).alias("lent"))
    sent = sent.select("k", "x", "h", F.explode(F.when(first, F.array(home, F.struct(F.col("before").alias("at"), F.lit(True).alias("lent")))).otherwise(F.array(home))).alias("to"))
    w = Window.partitionBy("at").orderBy("lent", F.col("k").asc_nulls_last(), "h")
    return sent.select("k", "x", "h", "to.*").withColumn("next", F.lead("x").over(w)).where("not lent").select("k", "x", "next")


def edit_likeness(docs: DataFrame, key: str = "doc_id", text: str = "text", part: int = 4) -> DataFrame:
    """How much a fingerprint tells of an edit: each text is compared with itself after its last 1/part of code points
    is replaced by the first as many of the next document, and with the next document.

    key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. Edge cases as in
    `with_next` and `fingerprint`; one document alone is its own next.
    """
    rows = with_next(docs, key, text).withColumn("size", F.length("x")).withColumn("q", F.floor(F.col("size") / part).cast("int"))
    rows = rows.withColumn("e", F.concat(F.substring(F.col("x"), F.lit(1), F.col("size") - F.col("q")), F.substring(F.col("next"), F.lit(1), F.col("q"))))
    rows = with_trees(rows, {"x": "x", "e": "e", "next": "n"})
    rows = with_likeness(with_likeness(rows, "x", "e", "near_edited"), "x", "n", "near_next")
    return rows.select(
        F.col("k").alias(key),
        F.col("size").cast("long").alias("n_chars"),
        F.sha2("e", 256).alias("edited_sha256"),
        printed(F.col("x_root"), F.col("x_short")).alias("fingerprint"),
        printed(F.col("e_root"), F.col("e_short")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
