"""Ordered-rule classification of texts, and keyword signals. All are Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions import lookups as L
from threadloom.functions.text import has, let, strip


#: No reaction is longer, with its full stop.
LONGEST_REACTION = 20


def drop_reason(text: Column, is_post_body: Column) -> Column:
    """Why a text is no review; null where it is one. Null counts as empty; white space at the ends does not count."""
    return let(_trimmed(text), lambda b: _reason(b, is_post_body))


def _trimmed(text: Column) -> Column:
    return strip(F.coalesce(text, F.lit("")))


def _reason(b: Column, is_post_body: Column) -> Column:
    """Of a trimmed text. The first rule that fits counts. Lengths come before patterns: most texts are too long for
    most rules. A long comment can't be dropped by the rules after the one on review terms, so it isn't searched for
    them."""
    n, review, ask = F.length(b), has(b, L.REVIEW_TERMS), has(b, L.ASKS)
    marks = n - F.length(F.replace(b, F.lit("?"), F.lit("")))
    return (
        F.when((n <= 9) & F.lower(b).isin(L.DELETED), "empty")
        .when((n <= LONGEST_REACTION) & has(b, L.REACTIONS), "reaction")
        .when(has(b, L.COURSE_CODE), "course_code")
        .when((n <= 100) & ask, "ask")
        .when((n <= 100) & b.endswith("?") & review, "ask")
        .when(is_post_body & (n < 400) & (marks >= 2), "ask")
        .when(is_post_body | (n <= 160), F.when(review, F.lit(None)).otherwise(_without_terms(b, n, ask, is_post_body)))
    )


def _without_terms(b: Column, n: Column, ask: Column, is_post_body: Column) -> Column:
    """Of texts without review terms that are short or a post's."""
    return F.when(has(b, L.REQUESTS), "request").when((n > 100) & ask, "ask").when((n <= 80) & has(b, L.THANKS), "thanks").when(n < 80, "too_short").when(is_post_body & (n < 150), "thin")


def present(text: Column, keyword: str) -> Column:
    return F.contains(F.lower(F.coalesce(text, F.lit(""))), F.lit(keyword))


def signals(found: dict[str, Column]) -> Column:
    """The signal struct, from a boolean Column for every keyword: dominant labels, counts by family and kind, and
    the keywords, sorted."""
    count = lambda kind: sum((found[k].cast("int") for k in L.SIGNALS[kind]), F.lit(0))
    counts = {kind: count(kind) for kind in L.SIGNALS}
    families = dict.fromkeys(f for f, _ in L.SIGNALS)
    heavy, light = counts["workload", "heavy"], counts["workload", "light"]
    workload = F.when(heavy > light, "heavy").when(light > heavy, "light").when(heavy > 0, "moderate")
    grades = [counts["grading", k] for k in ("generous", "fair", "strict")]
    top = F.greatest(*grades)
    grading = F.when(top == 0, F.lit(None)).when(grades[0] == top, "generous").when(grades[1] == top, "fair").otherwise("strict")
    words = dict.fromkeys(w for ws in L.SIGNALS.values() for w in ws)
    keywords = F.array_sort(F.array_compact(F.array(*[F.when(found[w], F.lit(w)) for w in words])))
    extra = {"workload": [F.lit(0).alias("moderate")]}
    return F.struct(
        workload.alias("workload"),
        grading.alias("grading"),
        *[F.struct(*[counts[f, k].alias(k) for g, k in L.SIGNALS if g == f], *extra.get(f, [])).alias(f"{f}_mentions") for f in families],
        keywords.alias("keywords"),
    )


def analyze_text(text: Column) -> Column:
    """Signals of one text."""
    words = {w for ws in L.SIGNALS.values() for w in ws}
    return let(F.lower(F.coalesce(text, F.lit(""))), lambda low: signals({w: F.contains(low, F.lit(w)) for w in words}))


def signals_by(df: DataFrame, key: str, text: str) -> DataFrame:
    """Signals over all texts of a key: presence is a maximum that combines before the shuffle, so texts aren't
    gathered. Columns: key, signals."""
    words = sorted({w for ws in L.SIGNALS.values() for w in ws})
    low = df.select(F.col(key), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("low"))
    got = low.groupBy(key).agg(*[F.max(F.contains("low", F.lit(w))).alias(f"w{i}") for i, w in enumerate(words)])
    return got.select(key, signals({w: F.col(f"w{i}") for i, w in enumerate(words)}).alias("signals"))


def triage(df: DataFrame, text: str, is_post_body: bool) -> DataFrame:
    """df with is_review (0/1) set and drop_reason added."""
    trimmed = df.withColumn("__text", _trimmed(F.col(text)))
    out = trimmed.withColumn("drop_reason", _reason(F.col("__text"), F.lit(is_post_body))).drop("__text")
    return out.withColumn("is_review", F.col("drop_reason").isNull().cast("int"))
