"""Relational queries over posts, comments and entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions import lookups as L
from threadloom.functions.text import iso_time, plausible_name, strip


def unparsed_posts(posts: DataFrame) -> DataFrame:
    """Posts without an entity, newest first."""
    return posts.where("professor_id is null").select("post_id", "title", "created_utc").orderBy(F.desc("created_utc"), "post_id")


def listable(rows: DataFrame, check_removed: bool = True) -> DataFrame:
    """Listing rows with an id that are neither stickied nor (if checked) removed."""
    keep = (F.coalesce("id", F.lit("")) != "") & ~F.coalesce(F.col("stickied"), F.lit(False))
    return rows.where(keep & (F.coalesce("removed_by_category", F.lit("")) == "") if check_removed else keep)


def with_body(rows: DataFrame, body: str, trimmed: bool = False) -> DataFrame:
    """Rows whose text isn't empty or deleted: exactly, as at ingest, or trimmed, as in exports. Null counts as empty."""
    c = F.coalesce(F.col(body), F.lit(""))
    return rows.where(~(strip(c) if trimmed else c).isin(L.DELETED))


def campus_is(campus: str, column: str = "campus") -> Column:
    return F.upper(F.coalesce(column, F.lit(""))) == F.lit(campus.upper())


def known_campus(column: str = "campus") -> Column:
    """Whether it is a code, in any case; aliases aren't."""
    return F.upper(F.coalesce(column, F.lit(""))).isin([c.upper() for c in L.CAMPUS_CODES])


def in_window(rows: DataFrame, at: str, after: float | None = None, before: float | None = None) -> DataFrame:
    """after inclusive, before exclusive; either may be open. Pushed down to the scan."""
    out = rows if after is None else rows.where(F.col(at) >= after)
    return out if before is None else out.where(F.col(at) < before)


def listing_order(rows: DataFrame, sort: str = "new", key: str = "id") -> DataFrame:
    """The order of a listing: `top` by score, `hot` by score halved for each half day of age, `rising` by comments, else
    newest first; ties by time, then by id, so that a cut of it is the same in each run."""
    score, at = F.coalesce("score", F.lit(0)), F.coalesce("created_utc", F.lit(0.0))
    # twice the score counts like half a day
    hot = F.log2(F.greatest(score, F.lit(1))) + at / 43_200.0
    first = {"top": [F.desc(score)], "hot": [F.desc(hot)], "rising": [F.desc(F.coalesce("num_comments", F.lit(0)))]}.get(sort, [])
    return rows.orderBy(*first, F.desc(at), key)


def short_ids(posts: DataFrame, top: int, most: int = 12) -> DataFrame:
    """Of the top rows (0: all) those with ids that aren't too long: first the slice, then the filter."""
    return (posts.limit(top) if top > 0 else posts).where(F.length("post_id") <= most)


def mentions(posts: DataFrame, entities: DataFrame, campus: str | None = L.DEFAULT_CAMPUS) -> DataFrame:
    """Posts with an entity whose name is plausible, of one campus or all, newest first."""
    e = entities.select(F.col("id").alias("professor_id"), "last_name", "first_name")
    e = e.where(plausible_name(F.col("last_name"), F.col("first_name")))
    p = posts.where("professor_id is not null").select("post_id", "title", "campus", "course", "professor_id", "created_utc")
    p = p if campus is None else p.where(campus_is(campus))
    return p.join(e, "professor_id").select("post_id", "title", "campus", "course", "professor_id", "last_name", "first_name", "created_utc").orderBy(F.desc("created_utc"), "post_id")


def comment_gaps(posts: DataFrame, comments: DataFrame, limit: int | None = None) -> DataFrame:
    """Posts with fewer comments stored than they claim, widest gap first, then newest. A post claiming none can't
    have a gap, so it isn't joined. Comments are counted before the join, so a busy thread is one row there."""
    stored = comments.groupBy("post_id").agg(F.count(F.lit(1)).alias("stored"))
    p = posts.where("num_comments > 0").select("post_id", "title", "num_comments", "created_utc")
    out = p.join(stored, "post_id", "left").withColumn("stored", F.coalesce("stored", F.lit(0)).cast("long")).where("stored < num_comments")
    out = out.withColumn("gap", F.col("num_comments") - F.col("stored")).orderBy(F.desc("gap"), F.desc("created_utc"), "post_id")
    return out if limit is None else out.limit(limit)


def campus_counts(posts: DataFrame) -> DataFrame:
    return posts.where("campus is not null").groupBy("campus").agg(F.count(F.lit(1)).alias("posts")).orderBy(F.desc("posts"), "campus")


def stats(posts: DataFrame, comments: DataFrame, entities: DataFrame) -> DataFrame:
    """One row of counts; parse_rate is a percentage as text, `N/A` where there are no posts. Tables from before
    triage have no is_review: all their rows count as reviews."""
    flagged = lambda df: F.count_if(F.col("is_review") == 1) if "is_review" in df.columns else F.count(F.lit(1))
    p = posts.agg(F.count(F.lit(1)).alias("total_posts"), F.count("professor_id").alias("parsed_posts"), flagged(posts).alias("review_posts"))
    c = comments.agg(F.count(F.lit(1)).alias("total_comments"), flagged(comments).alias("review_comments"))
    e = entities.agg(F.count(F.lit(1)).alias("total_professors"))
    rate = F.when(F.col("total_posts") > 0, F.format_string("%.1f%%", 100.0 * F.col("parsed_posts") / F.col("total_posts"))).otherwise("N/A")
    minus = lambda a, b: F.col(a) - F.col(b)
    return p.crossJoin(c).crossJoin(e).withColumns(  # one row each
        {"unparsed_posts": minus("total_posts", "parsed_posts"), "dropped_posts": minus("total_posts", "review_posts"), "dropped_comments": minus("total_comments", "review_comments"), "parse_rate": rate}
    )


def entity_courses(posts: DataFrame) -> DataFrame:
    """professor_id, courses: distinct, sorted, none empty."""
    p = posts.where("professor_id is not null and course <> ''").select("professor_id", "course").distinct()
    return p.groupBy("professor_id").agg(F.array_sort(F.collect_list("course")).alias("courses"))


def threads(posts: DataFrame, comments: DataFrame, entities: DataFrame) -> DataFrame:
    """One row per post, newest first: campus, course, professor (null if unlinked), post, comments (oldest first)."""
    note = F.struct("created_utc", F.col("comment_id").alias("id"), "parent_id", "author", "body", "score", "depth")
    c = comments.groupBy("post_id").agg(F.array_sort(F.collect_list(note)).alias("notes"))
    e = entities.select(F.col("id").alias("professor_id"), F.struct("last_name", "first_name").alias("professor"))
    t = posts.join(e, "professor_id", "left").join(c, "post_id", "left")
    post = F.struct("post_id", "title", "url", "score", "num_comments", iso_time(F.col("created_utc")).alias("posted_at"), "author", F.coalesce("selftext", F.lit("")).alias("body"))
    out = F.transform(
        F.coalesce("notes", F.array().cast(dict(c.dtypes)["notes"])),
        lambda n: F.struct(n["id"].alias("comment_id"), n["parent_id"].alias("parent_id"), n["author"].alias("author"), n["body"].alias("body"), n["score"].alias("score"), n["depth"].alias("depth"), iso_time(n["created_utc"]).alias("posted_at")),
    )
    return t.orderBy(F.desc("created_utc"), "post_id").select("campus", "course", "professor", post.alias("post"), out.alias("comments"))


def parse_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """newly, still: of the rows parsed again, how many have an entity now and how many don't."""
    now = after.join(before.select("post_id"), "post_id", "left_semi")
    return now.agg(F.count_if(F.col("professor_id").isNotNull()).alias("newly"), F.count_if(F.col("professor_id").isNull()).alias("still"))


def hash_sample(rows: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """A sample without replacement that depends on keys and seed only, not on row order: the least digests."""
    return rows.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(n)
