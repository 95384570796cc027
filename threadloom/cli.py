"""Command line over a store folder: `python -m threadloom.cli COMMAND`.

Exit codes: 0; 2 nothing ingested, or no report; 3 the report's gate failed; 130 interrupted; 1 another error.
"""

from __future__ import annotations

import argparse
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions import lookups
from threadloom.functions.classify import triage
from threadloom.functions.text import time_bound
from threadloom.functions.titles import parse_titles
from threadloom.operators import dedupe, relational, report
from threadloom.sources import fallback, raw, roster, sinks
from threadloom.sources.store import Change, Snapshot, Store, unseen
from threadloom.streaming import ingest as streams


def scaled_passes(scale: float) -> list[tuple[str, str | None, int, int]]:
    s = max(0.1, scale)
    return [(sort, q, max(1, int(posts * s)), max(0, int(comments * s))) for sort, q, posts, comments in lookups.PASSES]


def bound(spark: SparkSession, text: str | None) -> float | None:
    """A time bound as epoch seconds: digits, or an ISO date or time, UTC unless it says otherwise."""
    if text is None or isinstance(text, float):
        return text
    at = spark.createDataFrame([(text,)], "t string").select(time_bound(F.col("t"))).first()[0]
    if at is None:
        raise ValueError(f"no time: {text}")
    return float(at)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _sources(spark: SparkSession, folder: str, a: argparse.Namespace) -> list[tuple[str, DataFrame]]:
    """The raw files of a folder, in the order of fallback: json/, archive/ and rss/ below it."""
    readers: dict[str, Callable[[], DataFrame]] = {
        "json": lambda: raw.read_listings(spark, f"{folder}/json"),
        "archive": lambda: raw.read_archive_posts(spark, f"{folder}/archive", a.after, a.before, a.sort, a.limit),
        "rss": lambda: raw.read_feed(spark, f"{folder}/rss"),
    }
    order = fallback.source_order(a.after is not None or a.before is not None, False, a.query, a.archive)
    return [(s, readers[s]()) for s in order if _exists(spark, f"{folder}/{s}")]


def load_comments(spark: SparkSession, store: Store, folder: str, posts: DataFrame, archive: bool) -> int:
    """Merges the comments of these posts (post_id) from the raw files: reply trees in threads/, and an archive's flat
    rows in comments/. For each post the first that has any is used: threads, or with `archive` the archive."""
    readers: dict[str, Callable[[], DataFrame]] = {
        "threads": lambda: raw.read_reply_trees(spark, f"{folder}/threads"),
        "comments": lambda: raw.read_archive_comments(spark, f"{folder}/comments"),
    }
    order = ["comments", "threads"] if archive else ["threads", "comments"]
    found = [(s, readers[s]()) for s in order if _exists(spark, f"{folder}/{s}")]
    if not found:
        return 0
    wanted = relational.short_ids(posts, 0).select("post_id").distinct()
    rows = fallback.first_per_key(fallback.ranked([(s, df.join(wanted, "post_id", "left_semi")) for s, df in found]), "post_id")
    comments = raw.comments_from_raw(rows).persist()
    n = comments.select("comment_id").distinct().count()
    heads = raw.read_threads(spark, f"{folder}/threads").join(wanted, "post_id", "left_semi").where("score is not null or num_comments is not null") if "threads" in dict(found) else None

    def plan(snap: Snapshot) -> list[Change]:
        changes = [Change("comments", comments)] if n else []
        return changes if heads is None else [*changes, streams.refreshed(snap, heads)]

    store.update(plan)
    comments.unpersist()
    if heads is not None and (lost := raw.unreadable_trees(raw.read_threads(spark, f"{folder}/threads").join(wanted, "post_id", "left_semi")).count()):
        print(f"{lost} threads can't be read")
    return n


def ingest(spark: SparkSession, store: Store, a: argparse.Namespace) -> int:
    found = _sources(spark, a.raw, a)
    if not found:
        return 0 if a.query else 2
    items = relational.listable(fallback.first_with_rows(fallback.ranked(found)))
    items = items.where(F.contains(F.lower("title"), F.lit(a.query.lower()))) if a.query else items
    posts = raw.posts_from_raw(relational.listing_order(items, a.sort).limit(a.limit) if a.limit else items)
    if a.resume:
        posts = unseen(posts, store.read("posts"))
    posts = posts.persist()
    n, parsed = posts.agg(F.count(F.lit(1)), F.count("professor_id")).first()
    if n:
        store.merge(posts=posts, entities=raw.entities_from_posts(posts))
        got = load_comments(spark, store, a.raw, relational.listing_order(posts, a.sort, "post_id").limit(a.comments) if a.comments else posts, a.archive)
    posts.unpersist()
    print(f"{n} posts, {got if n else 0} comments")
    totals = getattr(a, "totals", None)
    if totals is not None:
        for name, more in (("posts", n), ("comments", got if n else 0), ("parsed", parsed)):
            totals[name] = totals.get(name, 0) + more
    return 0 if n or a.query or a.resume else 2


def scrape_all(spark: SparkSession, store: Store, a: argparse.Namespace) -> int:
    """All passes, their totals, the store's counts and, if asked for, an export of people."""
    a.totals = {"posts": 0, "comments": 0, "parsed": 0}
    for sort, query, posts, comments in scaled_passes(a.scale):
        ingest(spark, store, argparse.Namespace(**vars(a) | {"sort": sort, "query": query, "limit": posts, "comments": comments, "archive": False, "after": None, "before": None}))
    print("in all: " + ", ".join(f"{n} {name}" for name, n in a.totals.items()))
    show_stats(store)
    if a.output:
        export(spark, store, argparse.Namespace(format="professors", roster=a.roster, output=a.output))
    return 0 if a.totals["posts"] else 2


def show_stats(store: Store) -> None:
    snap = store.snapshot()
    relational.stats(snap.read("posts"), snap.read("comments"), snap.read("entities")).show(vertical=True)
    relational.campus_counts(snap.read("posts")).show()


def backfill(spark: SparkSession, store: Store, a: argparse.Namespace) -> int:
    """The archive's posts, year by year. Years that an earlier run has done aren't read again."""
    return streams.backfill(store, lambda after, before: raw.read_archive_posts(spark, f"{a.raw}/archive", after, before), streams.shards(a.first_year, a.last_year), a.batch)


def enrich(spark: SparkSession, store: Store, a: argparse.Namespace) -> None:
    """Comments of the posts that have fewer stored than they claim, widest gap first."""
    gaps = relational.comment_gaps(store.read("posts"), store.read("comments"), a.limit).persist()
    gaps.show(40, 60)
    if a.raw:
        print(f"{load_comments(spark, store, a.raw, gaps, a.archive)} comments")
    gaps.unpersist()


def show_match(matched: DataFrame, taught: DataFrame) -> None:
    """The lists of a match, then its summary; of junk only the first rows."""
    lists = report.match_lists(matched, taught).persist()
    counts = {r["status"]: r["count"] for r in lists.groupBy("status").count().collect()}
    for status in ("resolved", "ambiguous", "unresolved", "junk"):
        if counts.get(status):
            print(f"{status} ({counts[status]})")
            rows = lists.where(F.col("status") == status).orderBy("name", "campus")
            for r in (rows.limit(report.LIST_JUNK) if status == "junk" else rows).toLocalIterator():
                print("  " + " | ".join(str(x) for x in r[1:] if x not in (None, "")))
            if status == "junk" and counts[status] > report.LIST_JUNK:
                print(f"  +{counts[status] - report.LIST_JUNK} more")
    lists.unpersist()
    report.match_summary(matched).show(vertical=True)


def _changed(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows of new that differ from old in any of the columns."""
    was = old.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__{c}") for c in columns])
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return new.join(was, F.col(key) == F.col("__key")).where(~same).select(new.columns)


def reparse(store: Store, everything: bool) -> None:
    """Parses stored titles again; only posts whose fields change are written, with their review flags as they are."""

    def plan(snap: Snapshot) -> list[Change]:
        posts = snap.read("posts")
        again = posts if everything else posts.where("professor_id is null")
        parsed = parse_titles(again)
        relational.parse_counts(again, parsed).show()
        return [Change("posts", _changed(again, parsed, "post_id", ["campus", "course", "professor_id"])), Change("entities", raw.entities_from_posts(parsed), "insert")]

    store.update(plan)


def clean_junk(store: Store) -> None:
    def plan(snap: Snapshot) -> list[Change]:
        posts = snap.read("posts")
        entities, linked, counts = dedupe.clean_entities(snap.read("entities"), posts)
        counts.show(vertical=True)
        return [Change("posts", _changed(posts, linked, "post_id", ["professor_id"])), Change("entities", entities, "rewrite")]

    store.update(plan)


def triage_reviews(store: Store) -> None:
    """Flags posts and comments; only rows whose flag changes are written."""

    def plan(snap: Snapshot) -> list[Change]:
        changes = []
        for name, key, text, is_post in (("posts", "post_id", "selftext", True), ("comments", "comment_id", "body", False)):
            old = snap.read(name)
            rows = triage(old, text, is_post)
            rows.groupBy(F.coalesce("drop_reason", F.lit("kept")).alias("reason")).count().orderBy("reason").show()
            changes.append(Change(name, _changed(old, rows, key, ["is_review"])))
        return changes

    store.update(plan)


def export(spark: SparkSession, store: Store, a: argparse.Namespace) -> None:
    snap = store.snapshot()
    posts, comments, entities = (snap.read(t) for t in ("posts", "comments", "entities"))
    official, taught = roster.load(spark, a.roster) if a.roster and roster.is_available(spark, a.roster) else (None, None)
    if a.format == "full":
        n = sinks.write_threads(posts, comments, entities, a.output)
    elif a.format == "professors":
        n = sinks.write_document(report.entity_index(posts, comments, entities, official, taught), a.output)
    else:
        rows, unresolved = report.review_rows(posts, comments, entities, official)
        sinks.write_names(unresolved, a.output.removesuffix(".json") + ".unresolved.json", "unresolved_count", "unresolved")
        n = sinks.write_document(rows, a.output)
    print(f"{n} rows")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="threadloom")
    p.add_argument("--store", required=True)
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("scrape")
    c.add_argument("--raw", required=True)
    c.add_argument("--sort", default="new", choices=["new", "hot", "top", "rising"])
    c.add_argument("--limit", type=int, default=0)
    c.add_argument("--comments", type=int, default=0)
    c.add_argument("--query")
    c.add_argument("--archive", action="store_true")
    c.add_argument("--resume", action="store_true")
    c.add_argument("--after")
    c.add_argument("--before")
    c = sub.add_parser("scrape-all")
    c.add_argument("--raw", required=True)
    c.add_argument("--scale", type=float, default=1.0)
    c.add_argument("--no-resume", action="store_false", dest="resume")
    c.add_argument("--export", dest="output")
    c.add_argument("--roster")
    c = sub.add_parser("backfill")
    c.add_argument("--raw", required=True)
    c.add_argument("--first-year", type=int, required=True)
    c.add_argument("--last-year", type=int, required=True)
    c.add_argument("--batch", type=int, default=1)
    sub.add_parser("reparse").add_argument("--all", action="store_true", dest="everything")
    c = sub.add_parser("enrich")
    c.add_argument("--raw")
    c.add_argument("--limit", type=int, default=50)
    c.add_argument("--archive", action="store_true")
    c.add_argument("--every", type=float, default=0.0)
    c.add_argument("--times", type=int, default=1)
    c = sub.add_parser("vacuum")
    c.add_argument("--keep", type=int, default=10)
    c.add_argument("--older-than", type=float, default=86_400.0)
    for name in ("export", "match", "resolve-report"):
        c = sub.add_parser(name)
        c.add_argument("--roster")
        c.add_argument("--output", default=f"{name}.json")
        c.add_argument("--format", default="full", choices=["full", "professors", "comments"])
        c.add_argument("--sample", type=int, default=100)
        c.add_argument("--strategy", default="recent", choices=["recent", "random"])
        c.add_argument("--seed", type=int, default=42)
        c.add_argument("--all-campuses", action="store_true")
    for name in ("stats", "clean-junk", "triage-reviews"):
        sub.add_parser(name)
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("threadloom").config("spark.sql.session.timeZone", "UTC").config("spark.python.sql.dataFrameDebugging.enabled", "false").getOrCreate()
    store = Store(spark, a.store)
    try:
        if a.command == "scrape":
            a.after, a.before = bound(spark, a.after), bound(spark, a.before)
            return ingest(spark, store, a)
        if a.command == "scrape-all":
            return scrape_all(spark, store, a)
        if a.command == "reparse":
            reparse(store, a.everything)
        elif a.command == "enrich":
            for i in range(a.times):
                time.sleep(a.every if i else 0)
                enrich(spark, store, a)
        elif a.command == "backfill":
            print(f"{backfill(spark, store, a)} windows")
        elif a.command == "vacuum":
            print(f"{store.vacuum(a.keep, a.older_than)} files deleted")
        elif a.command == "export":
            export(spark, store, a)
        elif a.command == "stats":
            show_stats(store)
        elif a.command == "clean-junk":
            clean_junk(store)
        elif a.command == "triage-reviews":
            triage_reviews(store)
        else:
            if not a.roster or not roster.is_available(spark, a.roster):
                print("roster not found", file=sys.stderr)
                return 0 if a.command == "match" else 2
            official, taught = roster.load(spark, a.roster)
            if a.command == "match":
                show_match(report.match_entities(store.read("entities"), store.read("posts"), official, taught), taught)
                return 0
            rows = report.resolve_mentions(store.read("posts"), store.read("entities"), official, taught, None if a.all_campuses else "UPD", a.strategy, a.sample, a.seed).persist()
            one = report.resolve_report(rows).first().asDict()
            if not one["sample_size"]:
                return 2
            lists = {s: [r.asDict(recursive=True) for r in rows.where(F.col("status") == s).toLocalIterator()] for s in ("resolved", "ambiguous", "unresolved")}  # at most --sample rows
            sinks.write_object(one | lists, a.output)
            return 0 if one["acceptance_met"] else 3
        return 0
    except KeyboardInterrupt:
        return 130
    except Exception as e:  # noqa: BLE001
        print(e, file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
