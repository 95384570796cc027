"""The store: what merges write, writers that meet, migration, and backfills that are killed."""

import json
import time

import pytest
from pyspark.sql import functions as F

from threadloom.sources import store
from threadloom.sources.store import Change
from threadloom.streaming import ingest


@pytest.fixture
def made(spark, tmp_path):
    return store.Store(spark, f"file://{tmp_path}/store")


def posts_of(spark, ids, score=0, at=0.0):
    return spark.createDataFrame([(str(i), f"title {i}", score, at) for i in ids], "post_id string, title string, score long, scraped_at double")


def people_of(spark, n):
    return spark.createDataFrame([(f"e{i}", "Cruz") for i in range(n)], "id string, last_name string")


def scores(s):
    return {r.post_id: r.score for r in s.read("posts").select("post_id", "score").collect()}


def test_a_change_is_atomic(spark, made, tmp_path, monkeypatch):
    """One that stops at any step leaves all tables as they were; the next one goes on from there."""
    assert made.read("posts").count() == 0 and not made.exists("posts")
    made.merge(posts=posts_of(spark, range(2)), entities=people_of(spark, 2))
    publish = store.Store._publish

    def stopped(self, number, manifest):
        raise OSError("stopped")

    monkeypatch.setattr(store.Store, "_publish", stopped)
    with pytest.raises(OSError):
        made.merge(posts=posts_of(spark, range(5)), entities=people_of(spark, 5))
    (tmp_path / "store/_part-left").write_text("{")
    assert (made.read("posts").count(), made.read("entities").count()) == (2, 2)
    monkeypatch.setattr(store.Store, "_publish", publish)
    made.merge(posts=posts_of(spark, range(3), 7), entities=people_of(spark, 4))
    assert scores(made) == {"0": 7, "1": 7, "2": 7} and made.read("entities").count() == 4


def test_two_merges_that_meet(spark, made):
    """Each reads the same state; the one that publishes second starts again, and both rows are there."""
    made.merge(posts=posts_of(spark, ["a"]))
    met = []

    def plan(snap):
        if not met:
            met.append(made.merge(posts=posts_of(spark, ["b"]), entities=people_of(spark, 1)))
        return [Change("posts", posts_of(spark, ["c"]))]

    made.update(plan)
    assert set(scores(made)) == {"a", "b", "c"} and made.read("entities").count() == 1
    with pytest.raises(store.Conflict):
        made._publish(made.snapshot().number, {"schema": store.SCHEMA, "tables": {}})
    assert set(scores(made)) == {"a", "b", "c"}


def test_a_rewrite_between_read_and_write(spark, made):
    """What another writer merged meanwhile isn't lost: the plan is made again from it."""
    made.merge(posts=posts_of(spark, ["a"]))
    seen = []

    def flagged(snap):
        posts = snap.read("posts")
        seen.append(posts.count())
        if len(seen) == 1:
            made.merge(posts=posts_of(spark, ["b"]))
        return [Change("posts", posts.withColumn("is_review", F.lit(0)), "rewrite")]

    made.update(flagged)
    assert seen == [1, 2] and {(r.post_id, r.is_review) for r in made.read("posts").collect()} == {("a", 0), ("b", 0)}
    with pytest.raises(store.Conflict):  # somebody is always first
        made.update(lambda snap: made.merge(posts=posts_of(spark, ["x"], snap.number)) and [Change("posts", posts_of(spark, ["y"]))], tries=2)


def test_a_small_merge_writes_little(spark, made):
    """27 rows into 600,000, most of them there already: under 2 % of the bytes, and the same rows as by whole tables."""
    big = spark.range(600_000).select(F.col("id").cast("string").alias("post_id"), F.md5(F.col("id").cast("string")).alias("title"), F.lit(1).alias("score"), F.lit(0.0).alias("scraped_at"))
    made.write(posts=big)
    before = {f: n for f, (n, _) in made._files("").items()}
    new = posts_of(spark, [*range(0, 600_000, 30_000), *range(600_000, 600_007)], 5, 1.0)
    made.merge(posts=new)
    written = sum(n for f, (n, _) in made._files("").items() if f not in before)
    assert 0 < written < 0.02 * sum(before.values())
    want = store.replace_by_key(store.conform(big, "posts"), store.conform(new, "posts").withColumn("is_review", F.lit(1)), "post_id", [F.desc("scraped_at")])
    digest = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("post_id", "score", "title") % 1_000_003)).first())
    assert digest(made.read("posts")) == digest(want) and made.read("posts").where("score = 5").count() == 27


def test_changes_pile_up_and_are_taken_in(spark, made, monkeypatch):
    """Merges again and again, of rows there and not, against a dictionary; then old files go."""
    monkeypatch.setattr(store, "REWRITE_AT", 1.2)  # files of a few rows are mostly their footers
    want, table = {}, {}
    for n in range(7):
        ids = [str((i * 7 + n * 13) % 90) for i in range(40)]
        made.merge(posts=posts_of(spark, ids, n, float(n)))
        want |= dict.fromkeys(ids, n)
        assert scores(made) == want
        table[n] = made.snapshot().tables["posts"]
    assert any(t.changes for t in table.values())
    # of rows with one key the last scraped counts; an insert leaves what is there
    twice = posts_of(spark, ["0"], 50, 1.0).unionByName(posts_of(spark, ["0"], 51, 9.0))
    made.update(lambda _: [Change("posts", twice), Change("entities", people_of(spark, 2), "insert")])
    made.update(lambda _: [Change("entities", people_of(spark, 3).withColumn("last_name", F.lit("Lim")), "insert")])
    assert scores(made)["0"] == 51 and sorted((r.id, r.last_name) for r in made.read("entities").collect()) == [("e0", "Cruz"), ("e1", "Cruz"), ("e2", "Lim")]
    number = made.snapshot().number
    assert made.update(lambda _: [Change("posts", posts_of(spark, []))]) == number  # nothing changes
    files = len(made._files(""))
    assert made.vacuum(keep=2) == len(range(1, number - 1)) and len(made._files("")) == files  # files are too young
    gone = made.vacuum(keep=1, older_than=-5)
    left = set(made._files(""))
    assert gone > 50 and left == set().union(*(t.paths() for t in made.snapshot().tables.values())) and scores(made) == want | {"0": 51}


def test_a_grown_table_gets_more_buckets(spark, made, monkeypatch):
    monkeypatch.setattr(store, "BUCKET_BYTES", 100)
    made.merge(posts=posts_of(spark, range(300)))
    made.merge(posts=posts_of(spark, range(290, 310), 2))
    t = made.snapshot().tables["posts"]
    assert t.buckets > store.LEAST_BUCKETS and not t.changes and len(scores(made)) == 310 and scores(made)["295"] == 2


def test_an_older_store_is_migrated_once(spark, made, tmp_path):
    """Layout 1: a folder a table, without columns that came later."""
    posts_of(spark, ["a", "b"], 3).write.parquet(f"file://{tmp_path}/store/posts-old")
    people_of(spark, 2).write.parquet(f"file://{tmp_path}/store/entities-old")
    (tmp_path / "store/manifest-000000000001.json").write_text(json.dumps({"posts": "posts-old", "entities": "entities-old"}))
    rows = made.read("posts").collect()
    assert {(r.post_id, r.score, r.is_review, r.selftext) for r in rows} == {("a", 3, 1, ""), ("b", 3, 1, "")} and made.read("entities").count() == 2
    files, snap = set(made._files("")), made.snapshot()
    assert snap.number == 2 and len(snap.manifest["steps"]) == 3 and "is_review = 1" in snap.manifest["steps"][0]
    again = store.Store(spark, f"file://{tmp_path}/store")
    assert again.read("posts").count() == 2 and again.snapshot().number == 2 and set(again._files("")) == files
    again.merge(posts=posts_of(spark, ["b", "c"], 4))
    assert scores(again) == {"a": 3, "b": 4, "c": 4} and again.snapshot().manifest["steps"] == snap.manifest["steps"]


def test_backfill_goes_on(spark, made):
    """A run that is killed leaves no window half done; the next one doesn't repeat finished ones."""
    asked = []

    def read(after, before):
        asked.append(after)
        if len(asked) == 3:
            raise KeyboardInterrupt
        return spark.createDataFrame([(f"p{after:.0f}-{i}", "[UPD] Math 21 - Cruz, Juan", after + i, None, None) for i in range(3)], "id string, title string, created_utc double, stickied boolean, removed_by_category string").selectExpr("*", "null as permalink", "null as url", "null as author", "null as selftext", "0.0 as score", "0.0 as num_comments")

    years = ingest.shards(2018, 2023)
    with pytest.raises(KeyboardInterrupt):
        ingest.backfill(made, read, years)
    assert made.read("posts").count() == 6 and asked == [a for a, _ in years[:3]]
    assert ingest.backfill(made, read, years) == 3  # the claimed one isn't overdue yet
    assert ingest.backfill(made, read, years, holds=0.0) == 1 and made.read("posts").count() == 18
    assert sorted(asked) == sorted([a for a, _ in years] + [years[2][0]]) and ingest.backfill(made, read, years, holds=0.0) == 0
    states = {(r.state, r.attempt) for r in made.read("progress").collect()}
    assert states == {("done", 1), ("done", 2)} and made.read("entities").count() == 1


def test_two_runs_never_claim_the_same(spark, made):
    ingest.plan_tasks(made, [f"t{i}" for i in range(5)])
    ingest.plan_tasks(made, ["t4", "t5"])
    first, second = ingest.claim_tasks(made, "t", 3), ingest.claim_tasks(made, "t", 9)
    assert first == ["t0", "t1", "t2"] and second == ["t3", "t4", "t5"] and ingest.claim_tasks(made, "t", 9) == []
    assert ingest.claim_tasks(made, "t", 1, now=time.time() + 2 * ingest.CLAIM_HOLDS) == ["t0"]


def test_refreshed_counts_leave_the_rest(spark, made):
    made.merge(posts=posts_of(spark, ["a", "b"], 1).withColumn("num_comments", F.lit(2)))
    made.update(lambda snap: [Change("posts", snap.read("posts").withColumn("is_review", F.lit(0)))])
    counts = spark.createDataFrame([("a", 9.0, None), ("z", 1.0, 1.0)], "post_id string, score double, num_comments double")
    made.update(lambda snap: [ingest.refreshed(snap, counts)])
    assert {(r.post_id, r.score, r.num_comments, r.is_review) for r in made.read("posts").collect()} == {("a", 9, 2, 0), ("b", 1, 2, 0)}
