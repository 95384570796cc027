"""Incremental ingest: de-duplicated streams, idempotent keyed merges, and backfills that resume."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.operators.relational import comment_gaps, listable
from threadloom.sources.raw import ITEM, entities_from_posts, posts_from_raw
from threadloom.sources.store import Change, Snapshot, Store, unseen

#: The setting and the state store that keeps what streams remember on disk, for sessions whose states are large.
STATE_STORE, ROCKSDB = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: How long a stream remembers an id. The store knows older ones.
REMEMBERED = 7 * 86_400.0


def item_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Listing items as JSON lines, as they arrive."""
    return spark.readStream.schema(ITEM).json(folder)


def distinct_items(items: DataFrame, remembered: float = REMEMBERED) -> DataFrame:
    """Each id once, however many pages hold it.

    Pages come newest first and backfills reach years back, so the watermark isn't on their times: it follows the clock,
    no item is too late, and an id is remembered for so many seconds at least and twice as many at most. So the state
    levels off with what comes in that time. An id that comes again later passes again: `merge_stream` holds it against
    the store. Null ids count as one. On a batch DataFrame all ids are told apart.
    """
    if not items.isStreaming:
        return items.dropDuplicates(["id"])
    seen = items.withColumn("__seen", F.current_timestamp()).withWatermark("__seen", f"{int(remembered * 1000)} milliseconds")
    return seen.dropDuplicatesWithinWatermark(["id"]).drop("__seen")


def merge_stream(items: DataFrame, store: Store, checkpoint: str, resume: bool = True):
    """Each batch's posts and entities are merged by key, so a batch that is run again changes nothing. resume: posts
    that are stored already are skipped. Runs what is there, then stops."""

    def merge(batch: DataFrame, _: int) -> None:
        rows = posts_from_raw(listable(batch)).persist()

        def plan(snap: Snapshot) -> list[Change]:
            posts = unseen(rows, snap.read("posts")) if resume else rows
            return [Change("posts", posts), Change("entities", entities_from_posts(posts), "insert")]

        store.update(plan)
        rows.unpersist()

    return items.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


# --- backfills --------------------------------------------------------------------------------------------------------

WAITING, CLAIMED, DONE = "waiting", "claimed", "done"
#: A claim that isn't followed by an end within so many seconds may be claimed by another run.
CLAIM_HOLDS = 3_600.0


def plan_tasks(store: Store, tasks: list[str]) -> None:
    """Adds tasks that aren't known yet; those that are keep their state."""
    rows = store.spark.createDataFrame([(t, WAITING, 0, time.time()) for t in tasks], "task string, state string, attempt int, at double")
    store.update(lambda _: [Change("progress", rows, "insert")])


def claim_tasks(store: Store, prefix: str, most: int, now: float | None = None, holds: float = CLAIM_HOLDS) -> list[str]:
    """Claims up to `most` open tasks in order: waiting ones, and claims whose run is overdue. Two runs never hold the
    same task: a claim is published onto the state that it was made from."""
    at, got = time.time() if now is None else now, []

    def plan(snap: Snapshot) -> list[Change]:
        open_ = (F.col("state") == WAITING) | ((F.col("state") == CLAIMED) & (F.col("at") <= at - holds))
        rows = snap.read("progress").where(F.startswith("task", F.lit(prefix)) & open_).orderBy("task").limit(most)
        found = rows.select("task", "attempt").collect()  # at most `most`
        got[:] = [r.task for r in found]
        if not found:
            return []
        return [Change("progress", store.spark.createDataFrame([(r.task, CLAIMED, r.attempt + 1, at) for r in found], "task string, state string, attempt int, at double"))]

    store.update(plan)
    return got


def finished(snap: Snapshot, tasks: list[str], now: float | None = None) -> Change:
    """The change that marks tasks as done, to be published with what they brought."""
    rows = snap.read("progress").where(F.col("task").isin(tasks))
    return Change("progress", rows.withColumns({"state": F.lit(DONE), "at": F.lit(time.time() if now is None else now)}))


def run_tasks(store: Store, prefix: str, bring: Callable[[list[str]], Callable[[Snapshot], list[Change]]], batch: int = 1, holds: float = CLAIM_HOLDS) -> int:
    """Claims tasks in batches and merges what `bring` makes of each, with the mark that they are done, in one commit.
    So a run that is killed leaves no task half done, and the next one goes on where it stopped. Returns how many."""
    n = 0
    while tasks := claim_tasks(store, prefix, batch, holds=holds):
        changes = bring(tasks)
        store.update(lambda snap: [*changes(snap), finished(snap, tasks)])  # noqa: B023
        n += len(tasks)
    return n


def shards(first_year: int, last_year: int) -> list[tuple[float, float]]:
    """Half-open year windows, to be backfilled one by one or side by side; merges by key make overlaps harmless."""
    from datetime import datetime, timezone

    start = lambda y: datetime(y, 1, 1, tzinfo=timezone.utc).timestamp()
    return [(start(y), start(y + 1)) for y in range(first_year, last_year + 1)]


def backfill(store: Store, read: Callable[[float, float], DataFrame], windows: list[tuple[float, float]], batch: int = 1, holds: float = CLAIM_HOLDS) -> int:
    """Merges the items that `read` gives for each window, each window once, whatever run it belongs to."""
    plan_tasks(store, [f"window {a:.0f} {b:.0f}" for a, b in windows])

    def bring(tasks: list[str]) -> Callable[[Snapshot], list[Change]]:
        frames = [read(*map(float, t.split()[1:])) for t in tasks]
        items = frames[0]
        for more in frames[1:]:
            items = items.unionByName(more)
        posts = posts_from_raw(listable(items))
        return lambda _: [Change("posts", posts), Change("entities", entities_from_posts(posts), "insert")]

    return run_tasks(store, "window ", bring, batch, holds)


def refill_plan(store: Store, limit: int | None) -> DataFrame:
    """Posts whose comments should be fetched again, widest gap first."""
    snap = store.snapshot()
    return comment_gaps(snap.read("posts"), snap.read("comments"), limit)


def refreshed(snap: Snapshot, counts: DataFrame) -> Change:
    """counts: post_id, score, num_comments, as a fetched thread shows them; nulls leave what is there. Only these columns
    of the posts change, so the review flag and the parsed fields stay."""
    new = counts.select("post_id", F.col("score").cast("long").alias("new_score"), F.col("num_comments").cast("long").alias("new_count")).dropDuplicates(["post_id"])
    rows = snap.read("posts").join(new, "post_id").withColumns({"score": F.coalesce("new_score", "score"), "num_comments": F.coalesce("new_count", "num_comments")})
    return Change("posts", rows.drop("new_score", "new_count"))
