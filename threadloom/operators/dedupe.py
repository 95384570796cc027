"""Cleanup of entities: purge of junk, removal of orphans, merge of duplicates. Pure transforms, no update in place."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions import lookups as L
from threadloom.functions.text import canonical_campus, clean_name, fold_key, plausible_name, strip, tokens
from threadloom.operators.relational import known_campus


def junk_entities(entities: DataFrame) -> DataFrame:
    """id of entities whose name can't be a person's or whose campus isn't a code (aliases don't count)."""
    return entities.where(~(plausible_name(F.col("last_name"), F.col("first_name")) & known_campus())).select("id")


def unlink(posts: DataFrame, gone: DataFrame) -> DataFrame:
    """posts, those of entities that are gone without one. Few entities go, so the side is small or AQE finds out."""
    g = gone.select(F.col("id").alias("gone")).distinct()
    return posts.join(g, F.col("professor_id") == F.col("gone"), "left").withColumn("professor_id", F.when(F.col("gone").isNull(), F.col("professor_id"))).drop("gone")


def orphans(entities: DataFrame, posts: DataFrame) -> DataFrame:
    """Entities without a post."""
    return entities.join(posts.select(F.col("professor_id").alias("id")), "id", "left_anti")


def merge_plan(entities: DataFrame, posts: DataFrame) -> DataFrame:
    """loser, keeper: who is merged into whom.

    Duplicates share the canonical campus, the folded surname and the first word of the folded given name, all
    cleaned; implausible names are never merged. The keeper has most posts; then a stored campus that is the default;
    then the shortest id; then the least.
    """
    n = posts.where("professor_id is not null").groupBy(F.col("professor_id").alias("id")).agg(F.count(F.lit(1)).alias("posts"))
    e = entities.where(plausible_name(F.col("last_name"), F.col("first_name"))).withColumn("c", clean_name(F.col("last_name"), F.col("first_name")))
    e = e.select("id", "campus", canonical_campus(F.col("campus")).alias("k1"), fold_key(F.col("c.last")).alias("k2"), fold_key(F.get(tokens(F.col("c.first")), F.lit(0))).alias("k3"))
    e = e.where("k1 is not null and k3 is not null").join(n, "id", "left")
    text = F.col("id").cast("string")
    order = [F.desc(F.coalesce("posts", F.lit(0))), (F.upper(strip(F.coalesce("campus", F.lit("")))) != L.DEFAULT_CAMPUS).cast("int"), F.length(text), text]
    w = Window.partitionBy("k1", "k2", "k3").orderBy(*order)
    placed = e.withColumns({"keeper": F.first("id").over(w), "place": F.row_number().over(w)})
    return placed.where("place > 1").select(F.col("id").alias("loser"), "keeper")


def merge_duplicates(entities: DataFrame, posts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entities, posts, counts): posts of losers are relinked, losers go. counts: one row."""
    plan = merge_plan(entities, posts)
    linked = posts.join(plan, F.col("professor_id") == F.col("loser"), "left")
    moved = linked.withColumn("professor_id", F.coalesce("keeper", "professor_id")).drop("loser", "keeper")
    kept = entities.join(plan.select(F.col("loser").alias("id")), "id", "left_anti")
    counts = plan.agg(F.countDistinct("keeper").alias("duplicate_groups_merged"), F.count(F.lit(1)).alias("duplicate_professors_removed"))
    relinked = posts.join(plan, F.col("professor_id") == F.col("loser"), "left_semi").agg(F.count(F.lit(1)).alias("posts_relinked"))
    return kept, moved, counts.crossJoin(relinked)  # one row each


def clean_entities(entities: DataFrame, posts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Purge, then orphans, then merge; a second run changes nothing. counts has a column for each step."""
    junk = junk_entities(entities)
    left = entities.join(junk, "id", "left_anti")
    loose = unlink(posts, junk)
    lost = orphans(left, loose)
    kept, moved, merged = merge_duplicates(left.join(lost.select("id"), "id", "left_anti"), loose)
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    unlinked = posts.join(junk.select(F.col("id").alias("professor_id")), "professor_id", "left_semi")
    counts = one(junk, "junk_professors_removed").crossJoin(one(unlinked, "posts_unlinked")).crossJoin(one(lost, "orphan_professors_removed")).crossJoin(merged)
    return kept, moved, counts
