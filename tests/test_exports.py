"""Exports: the bytes of one document that many tasks write, in each format."""

import argparse
import json

import pytest
from pyspark.sql import functions as F

from threadloom import cli
from threadloom.operators import relational, report
from threadloom.sources import sinks, store


def plain(df):
    """What a document of these rows should be."""
    rows = [json.dumps(r.asDict(recursive=True), ensure_ascii=False, indent=2) for r in df.collect()]
    return "[\n" + ",\n".join(rows) + "\n]\n" if rows else "[\n]\n"


@pytest.fixture
def tables(spark):
    posts = [(f"p{i}", f"title {i} \"é\"", "UPD" if i % 3 else None, "Speech 30" if i % 3 else None, "upd__x__y" if i % 3 else None, "https://u", 42, 3, 1710000000.0 + i // 2, None if i == 4 else "me", "text\nof two [", 1710500000.0, 1) for i in range(40)]
    comments = [(f"c{i}", f"p{i % 7}", f"t3_p{i % 7}", "reviewer", "so fair and clear [ }", 1, 1710100000.0 + i // 3, i % 4, 1710500000.0, i % 2) for i in range(300)] + [("lost", "p99", None, None, "x", 0, 0.0, 0, 0.0, 1)]
    people = [("upd__x__y", "Redelicia", "Romeo Joshua", "UPD"), ("upd__a__b", "Cruz", "Ana", "UPD")]
    make = lambda rows, name: store.conform(spark.createDataFrame(rows, store.schema(name)), name)
    return make(posts, "posts"), make(comments, "comments"), make(people, "entities")


@pytest.mark.parametrize("chunk", [1, 1 << 20])
def test_threads(spark, tables, tmp_path, monkeypatch, chunk):
    """Whole threads and such that lie in several tasks; threads without comments."""
    monkeypatch.setattr(sinks, "CHUNK", chunk)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        n = sinks.write_threads(*tables, f"{tmp_path}/out/full.json")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    text = (tmp_path / "out/full.json").read_text()
    assert text == plain(relational.threads(*tables)) and n == 40 == len(json.loads(text))
    assert [p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")] == ["full.json"]
    one = next(d for d in json.loads(text) if d["post"]["post_id"] == "p1")
    assert one["professor"] == {"last_name": "Redelicia", "first_name": "Romeo Joshua"} and "T" in one["post"]["posted_at"] and len(one["comments"]) == 43 and one["comments"][0]["depth"] == 1


def test_documents(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "CHUNK", 300)
    people = report.entity_index(*tables)
    assert sinks.write_document(people, f"file://{tmp_path}/people.json") == 2 and (tmp_path / "people.json").read_text() == plain(people)
    rows, _ = report.review_rows(*tables)
    rows = rows.orderBy("reviewId")
    n = sinks.write_document(rows, str(tmp_path / "rows.json"))
    assert n == rows.count() > 100 and (tmp_path / "rows.json").read_text() == plain(rows)
    assert sinks.write_document(people.limit(0), str(tmp_path / "people.json")) == 0 and (tmp_path / "people.json").read_text() == "[\n]\n"
    assert sinks.write_threads(*[t.limit(0) for t in tables], str(tmp_path / "none.json")) == 0 and json.loads((tmp_path / "none.json").read_text()) == []
    sinks.write_lines(people, f"file://{tmp_path}/lines")
    assert sorted(json.loads(x)["professor"] for x in "".join(p.read_text() for p in (tmp_path / "lines").glob("part-*")).splitlines()) == ["Cruz, Ana", "Redelicia, Romeo Joshua"]


def test_names(spark, tmp_path):
    names = spark.createDataFrame([("Ñ, b",), ("a",), ("c",)], "name string").repartition(3).orderBy("name")
    for rows, want in ((names, ["a", "c", "Ñ, b"]), (names.limit(0), [])):
        assert sinks.write_names(rows, str(tmp_path / "names.json"), "unresolved_count", "unresolved") == len(want)
        text = (tmp_path / "names.json").read_text()
        assert text == json.dumps({"unresolved_count": len(want), "unresolved": want}, ensure_ascii=False, indent=2) + "\n"


def test_a_thread_is_never_held(spark, tmp_path):
    """One thread of many comments: no task sees all of them, no row of text is long."""
    n = 200_000
    post = store.conform(spark.createDataFrame([("p", 1.0)], "post_id string, created_utc double"), "posts")
    comments = store.conform(spark.range(n).select(F.concat(F.lit("c"), "id").alias("comment_id"), F.lit("p").alias("post_id"), F.col("id").cast("double").alias("created_utc"), F.lit("so fair").alias("body")), "comments")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert sinks.write_threads(post, comments, store.conform(spark.createDataFrame([], store.schema("entities")), "entities"), str(tmp_path / "t.json")) == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    (doc,) = json.loads((tmp_path / "t.json").read_text())
    assert [c["comment_id"] for c in doc["comments"]] == [f"c{i}" for i in range(n)]


def test_commands(spark, tables, tmp_path, capsys):
    """export in its three formats, reparse and triage-reviews, on a store."""
    posts, comments, people = tables
    s = store.Store(spark, f"file://{tmp_path}/store")
    s.write(posts=posts, comments=comments, entities=people)
    call = lambda *args: cli.main(["--store", f"file://{tmp_path}/store", *args])
    for kind, n in (("full", 40), ("professors", 2), ("comments", None)):
        assert call("export", "--format", kind, "--output", str(tmp_path / f"{kind}.json")) == 0
        data = json.loads((tmp_path / f"{kind}.json").read_text())
        assert n in (None, len(data)) and f"{len(data)} rows" in capsys.readouterr().out
    assert {r["resolve_status"] for r in data} == {"unchecked"} and json.loads((tmp_path / "comments.unresolved.json").read_text()) == {"unresolved_count": 0, "unresolved": []}
    before = s.snapshot()
    assert call("triage-reviews") == 0 and "too_short" in capsys.readouterr().out
    flags = {r.post_id: r.is_review for r in s.read("posts").collect()}
    assert set(flags.values()) == {0}
    number = s.snapshot().number
    assert number == before.number + 1 and call("triage-reviews") == 0 and s.snapshot().number == number  # a second run changes nothing
    s.update(lambda snap: [store.Change("posts", snap.read("posts").where("post_id = 'p0'").withColumn("title", F.lit("[UPLB] Math 21 - Reyes, Ana")))])
    assert call("reparse") == 0
    got = {r.post_id: r for r in s.read("posts").collect()}
    assert (got["p0"].professor_id, got["p0"].campus, got["p0"].is_review) == ("uplb__reyes__ana", "UPLB", 0) and got["p1"].professor_id == "upd__x__y"
    assert s.read("entities").where("id = 'uplb__reyes__ana'").count() == 1
    assert call("reparse", "--all") == 0 and {r.professor_id for r in s.read("posts").collect()} == {None, "uplb__reyes__ana"}
    assert call("clean-junk") == 0 and [r.id for r in s.read("entities").collect()] == ["uplb__reyes__ana"]
    assert call("vacuum", "--keep", "1", "--older-than", "-5") == 0 and s.read("posts").count() == 40
    assert argparse.Namespace is not None
