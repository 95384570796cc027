"""Sources, streams and the store on small files."""

import argparse
import json

import pytest
from pyspark.sql import functions as F

from threadloom import cli
from threadloom.functions import lookups
from threadloom.operators import relational
from threadloom.sources import paged, raw, store
from threadloom.streaming import ingest


def page(*items, after=None):
    return json.dumps({"data": {"after": after, "children": [{"kind": "t3", "data": x} for x in items]}})


def post(i, at=0.0, **more):
    return {"id": i, "title": "[UPD] Math 21 - Cruz, Juan", "created_utc": at} | more


def test_paged_listing(spark, tmp_path):
    paged.register(spark)
    (tmp_path / "first.json").write_text(page(post("a"), post("b"), after="p2"))
    (tmp_path / "p2.json").write_text(page(post("c", score=3), after="p3"))
    (tmp_path / "p3.json").write_text("{no json")
    read = lambda **o: spark.read.format("paged_listing").options(path=str(tmp_path), **o).load()
    assert sorted((r.id, r.score) for r in read().collect()) == [("a", None), ("b", None), ("c", 3.0)]
    assert sorted(r.id for r in read(limit=1).collect()) == ["a"] and sorted(r.id for r in read(cursors="p2,p3").collect()) == ["c"]
    assert raw.posts_from_raw(read()).where("professor_id = 'upd__cruz__juan'").count() == 3


def test_paged_stream_goes_on(spark, tmp_path):
    """Few pages a trigger; a last page that grows and then names a next one; a batch that is read again."""
    paged.register(spark)
    (tmp_path / "in").mkdir()
    put = lambda name, text: (tmp_path / f"in/{name}.json").write_text(text)
    put("first", page(post("a"), post("b"), after="p2"))
    put("p2", page(post("c")))
    got = lambda: sorted(r.id for r in spark.read.parquet(f"file://{tmp_path}/out").collect())

    def run():
        rows = spark.readStream.format("paged_listing").option("path", str(tmp_path / "in")).option("pagesPerTask", 1).load()
        q = rows.writeStream.format("parquet").option("path", f"file://{tmp_path}/out").option("checkpointLocation", f"file://{tmp_path}/at").trigger(processingTime="0 seconds").start()
        q.processAllAvailable()
        q.stop()

    run()
    assert got() == ["a", "b", "c"]
    put("p2", page(post("c"), post("d")))
    run()
    assert got() == ["a", "b", "c", "d"]
    put("p2", page(post("c"), post("d"), after="p3"))
    put("p3", page(post("e")))
    run()
    assert got() == ["a", "b", "c", "d", "e"]
    reader = paged._Stream({"path": str(tmp_path / "in"), "pagesPerTask": "1"})
    first = reader.initialOffset()
    assert (end := reader.latestOffset()) == {"first": {"cursor": "p3", "seen": 1}}
    parts = reader.partitions(first, end)
    assert [[r[0] for r in reader.read(p)] for p in parts] == [["a", "b"], ["c", "d"], ["e"]] and reader.partitions(end, end) == []
    # begun again in the middle, and without knowing the walk
    middle = {"first": {"cursor": "p2", "seen": 1}}
    assert [[r[0] for r in reader.read(p)] for p in reader.partitions(middle, end)] == [["d"], ["e"]]
    assert [[r[0] for r in reader.read(p)] for p in paged._Stream({"path": str(tmp_path / "in")}).partitions(middle, end)] == [["d", "e"]]


class Service:
    """A service on this machine that counts what it is asked."""

    def __init__(self, answer):
        from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
        from threading import Thread
        from urllib.parse import parse_qsl, urlsplit

        asked = self.asked = []

        class Handler(BaseHTTPRequestHandler):
            def do_GET(self):
                at = urlsplit(self.path)
                params = dict(parse_qsl(at.query))
                asked.append((at.path, params))
                code, body = answer(at.path, params)
                self.send_response(code)
                self.end_headers()
                self.wfile.write(body.encode())

            def log_message(self, *_):
                pass

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        self.url = f"http://127.0.0.1:{self.server.server_port}"
        Thread(target=self.server.serve_forever, daemon=True).start()


def archive_of(rows):
    """Newest first, at most `limit`, before exclusive, after inclusive."""

    def answer(path, q):
        found = [r for r in rows if r["created_utc"] < float(q.get("before", "inf")) and r["created_utc"] >= float(q.get("after", "-inf")) and ("link_id" not in q or r["link_id"] == q["link_id"])]
        found.sort(key=lambda r: -r["created_utc"])
        return 200, json.dumps({"data": found[: int(q["limit"])]})

    return answer


def test_archive_pages_follow_the_filter(spark, capsys):
    """Bounds reach the service, so that pages outside them are never asked for; a second that fills pages loses no row."""
    paged.register(spark)
    rows = [post(f"p{i}", float(i // 3)) for i in range(3000)] + [post(f"s{i}", 500.0) for i in range(250)]
    service = Service(archive_of(rows))
    read = lambda **o: spark.read.format("paged_archive").options(path=service.url, delay="0", **o).load()
    assert sorted(r.id for r in read().collect()) == sorted(r["id"] for r in rows)
    all_pages, service.asked[:] = len(service.asked), []
    some = read(windows="4").where("created_utc >= 100 and created_utc < 140 and score is null")
    some.explain("formatted")
    assert "PushedFilters: [GreaterThanOrEqual(created_utc,100.0), LessThan(created_utc,140.0)]" in capsys.readouterr().out
    assert sorted(r.id for r in some.collect()) == sorted(r["id"] for r in rows if 100 <= r["created_utc"] < 140)
    assert 4 <= len(service.asked) <= 8 < all_pages and all(100 <= int(q["after"]) and int(q["before"]) <= 140 for _, q in service.asked)
    service.asked.clear()
    assert sorted(r.created_utc for r in read().where("created_utc > 998 and created_utc <= 999.0").collect()) == [999.0] * 3
    assert [r.id for r in read().where("created_utc = 7").orderBy("id").collect()] == ["p21", "p22", "p23"] and read().where("created_utc > 5 and created_utc < 5").count() == 0
    assert len({r.id for r in read(limit="30").collect()}) == 30
    comments = [{"id": f"c{i}", "link_id": "t", "created_utc": float(i // 2), "body": "[deleted]" if i % 10 == 0 else "x", "parent_id": "t3_t" if i % 2 else f"t1_c{i - 1}"} for i in range(500)]
    service = Service(archive_of(comments))
    got = spark.read.format("paged_archive").options(path=service.url, kind="comments", threads="t,none").load().collect()
    assert sorted(r.id for r in got) == sorted(c["id"] for c in comments if c["body"] == "x") and {(r.parent_id[:3], r.depth) for r in got} == {("t3_", 0.0), ("t1_", 1.0)}


def test_archive_is_asked_again(monkeypatch):
    codes = [429, 200]
    rows = [post("a", 1.0), post("b", 2.0)]
    service = Service(lambda _, q: (codes.pop(0), json.dumps({"data": rows})))
    assert [r["id"] for r in paged.ask(service.url, {"limit": 5, "sort": "desc"}, 0)] == ["b", "a"] and len(service.asked) == 2
    refusing = Service(lambda _, q: (422, "") if "sort" in q else (200, json.dumps({"data": rows})))
    assert [r["id"] for r in paged.ask(refusing.url, {"limit": 5, "sort": "desc", "sort_type": "x"}, 0)] == ["b", "a"]
    broken = Service(lambda _, q: (200, "<html>"))
    assert paged.ask(broken.url, {}, 0) == [] and paged.ask("http://127.0.0.1:9/none", {}, 0) == []
    # more rows in one second than the longest page takes: the rest is given up, older ones are not
    monkeypatch.setattr(paged, "LONGEST_PAGE", 200)
    many = [post(f"s{i}", 9.0) for i in range(400)] + [post("old", 3.0)]
    answer = archive_of(many)
    got = [r["id"] for r in paged.by_time(lambda p: json.loads(answer("", {k: str(v) for k, v in p.items()})[1])["data"], None, None, 1000)]
    assert len(got) == len(set(got)) and "old" in got and len(got) >= 200
    assert len(list(paged.by_time(lambda p: json.loads(answer("", {k: str(v) for k, v in p.items()})[1])["data"], None, None, 150))) == 150


def test_several_listings_in_one_stream(spark, tmp_path):
    """Each goes on by itself; started again, tasks read only what is new."""
    paged.register(spark)
    listings = {"new": page(post("n1"), post("n2"), after="new2"), "new2": page(post("n3")), "top": page(post("t1"))}
    service = Service(lambda _, q: (200, listings[q["after"]]) if q["after"] in listings else (404, ""))
    got = lambda: sorted(r.id for r in spark.read.parquet(f"file://{tmp_path}/out").collect())

    def run():
        rows = spark.readStream.format("paged_listing").option("path", service.url).option("cursors", "new,top").option("pagesPerTask", 1).load()
        q = rows.writeStream.format("parquet").option("path", f"file://{tmp_path}/out").option("checkpointLocation", f"file://{tmp_path}/at").trigger(processingTime="0 seconds").start()
        q.processAllAvailable()
        q.stop()

    run()
    assert got() == ["n1", "n2", "n3", "t1"]
    listings |= {"new2": page(post("n3"), after="new3"), "new3": page(post("n4"), post("n5")), "top": page(post("t1"), post("t2"))}
    service.asked.clear()
    run()
    assert got() == ["n1", "n2", "n3", "n4", "n5", "t1", "t2"]


def test_ids_are_remembered_for_a_while(spark, tmp_path):
    """The state levels off; what it has forgotten, the store knows."""
    spark.conf.set(ingest.STATE_STORE, ingest.ROCKSDB)
    (tmp_path / "in").mkdir()
    s = store.Store(spark, f"file://{tmp_path}/store")
    states, batches = [], 7
    for n in range(batches):
        items = [post(f"b{n}-{i}", float(n)) for i in range(20)] + [post("b0-0", 0.0, title="again"), post(f"b{n}-1", 0.0)]
        (tmp_path / f"in/{n}.json").write_text("\n".join(map(json.dumps, items)))
        q = ingest.merge_stream(ingest.distinct_items(ingest.item_stream(spark, f"file://{tmp_path}/in"), remembered=0.001), s, f"file://{tmp_path}/at")
        assert q.awaitTermination(60)
        states.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert s.read("posts").count() == 20 * batches and s.read("posts").where("title = 'again'").count() == 0
    assert max(states[2:]) <= 4 * 21 < 20 * batches
    spark.conf.unset(ingest.STATE_STORE)


def test_merge_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    s = store.Store(spark, f"file://{tmp_path}/store")
    batches = [[post("a", 5.0, score=1), post("b", 4.0, stickied=True), post("c", 3.0)], [post("a", 5.0, score=7), post("d", 1.0)]]
    for n, items in enumerate(batches):
        (tmp_path / f"in/{n}.json").write_text("\n".join(map(json.dumps, items)))
        ingest.merge_stream(ingest.distinct_items(ingest.item_stream(spark, f"file://{tmp_path}/in")), s, f"file://{tmp_path}/at").awaitTermination()
    assert sorted((r.post_id, r.score) for r in s.read("posts").collect()) == [("a", 1), ("c", 0), ("d", 0)] and s.read("entities").count() == 1
    s.merge(posts=s.read("posts").withColumn("num_comments", F.when(F.col("post_id") == "c", 4).otherwise(0)))
    assert [(r.post_id, r.gap) for r in ingest.refill_plan(s, 10).collect()] == [("c", 4)]
    years = ingest.shards(2023, 2025)
    assert len(years) == 3 and all(a[1] == b[0] for a, b in zip(years, years[1:])) and years[1] == (1704067200.0, 1735689600.0)


def test_archive_and_feed(spark, tmp_path):
    rows = [post("a", 10.0, score=1), post("b", 20.0, score=9), post("a", 10.0, score=1), post("c", 30.0, score=5), post("d", 40.0)]
    (tmp_path / "a.json").write_text("\n".join(map(json.dumps, rows)))
    ids = lambda **o: [r.id for r in raw.read_archive_posts(spark, f"file://{tmp_path}/a.json", **o).collect()]
    assert ids() == ["d", "c", "b", "a"] and ids(after=20.0, before=40.0) == ["c", "b"] and ids(sort="top", limit=2) == ["b", "c"]
    (tmp_path / "feed.xml").write_text('''<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>t3_x1</id><title> Math 21 - Cruz, Juan </title><published>2024-01-01T00:00:00Z</published>
<link href="https://www.reddit.com/r/x/comments/x1/slug/"/><author><name>/u/me</name></author><content type="html">&lt;p&gt;so   &lt;b&gt;fair&lt;/b&gt;&lt;/p&gt;</content></entry>
<entry><id>none</id><title>second</title><link href="https://www.reddit.com/r/x/comments/y2/"/></entry><entry><id>t3_z</id><title> </title></entry></feed>''')
    got = {r.id: r for r in raw.read_feed(spark, f"file://{tmp_path}/feed.xml").collect()}
    assert set(got) == {"x1", "y2"} and (got["x1"].selftext, got["x1"].author, got["x1"].created_utc, got["x1"].title) == ("so fair", "me", 1704067200.0, "Math 21 - Cruz, Juan")
    assert got["y2"].created_utc == 0.0 and got["x1"].permalink == "/r/x/comments/x1/slug/"


def test_listings_nest_and_unnest(spark, tmp_path):
    """Flat items as a nested listing and back; trees that can't be parsed are told."""
    items = spark.createDataFrame([post("a", 1.0, score=2.0), post("b", 2.0, score=None)], raw.ITEM)
    raw.wrap_listing(items).coalesce(1).write.json(f"file://{tmp_path}/one")
    assert sorted((r.id, r.score) for r in raw.read_listings(spark, f"file://{tmp_path}/one").collect()) == [("a", 2.0), ("b", None)]
    trees = spark.createDataFrame([("p1", "{no json"), ("p2", "[" * 300_000 + "]" * 300_000), ("p3", None), ("p4", "{}")], "post_id string, tree string")
    assert sorted(r.post_id for r in raw.unreadable_trees(trees).collect()) == ["p1", "p2"] and raw.flatten_replies(trees).count() == 0


def test_orders_of_listings(spark):
    rows = spark.createDataFrame([("a", 10, 1, 0.0), ("b", 1, 5, 86_400.0), ("c", 20, 0, 0.0), ("d", None, None, None)], "id string, score long, num_comments long, created_utc double")
    order = lambda sort: [r.id for r in relational.listing_order(rows, sort).collect()]
    assert order("new") == ["b", "a", "c", "d"] and order("top") == ["c", "a", "b", "d"] and order("rising")[0] == "b" and order("hot") == ["c", "a", "b", "d"]


def test_cli_bounds_and_passes(spark):
    assert cli.bound(spark, "1700000000") == 1700000000.0 and cli.bound(spark, "2024-01-01") == 1704067200.0 and cli.bound(spark, None) is None
    with pytest.raises(ValueError):
        cli.bound(spark, "soon")
    assert len(lookups.PASSES) == 13 and cli.scaled_passes(0.01)[0] == ("new", None, 10, 5)
    assert argparse.Namespace is not None
