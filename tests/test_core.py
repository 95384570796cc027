"""Golden cases of titles, names, classification, match, cleanup and the store."""

import argparse
import json
import random

from pyspark.sql import functions as F

from threadloom import cli
from threadloom.functions import classify, text
from threadloom.functions.titles import parse_titles
from threadloom.operators import dedupe, match, mentions, report
from threadloom.plans import queries
from threadloom.sources import fallback, raw, store
from threadloom.streaming import ingest

TITLES = {
    "[UPD] Math 21 - REDELICIA, ROMEO JOSHUA": ("UPD", "Math 21", "Redelicia", "Romeo Joshua"),
    "[upmin] Bio 1 - SANTOS-REYES, MA. ANA (AY 2024-2025)": ("UPMin", "Bio 1", "Santos-Reyes", "Ma. Ana"),
    "[UPD] GARCIA, MARK - Physics 71": ("UPD", "Physics 71", "Garcia", "Mark"),
    "Fil 40 - Cruz, Juan": ("UPD", "Fil 40", "Cruz", "Juan"),
    "UPD Fil 40 - Cruz, Juan": None,
    "[XYZ] Math 21 - Cruz, Juan": None,
    "[Review] Math 21 - Cruz, Juan": ("UPD", "Math 21", "Cruz", "Juan"),
    "[UPD] Physics 71 – Pagayon, Julius": ("UPD", "Physics 71", "Pagayon", "Julius"),
    "[UPD] PE 2 - PHILIPPINE GAMES - BERNALES, ANA": ("UPD", "PE 2 - PHILIPPINE GAMES", "Bernales", "Ana"),
    "[UPD] SOC SCI 2 PAGUIRIGAN, MARIA": ("UPD", "SOC SCI 2", "Paguirigan", "Maria"),
    "[UPD] Math 21 WFX - Sir Cruz, Juan pls": ("UPD", "Math 21", "Cruz", "Juan"),
    "[UPD] looking for classmates - Cruz, Juan": None,
    "": None,
    None: None,
}


def test_titles(spark):
    rows = parse_titles(spark.createDataFrame([(t,) for t in TITLES], "title string")).collect()
    got = {r.title: (r.campus, r.course, r.last_name, r.first_name) if r.campus else None for r in rows}
    assert got == TITLES
    assert {r.professor_id for r in rows if r.title and r.title.startswith("[upmin]")} == {"upmin__santosreyes__ma_ana"}


def test_names(spark):
    df = spark.createDataFrame([("Diñgal", "Juan", True), ("TBA", "Juan", False), ("De", "Juan", False), ("Cruz", "Math 21", False), ("1 Francisco", "Ana", True), ("Cruz", "", False), ("a@b.com", "x", False)], "last string, first string, ok boolean")
    assert df.where(text.plausible_name(F.col("last"), F.col("first")) != F.col("ok")).count() == 0
    s = spark.createDataFrame([("Juan Dela Cruz",), ("GARCIA, MARK",), ("Cher",), ("",)], "t string").select(text.split_name(F.col("t")).alias("s")).collect()
    assert [tuple(r.s) for r in s] == [("Dela Cruz", "Juan"), ("GARCIA", "MARK"), ("Cher", ""), ("", "")]
    assert spark.range(1).select(text.normalize_name(F.lit("  Ñoño, O'Brien-Cruz. "))).first()[0] == "nono obrien-cruz"


def test_triage_and_signals(spark):
    cases = [("any thoughts on this prof?", "ask"), ("haha", "reaction"), ("Math 21", "course_code"), ("[deleted]", "empty"), (None, "empty"), ("the exams were hard", None), ("lf classmates", "request"), ("hello po", "thanks"), ("x" * 90, None), ("short", "too_short")]
    df = spark.createDataFrame(cases, "t string, want string")
    assert df.where(~classify.drop_reason(F.col("t"), F.lit(False)).eqNullSafe(F.col("want"))).count() == 0
    s = spark.range(1).select(classify.analyze_text(F.lit("heavy workload but fair")).alias("s")).first().s
    assert (s.workload, s.grading, s.workload_mentions.heavy, s.keywords) == ("heavy", "fair", 2, ["fair", "heavy", "heavy workload"])


ROSTER = [("1", "REYES, JUAN", "Juan Reyes", 1), ("2", "REYES, ANA", "Ana Reyes", 2), ("3", "DELA CRUZ, MARIA CLARA", "Maria Clara Dela Cruz", 3), ("4", "PEÑAFLOR, JOSE", "Jose Penaflor", 4), ("5", "SANTOS, PEDRO", "Pedro Santos", 5)]


def test_match(spark):
    roster = spark.createDataFrame(ROSTER, "instructor_id string, name_normalized string, name_display string, ord long")
    taught = spark.createDataFrame([("1", ["Math 21"], "upd"), ("2", ["Eng 13"], "upd")], "instructor_id string, courses array<string>, university_id string")
    names = spark.createDataFrame(
        [("exact", "Reyes", "Juan", None, None), ("reversed", "Juan", "Reyes", None, None), ("token", "Dela Cruz", "Maria", None, None), ("accent", "Penaflor", "José", None, None), ("hyphen", "Santos-Lim", "Pedro", None, None), ("course", "Reyes", "Zoe", ["Math 21"], "upd"), ("tie", "Reyes", "Zoe", None, None), ("none", "Nobody", "At All", None, None)],
        "n string, last string, first string, courses array<string>, university string",
    )
    got = {r.n: (r.instructor_id, r.match_type, r.confidence) for r in match.match(names, match.roster_keys(roster), taught).collect()}
    assert got["exact"] == ("1", "exact", 1.0) and got["reversed"] == ("1", "exact_reversed", 1.0) and got["token"] == ("3", "first_token", 0.8) and got["accent"] == ("4", "exact", 1.0)
    assert got["hyphen"] == ("5", "exact_hyphen_head", 1.0) and got["course"] == ("1", "last_name_only+course", 0.95)
    assert "tie" not in got and "none" not in got
    status = {r.n: r.status for r in report.statuses(names, roster, taught, 5).collect()}
    assert (status["tie"], status["none"], status["course"]) == ("ambiguous", "unresolved", "resolved")


def test_cleanup_is_idempotent(spark):
    e = spark.createDataFrame([("a", "Reyes", "Juan", "UPD"), ("bb", "REYES", "Juan Carlo", "upd"), ("j", "TBA", "Ana", "UPD"), ("o", "Lim", "Ana", "UPD"), ("x", "Tan", "Bo", "XYZ")], "id string, last_name string, first_name string, campus string")
    p = spark.createDataFrame([("1", "a"), ("2", "bb"), ("3", "bb"), ("4", "j"), ("5", "x"), ("6", None)], "post_id string, professor_id string")
    e1, p1, counts = dedupe.clean_entities(e, p)
    assert [r.id for r in e1.collect()] == ["bb"]
    assert sorted((r.post_id, r.professor_id) for r in p1.collect()) == [("1", "bb"), ("2", "bb"), ("3", "bb"), ("4", None), ("5", None), ("6", None)]
    assert counts.first().asDict() == {"junk_professors_removed": 2, "posts_unlinked": 2, "orphan_professors_removed": 1, "duplicate_groups_merged": 1, "duplicate_professors_removed": 1, "posts_relinked": 1}
    assert sum(dedupe.clean_entities(e1, p1)[2].first()) == 0


def test_raw_and_store(spark, tmp_path):
    item = {"id": "p1", "title": "[UPD] Math 21 - Cruz, Juan", "permalink": "/r/x/p1", "score": 3, "created_utc": 5, "author": "[deleted]"}
    (tmp_path / "json").mkdir()
    (tmp_path / "json/a.json").write_text(json.dumps({"data": {"after": None, "children": [{"kind": "t3", "data": item}]}}))
    posts = raw.posts_from_raw(raw.read_listings(spark, str(tmp_path / "json")))
    r = posts.first()
    assert (r.post_id, r.url, r.author, r.score, r.num_comments, r.professor_id) == ("p1", "https://reddit.com/r/x/p1", None, 3, 0, "upd__cruz__juan")
    s = store.Store(spark, f"file://{tmp_path}/store")
    s.merge(posts=posts, entities=raw.entities_from_posts(posts))
    s.merge(posts=posts.withColumn("score", F.lit(9)))
    assert [(x.score, x.is_review) for x in s.read("posts").collect()] == [(9, 1)] and s.read("entities").count() == 1 and s.read("comments").count() == 0


def test_reply_tree_drops_deleted_with_replies(spark):
    node = lambda i, body, *kids: {"kind": "t1", "data": {"id": i, "parent_id": "t3_p", "body": body, "replies": {"data": {"children": list(kids)}} if kids else ""}}
    tree = json.dumps({"data": {"children": [node("a", "hi", node("b", "yo")), node("c", "[deleted]", node("d", "lost"))]}})
    rows = raw.flatten_replies(spark.createDataFrame([("p", tree)], "post_id string, tree string")).collect()
    assert sorted((r.id, r.depth) for r in rows) == [("a", 0.0), ("b", 1.0)]


def test_reply_tree_of_many_levels(spark):
    depth, tree = 60, '""'
    for d in reversed(range(depth)):
        tree = f'{{"data":{{"children":[{{"kind":"t1","data":{{"id":"c{d}","parent_id":"t3_p","body":"b","score":{d},"replies":{tree}}}}}]}}}}'
    rows = raw.flatten_replies(spark.createDataFrame([("p", tree), ("q", None), ("r", "{")], "post_id string, tree string")).collect()
    assert sorted((int(r.depth), r.id, r.score, r.post_id) for r in rows) == [(d, f"c{d}", float(d), "p") for d in range(depth)]


def test_merge_queries_meet_stored_rows(spark, monkeypatch):
    sizes, own = [], {f: getattr(store, f) for f in ("replace_by_key", "insert_absent")}
    for f, run in own.items():
        monkeypatch.setattr(store, f, lambda old, new, key, order, run=run: sizes.append((old.count(), old.join(new, key, "left_semi").count(), new.join(old, key, "left_anti").count())) or run(old, new, key, order))
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("user_id", "event_id", "value", "ts").collect()
    for name, pick in (("upsert_last_wins", max), ("insert_first_wins", min)):
        sizes.clear()
        want = {u: pick((r.ts, r.event_id, r.value) for r in e if r.user_id == u)[1:] for u in {r.user_id for r in e}}
        assert sorted(map(tuple, queries.QUERIES[name](spark, "/root/testdata/sf0.001").collect())) == sorted((u, *x) for u, x in want.items())
        assert any(old > met > 0 and new > 0 for old, met, new in sizes)


def test_cli_loads_comments(spark, tmp_path):
    for name in ("json", "threads", "comments"):
        (tmp_path / f"raw/{name}").mkdir(parents=True)
    items = [{"id": i, "title": "[UPD] Math 21 - Cruz, Juan", "num_comments": 2, "created_utc": n} for n, i in enumerate("pqr")]
    (tmp_path / "raw/json/a.json").write_text(json.dumps({"data": {"children": [{"kind": "t3", "data": x} for x in items]}}))
    reply = lambda i, *kids: {"kind": "t1", "data": {"id": i, "parent_id": "t3_p", "body": "b", "replies": {"data": {"children": list(kids)}} if kids else ""}}
    (tmp_path / "raw/threads/a.json").write_text(json.dumps({"post_id": "p", "tree": json.dumps({"data": {"children": [reply("a", reply("b"))]}})}))
    flat = [{"id": "x", "post_id": "p", "body": "not used, p has a tree"}, {"id": "c", "link_id": "t3_q", "body": "b"}, {"id": "d", "post_id": "q", "body": "[deleted]"}, {"id": "e", "post_id": "other", "body": "b"}]
    (tmp_path / "raw/comments/a.json").write_text("\n".join(map(json.dumps, flat)))
    a = argparse.Namespace(raw=f"file://{tmp_path}/raw", sort="new", limit=0, comments=0, query=None, archive=False, resume=False, after=None, before=None)
    s = store.Store(spark, f"file://{tmp_path}/store")
    assert cli.ingest(spark, s, a) == 0
    stored = lambda: sorted((r.post_id, r.comment_id, r.depth) for r in s.read("comments").collect())
    assert stored() == [("p", "a", 0), ("p", "b", 1), ("q", "c", 0)]
    (tmp_path / "raw/comments/b.json").write_text(json.dumps({"id": "f", "post_id": "r", "body": "late"}))
    cli.enrich(spark, s, argparse.Namespace(raw=a.raw, limit=50, archive=False))
    assert stored() == [("p", "a", 0), ("p", "b", 1), ("q", "c", 0), ("r", "f", 0)]


def test_stream_keeps_older_items(spark, tmp_path):
    (tmp_path / "in").mkdir()
    day, seen = 86_400, f"file://{tmp_path}/seen"
    pages = [[("a", 900 * day), ("b", 899 * day), ("a", 900 * day)], [("c", 3 * day), ("b", 899 * day), ("d", 800 * day)], [("e", 1), ("c", 3 * day)]]
    for n, page in enumerate(pages):
        (tmp_path / f"in/{n}.json").write_text("\n".join(json.dumps({"id": i, "title": "t", "created_utc": at}) for i, at in page))
        items = ingest.distinct_items(ingest.item_stream(spark, f"file://{tmp_path}/in"))
        q = items.writeStream.format("parquet").option("path", f"file://{tmp_path}/out").option("checkpointLocation", seen).trigger(availableNow=True).start()
        q.awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(f"file://{tmp_path}/out").collect()) == ["a", "b", "c", "d", "e"]


def test_fallback(spark):
    empty, one = spark.createDataFrame([], "id string"), spark.createDataFrame([("x",)], "id string")
    assert [(r.id, r.source) for r in fallback.first_with_rows(fallback.ranked([("json", empty), ("archive", one), ("rss", one)])).collect()] == [("x", "archive")]
    assert fallback.source_order(False, False, "q", False) == ["archive", "rss"]


def test_expressions_are_built_once(spark):
    from threadloom.functions import text

    a = spark.createDataFrame([("Dr. Cruz", "Ana", "Reyes", "Juan pls")], "l string, f string, l2 string, f2 string")
    one, again, other = (text.clean_name(F.col(x), F.col(y)) for x, y in (("l", "f"), ("l", "f"), ("l2", "f2")))
    assert one is again and one is not other
    r = a.select(one.alias("x"), other.alias("y"), F.transform(F.array("l", "l2"), lambda v: text.split_name(v)["first"]).alias("z")).first()
    assert (tuple(r.x), tuple(r.y), r.z) == (("Cruz", "Ana"), ("Reyes", "Juan"), ["Dr.", ""])


# Texts that are reviews and texts that aren't, and what signals a text should give.
REVIEWS = [
    "mabait at unoable nagaadjust sa deadline", "Very responsive din, mapa-email o gclass. Reqs for this sem: 3 essays.", "BASTA PLS DONT WAITLIST OR DO PREROG FOR SIR DENNIS — don't take him",
    "vouch", "1.25!!", "sir Gavin goated", "Took him from 1st sem pa and ganyang katagal si sir na magbigay ng grade.",
]
JUNK = [
    "up", "+1", "lf classmates huhu", "email pls", "how can i prerog po?", "PA 101", "[deleted]", "Has anyone taken this class? How is he?", "may i also ask for their emails, please?",
    "i saw it na, thank u sm!!", "Hi! Unoable po ba?", "is he unoable",
]
JUNK_POST = "Thoughts po sa kanila? Workload? Pedagogy? Unoable? Marami akong majors this sem so goods sana kung di ganun kabigat."
SIGNALS = {
    "Super unoable prof! Activities are very engaging and clear PPT slides.": {"grading": "generous", "keywords": {"unoable", "engaging"}, "pedagogy_mentions": {"engaging", "clear"}},
    "Heavy workload with so many requirements. Strict grader and zero uno given.": {"workload": "heavy", "grading": "strict", "keywords": {"heavy workload", "strict grader"}},
    "Very light workload, manageable tasks, and optional attendance. Recorded sessions available.": {"workload": "light", "keywords": {"light workload"}, "attendance_mentions": {"lenient"}},
    "": {"workload": None, "grading": None, "keywords": set()},
}


def test_golden_texts(spark):
    rows = [(t, False, True) for t in REVIEWS] + [(t, False, False) for t in JUNK] + [(JUNK_POST, True, False)]
    df = spark.createDataFrame(rows, "t string, post boolean, keep boolean")
    wrong = df.where(classify.drop_reason(F.col("t"), F.col("post")).isNull() != F.col("keep")).collect()
    assert wrong == []
    got = spark.createDataFrame([(t,) for t in SIGNALS], "t string").select("t", classify.analyze_text(F.col("t")).alias("s")).collect()
    for r in got:
        for name, want in SIGNALS[r.t].items():
            have = r.s[name]
            if name == "keywords":
                assert want <= set(have) and (want or not have)
            elif isinstance(want, set):
                assert all(have[k] >= 1 for k in want)
            else:
                assert have == want


def test_spellings_by_automaton_and_by_join(spark):
    """Both ways of finding spellings agree, with thousands of them, at edges of texts and inside words."""
    rng = random.Random(3)
    syllables = ["ka", "lo", "mi", "ren", "tos", "vil", "da", "gu", "zo", "be"]
    word = lambda n: "".join(rng.choices(syllables, k=n)).capitalize()
    terms = sorted({f"{word(rng.randint(2, 4))}, {word(2)} {word(rng.randint(1, 2))}" for _ in range(2500)}) + ["Dela Cruz, Ana", "Cruz, Ana"]
    people = spark.createDataFrame([(t, i) for i, t in enumerate(terms)], "term string, ord int")
    said = [rng.choice(terms) for _ in range(80)]
    texts = [f"{t.split(', ')[0]} is fair" for t in said[:30]] + [f"ask {' '.join(reversed(t.split(', ')))}" for t in said[30:60]] + [f"xx{t.split(', ')[0].lower()}yy" for t in said[60:]] + ["sir Cruz", "Dela Cruz, Ana!", "", None, "nobody here"]
    df = spark.createDataFrame(list(enumerate(texts)), "text_id int, text string")
    one, other = ({tuple(r) for r in mentions.match_texts(df, people, most).collect()} for most in (50_000, 10))
    assert one == other and len(one) > 30
    stats = mentions.resolver_stats(people).first()
    assert stats.professors == len(terms) and stats.unique_last_names == len({t.split(", ")[0].lower() for t in terms}) and stats.variants > len(terms)
    assert mentions.match_texts(df, people.limit(0)).count() == 0 == mentions.match_texts(df.limit(0), people).count()


def test_namesakes_are_not_expanded(spark):
    """Long lists of namesakes: the same matches as from all candidates, from far fewer hits."""
    rng = random.Random(5)
    given = ["JUAN", "ANA", "MARIA", "JOSE", "PEDRO", "LIZA"]
    people = [(str(i), f"{rng.choice(['REYES', 'SANTOS', 'DELA CRUZ', 'SANTOS-REYES'])}, {rng.choice(given)} {rng.choice('ABC')}{rng.choice(given)}", f"P {i}", i) for i in range(300)]
    roster = spark.createDataFrame(people, "instructor_id string, name_normalized string, name_display string, ord long")
    taught = spark.createDataFrame([(str(i), [f"Math {rng.randint(1, 60)}", "Eng 1"][: rng.randint(0, 2)], rng.choice(["upd", "uplb", None])) for i in range(0, 300, 2)], "instructor_id string, courses array<string>, university_id string")
    asked = [(f"n{i}", rng.choice(["Reyes", "Santos", "Dela Cruz", "Cruz", "Lim"]), rng.choice([*given, "", "Jo", "Juan Dela"]).title(), rng.choice([None, ["Math 7"], ["Math 12", "Eng"], ["Math"]]), rng.choice([None, "upd", "UPLB", "unknown"])) for i in range(150)]
    names = spark.createDataFrame(asked, "n string, last string, first string, courses array<string>, university string")
    keys = match.roster_keys(roster)
    sure = match.direct(match.hits(match.cleaned(names), keys))
    rest = names.join(sure.select("n"), "n", "left_anti")
    all_hits = match.hits(match.cleaned(rest, 2), keys)
    want = sure.unionByName(match.disambiguate(match.candidates(all_hits), names, taught))
    assert {tuple(r) for r in match.match(names, keys, taught).collect()} == {tuple(r) for r in want.collect()}
    _, some = match.found_and_open(names, keys, taught)
    assert some.where("twice").count() < 0.5 * all_hits.count()
    shown = lambda df: {(r.n, r.place, r.instructor_id, r.match_type) for r in df.where("place <= 8").collect()}
    assert shown(match.candidates(some.where("once"))) == shown(match.candidates(match.hits(match.cleaned(rest), keys)))
