"""The query catalogue: each operator over whole tables, and the SQL that DuckDB checks it with.

The SQL of fixtures' queries knows how a fixture was made and derives the result from that, not by parsing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadloom.functions import classify, lookups, text
from threadloom.functions.titles import FORMS, parse_form, parse_titles
from threadloom.operators import dedupe, match, mentions, relational, report
from threadloom.plans import fixtures as fx
from threadloom.sources import fallback, store
from threadloom.sources.shared import kept, shared_folder
from threadloom.streaming import ingest

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = fx.duck(sql)
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return fx.table(spark, sf_dir, name)


def epoch(c: str):
    return (F.unix_micros(F.col(c).cast("timestamp")) / 1e6).cast("double")


# --- titles ---------------------------------------------------------------------------------------------------------

_CASED = "Reyes|Dela Cruz|Santos-Reyes|Garcia|Peñaflor|Go|Villanueva|De Guzman|Tan|Aquino|Lim"
_GIVEN = "Juan|Maria Clara|Mark Lester B.|Ana|José|Ma. Teresa|Pedro"
#: What a title should give, from the fixture's parts. A hyphen in a surname is taken for the dash of a title without.
_EXPECTED = f"""
WITH parts AS (SELECT *, {fx.pick(_CASED, "o_custkey")} AS last0, {fx.pick(_GIVEN, "o_custkey")} AS first0,
    CASE WHEN form = 2 THEN 'UPD' WHEN upper(c) IN ('UPD', 'REVIEW', 'DILIMAN') THEN 'UPD' WHEN c = 'XYZ' THEN NULL ELSE c END AS campus0 FROM ({fx.PARTS}) x),
split AS (SELECT *, CASE WHEN strpos(last0, ' ') > 0 THEN split_part(last0, ' ', 2) ELSE last0 END AS tail,
    CASE WHEN strpos(last0, ' ') > 0 THEN split_part(last0, ' ', 1) END AS particle FROM parts),
expected AS (SELECT CAST(o_orderkey AS STRING) AS post_id, o_custkey, o_orderdate,
    CASE WHEN form IN (9, 10) OR (form = 11 AND particle IS NULL) THEN NULL ELSE campus0 END AS campus, CASE WHEN form = 4 AND strpos(last0, '-') > 0 THEN k || ' SANTOS' ELSE k END AS course,
    CASE WHEN form = 4 AND strpos(last0, '-') > 0 THEN 'Reyes' WHEN form IN (3, 11) THEN tail ELSE last0 END AS last_name,
    CASE WHEN form = 11 THEN particle WHEN form = 3 AND particle IS NOT NULL THEN first0 || ' ' || particle ELSE first0 END AS first_name FROM split),
parsed AS (SELECT post_id, o_custkey, o_orderdate, campus, CASE WHEN campus IS NOT NULL THEN course END AS course, CASE WHEN campus IS NOT NULL THEN last_name END AS last_name,
    CASE WHEN campus IS NOT NULL THEN first_name END AS first_name FROM expected)
"""


def parsed_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_titles(fx.frame(spark, sf_dir, fx.TITLES))


_SLUG = r"replace(regexp_replace(lower({0}), '[^a-z0-9 ]', '', 'g'), ' ', '_')"
_ID = " || '__' || ".join(_SLUG.replace("{0}", c) for c in ("campus", "last_name", "first_name"))


@query(_EXPECTED + f"SELECT post_id, campus, course, last_name, first_name, {_ID} AS professor_id FROM parsed")
def parse_titles_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed_titles(spark, sf_dir).select("post_id", "campus", "course", "last_name", "first_name", "professor_id")


@query(_EXPECTED + "SELECT campus, count(*) AS posts FROM parsed WHERE campus IS NOT NULL GROUP BY campus")
def campus_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.campus_counts(parsed_titles(spark, sf_dir))


@query(_EXPECTED + "SELECT post_id, epoch(o_orderdate)::DOUBLE AS created_utc FROM parsed WHERE campus IS NULL")
def unparsed_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = parsed_titles(spark, sf_dir).withColumn("created_utc", epoch("o_orderdate"))
    return relational.unparsed_posts(posts).select("post_id", "created_utc")


@query(_EXPECTED + "SELECT last_name || ', ' || first_name AS display, count(*) AS n FROM parsed WHERE campus IS NOT NULL GROUP BY 1")
def display_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = parsed_titles(spark, sf_dir).where("professor_id is not null")
    return p.groupBy(text.display_name(F.col("last_name"), F.col("first_name")).alias("display")).agg(F.count(F.lit(1)).alias("n"))


def _fits(form: str) -> str:
    """Whether a title fits a form's pattern; look-ahead isn't to be had in DuckDB, so `bare` has it apart."""
    pattern, ahead = FORMS[form][0], ""
    if form == "bare":
        at = pattern.index("(?!"), pattern.index(r"\s)") + 3
        ahead = f"NOT regexp_matches(t, {_sql(r'^' + chr(92) + 's*' + pattern[at[0]:at[1]].replace('(?!', '(?:'))}) AND "
        pattern = pattern[: at[0]] + pattern[at[1] :]
    return f"{ahead}regexp_matches(t, {_sql(pattern)})"


def _sql(pattern: str) -> str:
    return "'(?i)" + pattern.replace("'", "''") + "'"


@query("WITH titles AS (SELECT regexp_extract(translate(trim(title), '–—−', '---'), '^([^;&]*)', 1) AS t FROM (" + fx.TITLES + ") x) SELECT form, count(*) AS n FROM (SELECT CASE "
    + " ".join(f"WHEN {_fits(f)} THEN '{f}'" for f in FORMS).replace("{", "{{").replace("}", "}}") + " END AS form FROM titles) f GROUP BY 1")
def title_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_form(fx.frame(spark, sf_dir, fx.TITLES)).groupBy("form").agg(F.count(F.lit(1)).alias("n"))


# --- names ----------------------------------------------------------------------------------------------------------


@query(r"""
SELECT doc_id, length(name) AS n, md5(name) AS name_md5 FROM (
  SELECT doc_id, trim(regexp_replace(regexp_replace(strip_accents(lower(text)), '[.,;:''"!?()/\\]', '', 'g'), '\s+', ' ', 'g')) AS name FROM documents) x""")
def normalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as names."""
    rows = read(spark, sf_dir, "documents").select("doc_id", text.normalize_name(F.col("text")).alias("name"))
    return rows.select("doc_id", F.length("name").cast("long").alias("n"), F.md5("name").alias("name_md5"))


@query("""
SELECT id, (id % 20) IN (0, 1, 15, 16, 17, 18) AS plausible, CASE WHEN (id % 20) IN (1, 15, 17) THEN 'Cruz' ELSE last_name END AS last,
  CASE WHEN (id % 20) IN (1, 16) THEN 'Juan' ELSE first_name END AS first FROM (""" + fx.ODD_NAMES + ") e")
def odd_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule of plausible names, and every kind of cleaning, by a pair that only it concerns."""
    e = fx.frame(spark, sf_dir, fx.ODD_NAMES)
    c = text.clean_name(F.col("last_name"), F.col("first_name"))
    return e.select("id", text.plausible_name(F.col("last_name"), F.col("first_name")).alias("plausible"), c["last"].alias("last"), c["first"].alias("first"))


@query("""
SELECT id, last_name NOT LIKE 'TBA' AS plausible, CASE WHEN last_name = '1 Francisco' THEN 'Francisco' ELSE last_name END AS last, first_name AS first
FROM (""" + fx.ENTITIES + ") e")
def plausible_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = fx.frame(spark, sf_dir, fx.ENTITIES)
    c = text.clean_name(F.col("last_name"), F.col("first_name"))
    return e.select("id", text.plausible_name(F.col("last_name"), F.col("first_name")).alias("plausible"), c["last"].alias("last"), c["first"].alias("first"))


@query("""
SELECT regexp_replace(regexp_replace(upper(p_type), '[^A-Z0-9]', '', 'g'), 'X', 'X', 'g') AS key, count(*) AS n FROM {part} GROUP BY 1""")
def course_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").groupBy(text.course_key(F.col("p_type")).alias("key")).agg(F.count(F.lit(1)).alias("n"))


# --- classification -------------------------------------------------------------------------------------------------


def reason_sql(body: str, is_post: str) -> str:
    """The rules as SQL; white space at the ends is off `body` already."""
    at = lambda p: f"regexp_matches({body}, {_sql(p)})"
    n, marks = f"length({body})", f"(length({body}) - length(replace({body}, '?', '')))"
    return f"""CASE WHEN lower({body}) IN ('', '[deleted]', '[removed]') THEN 'empty' WHEN {at(lookups.REACTIONS)} THEN 'reaction' WHEN {at(lookups.COURSE_CODE)} THEN 'course_code'
  WHEN {n} <= 100 AND ({at(lookups.ASKS)} OR ({body} LIKE '%?' AND {at(lookups.REVIEW_TERMS)})) THEN 'ask' WHEN {is_post} AND {marks} >= 2 AND {n} < 400 THEN 'ask'
  WHEN {at(lookups.REVIEW_TERMS)} THEN NULL WHEN ({is_post} OR {n} <= 160) AND {at(lookups.REQUESTS)} THEN 'request' WHEN ({is_post} OR {n} <= 160) AND {at(lookups.ASKS)} THEN 'ask'
  WHEN {n} <= 80 AND {at(lookups.THANKS)} THEN 'thanks' WHEN {n} < 80 THEN 'too_short' WHEN {is_post} AND {n} < 150 THEN 'thin' END"""


_TRIM = r"regexp_replace(coalesce({0}, ''), '^\s+|\s+$', '', 'g')"


@query("SELECT body_id, reason AS drop_reason, CASE WHEN reason IS NULL THEN 1 ELSE 0 END AS is_review FROM (SELECT body_id, " + reason_sql("body", "false").replace("{", "{{").replace("}", "}}") + " AS reason FROM (" + fx.BODIES + ") b) r")
def triage_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.triage(fx.frame(spark, sf_dir, fx.BODIES), "body", False).select("body_id", "drop_reason", "is_review")


_DOC_REASONS = "SELECT kind, coalesce(reason, 'kept') AS reason, count(*) AS n FROM (SELECT 'post' AS kind, " + reason_sql("b", "true") + " AS reason FROM (SELECT " + _TRIM.format("text") + " AS b FROM documents) d UNION ALL SELECT 'comment', " + reason_sql("b", "false") + " FROM (SELECT " + _TRIM.format("text") + " AS b FROM conversations) c) x GROUP BY 1, 2"


@query(_DOC_REASONS.replace("{", "{{").replace("}", "}}"))
def triage_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = lambda table, kind, post: classify.triage(read(spark, sf_dir, table).select("text"), "text", post).select(F.lit(kind).alias("kind"), F.coalesce("drop_reason", F.lit("kept")).alias("reason"))
    return one("documents", "post", True).unionByName(one("conversations", "comment", False)).groupBy("kind", "reason").agg(F.count(F.lit(1)).alias("n"))


def _count_sql(column: str, kind: tuple[str, str]) -> str:
    return "(" + " + ".join(f"(CASE WHEN {column.format(k)} THEN 1 ELSE 0 END)" for k in lookups.SIGNALS[kind]) + ")"


def _signals_sql(source: str, key: str, column: str) -> str:
    c = {k: _count_sql(column, k) for k in lookups.SIGNALS}
    names = {k: f"{k[0]}_{k[1]}" for k in c}
    counts = ", ".join(f"{v} AS {names[k]}" for k, v in c.items())
    return f"""SELECT {key}, {", ".join(names.values())},
  CASE WHEN workload_heavy > workload_light THEN 'heavy' WHEN workload_light > workload_heavy THEN 'light' WHEN workload_heavy > 0 THEN 'moderate' END AS workload,
  CASE WHEN greatest(grading_generous, grading_fair, grading_strict) = 0 THEN NULL WHEN grading_generous >= greatest(grading_fair, grading_strict) THEN 'generous' WHEN grading_fair >= grading_strict THEN 'fair' ELSE 'strict' END AS grading
FROM (SELECT {key}, {counts} FROM {source}) s"""


def _flat(df: DataFrame, key: str) -> DataFrame:
    s = "signals"
    return df.select(key, *[F.col(f"{s}.{f}_mentions.{k}").alias(f"{f}_{k}") for f, k in lookups.SIGNALS], F.col(f"{s}.workload").alias("workload"), F.col(f"{s}.grading").alias("grading"))


@query(_signals_sql("(" + fx.BODIES + ") b", "body_id", "strpos(lower(body), '{0}') > 0"))
def signals_by_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = fx.frame(spark, sf_dir, fx.BODIES)
    return _flat(b.select("body_id", classify.analyze_text(F.col("body")).alias("signals")), "body_id")


@query(_signals_sql("(SELECT l_suppkey, string_agg(lower(body), chr(10)) AS t FROM (" + fx.BODIES + ") b GROUP BY l_suppkey) g", "l_suppkey", "strpos(t, '{0}') > 0"))
def signals_by_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(classify.signals_by(fx.frame(spark, sf_dir, fx.BODIES), "l_suppkey", "body"), "l_suppkey")


# --- relational -----------------------------------------------------------------------------------------------------


@query("""
SELECT o_orderkey AS post_id, o_orderkey % 7 AS num_comments, coalesce(n, 0) AS stored, o_orderkey % 7 - coalesce(n, 0) AS gap
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) c ON l_orderkey = o_orderkey WHERE coalesce(n, 0) < o_orderkey % 7
ORDER BY gap DESC, o_orderdate DESC, o_orderkey LIMIT 200""")
def comment_gap_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("post_id"), F.lit("").alias("title"), (F.col("o_orderkey") % 7).alias("num_comments"), epoch("o_orderdate").alias("created_utc"))
    comments = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("post_id"))
    return relational.comment_gaps(posts, comments, 200).select("post_id", "num_comments", "stored", "gap")


def conversation_threads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Posts: the lowest turn of a conversation; comments: the later ones, each a reply to the one before."""
    c = read(spark, sf_dir, "conversations")
    first = c.groupBy("conv_id").agg(F.min_by(F.struct("turn", "text", "role"), F.struct("turn", "text")).alias("f"), F.min("turn").alias("t0"))
    posts = first.select(F.col("conv_id").cast("string").alias("post_id"), F.col("f.text").alias("title"), F.lit(None).cast("string").alias("campus"), F.lit(None).cast("string").alias("course"), F.lit(None).cast("string").alias("professor_id"), F.lit("").alias("url"), F.lit(0).alias("score"), F.lit(0).alias("num_comments"), F.col("conv_id").cast("double").alias("created_utc"), F.col("f.role").alias("author"), F.lit("").alias("selftext"), F.lit(1).alias("is_review"))
    later = c.join(first.select("conv_id", "t0"), "conv_id").where("turn > t0")
    comments = later.select(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("comment_id"), F.col("conv_id").cast("string").alias("post_id"), F.concat(F.lit("t1_"), (F.col("turn") - 1).cast("string")).alias("parent_id"), F.col("role").alias("author"), F.col("text").alias("body"), F.lit(0).alias("score"), F.col("turn").cast("double").alias("created_utc"), (F.col("turn") - F.col("t0") - 1).cast("int").alias("depth"), F.lit(1).alias("is_review"))
    return posts, comments


@query("""
WITH f AS (SELECT conv_id, min(turn) AS t0 FROM conversations GROUP BY 1)
SELECT c.conv_id::VARCHAR AS post_id, min_by(c.text, c.turn) AS title, min(s_name) AS last_name, count(*) FILTER (turn > t0) AS n_comments,
  md5(coalesce(string_agg(c.text, chr(10) ORDER BY turn, c.text) FILTER (turn > t0), '')) AS bodies_md5
FROM conversations c JOIN f ON f.conv_id = c.conv_id LEFT JOIN supplier ON s_suppkey = c.conv_id % 13 AND c.conv_id % 13 > 2 GROUP BY c.conv_id""")
def thread_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threads with their person: of thirteen two are linked to nobody known, one to nobody."""
    posts, comments = conversation_threads(spark, sf_dir)
    link = F.pmod(F.col("post_id").cast("long"), F.lit(13))
    posts = posts.withColumn("professor_id", F.when(link > 0, F.concat(F.lit("s"), link.cast("string"))))
    s = read(spark, sf_dir, "supplier").where("s_suppkey > 2")
    entities = s.select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_name").alias("last_name"), F.lit("").alias("first_name"), F.lit("UPD").alias("campus"))
    t = relational.threads(posts, comments, entities)
    return t.select("post.post_id", "post.title", "professor.last_name", F.size("comments").cast("long").alias("n_comments"), F.md5(F.array_join(F.transform("comments", lambda c: c["body"]), "\n")).alias("bodies_md5"))


@query("""
WITH f AS (SELECT conv_id, min(turn) AS t0 FROM conversations GROUP BY 1)
SELECT c.conv_id::VARCHAR AS post_id, max(turn - t0 - 1)::INTEGER AS deepest, count(*) AS n FROM conversations c JOIN f ON f.conv_id = c.conv_id WHERE turn > t0 GROUP BY 1""")
def thread_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, comments = conversation_threads(spark, sf_dir)
    return comments.groupBy("post_id").agg(F.max("depth").alias("deepest"), F.count(F.lit(1)).alias("n"))


@query("SELECT l_suppkey::VARCHAR AS professor_id, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS courses FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def entity_courses(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    out = relational.entity_courses(p.select(F.col("l_suppkey").cast("string").alias("professor_id"), F.col("p_brand").alias("course")))
    return out.select("professor_id", F.array_join("courses", ",").alias("courses"))


def _event_rounds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, tuple[DataFrame, DataFrame]]:
    """All events, and the two rounds that they are merged in: a third of the users only in the first, a third only in
    the second, the others in both, cut in time."""
    e = read(spark, sf_dir, "events").select("user_id", "event_id", "value", "ts")
    kind = F.coalesce(F.pmod(F.col("user_id"), F.lit(3)), F.lit(0))
    early = (kind == 0) | ((kind == 2) & F.coalesce(F.col("ts") < F.lit("2024-01-15").cast("timestamp"), F.lit(False)))
    return e, (e.where(early), e.where(~early))


@query("SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) e WHERE r = 1")
def upsert_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, (first, later) = _event_rounds(spark, sf_dir)
    order = [F.desc("ts"), F.desc("event_id")]
    stored = store.replace_by_key(e.limit(0), first, "user_id", order)
    return store.replace_by_key(stored, later, "user_id", order).select("user_id", "event_id", "value")


@query("SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) e WHERE r = 1")
def insert_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, (first, later) = _event_rounds(spark, sf_dir)
    stored = store.insert_absent(e.limit(0), first, "user_id", ["ts", "event_id"])
    return store.insert_absent(stored, later, "user_id", ["ts", "event_id"]).select("user_id", "event_id", "value")


@query("SELECT o_orderkey AS post_id, o_custkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l_returnflag = 'R')")
def resume_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = read(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("post_id"))
    return store.unseen(read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("post_id"), "o_custkey"), seen)


@query("SELECT c_custkey AS id, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey - o_custkey % 3 FROM orders WHERE o_custkey IS NOT NULL)")
def orphan_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts are linked to every third customer, so the others are orphans."""
    e = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_name")
    return dedupe.orphans(e, read(spark, sf_dir, "orders").select((F.col("o_custkey") - F.col("o_custkey") % 3).alias("professor_id")))


@query("SELECT event_id, epoch(ts)::DOUBLE AS at, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 > 0 THEN '.' || lpad((microsecond(ts) % 1000000)::VARCHAR, 6, '0') ELSE '' END || '+00:00' AS iso FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15'")
def time_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select("event_id", epoch("ts").alias("at"))
    got = relational.in_window(e, "at", 1704672000.0, 1705276800.0)
    return got.select("event_id", "at", text.iso_time(F.col("at")).alias("iso"))


_KINDS = ["view", "click", "purchase", "signup", "logout"]


@query("""
WITH r AS (SELECT user_id, event_type, count(*) AS n, dense_rank() OVER (ORDER BY event_type) AS rk FROM events GROUP BY 1, 2),
least AS (SELECT user_id, min(rk) AS rk FROM r GROUP BY 1)
SELECT r.user_id, event_type AS source, n FROM r JOIN least ON r.user_id = least.user_id AND r.rk = least.rk""")
def source_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select("user_id", "event_type")
    # event types as sources, by name
    order = e.select("event_type").distinct().withColumn("source_rank", F.dense_rank().over(Window.orderBy("event_type")))
    rows = e.join(F.broadcast(order), "event_type").withColumnRenamed("event_type", "source")
    return fallback.first_per_key(rows, "user_id").groupBy("user_id", "source").agg(F.count(F.lit(1)).alias("n"))


@query(r"""
SELECT page_id, md5(trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '[ \t\n\r\f\v]+', ' ', 'g'))) AS text_md5 FROM pages""")
def strip_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", F.md5(text.strip_html(F.col("html"))).alias("text_md5"))


@query("SELECT page_id, CASE WHEN page_id % 2 = 0 THEN page_id::VARCHAR ELSE page_id::VARCHAR || 'x' END AS post_id FROM pages")
def page_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("page_id").cast("string")
    tag = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("tag:t3_"), n)).otherwise(F.lit(""))
    return read(spark, sf_dir, "pages").select("page_id", text.post_id(tag, F.concat("url", F.lit("/comments/"), n, F.lit("x/slug"))).alias("post_id"))


# --- cleanup --------------------------------------------------------------------------------------------------------

_CLEANED = ("""
WITH e AS (""" + fx.ENTITIES + """), p AS (""" + fx.ENTITY_POSTS + """),
n AS (SELECT professor_id, count(*) AS posts FROM p WHERE professor_id IS NOT NULL GROUP BY 1),
good AS (SELECT * FROM e WHERE last_name <> 'TBA' AND upper(campus) IN ('UPD', 'UPLB', 'UPMIN')),
live AS (SELECT good.*, posts FROM good JOIN n ON professor_id = id),
keyed AS (SELECT *, first_value(id) OVER w AS keeper FROM live
  WINDOW w AS (PARTITION BY upper(campus), upper(strip_accents(replace(last_name, '1 ', ''))), upper(strip_accents(split_part(replace(first_name, '.', ''), ' ', 1)))
    ORDER BY posts DESC, length(id), id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) """)


def _cleanup(spark: SparkSession, sf_dir: str):
    posts = fx.frame(spark, sf_dir, fx.ENTITY_POSTS)
    return dedupe.clean_entities(fx.frame(spark, sf_dir, fx.ENTITIES), posts)


@query(_CLEANED + "SELECT id, last_name, first_name, campus FROM keyed WHERE id = keeper")
def merge_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleanup(spark, sf_dir)[0].select("id", "last_name", "first_name", "campus")


@query(_CLEANED + "SELECT p.post_id, keyed.keeper AS professor_id FROM p LEFT JOIN keyed ON keyed.id = p.professor_id")
def relinked_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleanup(spark, sf_dir)[1].select("post_id", "professor_id")


@query(_CLEANED + """
SELECT (SELECT count(*) FROM e) - (SELECT count(*) FROM good) AS junk_professors_removed, (SELECT count(*) FROM p WHERE professor_id IN (SELECT id FROM e) AND professor_id NOT IN (SELECT id FROM good)) AS posts_unlinked,
  (SELECT count(*) FROM good) - (SELECT count(*) FROM live) AS orphan_professors_removed, (SELECT count(DISTINCT keeper) FROM keyed WHERE id <> keeper) AS duplicate_groups_merged,
  (SELECT count(*) FROM keyed WHERE id <> keeper) AS duplicate_professors_removed, (SELECT count(*) FROM p JOIN keyed ON keyed.id = professor_id WHERE id <> keeper) AS posts_relinked""")
def cleanup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleanup(spark, sf_dir)[2]


# --- roster and match -----------------------------------------------------------------------------------------------


def roster_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """roster, section, section_instructor, course: lines are sections, suppliers teach, parts are courses."""
    l = read(spark, sf_dir, "lineitem").select(F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("section_id"), (F.col("l_partkey") % 40).alias("course_id"), F.col("l_suppkey").cast("string").alias("instructor_id"), (F.col("l_orderkey") % 9).alias("u"))
    home = F.split(F.lit("upd uplb upm upou upv upmin upb upc upt"), " ")
    section = l.select("section_id", "course_id", F.get(home, F.col("u").cast("int")).alias("university_id"))
    course = spark.range(40).select(F.col("id").alias("course_id"), F.concat(F.get(F.split(F.lit("Math|Eng|PHYSICS|Fil|Soc Sci"), r"\|"), (F.col("id") % 5).cast("int")), F.lit(" "), F.col("id").cast("string")).alias("course_code"))
    return fx.frame(spark, sf_dir, fx.ROSTER), section, l.select("section_id", "instructor_id"), course


@query("""
SELECT instructor_id, string_agg(code, ',' ORDER BY code) AS courses FROM (
  SELECT DISTINCT l_suppkey::VARCHAR AS instructor_id, (['Math', 'Eng', 'PHYSICS', 'Fil', 'Soc Sci'])[(l_partkey % 40) % 5 + 1] || ' ' || (l_partkey % 40)::VARCHAR AS code FROM lineitem) x GROUP BY 1""")
def roster_courses(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, section, si, course = roster_tables(spark, sf_dir)
    return match.roster_courses(section, si, course).select("instructor_id", F.array_join("courses", ",").alias("courses"))


@query("""
SELECT instructor_id, u AS university_id FROM (
  SELECT l_suppkey::VARCHAR AS instructor_id, (['upd', 'uplb', 'upm', 'upou', 'upv', 'upmin', 'upb', 'upc', 'upt'])[l_orderkey % 9 + 1] AS u,
    row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, (['upd', 'uplb', 'upm', 'upou', 'upv', 'upmin', 'upb', 'upc', 'upt'])[l_orderkey % 9 + 1]) AS r
  FROM lineitem GROUP BY l_suppkey, l_orderkey % 9) x WHERE r = 1""")
def roster_home(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, section, si, _ = roster_tables(spark, sf_dir)
    return match.roster_home(section, si)


def _matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    roster, section, si, course = roster_tables(spark, sf_dir)
    posts = fx.frame(spark, sf_dir, fx.ENTITY_POSTS).withColumn("course", F.concat(F.lit("Math "), (F.col("post_id").cast("long") % 40).cast("string")))
    return report.match_entities(fx.frame(spark, sf_dir, fx.ENTITIES), posts, roster, report.teaching(section, si, course))


_TAUGHT = """taught AS (SELECT DISTINCT l_suppkey::VARCHAR AS instructor_id, upper(replace((['Math', 'Eng', 'PHYSICS', 'Fil', 'Soc Sci'])[(l_partkey % 40) % 5 + 1], ' ', '')) || (l_partkey % 40)::VARCHAR AS code FROM lineitem),
home AS (SELECT instructor_id, u AS university_id FROM (SELECT l_suppkey::VARCHAR AS instructor_id, (['upd', 'uplb', 'upm', 'upou', 'upv', 'upmin', 'upb', 'upc', 'upt'])[l_orderkey % 9 + 1] AS u,
    row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, (['upd', 'uplb', 'upm', 'upou', 'upv', 'upmin', 'upb', 'upc', 'upt'])[l_orderkey % 9 + 1]) AS r FROM lineitem GROUP BY l_suppkey, l_orderkey % 9) x WHERE r = 1)"""
_UNTAUGHT = "taught AS (SELECT '' AS instructor_id, '' AS code WHERE false), home AS (SELECT '' AS instructor_id, '' AS university_id WHERE false)"


def match_sql(names: str, taught: str = _TAUGHT) -> str:
    """CTEs that match `names` (CTEs that end in names0: n, l, f, courses, university; names cleaned) with the fixture's
    roster: sure, cands, matched (n, instructor_id, match_type, confidence). Written from what names can be there."""
    fold = lambda c: f"upper(strip_accents(regexp_replace({c}, '[.,]', '', 'g')))"
    typed = lambda label: f"CASE WHEN tag = 'as_is' THEN '{label}' ELSE '{label}_' || tag END"
    return f"""{names}, {taught},
roster AS (SELECT s_suppkey::VARCHAR AS instructor_id, s_suppkey AS ord, s_name AS display, split_part(name_normalized, ', ', 1) AS l, replace(split_part(name_normalized, ', ', 2), '.', '') AS f
  FROM (SELECT *, {fx.ROSTER[fx.ROSTER.index("upper("):fx.ROSTER.index(" AS name_normalized")]} AS name_normalized FROM supplier) s),
keys AS (
  SELECT 'exact' AS kind, l || ', ' || f AS key, max_by(instructor_id, ord) AS instructor_id, max(ord) AS ord, split_part(min(l), ' ', 1) AS first_word FROM roster GROUP BY l, f
  UNION ALL SELECT 'token', l || ',' || split_part(f, ' ', 1), instructor_id, ord, split_part(l, ' ', 1) FROM roster
  UNION ALL SELECT 'last', l, instructor_id, ord, split_part(l, ' ', 1) FROM roster
  UNION ALL SELECT 'head', split_part(l, ' ', 1), instructor_id, ord, split_part(l, ' ', 1) FROM roster WHERE l LIKE '% %'
  UNION ALL SELECT 'token', split_part(l, ' ', 1) || ',' || split_part(f, ' ', 1), instructor_id, ord, split_part(l, ' ', 1) FROM roster WHERE l LIKE '% %'),
folded AS (SELECT n, {fold("l")} AS l, {fold("f")} AS f, string_split({fold("f")}, ' ') AS g FROM names0),
tried AS (
  SELECT n, 0 AS reading, 'as_is' AS tag, l AS lk, f AS fk FROM folded
  UNION ALL SELECT n, 1, 'hyphen_head', split_part(l, '-', 1), f FROM folded WHERE strpos(l, '-') > 1
  UNION ALL SELECT n, 3, 'reversed', f, l FROM folded WHERE f <> ''
  UNION ALL SELECT n, 4, 'rotate', g[1], array_to_string(g[2:], ' ') || ' ' || l FROM folded WHERE len(g) > 1
  UNION ALL SELECT n, 5, 'particle_join', g[-1] || ' ' || l, array_to_string(g[:-2], ' ') FROM folded WHERE len(g) > 1 AND g[-1] IN ('DELA', 'DE', 'DEL', 'DELOS', 'SAN')),
reads AS (SELECT n, lk, fk, min(reading) AS reading, min_by(tag, reading) AS tag, list_filter(string_split(fk, ' '), lambda w: length(w) > 1) AS w FROM tried GROUP BY n, lk, fk),
plain AS (SELECT *, CASE WHEN len(w) > 0 THEN array_to_string(w, ' ') ELSE fk END AS p, CASE WHEN len(w) > 0 THEN w[1] ELSE split_part(fk, ' ', 1) END AS token FROM reads),
probes AS (
  SELECT n, reading, tag, token, 1 AS tier, 'exact' AS kind, CASE WHEN p = '' THEN lk ELSE lk || ', ' || p END AS key FROM plain
  UNION ALL SELECT n, reading, tag, token, 2, 'exact', lk || ', ' || fk FROM plain WHERE p <> fk
  UNION ALL SELECT n, reading, tag, token, 3, 'token', lk || ',' || token FROM plain WHERE token <> ''
  UNION ALL SELECT n, reading, tag, token, 4, 'last', lk FROM plain UNION ALL SELECT n, reading, tag, token, 5, 'head', lk FROM plain),
found AS (SELECT n, reading, tag, tier, token, instructor_id, ord, first_word FROM probes JOIN keys USING (kind, key)),
steps AS (SELECT *, CASE WHEN tier = 5 THEN 6 ELSE tier END AS t FROM found UNION ALL SELECT *, 5 FROM found WHERE tier = 5 AND token <> '' AND first_word = token),
alone AS (SELECT n, reading, tag, t, min(instructor_id) AS instructor_id FROM steps GROUP BY n, reading, tag, t HAVING count(*) = 1),
best AS (SELECT n, reading, tag, min(t) AS t, min_by(instructor_id, t) AS instructor_id FROM alone GROUP BY n, reading, tag),
sure AS (SELECT n, instructor_id, CASE t WHEN 1 THEN {typed("exact")} WHEN 2 THEN 'exact' WHEN 3 THEN {typed("first_token")} ELSE 'last_head_first_token' END AS match_type,
    CASE WHEN t <= 2 THEN 1.0 ELSE 0.8 END::DOUBLE AS confidence FROM best WHERE t IN (1, 2, 3, 5) QUALIFY row_number() OVER (PARTITION BY n ORDER BY reading) = 1),
loose AS (SELECT * FROM found WHERE tier <> 2 QUALIFY tier = min(tier) OVER (PARTITION BY n, reading)),
opened AS (SELECT *, min(reading) OVER (PARTITION BY n) AS r0 FROM loose),
kept AS (SELECT * FROM (SELECT *, min(CASE WHEN reading = r0 THEN tier END) OVER (PARTITION BY n) AS t0 FROM opened) x WHERE t0 > 3 OR reading = r0),
once AS (SELECT n, instructor_id, reading, ord, tier FROM kept QUALIFY row_number() OVER (PARTITION BY n, instructor_id ORDER BY reading, ord, tier) = 1),
cands AS (SELECT n, instructor_id, row_number() OVER (PARTITION BY n ORDER BY reading, ord, tier) AS place, CASE tier WHEN 1 THEN 'exact' WHEN 3 THEN 'first_token' WHEN 4 THEN 'last_name_only' ELSE 'last_head_only' END AS match_type,
    CASE tier WHEN 1 THEN 1.0 WHEN 3 THEN 0.8 WHEN 4 THEN 0.5 ELSE 0.45 END::DOUBLE AS base FROM once),
asked AS (SELECT n, upper(regexp_replace(unnest(courses), '[^A-Za-z0-9]', '', 'g')) AS code FROM names0),
overlap AS (SELECT DISTINCT cands.n, cands.instructor_id FROM cands JOIN asked ON asked.n = cands.n JOIN taught ON taught.instructor_id = cands.instructor_id
  WHERE asked.code <> '' AND (starts_with(asked.code, taught.code) OR starts_with(taught.code, asked.code))),
scored AS (SELECT cands.*, round(base + CASE WHEN overlap.n IS NULL THEN 0 ELSE 0.35 END + CASE WHEN coalesce(home.university_id, 'unknown') = university THEN 0.1 ELSE 0 END, 4)::DOUBLE AS s, len(coalesce(courses, [])) > 0 AS asks
  FROM cands JOIN names0 ON names0.n = cands.n LEFT JOIN overlap ON overlap.n = cands.n AND overlap.instructor_id = cands.instructor_id LEFT JOIN home ON home.instructor_id = cands.instructor_id
  WHERE cands.n NOT IN (SELECT n FROM sure)),
firsts AS (SELECT *, lead(s) OVER w AS after, count(*) OVER (PARTITION BY n) AS c, row_number() OVER w AS r FROM scored WINDOW w AS (PARTITION BY n ORDER BY s DESC, place)),
judged AS (SELECT *, s >= 0.8 AND asks AND s > base AS helped, coalesce(s < 0.8 AND s >= 0.7 AND round(s - after, 4) >= 0.25, false) AS clear FROM firsts WHERE r = 1),
matched AS (SELECT * FROM sure UNION ALL SELECT n, instructor_id, CASE WHEN c > 1 AND (helped OR clear) THEN match_type || '+course' ELSE match_type END,
    CASE WHEN c = 1 THEN base WHEN helped THEN least(0.95, s) WHEN clear THEN least(0.9, s) ELSE base END FROM judged WHERE c = 1 OR s >= 0.8 OR clear)"""


#: Entities as names: of those that are plausible, with the courses of their posts.
_NAMES = "WITH e AS (" + fx.ENTITIES + "), p AS (" + fx.ENTITY_POSTS + """),
of AS (SELECT professor_id, list_sort(list(DISTINCT 'Math ' || (post_id::BIGINT % 40)::VARCHAR)) AS courses FROM p WHERE professor_id IS NOT NULL GROUP BY 1),
names0 AS (SELECT id AS n, replace(last_name, '1 ', '') AS l, first_name AS f, courses, CASE WHEN upper(campus) IN ('UPD', 'UPLB', 'UPMIN') THEN lower(campus) END AS university
  FROM e LEFT JOIN of ON professor_id = id WHERE last_name <> 'TBA')"""
_STATUS = "CASE WHEN id NOT IN (SELECT n FROM names0) THEN 'junk' WHEN m.n IS NOT NULL THEN 'resolved' WHEN c.n IS NOT NULL THEN 'ambiguous' ELSE 'unresolved' END"
_ENTITY_STATUS = match_sql(_NAMES) + f""", status AS (SELECT id, {_STATUS} AS status, m.instructor_id, m.match_type, m.confidence, CASE WHEN m.n IS NULL THEN coalesce(c.k, 0) ELSE 0 END::INTEGER AS n_candidates
  FROM e LEFT JOIN (SELECT * FROM matched WHERE confidence >= 0.8) m ON m.n = id LEFT JOIN (SELECT n, least(count(*), 8) AS k FROM cands GROUP BY n) c ON c.n = id)"""


def _braced(sql: str) -> str:
    """SQL with braces of its own and tables in braces: only the tables' are for `duck`."""
    out = sql.replace("{", "{{").replace("}", "}}")
    for t in fx.TABLES:
        out = out.replace("{{" + t + "}}", "{" + t + "}")
    return out


def _entity_names(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Names of plausible entities, and keys of the roster."""
    e = fx.frame(spark, sf_dir, fx.ENTITIES)
    good = e.select(F.col("last_name").alias("l"), F.col("first_name").alias("f")).distinct().where(text.plausible_name(F.col("l"), F.col("f")))  # equal names are judged once
    e = e.join(good, F.col("last_name").eqNullSafe(F.col("l")) & F.col("first_name").eqNullSafe(F.col("f")), "left_semi")
    names = e.select(F.col("id").alias("n"), F.col("last_name").alias("last"), F.col("first_name").alias("first"), text.university(F.col("campus")).alias("university"))
    return names, match.roster_keys(fx.frame(spark, sf_dir, fx.ROSTER))


def _evidence(spark: SparkSession, sf_dir: str, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The names with the courses of their posts, and what is taught."""
    _, section, si, course = roster_tables(spark, sf_dir)
    posts = fx.frame(spark, sf_dir, fx.ENTITY_POSTS).withColumn("course", F.concat(F.lit("Math "), (F.col("post_id").cast("long") % 40).cast("string")))
    return names.join(relational.entity_courses(posts).withColumnRenamed("professor_id", "n"), "n", "left"), report.teaching(section, si, course)


@query(_braced(match_sql(_NAMES) + " SELECT n AS id, instructor_id, match_type, confidence FROM sure"))
def match_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    names, keys = _entity_names(spark, sf_dir)
    return match.match_direct(names, keys).select(F.col("n").alias("id"), "instructor_id", "match_type", "confidence")


@query(_braced(match_sql(_NAMES) + " SELECT n AS id, place::INTEGER AS place, instructor_id, match_type, base AS confidence FROM cands"))
def match_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    names, keys = _entity_names(spark, sf_dir)
    return match.match_all(names, keys).select(F.col("n").alias("id"), "place", "instructor_id", "match_type", "confidence")


@query(_braced(match_sql(_NAMES) + " SELECT n AS id, instructor_id, match_type, confidence FROM matched"))
def match_disambiguated(spark: SparkSession, sf_dir: str) -> DataFrame:
    names, keys = _entity_names(spark, sf_dir)
    names, taught = _evidence(spark, sf_dir, names)
    return match.match(names, keys, taught).select(F.col("n").alias("id"), "instructor_id", "match_type", "confidence")


@query(_braced(_ENTITY_STATUS + " SELECT * FROM status"))
def match_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matched(spark, sf_dir).select("id", "status", "instructor_id", "match_type", "confidence", F.coalesce(F.size("candidates"), F.lit(0)).alias("n_candidates"))


@query(_braced(_ENTITY_STATUS + """ SELECT matched, ambiguous, unmatched, junk, scraped, scraped - junk AS considered, matched::VARCHAR || '/' || (scraped - junk)::VARCHAR AS match_rate
FROM (SELECT count(*) FILTER (status = 'resolved') AS matched, count(*) FILTER (status = 'ambiguous') AS ambiguous, count(*) FILTER (status = 'unresolved') AS unmatched,
  count(*) FILTER (status = 'junk') AS junk, count(*) AS scraped FROM status) s"""))
def match_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.match_summary(_matched(spark, sf_dir))


def _linked_posts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Parsed fixture titles as posts, and their entities."""
    # titles are parsed once and written, as a store would have them
    posts = kept(parsed_titles(spark, sf_dir), "posts").withColumns({"created_utc": epoch("o_orderdate"), "url": F.lit(""), "score": F.lit(0), "num_comments": F.lit(1), "author": F.lit(None).cast("string"), "selftext": F.col("title"), "is_review": F.lit(1)})
    entities = posts.where("professor_id is not null").groupBy(F.col("professor_id").alias("id")).agg(F.min(F.struct("last_name", "first_name", "campus")).alias("e")).select("id", "e.*")
    return posts, entities


@query(_EXPECTED + "SELECT count(*) AS mention_pool FROM parsed WHERE campus = 'UPD'")
def mention_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts, entities = _linked_posts(spark, sf_dir)
    return relational.mentions(posts, entities).agg(F.count(F.lit(1)).alias("mention_pool"))


def _resolved(spark: SparkSession, sf_dir: str, strategy: str) -> DataFrame:
    roster, section, si, course = roster_tables(spark, sf_dir)
    posts, entities = _linked_posts(spark, sf_dir)
    return report.resolve_mentions(posts, entities, roster, report.teaching(section, si, course), strategy=strategy)


def _sampled(order: str) -> str:
    return match_sql(_EXPECTED + """, names0 AS (SELECT post_id AS n, last_name AS l, first_name AS f, [course] AS courses, 'upd' AS university FROM parsed WHERE campus = 'UPD'
  ORDER BY """ + order + """ LIMIT 100)""") + """, status AS (SELECT names0.n AS post_id, l || ', ' || f AS professor,
  CASE WHEN m.n IS NOT NULL THEN 'resolved' WHEN names0.n IN (SELECT n FROM cands) THEN 'ambiguous' ELSE 'unresolved' END AS status, m.instructor_id, m.match_type, m.confidence
  FROM names0 LEFT JOIN (SELECT * FROM matched WHERE confidence >= 0.8) m ON m.n = names0.n)"""


_RECENT, _RANDOM = _sampled("o_orderdate DESC, post_id"), _sampled("md5('42:' || post_id), post_id")
_GATE = """ SELECT *, round(resolved_count / sample_size, 4)::DOUBLE AS resolve_rate, printf('%.1f%%', 100.0 * resolved_count / sample_size) AS resolve_rate_pct, 0.8::DOUBLE AS acceptance_threshold,
  resolved_count / sample_size >= 0.8 AS acceptance_met
FROM (SELECT count(*) AS sample_size, count(*) FILTER (status = 'resolved') AS resolved_count, count(*) FILTER (status = 'ambiguous') AS ambiguous_count, count(*) FILTER (status = 'unresolved') AS unresolved_count FROM status) s"""


@query(_braced(_RECENT + " SELECT * FROM status"))
def resolve_sample_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolved(spark, sf_dir, "recent").select("post_id", "professor", "status", "instructor_id", "match_type", "confidence")


@query(_braced(_RECENT + _GATE))
def resolve_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.resolve_report(_resolved(spark, sf_dir, "recent"))


@query(_braced(_RANDOM + _GATE))
def resolve_report_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.resolve_report(_resolved(spark, sf_dir, "random"))


def _bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = classify.triage(fx.frame(spark, sf_dir, fx.BODIES), "body", False)
    return b.select(F.col("body_id").cast("string").alias("comment_id"), F.col("l_orderkey").cast("string").alias("post_id"), "body", "is_review", F.lit(0.0).alias("created_utc"))


@query(_EXPECTED + ", b AS (SELECT l_orderkey, body, " + reason_sql("body", "false").replace("{", "{{").replace("}", "}}") + " AS reason FROM (" + fx.BODIES + ") x)" + """
SELECT professor, count(*) AS n FROM (
  SELECT last_name || ', ' || first_name AS professor FROM parsed WHERE campus IS NOT NULL
  UNION ALL SELECT last_name || ', ' || first_name FROM parsed JOIN b ON b.l_orderkey::VARCHAR = post_id WHERE campus IS NOT NULL AND reason IS NULL) x GROUP BY 1""")
def review_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts, entities = _linked_posts(spark, sf_dir)
    rows, _ = report.review_rows(posts, _bodies(spark, sf_dir), entities)
    return rows.groupBy("professor").agg(F.count(F.lit(1)).alias("n"))


@query(_braced(match_sql(_EXPECTED + ", names0 AS (SELECT DISTINCT last_name || ', ' || first_name AS n, last_name AS l, first_name AS f, NULL::VARCHAR[] AS courses, NULL::VARCHAR AS university FROM parsed WHERE campus IS NOT NULL)", _UNTAUGHT)
    + " SELECT n AS name FROM names0 WHERE n NOT IN (SELECT n FROM matched WHERE confidence >= 0.8)"))
def unresolved_sidecar(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts, entities = _linked_posts(spark, sf_dir)
    return report.review_rows(posts, _bodies(spark, sf_dir), entities, roster_tables(spark, sf_dir)[0])[1]


@query(_EXPECTED + f""", e AS (SELECT DISTINCT {_ID} AS id, campus, post_id, course FROM parsed WHERE campus IS NOT NULL)
SELECT id, count(*) AS total_discussions, string_agg(DISTINCT course, ',' ORDER BY course) AS courses FROM e GROUP BY id""")
def entity_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts, entities = _linked_posts(spark, sf_dir)
    e = report.entity_index(posts, _bodies(spark, sf_dir), entities.withColumn("last_name", F.col("id")).withColumn("first_name", F.lit("")))
    return e.select(F.regexp_replace("professor", ", $", "").alias("id"), "total_discussions", F.array_join("courses", ",").alias("courses"))


_ALL_NAMES = ", names0 AS (SELECT DISTINCT {0} AS n, last_name AS l, first_name AS f, NULL::VARCHAR[] AS courses, NULL::VARCHAR AS university FROM parsed WHERE campus IS NOT NULL)"
_REASONS = ", b AS (SELECT l_orderkey, l_suppkey, body, " + reason_sql("body", "false") + " AS reason FROM (" + fx.BODIES + ") x)"


@query(_braced(_EXPECTED + _REASONS + f"""
SELECT *, total_posts - parsed_posts AS unparsed_posts, total_posts - review_posts AS dropped_posts, total_comments - review_comments AS dropped_comments, printf('%.1f%%', 100.0 * parsed_posts / total_posts) AS parse_rate
FROM (SELECT count(*) AS total_posts, count(campus) AS parsed_posts, count(*) FILTER (o_custkey % 3 > 0) AS review_posts FROM parsed) p,
  (SELECT count(*) AS total_comments, count(*) FILTER (reason IS NULL) AS review_comments FROM b) c, (SELECT count(DISTINCT {_ID}) AS total_professors FROM parsed WHERE campus IS NOT NULL) e"""))
def parse_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts, entities = _linked_posts(spark, sf_dir)
    return relational.stats(posts.withColumn("is_review", (F.col("o_custkey") % 3 > 0).cast("int")), _bodies(spark, sf_dir), entities)


@query(_braced(match_sql(_EXPECTED + _ALL_NAMES.format("last_name || ', ' || first_name"), _UNTAUGHT) + _REASONS + """,
known AS (SELECT names0.n, CASE WHEN confidence >= 0.8 THEN 'resolved' WHEN confidence IS NOT NULL THEN 'ambiguous' ELSE 'unresolved' END AS resolve_status,
  CASE WHEN confidence >= 0.8 THEN display ELSE names0.n END AS professor, CASE WHEN confidence >= 0.8 THEN instructor_id END AS teacher
  FROM names0 LEFT JOIN matched ON matched.n = names0.n LEFT JOIN (SELECT instructor_id, display FROM roster) r USING (instructor_id))
SELECT professor, resolve_status, coalesce(teacher, 'none') AS teacher, count(*) AS n FROM (
  SELECT last_name || ', ' || first_name AS n FROM parsed WHERE campus IS NOT NULL
  UNION ALL SELECT last_name || ', ' || first_name FROM parsed JOIN b ON b.l_orderkey::VARCHAR = post_id WHERE campus IS NOT NULL AND reason IS NULL) x JOIN known USING (n) GROUP BY ALL"""))
def review_rows_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts, entities = _linked_posts(spark, sf_dir)
    rows, _ = report.review_rows(posts, _bodies(spark, sf_dir), entities, roster_tables(spark, sf_dir)[0])
    teacher = F.when(F.startswith("teacherId", F.lit("reddit:")), "none").otherwise(F.col("teacherId"))
    return rows.groupBy("professor", "resolve_status", teacher.alias("teacher")).agg(F.count(F.lit(1)).alias("n"))


@query(_braced(match_sql(_EXPECTED + _ALL_NAMES.format(_ID)) + f""", said AS (SELECT {_ID} AS id, string_agg(lower(body), chr(10)) AS t FROM parsed JOIN ({fx.BODIES}) b ON b.l_orderkey::VARCHAR = post_id WHERE campus IS NOT NULL GROUP BY 1),
d AS (SELECT {_ID} AS id, min(campus) AS campus, md5(string_agg(course || '|' || post_id, ',' ORDER BY o_orderdate DESC, post_id)) AS discussions_md5, count(*) AS n FROM parsed WHERE campus IS NOT NULL GROUP BY 1)
SELECT d.id, campus, d.n AS total_discussions, discussions_md5, m.instructor_id, m.match_type, university_id, codes, workload, grading, workload_heavy, pedagogy_clear FROM d
LEFT JOIN matched m ON m.n = d.id LEFT JOIN home ON home.instructor_id = m.instructor_id LEFT JOIN (SELECT instructor_id, count(*) AS codes FROM taught GROUP BY 1) c ON c.instructor_id = m.instructor_id
LEFT JOIN ({_signals_sql("(SELECT d.id, coalesce(t, '') AS t FROM d LEFT JOIN said ON said.id = d.id)", "id", "strpos(t, '{0}') > 0")}) s ON s.id = d.id"""))
def entity_export_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole index: order of discussions, signals, and the roster's word on each person."""
    posts, entities = _linked_posts(spark, sf_dir)
    roster, section, si, course = roster_tables(spark, sf_dir)
    # the id in the campus' place tells rows of one display name apart
    e = report.entity_index(posts, _bodies(spark, sf_dir), entities.withColumn("campus", F.concat_ws("|", "id", "campus")), roster, report.teaching(section, si, course))
    d = F.transform("discussions", lambda x: F.concat(x["course"], F.lit("|"), F.regexp_extract(x["url"], "([0-9]+)$", 1)))
    s, v = "signals_summary", "crs_verified"
    return e.select(
        F.split("campus", r"\|")[0].alias("id"), F.split("campus", r"\|")[1].alias("campus"), "total_discussions", F.md5(F.array_join(d, ",")).alias("discussions_md5"), f"{v}.instructor_id", f"{v}.match_type",
        F.nullif(f"{v}.university_id", F.lit("unknown")).alias("university_id"), F.size(f"{v}.official_courses").cast("long").alias("codes"), f"{s}.workload", f"{s}.grading",
        F.col(f"{s}.workload_mentions.heavy").alias("workload_heavy"), F.col(f"{s}.pedagogy_mentions.clear").alias("pedagogy_clear"),
    )


# --- mentions of people in free text --------------------------------------------------------------------------------

_PEOPLE = "GARCIA, MARK LESTER B.|Juan Dela Cruz|GO, Ana|Santos, Maria|Reyes, Pedro|Reyes, Ana"


def _people(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t, i) for i, t in enumerate(_PEOPLE.split("|"))], "term string, ord long")


_MENTION = f"""SELECT CAST(o_orderkey AS STRING) AS text_id, 'took the class of ' || {fx.pick("Sir Garcia|mark garcia|Dela Cruz, J.|ana go|maria and also santos|reyes|nobody|prof santos", "o_orderkey")} || ' last term' AS text FROM {{orders}}"""


@query("WITH t AS (" + _MENTION + """) SELECT text_id, CASE CAST(text_id AS BIGINT) % 8 WHEN 0 THEN 'GARCIA, MARK LESTER B.' WHEN 1 THEN 'GARCIA, MARK LESTER B.' WHEN 2 THEN 'Juan Dela Cruz' WHEN 3 THEN 'GO, Ana'
  WHEN 4 THEN 'Santos, Maria' WHEN 5 THEN 'Reyes, Pedro' WHEN 7 THEN 'Santos, Maria' END AS term FROM t WHERE CAST(text_id AS BIGINT) % 8 <> 6""")
def attribute_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = _people(spark)
    pairs = mentions.normalized(fx.frame(spark, sf_dir, _MENTION)).crossJoin(F.broadcast(people.withColumnRenamed("ord", "place")))  # six candidates a text
    return mentions.attribute_texts(pairs, people)


@query("WITH t AS (" + _MENTION + """), s AS (SELECT text_id, CAST(text_id AS BIGINT) % 8 AS m FROM t)
SELECT text_id, CASE m WHEN 0 THEN 'sir garcia' WHEN 1 THEN 'mark garcia' WHEN 2 THEN 'dela cruz j' WHEN 3 THEN 'ana go' WHEN 7 THEN 'prof santos' END AS variant, CAST(0.95 AS DOUBLE) AS confidence FROM s WHERE m IN (0, 1, 2, 3, 7)""")
def match_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.match_texts(fx.frame(spark, sf_dir, _MENTION), _people(spark)).select("text_id", "variant", F.col("confidence").cast("double").alias("confidence"))


#: Texts by rung of the score ladder, and what each of _PEOPLE scores in them, in order. Garcia and the Santos are the
#: only ones of their surname, the two Reyes aren't, and Go is a short one.
_RUNGS = {
    "asked Mark Lester Garcia twice": (0.95, 0, 0, 0, 0, 0),
    "Garcia is strict, they say Mark smiles": (0.85, 0, 0, 0, 0, 0),
    "it is garcia m. again": (0.95, 0, 0, 0, 0, 0),
    "that garcia again": (0.60, 0, 0, 0, 0, 0),
    "go on and ask ana": (0, 0, 0.85, 0, 0, 0),
    "Dela Cruz only": (0, 0.60, 0, 0, 0, 0),
    "reyes and santos": (0, 0, 0, 0.60, 0.30, 0.75),  # an initial, as it happens
    "reyes, pedro": (0, 0, 0, 0, 0.95, 0.30),
    "no name at all": (0, 0, 0, 0, 0, 0),
}
_SCORED = f"""SELECT CAST(o_orderkey AS STRING) AS text_id, {fx.pick("|".join(_RUNGS), "o_orderkey")} AS text FROM {{orders}}"""


@query("WITH t AS (" + _SCORED + "), s(text, term, score) AS (VALUES " + ", ".join(f"('{t}', '{p}', {x}::DOUBLE)" for t, xs in _RUNGS.items() for p, x in zip(_PEOPLE.split("|"), xs, strict=True)) + ") SELECT text_id, term, score FROM t JOIN s USING (text)")
def mention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = _people(spark)
    pairs = fx.frame(spark, sf_dir, _SCORED).crossJoin(F.broadcast(people.select("term")))  # six people a text
    return mentions.score_mentions(pairs, people).select("text_id", "term", F.col("score").cast("double").alias("score"))


# --- streams --------------------------------------------------------------------------------------------------------


@query("SELECT CAST(user_id AS STRING) AS id FROM {events} WHERE user_id IS NOT NULL GROUP BY 1")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream of pages of their users: each user once."""
    events = read(spark, sf_dir, "events")
    pages = spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events*.parquet")
    items = ingest.distinct_items(pages.where("user_id is not null").select(F.col("user_id").cast("string").alias("id")))
    at, out = shared_folder(spark, "stream"), shared_folder(spark, "seen")
    items.writeStream.format("parquet").option("path", out).option("checkpointLocation", at).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("id string").parquet(out)
