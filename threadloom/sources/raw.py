"""Raw records to posts and comments: listings, archives, feeds and reply trees read from files."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.functions import lookups as L
from threadloom.functions.text import feed_time, post_id, squeeze, strip, strip_html
from threadloom.functions.titles import parse_titles
from threadloom.operators.relational import in_window, with_body

_S, _N = T.StringType(), T.DoubleType()
#: A listing item; absent keys are null.
ITEM = T.StructType(
    [T.StructField(c, _S) for c in ("id", "title", "permalink", "url", "author", "selftext", "removed_by_category")] + [T.StructField("stickied", T.BooleanType())] + [T.StructField(c, _N) for c in ("score", "num_comments", "created_utc")]
)
ENVELOPE = T.StructType([T.StructField("data", T.StructType([T.StructField("after", _S), T.StructField("children", T.ArrayType(T.StructType([T.StructField("kind", _S), T.StructField("data", ITEM)])))]))])
COMMENT = T.StructType([T.StructField(c, _S) for c in ("id", "parent_id", "author", "body")] + [T.StructField(c, _N) for c in ("score", "created_utc", "depth")])
#: An archive's limit (fixed value).
MOST_POSTS = 50_000


def read_listings(spark: SparkSession, path: str) -> DataFrame:
    """Items of nested listing files, one document a file or line; null items go."""
    pages = spark.read.schema(ENVELOPE).option("multiLine", True).json(path)
    return pages.select(F.explode("data.children").alias("c")).where("c.data is not null").select("c.data.*")


def wrap_listing(items: DataFrame) -> DataFrame:
    """Flat items as one nested listing: data.children[].{kind, data}; for tests and small files."""
    child = F.struct(F.lit("t3").alias("kind"), F.struct(*items.columns).alias("data"))
    return items.agg(F.collect_list(child).alias("children")).select(F.struct("children").alias("data"))


def read_archive_posts(spark: SparkSession, path: str, after: float | None = None, before: float | None = None, sort: str = "new", limit: int | None = None) -> DataFrame:
    """Items of flat JSON lines in a half-open window (after inclusive), by score for `top`, else newest first."""
    rows = in_window(spark.read.schema(ITEM).json(path), "created_utc", after, before).dropDuplicates(["id"])
    order = [F.desc("score"), "id"] if sort == "top" else [F.desc("created_utc"), "id"]
    return rows.orderBy(*order).limit(min(limit or MOST_POSTS, MOST_POSTS))


def read_archive_comments(spark: SparkSession, path: str) -> DataFrame:
    """Comments of an archive's flat JSON lines; the post is named by post_id, or by link_id (t3_ and the id)."""
    kind = T.StructType([*COMMENT.fields, T.StructField("post_id", _S), T.StructField("link_id", _S)])
    rows = spark.read.schema(kind).json(path)
    return archive_comments(rows.withColumn("post_id", F.coalesce("post_id", F.regexp_replace("link_id", "^t3_", ""))).drop("link_id"))


def archive_comments(rows: DataFrame) -> DataFrame:
    """rows: COMMENT and post_id. Distinct by id, without deleted or empty bodies, depth 0 for replies to the post."""
    r = with_body(rows.dropDuplicates(["post_id", "id"]), "body")
    parent = F.coalesce(F.nullif("parent_id", F.lit("")), F.concat(F.lit("t3_"), "post_id"))
    return r.withColumn("parent_id", parent).withColumn("depth", F.when(F.startswith("parent_id", F.lit("t3_")), 0.0).otherwise(1.0))


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Entries of Atom files as items: HTML stripped, id from the tag or the link, no score or comments, with _source."""
    text = T.StructType([T.StructField("_VALUE", _S), T.StructField("_type", _S)])
    schema = T.StructType(
        [
            T.StructField("id", _S), T.StructField("title", _S), T.StructField("published", _S), T.StructField("updated", _S), T.StructField("content", text),
            T.StructField("link", T.StructType([T.StructField("_href", _S), T.StructField("_VALUE", _S)])), T.StructField("author", T.StructType([T.StructField("name", _S)])),
        ]
    )
    e = spark.read.format("xml").option("rowTag", "entry").option("ignoreNamespace", True).schema(schema).load(path)
    link = F.coalesce("link._href", F.lit(""))
    return e.where(strip(F.coalesce("title", F.lit(""))) != "").select(
        F.coalesce(post_id(F.coalesce("id", link), link), F.lit("")).alias("id"), strip(F.col("title")).alias("title"),
        F.regexp_replace(link, r"^https://www\.reddit\.com", "").alias("permalink"), link.alias("url"), F.replace("author.name", F.lit("/u/"), F.lit("")).alias("author"),
        squeeze(strip_html(F.coalesce("content._VALUE", F.lit("")))).alias("selftext"), F.lit(None).cast("string").alias("removed_by_category"), F.lit(False).alias("stickied"),
        F.lit(0.0).alias("score"), F.lit(0.0).alias("num_comments"), feed_time(F.coalesce("published", "updated")).alias("created_utc"), F.lit("rss").alias("_source"),
    )


def read_reply_trees(spark: SparkSession, path: str) -> DataFrame:
    """Comments of thread files: JSON lines with post_id and tree (the nested listing of replies as text). A deleted
    comment goes with its replies."""
    return flatten_replies(read_threads(spark, path))


def _walk(batches):
    """Rows of post_id and tree to comments, level by level to the last one."""
    import pyarrow as pa

    kind = pa.schema([("post_id", pa.string()), *[(c, pa.string()) for c in ("id", "parent_id", "author", "body")], *[(c, pa.float64()) for c in ("score", "created_utc", "depth")]])
    for batch in batches:
        found: list[dict] = []
        for post, tree in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            level, depth = [_parse(tree)], 0.0
            while level:
                below = []
                for listing in level:
                    for d in _comments(listing):
                        found.append({"post_id": post, **{c: _text(d.get(c)) for c in ("id", "parent_id", "author", "body")}, **{c: _number(d.get(c)) for c in ("score", "created_utc")}, "depth": depth})
                        below.append(d.get("replies"))
                level, depth = [x for x in below if isinstance(x, dict)], depth + 1
                if len(found) >= 4096:
                    yield pa.RecordBatch.from_pylist(found, schema=kind)
                    found = []
        yield pa.RecordBatch.from_pylist(found, schema=kind)


def _parse(tree: str | None):
    """None where the text is no JSON, or nested deeper than the parser can hold (tens of thousands of levels)."""
    try:
        return json.loads(tree or "null")
    except (ValueError, RecursionError):
        return None


def unreadable_trees(rows: DataFrame) -> DataFrame:
    """post_id of the trees (post_id, tree) that give no comments because they can't be parsed; null trees can."""

    def run(batches):
        for b in batches:
            ok = [tree in (None, "", "null") or _parse(tree) is not None for tree in b.column(1).to_pylist()]
            yield b.filter(pa_array([not x for x in ok])).select([0])

    def pa_array(x):
        import pyarrow as pa

        return pa.array(x, pa.bool_())

    return rows.select(F.col("post_id").cast("string"), F.col("tree").cast("string")).mapInArrow(run, "post_id string")


def read_threads(spark: SparkSession, path: str) -> DataFrame:
    """Thread files as JSON lines: post_id, tree, and where the thread's head came along its score and num_comments."""
    return spark.read.schema("post_id string, tree string, score double, num_comments double").json(path)


def _comments(listing) -> list[dict]:
    """The comments of a listing, without deleted ones."""
    data = listing.get("data") if isinstance(listing, dict) else None
    children = (data.get("children") if isinstance(data, dict) else None) or []
    nodes = [n.get("data") for n in children if isinstance(n, dict) and n.get("kind") == "t1"]
    return [d for d in nodes if isinstance(d, dict) and (_text(d.get("body")) or "") not in L.DELETED]


def _text(x) -> str | None:
    return x if x is None or isinstance(x, str) else json.dumps(x)


def _number(x) -> float | None:
    return float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else None


def flatten_replies(rows: DataFrame) -> DataFrame:
    """rows: post_id, tree. COMMENT fields and post_id, of every level."""
    kind = "post_id string, id string, parent_id string, author string, body string, score double, created_utc double, depth double"
    return rows.select(F.col("post_id").cast("string"), F.col("tree").cast("string")).mapInArrow(_walk, kind)


def _author(c: str = "author") -> Column:
    return F.when(~F.col(c).isin("", "[deleted]"), F.col(c))


def posts_from_raw(items: DataFrame, scraped_at: Column | None = None) -> DataFrame:
    """Items as posts, titles parsed; is_review starts at 1. Null and absent numbers are 0, deleted authors null."""
    link, url, key = F.coalesce("permalink", F.lit("")), F.coalesce("url", F.lit("")), F.coalesce("id", F.lit(""))
    shown = F.when(F.startswith(link, F.lit("http")), link).when(F.startswith(link, F.lit("/")), F.concat(F.lit("https://reddit.com"), link))
    number = lambda c, kind: F.coalesce(F.col(c), F.lit(0)).cast(kind)
    posts = items.select(
        key.alias("post_id"), F.coalesce("title", F.lit("")).alias("title"), F.coalesce(shown, F.nullif(url, F.lit("")), F.concat(F.lit("https://reddit.com/comments/"), key)).alias("url"),
        number("score", "long").alias("score"), number("num_comments", "long").alias("num_comments"), number("created_utc", "double").alias("created_utc"), _author().alias("author"),
        F.coalesce("selftext", F.lit("")).alias("selftext"), (F.unix_timestamp().cast("double") if scraped_at is None else scraped_at).alias("scraped_at"), F.lit(1).alias("is_review"),
    )
    return parse_titles(posts)


def entities_from_posts(parsed: DataFrame) -> DataFrame:
    """id, last_name, first_name, campus of the parsed posts, one each: the first to name it."""
    p = parsed.where("professor_id is not null")
    first = F.min_by(F.struct("last_name", "first_name", "campus"), F.struct("created_utc", "post_id"))
    return p.groupBy(F.col("professor_id").alias("id")).agg(first.alias("e")).select("id", "e.*")


def comments_from_raw(rows: DataFrame, scraped_at: Column | None = None) -> DataFrame:
    """COMMENT rows with post_id as comments."""
    number = lambda c, kind: F.coalesce(F.col(c), F.lit(0)).cast(kind)
    return rows.select(
        F.col("id").alias("comment_id"), "post_id", "parent_id", _author().alias("author"), "body", number("score", "long").alias("score"),
        number("created_utc", "double").alias("created_utc"), number("depth", "int").alias("depth"), (F.unix_timestamp().cast("double") if scraped_at is None else scraped_at).alias("scraped_at"), F.lit(1).alias("is_review"),
    )
