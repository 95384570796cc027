"""The queries opN_<name> and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm import byte_bpe, conversation_trie, fingerprints, line_dedup, media_store, mixing, ngram_join, spelling, token_cache, token_files, topk_search, toxicity, url_filter
from threadloom.llm.common import shared_dir, table


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, _ = ngram_join.jaccard_classes(table(spark, sf_dir, "documents"))
    return members.select("doc_id", "n_shingles", "component_id")


OP1_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, 2 + greatest(len(w) - 5, 0))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT d.doc_id, coalesce(sizes.n, 0)::BIGINT AS n_shingles, min(reach.other) AS component_id
FROM documents d LEFT JOIN sizes ON sizes.doc_id = d.doc_id JOIN reach ON reach.doc_id = d.doc_id GROUP BY d.doc_id, sizes.n
"""

#: The rules of op2: (host, path, verdict).
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), rules)


OP2_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits AS (
  SELECT page_id, host, path, h || p AS rule, v,
    row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(h || p) DESC) AS place
  FROM (SELECT DISTINCT page_id, host, path FROM parts) JOIN rules
    ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT parts.page_id, parts.host, parts.path, fits.rule, coalesce(fits.v, 'allow') AS verdict
FROM parts LEFT JOIN fits ON parts.page_id = fits.page_id AND parts.host = fits.host AND parts.path = fits.path AND fits.place = 1
"""


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edit_likeness(table(spark, sf_dir, "documents"))


def _tree_sql(text: str) -> str:
    return f"list_transform(string_split({text}, chr(10)), lambda p: list_transform(list_filter(regexp_extract_all(p, '(?:[^ ]* ){{0,3}}[^ ]*(?: |$)'), lambda s: s <> ''), lambda s: md5(s)))"


OP3_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
n AS (SELECT doc_id, x, coalesce(lead(x) OVER (ORDER BY doc_id), first_value(x) OVER (ORDER BY doc_id)) AS nx, length(x) AS n_chars FROM d),
e AS (SELECT *, left(x, n_chars - n_chars // 4) || left(nx, n_chars // 4) AS e FROM n),
t AS (SELECT *, {_tree_sql("x")} AS xt, {_tree_sql("e")} AS et, {_tree_sql("nx")} AS nt FROM e),
p AS (SELECT *, list_transform(xt, lambda p: sha256(array_to_string(p, ','))) AS xp, list_transform(et, lambda p: sha256(array_to_string(p, ','))) AS ep,
  list_distinct(list_transform(flatten(xt), lambda d: substr(d, 1, 10))) AS xl, list_distinct(list_transform(flatten(et), lambda d: substr(d, 1, 10))) AS el,
  list_distinct(list_transform(flatten(nt), lambda d: substr(d, 1, 10))) AS nl FROM t),
s AS (SELECT *, list_transform(range(0, len(xp), 16), lambda i: sha256(array_to_string(xp[i + 1 : i + 16], '|'))) AS xs,
  list_transform(range(0, len(ep), 16), lambda i: sha256(array_to_string(ep[i + 1 : i + 16], '|'))) AS es FROM p)
SELECT doc_id, n_chars::BIGINT AS n_chars, sha256(e) AS edited_sha256,
  sha256(array_to_string(xs, ',')) || ':' || array_to_string(list_transform(xt, lambda p: array_to_string(list_transform(p, lambda d: substr(d, 1, 10)), '')), '.') AS fingerprint,
  sha256(array_to_string(es, ',')) || ':' || array_to_string(list_transform(et, lambda p: array_to_string(list_transform(p, lambda d: substr(d, 1, 10)), '')), '.') AS edited_fingerprint,
  CASE WHEN len(xl) + len(el) = 0 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * len(list_intersect(xl, el)) / (len(xl) + len(el)) END AS near_edited,
  CASE WHEN len(xl) + len(nl) = 0 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * len(list_intersect(xl, nl)) / (len(xl) + len(nl)) END AS near_next
FROM s
"""


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_files.round_trip(table(spark, sf_dir, "documents"), path, shared_dir(spark, "token-files"), end_id=2)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"))
    out = toxicity.score(docs, machine)
    return out.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a cache that persists is named by this setting; without it each run starts an empty one
    cache = spark.conf.get("threadloom.token.cache", None)
    counts = token_cache.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), cache)
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "lines_removed", F.length("text").cast("long").alias("chars_kept"), F.md5("text").alias("text_md5"))


OP7_SQL = r"""
WITH lines AS (
  SELECT doc_id, coalesce('s' || source, '') AS site, unnest(string_split(text, chr(10))) AS raw,
    generate_subscripts(string_split(text, chr(10)), 1) AS place FROM documents),
trimmed AS (SELECT *, regexp_replace(raw, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS line FROM lines),
boilerplate AS (SELECT line FROM trimmed WHERE line <> '' GROUP BY line HAVING count(DISTINCT site) >= 10),
marked AS (
  SELECT t.*, b.line IS NOT NULL AND row_number() OVER (PARTITION BY t.line ORDER BY doc_id, place) > 1 AS gone
  FROM trimmed t LEFT JOIN boilerplate b ON t.line = b.line)
SELECT doc_id, count(*) FILTER (gone) AS lines_removed,
  length(coalesce(string_agg(raw, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS chars_kept,
  md5(coalesce(string_agg(raw, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS text_md5
FROM marked GROUP BY doc_id
"""

#: Weights of sources by code point, repeating; and what they share of all sizes.
MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS = [5.0, 2.0, 1.0], 1.5, 2.0


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"), MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS)
    return out.select("doc_id", "size", "source_size", "target", "taken")


OP8_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, 'null') || ':20:' || md5(coalesce(text, ''))) AS r FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size, 2.0::DOUBLE * sum(size)::BIGINT AS cap,
    ([5.0, 2.0, 1.0])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight FROM docs GROUP BY source),
level AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM per),
final AS (
  SELECT source, source_size, CASE WHEN cap / weight <= level THEN cap
    ELSE least(cap, (SELECT arg_min(level, cap / weight) FROM level WHERE cap / weight > level) * weight) END AS target FROM level),
placed AS (
  SELECT doc_id, size, source_size, target, floor(target)::BIGINT AS budget,
    sum(size) OVER (PARTITION BY docs.source ORDER BY r, doc_id ROWS UNBOUNDED PRECEDING) - size AS start
  FROM docs JOIN final ON docs.source IS NOT DISTINCT FROM final.source)
SELECT doc_id, size, source_size, target, CASE WHEN source_size = 0 THEN 0 ELSE
  (budget // source_size) * size + greatest(0, least(size, budget % source_size - start)) END::BIGINT AS taken FROM placed
"""


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topk_search.integer_vectors(table(spark, sf_dir, "embeddings"))
    return topk_search.exact_top_k(rows, rows.where(F.pmod("k", F.lit(20)) == 0), k=20)


OP10_SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])), 0)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


#: The table of the checksum crc32 by its rule, and the checksum of a list of bytes.
_CRC_TABLE = "crc(steps) AS (SELECT list(list_reduce(range(8), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) FROM range(256) r(i))"


def _crc_sql(data: str) -> str:
    return f"xor(4294967295, list_reduce({data}, lambda c, b: xor(c >> 8, crc.steps[xor(c & 255, b) + 1]), 4294967295))"


def _bytes_sql(digits: str) -> str:
    return f"list_transform(range(1, length({digits}), 2), lambda i: ('0x' || substr({digits}, i::INT, 2))::BIGINT)"


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(spelling.word_counts(table(spark, sf_dir, "documents"))).select("word", "form", "root", "n", "n_near", "form_n")


OP11_SQL = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, run, count(*) AS times FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 5 GROUP BY ALL),
hashed AS (SELECT *, hex(coalesce(doc_id::VARCHAR, '') || ':' || run) AS x FROM runs),
typed AS (SELECT run, times, {_crc_sql(_bytes_sql("x"))} AS h FROM hashed, crc),
words AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, sum(times)::BIGINT AS n
  FROM typed GROUP BY 1 HAVING length(word) >= 5 AND sum(times) >= 3),
cut AS (SELECT word, n, i, left(word, i::INT - 1) || substr(word, i::INT + 1) AS rest FROM (SELECT word, n, unnest(range(1, 1 + length(word))) AS i FROM words)),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS most FROM near GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN most >= 2 * w.n THEN most END AS form_n,
    CASE WHEN most >= 2 * w.n THEN (SELECT min(other) FROM near x WHERE x.word = w.word AND x.other_n = most) END AS form
  FROM words w LEFT JOIN best ON best.word = w.word),
follow AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT follow.word, formed.form FROM follow JOIN formed ON formed.word = follow.at WHERE formed.form IS NOT NULL),
last AS (SELECT follow.word, follow.at AS root FROM follow JOIN formed ON formed.word = follow.at WHERE formed.form IS NULL)
SELECT formed.word, form, root, n, n_near, form_n FROM formed JOIN last ON last.word = formed.word
"""


def op12_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = media_store.media_features(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", *media_store.FEATURES)


_TWO = lambda v: f"lpad(to_hex({v} & 255), 2, '0') || lpad(to_hex(({v} >> 8) & 255), 2, '0') || lpad(to_hex(({v} >> 16) & 255), 2, '0') || lpad(to_hex(({v} >> 24) & 255), 2, '0')"

OP12_SQL = f"""
WITH {_CRC_TABLE},
raw AS (SELECT doc_id, coalesce(text, '') AS x, strlen(coalesce(text, ''))::BIGINT AS n_bytes FROM documents),
sized AS (SELECT *, greatest(64, (n_bytes + 63) // 64 * 64)::BIGINT AS payload_bytes FROM raw),
hexed AS (SELECT *, hex(x) || repeat('00', (payload_bytes - n_bytes)::INT) AS p FROM sized),
wav AS (SELECT *, '52494646' || {_TWO("(36 + payload_bytes)")} || '57415645666d74201000000001000100401f0000401f00000100080064617461' || {_TWO("payload_bytes")} || p AS m,
  {_bytes_sql("p")} AS b FROM hexed),
walked AS (SELECT *, list_zip(b[1 : len(b) - 1], b[2 : len(b)]) AS s FROM wav)
SELECT doc_id, n_bytes, payload_bytes, sha256(unhex(p)) AS payload_sha256, {_crc_sql("b[len(b) - 63 : len(b)]")} AS tail_crc32,
  payload_bytes + 44 AS media_bytes, sha256(unhex(m)) AS media_sha256,
  array_to_string(list_concat(list_transform(range(8), lambda k: len(list_filter(b, lambda v: v >> 5 = k))),
    [list_sum(list_transform(s, lambda z: abs(z[1] - z[2])))::BIGINT, len(list_filter(s, lambda z: (z[1] >= 128) <> (z[2] >= 128)))]), ',') AS feature
FROM walked, crc
"""


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = conversation_trie.rebuilt(conversation_trie.conversations(table(spark, sf_dir, "conversations")))
    return conversation_trie.prefix_trie(conversation_trie.distinct_sequences(convs))


OP13_SQL = f"""
WITH {_CRC_TABLE},
turns AS (
  SELECT conv_id AS c, turn, strlen(coalesce(text, ''))::BIGINT AS n, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS d
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list({{'d': d, 'n': n}} ORDER BY turn NULLS FIRST, d) AS t FROM turns GROUP BY c),
hashed AS (SELECT c, t, {_crc_sql(_bytes_sql("hex(c::VARCHAR)"))} % 9 AS h FROM own, crc),
built AS (
  SELECT o.c, list_concat(coalesce(b.t[1 : h], []), o.t[h + 1 : len(o.t)]) AS t
  FROM hashed o LEFT JOIN own b ON b.c = o.c - o.c % 5),
prefixes AS (
  SELECT c, i AS depth, list_transform(t[1 : i], lambda x: x.d) AS node, list_transform(t[1 : i - 1], lambda x: x.d) AS above, i = len(t) AS ends, CASE WHEN i > 0 THEN t[i].n ELSE 0 END AS n
  FROM (SELECT c, t, unnest(range(0, len(t) + 1)) AS i FROM built)),
nodes AS (
  SELECT node, depth::BIGINT AS depth, any_value(CASE WHEN depth > 0 THEN above END) AS above, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(n) AS own,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM prefixes GROUP BY node, depth),
heirs AS (SELECT above AS node, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1, 2),
full_nodes AS (SELECT nodes.*, coalesce(heirs.n, 0)::BIGINT AS n_children FROM nodes LEFT JOIN heirs ON heirs.node = nodes.node AND heirs.depth = nodes.depth),
below AS (
  SELECT x.node, x.depth, count(*) FILTER (y.n_children = 0) AS n_leaves, sum(y.own)::BIGINT AS saved_tokens
  FROM full_nodes x JOIN full_nodes y ON y.depth >= x.depth AND y.node[1 : x.depth] = x.node GROUP BY x.node, x.depth)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, b.n_leaves, b.saved_tokens, f.ends_sha256
FROM full_nodes f JOIN below b ON b.node = f.node AND b.depth = f.depth LEFT JOIN full_nodes p ON p.node = f.above AND p.depth = f.depth - 1
"""

QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_url_filters": op2_url_filters,
    "op3_fingerprints": op3_fingerprints,
    "op4_token_files": op4_token_files,
    "op5_toxicity": op5_toxicity,
    "op6_token_counts": op6_token_counts,
    "op7_line_dedup": op7_line_dedup,
    "op8_mixing": op8_mixing,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_topk": op10_topk,
    "op11_spelling": op11_spelling,
    "op12_media": op12_media,
    "op13_conversation_trie": op13_conversation_trie,
}

ORACLE = {"op1_ngram_join": OP1_SQL, "op2_url_filters": OP2_SQL, "op3_fingerprints": OP3_SQL, "op7_line_dedup": OP7_SQL, "op8_mixing": OP8_SQL, "op10_topk": OP10_SQL, "op11_spelling": OP11_SQL, "op12_media": OP12_SQL, "op13_conversation_trie": OP13_SQL}
