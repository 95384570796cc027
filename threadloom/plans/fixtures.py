"""Domain-shaped inputs derived from the star-schema tables by SQL that Spark and DuckDB both run.

Table names stand in braces: Spark binds DataFrames to them, DuckDB their names. Lists are picked from by keys with
coprime moduli, so that templates, campuses, courses and names vary independently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LOOKUPS = ("region", "nation")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

LASTS = "REYES|Dela Cruz|SANTOS-REYES|Garcia|Peñaflor|GO|Villanueva|De Guzman|Tan|Aquino|Lim"
FIRSTS = "JUAN|Maria Clara|MARK LESTER B.|Ana|José|Ma. Teresa|Pedro"
CAMPUSES = "UPD|UPLB|UPMin|upd|Review|XYZ|Diliman"
COURSES = "Math 21|Eng 13|PHYSICS 71|Fil 40|Soc Sci 2"


def pick(values: str, index: str) -> str:
    n = values.count("|") + 1
    return f"split_part('{values}', '|', CAST(({index}) % {n} AS INT) + 1)"


PARTS = f"""
SELECT o_orderkey, o_orderkey % 12 AS form, {pick(CAMPUSES, "o_orderkey")} AS c, {pick(COURSES, "CAST(floor(o_orderkey / 7) AS INT)")} AS k,
  {pick(LASTS, "o_custkey")} AS l, {pick(FIRSTS, "o_custkey")} AS f, o_custkey, o_orderdate FROM {{orders}}"""

TITLES = f"""
SELECT CAST(o_orderkey AS STRING) AS post_id, CASE form
  WHEN 0 THEN '[' || c || '] ' || k || ' - ' || l || ', ' || f
  WHEN 1 THEN '[' || c || '] ' || l || ', ' || f || ' - ' || k
  WHEN 2 THEN k || ' - ' || l || ', ' || f
  WHEN 3 THEN '[' || c || '] ' || k || ' - ' || f || ' ' || l
  WHEN 4 THEN '[' || c || '] ' || k || ' ' || l || ', ' || f
  WHEN 5 THEN '[' || c || '] ' || k || ' – ' || l || ', ' || f
  WHEN 6 THEN '[' || c || ']  ' || k || ' - ' || l || ', ' || f || ' (AY 2024-2025)'
  WHEN 7 THEN '[' || c || '] ' || k || ' - ' || l || ', ' || f || '; Cruz, Ana'
  WHEN 8 THEN '[' || c || '] ' || k || ' WFX - Sir ' || l || ', ' || f || ' pls'
  WHEN 9 THEN 'looking for classmates in ' || k
  WHEN 10 THEN '[' || c || '] ' || k || ' - anyone?'
  ELSE '[' || c || '] ' || k || ' - ' || l END AS title, o_custkey, o_orderdate
FROM ({PARTS}) parts"""

PHRASES = (
    "heavy workload and strict attendance|so fair and clear, unoable|any thoughts on this|lf classmates po|thank you po|up|Math 21|[deleted]|the exams are hard? really|"
    "can i have the notes|she explains well and is kind|just a line about the room|what? why?|quizzes every week|hello"
)
BODIES = f"""
SELECT l_orderkey * 10 + l_linenumber AS body_id, l_suppkey, l_orderkey,
  {pick(PHRASES, "l_partkey")} || repeat(' and so on', CAST(l_linenumber * (l_suppkey % 3) AS INT) * 2) AS body FROM {{lineitem}}"""

#: One entity row per customer, with doubles under other campuses' names and ids, aliases and junk.
ENTITIES = f"""
SELECT 'c' || CAST(c_custkey AS STRING) AS id, {pick(LASTS + "|TBA|1 Francisco", "c_custkey")} AS last_name, {pick(FIRSTS, "c_nationkey")} AS first_name,
  {pick(CAMPUSES, "c_custkey")} AS campus FROM {{customer}}"""
ENTITY_POSTS = "SELECT CAST(o_orderkey AS STRING) AS post_id, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE 'c' || CAST(o_custkey AS STRING) END AS professor_id FROM {orders}"

#: Pairs of surname and given name, one for each rule of plausible names and for what cleaning takes off.
ODD_LASTS = "Reyes||TBA|Cruz|Cruz?|C|Cruz|Cruz|Cruz|1a2|Dela|Cruz@up|cruz.com|Cruz/Reyes|Cruz|Dr. Cruz|Dela Cruz|WFX - Cruz|Santos-Reyes|Classmates"
ODD_FIRSTS = "Juan|Juan Cruz|Staff||Ana|Ana|Math 21|a b c d e f g h i|Ana, Maria|Ana|Ana|Ana|Ana|Ana|Ana and Ben|Ma. Ana|Juan prerog|Ana|Ana|Ana"
ODD_NAMES = f"SELECT c_custkey AS id, {pick(ODD_LASTS, 'c_custkey')} AS last_name, {pick(ODD_FIRSTS, 'c_custkey')} AS first_name FROM {{customer}}"

ROSTER = f"""
SELECT CAST(s_suppkey AS STRING) AS instructor_id, upper({pick("Reyes|Dela Cruz|Santos|Garcia|Penaflor|Go|Villanueva|De Guzman|Tan|Aquino|Lim", "s_suppkey")}) || ', ' ||
  upper({pick("Juan|Maria Clara|Mark Lester|Ana|Jose|Teresa M.|Pedro", "s_nationkey")}) AS name_normalized, s_name AS name_display, s_suppkey AS ord FROM {{supplier}}"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder. A scan that has fewer partitions than the session has cores, as of one small file, is dealt
    out first: what the queries work out for each row is dear. Scans of many files or blocks stay as they are."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if name not in LOOKUPS and df.rdd.getNumPartitions() < cores else df


def frame(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    used = {t: table(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in sql}
    return spark.sql(sql, **used)


def duck(sql: str) -> str:
    """The same for DuckDB."""
    return sql.format(**{t: t for t in TABLES}).replace("AS STRING", "AS VARCHAR")
