"""Scores of how surely a free text mentions a person, and attribution of texts to people."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.functions.text import name_variants, normalize_name
from threadloom.sources.shared import kept

#: Spellings that are sent to all tasks, some 100 bytes each and as an automaton some 1,000.
MOST_SPELLINGS = 50_000
#: Heads of spellings, of four letters, that are looked up in place; of more, every place of a text becomes a row.
MOST_HEADS = 10_000


def _quoted(text: Column) -> Column:
    """As a literal inside a pattern."""
    return F.concat(F.lit(r"\Q"), F.replace(text, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def people(terms: DataFrame) -> DataFrame:
    """terms: term, ord. Adds name parts, variants and same_surname (how many share the surname)."""
    t = terms.withColumn("v", name_variants(F.col("term"))).select("term", "ord", "v.*")
    n = t.groupBy("last").agg(F.count(F.lit(1)).alias("same_surname"))
    return t.join(n, "last")


def variant_index(terms: DataFrame) -> DataFrame:
    """variant, term, ord, place: each spelling belongs to the first person that has it; with an honorific, a surname
    of over three letters that one person alone has."""
    p = people(terms)
    plain = p.select(F.posexplode("variants").alias("place", "variant"), "term", "ord")
    plain = plain.withColumn("place", F.struct(F.lit(0).alias("late"), "ord", F.col("place").alias("at")))
    polite = p.where("same_surname = 1 and length(last) > 3").select("term", "ord", F.posexplode(F.array(*[F.concat(F.lit(f"{h} "), "last") for h in ("sir", "maam", "prof")])).alias("at", "variant"))
    polite = polite.select(F.struct(F.lit(1).alias("late"), "ord", "at").alias("place"), "variant", "term", "ord")
    both = plain.select("place", "variant", "term", "ord").unionByName(polite)
    return both.groupBy("variant").agg(F.min_by(F.struct("term", "ord", "place"), "place").alias("f")).select("variant", "f.*")


def _found(variant: Column, norm: Column) -> Column:
    """As whole words, or from eight letters on anywhere. A pattern is built only where the letters are there."""
    return F.contains(norm, variant) & ((F.length(variant) >= 8) | F.rlike(norm, F.concat(F.lit(r"(?:^|\s)"), _quoted(variant), F.lit(r"(?:\s|$)"))))


def mention_score(norm: Column, last: Column, first: Column, is_short: Column, variants: Column, same_surname: Column) -> Column:
    """0 to 1, from the first rung of the ladder that holds. norm: the normalised text."""
    at_last, at_first = F.instr(norm, last), F.instr(norm, first)
    initial = F.concat(_quoted(last), F.lit(r"[,\s]+"), _quoted(F.substring(first, 1, 1)), F.lit(r"\.?"))
    whole = F.concat(F.lit(r"(?U)\b"), _quoted(last), F.lit(r"\b"))
    return (
        F.when(F.exists(variants, lambda v: (F.length(v) >= 5) & _found(v, norm)), 0.95)
        .when((F.length(first) >= 3) & (at_last > 0) & (at_first > 0) & (F.abs(at_last - at_first) <= 30), 0.85)
        .when((first != "") & (at_last > 0) & F.rlike(norm, initial), 0.75)
        .when(~is_short & (last != "") & F.contains(norm, last), F.when(same_surname == 1, 0.60).otherwise(0.30))
        .when(is_short & (first != "") & (at_last > 0) & F.contains(norm, first) & F.rlike(norm, whole), 0.70)
        .otherwise(0.0)
    )


def normalized(texts: DataFrame) -> DataFrame:
    """Adds norm. Texts that are paired with many terms are best normalised before, once."""
    return texts.withColumn("norm", normalize_name(F.coalesce("text", F.lit(""))))


def _scored(pairs: DataFrame, terms: DataFrame) -> DataFrame:
    """pairs with score; its own norm is taken where it has one. Terms are written, so that Spark knows their size."""
    p = kept(people(terms).drop("ord"), "people")
    rows = (pairs if "norm" in pairs.columns else normalized(pairs)).join(p, "term")
    return rows.withColumn("score", mention_score(F.col("norm"), F.col("last"), F.col("first"), F.col("is_short"), F.col("variants"), F.col("same_surname")))


def score_mentions(pairs: DataFrame, terms: DataFrame) -> DataFrame:
    """pairs: text_id, text, term. Adds score. Terms not among `terms` score as the only ones of their surname do not:
    they have no row here."""
    return _scored(pairs, terms).select("text_id", "term", "score")


def attribute_texts(pairs: DataFrame, terms: DataFrame, least: float = 0.30) -> DataFrame:
    """pairs: text_id, text, term, place (of the candidate). text_id, term: of the best candidate with at least
    `least`, ties to the first. Pairs are scored in one pass, and only a text's best one of a task is shuffled."""
    scored = _scored(pairs, terms).where((F.col("score") >= least) & F.col("text_id").isNotNull())
    return scored.groupBy("text_id").agg(F.max_by("term", F.struct("score", -F.col("place"))).alias("term"))


def match_texts(texts: DataFrame, terms: DataFrame, most_spellings: int = MOST_SPELLINGS) -> DataFrame:
    """texts: text_id, text. text_id, term, confidence, variant: the best spelling found, of several words 0.95, of one
    0.60, ties to the first in the index.

    An index of up to `most_spellings` is sent to all tasks, where one automaton finds all spellings in one pass over a
    text. A larger one is joined: see `_joined_matches`.
    """
    index = variant_index(terms).where(F.length("variant") >= 5).withColumn("words", F.size(F.split("variant", " ")))
    norm = texts.select("text_id", normalize_name(F.coalesce("text", F.lit(""))).alias("norm"))
    known = index.select("variant", "term", "place", "words").limit(most_spellings + 1).collect()  # bounded by the limit
    if len(known) > most_spellings:
        return _joined_matches(norm, index)
    # by rank: the place in the index, best first
    ranked = sorted(((r.words > 1, r.place, r.variant, r.term) for r in known), key=lambda x: (not x[0], _place(x[1])))
    return _found_by_automaton(norm, [(v, t, 0.95 if many else 0.60) for many, _, v, t in ranked])


def _place(place) -> tuple:
    """As Spark orders structs: nulls first."""
    return tuple((x is not None, _place(x) if isinstance(x, tuple) else x) for x in place)


def _found_by_automaton(norm: DataFrame, ranked: list[tuple[str, str, float]]) -> DataFrame:
    """ranked: variant, term, confidence, best first."""
    sent = norm.sparkSession.sparkContext.broadcast(ranked)

    def run(batches):
        import ahocorasick
        import pyarrow as pa

        spellings = sent.value
        automaton = ahocorasick.Automaton()
        for rank, (variant, _, _) in enumerate(spellings):
            automaton.add_word(variant, (rank, len(variant)))
        if spellings:
            automaton.make_automaton()
        for b in batches:
            at, best = [], []
            for i, text in enumerate(b.column(1).to_pylist() if spellings else []):
                least, n = len(spellings), len(text)
                for end, (rank, size) in automaton.iter(text):
                    if rank < least:
                        begin, end = end - size + 1, end + 1
                        # as whole words, or from eight letters on anywhere
                        if size >= 8 or ((begin == 0 or text[begin - 1] == " ") and (end == n or text[end] == " ")):
                            least = rank
                if least < len(spellings):
                    at.append(i)
                    best.append(spellings[least])
            columns = list(zip(*best, strict=True)) if best else [[], [], []]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.float64()), pa.array(columns[0], pa.string())], ["text_id", "term", "confidence", "variant"])

    kind = T.StructType([norm.schema["text_id"], T.StructField("term", T.StringType()), T.StructField("confidence", T.DoubleType()), T.StructField("variant", T.StringType())])
    return norm.mapInArrow(run, kind)


def _joined_matches(norm: DataFrame, index: DataFrame) -> DataFrame:
    """Spellings are found by an equi-join: runs of words of the text, as long as spellings are, with whole spellings;
    those of eight letters and more that may stand inside words are joined on their first four letters at every place
    of the text, and then confirmed. So no text meets every spelling."""
    lengths = index.select("words").distinct()  # a handful of rows
    w = F.split("norm", " ")
    runs = norm.crossJoin(F.broadcast(lengths)).where(F.size(w) >= F.col("words"))
    runs = runs.select("text_id", F.explode(F.transform(F.sequence(F.lit(1), F.size(w) - F.col("words") + 1), lambda i: F.array_join(F.slice(w, i, F.col("words")), " "))).alias("variant")).distinct()
    whole = runs.join(index, "variant")
    long = index.where(F.length("variant") >= 8).withColumn("head", F.substring("variant", 1, 4))
    windows = F.transform(F.sequence(F.lit(1), F.length("norm") - 7), lambda i: F.substr(F.col("norm"), i, F.lit(4)))
    # where few spellings have such heads, other places of a text go before they become rows
    known = [r[0] for r in long.select("head").distinct().limit(MOST_HEADS + 1).collect()]
    if len(known) <= MOST_HEADS:
        windows = F.filter(windows, lambda w: w.isin(known))
    heads = norm.where(F.length("norm") >= 8).select("text_id", "norm", F.explode(F.array_distinct(windows)).alias("head"))
    inside = heads.join(long, "head").where(F.contains("norm", F.col("variant")))
    names = ["text_id", "variant", "term", "place", "words"]
    hits = whole.select(names).unionByName(inside.select(names)).distinct()
    conf = F.when(F.col("words") > 1, 0.95).otherwise(0.60)
    best = hits.withColumn("confidence", conf).withColumn("r", F.row_number().over(Window.partitionBy("text_id").orderBy(F.desc("confidence"), "place")))
    return best.where("r = 1").select("text_id", "term", "confidence", "variant")


def resolver_stats(terms: DataFrame) -> DataFrame:
    """professors, variants, unique_last_names."""
    p = people(terms).agg(F.count(F.lit(1)).alias("professors"), F.countDistinct("last").alias("unique_last_names"))
    return p.crossJoin(variant_index(terms).agg(F.count(F.lit(1)).alias("variants"))).select("professors", "variants", "unique_last_names")
