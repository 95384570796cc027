"""Spelling variants: words one edit apart, found by bands of letter-parity bitmasks.

A word's mask has a bit for each letter that it holds an odd number of times. One inserted, deleted or replaced letter
flips at most two bits, so of three bands of the mask one is left as it was. An edit also leaves the first or the last
half of the shorter word in place. Words are joined on equal (length of the shorter, half, band); what agrees there is
verified by its masks and then by edit distance. A pair is found at the first half and band that agree and at no other,
so that pairs need no second shuffle to be told apart. Keys follow the vocabulary, not the corpus.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.llm.common import written

#: Tables that grow with the vocabulary are never sent whole through the driver: their files are several times smaller than
#: their rows, and half and band keys six times as many, so that estimates from files take them for small.
SHUFFLED = "merge"
#: Letters of words (fixed value of the contract); only A-Z are lower-cased.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: One of so many occurrences loses a letter (fixed value of the contract).
TYPO_EVERY = 97
#: A form is at least so many times as frequent.
TIMES = 2
BANDS = 3
#: Letters from frequent to rare are dealt to the bands in turn, so that each band tells words apart about as well.
_ORDER = "etaoinshrdlucmfywgpbvkxqjz"


def slots(codes: np.ndarray) -> np.ndarray:
    """A slot for each code point: the band is slot % 3. Letters beyond a-z share 64 slots, code points 64 apart one."""
    table = np.full(128, -1)
    table[[ord(c) for c in _ORDER]] = np.arange(len(_ORDER))
    own = table[np.minimum(codes, 127)] * (codes < 128) - (codes >= 128)
    return np.where(own < 0, len(_ORDER) + codes % 64, own)


def with_masks(words: DataFrame, word: str = "word") -> DataFrame:
    """Adds m0, m1 and m2, the bands of each word's mask. Null and empty words have none set."""

    def run(it):
        import pyarrow as pa

        for b in it:
            texts = [x or "" for x in b.column(b.schema.get_field_index(word)).to_pylist()]
            size = np.array([len(x) for x in texts], np.int64)
            slot = slots(np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64))
            begin, full, masks = np.cumsum(size) - size, size > 0, []
            for band in range(BANDS):
                bits = np.where(slot % BANDS == band, np.int64(1) << (slot // BANDS), 0)
                mask = np.zeros(len(texts), np.int64)
                if full.any():
                    mask[full] = np.bitwise_xor.reduceat(bits, begin[full])
                masks.append(pa.array(mask.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*b.columns, *masks], [*b.schema.names, "m0", "m1", "m2"])

    return words.mapInArrow(run, T.StructType([*words.schema.fields, *[T.StructField(f"m{i}", T.IntegerType()) for i in range(BANDS)]]))


def with_typos(doc_id: Column, run: Column) -> Column:
    """The run without the letter that its document and itself name, for one in 97 of all occurrences."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % TYPO_EVERY == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n: words of at least five letters and three occurrences in all texts, after the contract's typos.

    Null texts have no words; a null id counts as an empty one; repeated rows count again; no rows give none.
    """
    # shorter runs can't give a word, as typos only take letters away
    found = F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(f"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}"), F.lit(0))
    runs = docs.select(F.col(key).alias("k"), F.explode(found).alias("run"))
    words = runs.select(with_typos(F.col("k"), F.col("run")).alias("word")).where(F.length("word") >= LEAST_LENGTH)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT)


def _keyed(masked: DataFrame, longer: bool) -> DataFrame:
    """A row for each half and band. longer: the word as the longer one of a pair."""
    short = F.length("word") - (1 if longer else 0)
    half = F.floor(short / 2).cast("int")
    ends = [F.substring(F.col("word"), F.lit(1), half), F.substring(F.col("word"), half - short, short - half)]
    keys = [F.struct(F.lit(side).alias("side"), F.lit(band).alias("band"), end.alias("half"), F.col(f"m{band}").alias("mask")) for side, end in enumerate(ends) for band in range(BANDS)]
    return masked.where(F.length("word") > 1).select("word", "n", "m0", "m1", "m2", F.lit(longer).alias("longer"), short.alias("short"), F.explode(F.array(*keys)).alias("at")).select("*", "at.*").drop("at")


def near_pairs(words: DataFrame) -> DataFrame:
    """a, b, a_n, b_n: pairs of different words one edit apart, each once. words: word, n, each word once; null words and
    words under two letters are near nothing."""
    masked = with_masks(words.select("word", "n"))
    on = ["short", "side", "band", "half", "mask"]
    left = _keyed(masked, False).drop("longer")
    right = _keyed(masked, False).unionByName(_keyed(masked, True))
    x, y = left.alias("x"), right.alias("y")
    flipped = sum((F.bit_count(F.col(f"x.m{i}").bitwiseXOR(F.col(f"y.m{i}"))) for i in range(BANDS)), F.lit(0))
    band, side = F.col("x.band"), F.col("x.side")
    earlier_band = F.lit(False)
    for i in range(BANDS):
        earlier_band = earlier_band | ((band > i) & (F.col(f"x.m{i}") == F.col(f"y.m{i}")))
    half = F.floor(F.col("x.short") / 2).cast("int")
    first_half = F.substring(F.col("x.word"), F.lit(1), half) == F.substring(F.col("y.word"), F.lit(1), half)
    fits = F.when(F.col("y.longer"), flipped == 1).otherwise((flipped <= 2) & (F.col("x.word") < F.col("y.word")))
    met = fits & ~earlier_band & ~((side == 1) & first_half) & (F.levenshtein(F.col("x.word"), F.col("y.word")) == 1)
    joined = x.join(y.hint(SHUFFLED), [F.col(f"x.{c}") == F.col(f"y.{c}") for c in on])
    return joined.where(met).select(F.col("x.word").alias("a"), F.col("y.word").alias("b"), F.col("x.n").alias("a_n"), F.col("y.n").alias("b_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root from word, form: what is reached by following forms to the last. A form's count is twice its word's at
    least, so there are no circles; pointers double their reach each round, and rounds grow with the logarithm of the
    longest way, which has no more steps than the largest count has bits."""
    spark = forms.sparkSession
    at = written(spark, forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("via"), F.col("root").alias("beyond"))
        joined = at.join(on.hint(SHUFFLED), at.root == on.via, "left")
        if joined.where("via is not null").isEmpty():
            return at
        at = written(spark, joined.select("word", F.coalesce("beyond", "root").alias("root")), "roots")


def group_variants(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for words (word, n). form: of the near words the most frequent one, of equals
    the first by code points, if it is at least twice as frequent; null otherwise, and the word is its own root."""
    spark = words.sparkSession
    words = written(spark, words.select("word", "n"), "words")
    ways = F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")), F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))))
    best = near_pairs(words).select(ways.alias("p")).select("p.*").groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("least"), F.col("near").alias("near"))).alias("best"))
    formed = F.col("best.least") * -1 >= TIMES * F.col("n")
    found = words.join(best.hint(SHUFFLED), "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("best.near")).alias("form"), F.when(formed, -F.col("best.least")).alias("form_n"))
    found = written(spark, found, "forms")
    rooted = roots(found.where("form is not null"))
    return found.join(rooted.hint(SHUFFLED), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
