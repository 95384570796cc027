"""Scalar functions over names, titles, ids and times. All are Column expressions that stay in the JVM.

Patterns run with Java's flags (?idU): case-insensitive, Unicode classes and boundaries, only \\n ends a line.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import wraps
from weakref import WeakKeyDictionary

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from threadloom.functions import lookups as L

SPACES = r"(?U)\s+"
# Fixed value: Unicode's White_Space, which is what \s is in these patterns.
WHITE_SPACE = "\t\n\x0b\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_MARKS = {chr(c): b for c in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)] if len(b := "".join(x for x in unicodedata.normalize("NFD", chr(c)) if not unicodedata.combining(x))) == 1 and b != chr(c)}


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


_built: WeakKeyDictionary = WeakKeyDictionary()
#: How a plain column prints, other than a lambda's variable.
_PLAIN = re.compile(r"Column<'(?![a-z]_\d+'>)[A-Za-z_]\w*'>")


def built_once(build: Callable[..., Column]) -> Callable[..., Column]:
    """A large expression over plain columns is built once a session: each of its nodes is a call to the JVM, so that
    building takes longer than planning. Expressions are unresolved, so they serve any table with such columns."""

    @wraps(build)
    def wrapped(*columns: Column) -> Column:
        names = tuple(map(str, columns))
        if not all(map(_PLAIN.fullmatch, names)):
            return build(*columns)
        known = _built.setdefault(SparkSession.active(), {})
        key = (build.__qualname__, names)
        if key not in known:
            known[key] = build(*columns)
        return known[key]

    return wrapped


def ci(pattern: str) -> str:
    return f"(?idU){pattern}"


def has(text: Column, pattern: str) -> Column:
    """Whether the pattern is found anywhere."""
    return text.rlike(ci(pattern))


def strip(text: Column, characters: str = WHITE_SPACE) -> Column:
    """Without white space, or the characters given, at both ends. Looks at the ends only."""
    return F.btrim(text, F.lit(characters))


def squeeze(text: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return strip(F.regexp_replace(text, SPACES, " "))


def tokens(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda t: t != "")


def joined(parts: Column) -> Column:
    return F.array_join(parts, " ")


def fold(text: Column) -> Column:
    """Accents off Latin letters, composed or not. ß and ø have no decomposition and stay."""
    return F.regexp_replace(F.translate(text, "".join(_MARKS), "".join(_MARKS.values())), r"\p{Mn}+", "")


def normalize_name(text: Column) -> Column:
    """Lower case, accents folded, punctuation (not the hyphen) deleted, white space squeezed."""
    return squeeze(F.regexp_replace(fold(F.lower(text)), r"[.,;:'\"!?()/\\]", ""))


def fold_key(text: Column) -> Column:
    """Upper-case match key. Commas are punctuation and go."""
    return F.upper(normalize_name(text))


def title_case(text: Column) -> Column:
    """Every word and every part between hyphens capitalised, the rest in lower case."""
    cap = lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2))))
    return joined(F.transform(tokens(text), lambda w: F.array_join(F.transform(F.split(w, "-", -1), cap), "-")))


def slug(text: Column) -> Column:
    """Id part: lower case a-z, 0-9 and underscores for spaces; other letters vanish."""
    return F.regexp_replace(F.regexp_replace(strip(F.lower(text)), r"(?U)[^a-z0-9\s]", ""), SPACES, "_")


def entity_id(campus: Column, last: Column, first: Column) -> Column:
    return F.concat_ws("__", slug(campus), slug(last), slug(first))


def display_name(last: Column, first: Column) -> Column:
    return F.concat_ws(", ", last, first)


def course_key(course: Column) -> Column:
    """Upper-case letters and digits only."""
    return F.regexp_replace(F.upper(course), r"[^A-Z0-9]", "")


def canonical_campus(raw: Column) -> Column:
    """Code in its canonical form: by code, alias or tag that stands for the default; else null."""
    pairs = {c.upper(): c for c in L.CAMPUS_CODES} | L.CAMPUS_ALIASES | dict.fromkeys(L.CAMPUS_TAGS, L.DEFAULT_CAMPUS)
    table = F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])
    return F.try_element_at(table, F.upper(strip(raw)))


def university(campus: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in L.UNIVERSITIES.items() for x in kv]), F.upper(campus))


def without_honorifics(text: Column, honorifics: str = L.HONORIFICS_OF_NAMES) -> Column:
    return joined(F.filter(tokens(text), lambda t: ~has(strip(t, r".,"), f"^(?:{honorifics})$")))


@built_once
def split_name(raw: Column) -> Column:
    """struct(last, first): at a comma (of a list of people, the first), else the last word with the particles before
    it, but never the first word, as surname."""
    many = r"^([A-Z][A-Z\s'-]+),\s*([A-Za-z][A-Za-z.\s'-]+?)(?:,\s*[A-Z]{2,},|$)"

    def by_words(t: Column) -> Column:
        n = F.size(t)
        particle = lambda w: F.regexp_replace(F.lower(w), "[^a-z]", "").isin(L.SURNAME_PARTICLES)
        # place (from 1) where the surname begins: walk back over particles
        at = F.aggregate(F.sequence(n - 1, F.lit(2), F.lit(-1)), n, lambda li, i: F.when((li == i + 1) & particle(F.get(t, i - 1)), i).otherwise(li))
        begin = F.when(n > 2, at).otherwise(n)
        return F.when(n <= 1, F.struct(joined(t).alias("last"), F.lit("").alias("first"))).otherwise(
            let(begin, lambda b: F.struct(joined(F.slice(t, b, n - b + 1)).alias("last"), joined(F.slice(t, F.lit(1), b - 1)).alias("first")))
        )

    def parts(term: Column) -> Column:
        cut = F.transform(F.split(term, ",", -1), lambda x: strip(x))
        with_comma = let(cut, lambda c: F.struct(F.get(c, F.lit(0)).alias("last"), F.coalesce(F.get(c, F.lit(1)), F.lit("")).alias("first")))
        return F.when(F.contains(term, F.lit(",")), with_comma).otherwise(let(tokens(term), by_words))

    first_person = lambda s: F.when(s.rlike(many), F.concat(F.regexp_extract(s, many, 1), F.lit(", "), strip(F.regexp_extract(s, many, 2)))).otherwise(s)
    return let(strip(F.coalesce(raw, F.lit(""))), lambda s: let(strip(first_person(s)), parts))


@built_once
def clean_name(last: Column, first: Column) -> Column:
    """struct(last, first) without honorifics, a section glued to the surname, and noise after the given name."""
    name = F.struct(
        strip(F.regexp_replace(without_honorifics(F.coalesce(last, F.lit(""))), ci(L.LEADING_SECTION), ""), " -–—:").alias("last"),
        strip(F.regexp_replace(without_honorifics(F.coalesce(first, F.lit(""))), ci(L.TRAILING_NOISE), "")).alias("first"),
    )
    return let(name, lambda n: F.when((n["last"] == "") & (n["first"] != ""), split_name(n["first"])).otherwise(n))


@built_once
def plausible_name(last: Column, first: Column) -> Column:
    """Whether a cleaned pair can be a person's name."""

    def test(n: Column) -> Column:
        a, b = n["last"], n["first"]
        both = F.concat_ws(" ", a, b)
        bad = [
            a == "", b == "",
            has(a, f"^(?:{L.JUNK_SURNAMES})$"),
            F.contains(both, F.lit("?")), F.length(a) < 2,
            b.rlike(r"^[A-Za-z]{1,4}(?U:\s)*\d+(?:\.\d+)?$"), F.size(tokens(b)) > 8,
            F.contains(both, F.lit(",")), ~a.rlike("[A-Za-z]{2}"),
            normalize_name(a).isin(L.PARTICLES_NEVER_ALONE) & (F.size(tokens(a)) == 1),
            F.contains(both, F.lit("@")), has(both, r"\.(?:com|edu)\b"),
            both.rlike(r"[\[\]/&]"), has(both, L.NAME_CONNECTIVES),
        ]
        out = F.lit(True)
        for x in bad:
            out = out & ~x
        return out

    return let(clean_name(last, first), test)


@built_once
def name_variants(term: Column) -> Column:
    """struct(last, first, first_full, middle_initial, is_short, variants): the ordered spellings of a name."""

    def build(n: Column) -> Column:
        last, rest = n["last"], n["rest"]
        first = F.coalesce(F.get(rest, F.lit(0)), F.lit(""))
        full = joined(F.filter(rest, lambda p: F.length(p) > 1))
        middle = F.coalesce(F.get(F.filter(rest, lambda p: F.length(p) == 1), F.lit(0)), F.lit(""))
        second = F.coalesce(F.get(rest, F.lit(1)), F.lit(""))
        initial = F.substring(first, 1, 1)
        put = lambda ok, *p: F.when(ok, F.concat(*p))
        gap, some, whole = F.lit(" "), first != "", full != ""
        spelled = F.array(
            put(whole, last, gap, full), put(whole, full, gap, last), put(some, last, gap, first), put(some & (first != full), first, gap, last),
            put(some, last, gap, initial), put(some, initial, gap, last), put(some & (F.length(second) > 1), initial, F.substring(second, 1, 1), gap, last),
            put(whole & (middle != ""), last, gap, full, gap, middle),
        )
        kept = F.array_distinct(F.filter(F.array_compact(spelled), lambda v: F.length(v) >= 3))
        return F.struct(last.alias("last"), first.alias("first"), full.alias("first_full"), middle.alias("middle_initial"), (F.length(last) <= 3).alias("is_short"), kept.alias("variants"))

    return let(split_name(term), lambda p: let(F.struct(normalize_name(p["last"]).alias("last"), tokens(normalize_name(p["first"])).alias("rest")), build))


def strip_html(html: Column) -> Column:
    """Tags as spaces, white space squeezed."""
    return squeeze(F.regexp_replace(html, "<[^>]+>", " "))


def post_id(tag: Column, link: Column) -> Column:
    """Id after `t3_` in the tag, else the path part after `/comments/` in the link; null if neither."""
    take = lambda c, p: F.nullif(F.regexp_extract(c, p, 1), F.lit(""))
    return F.coalesce(take(tag, r"t3_([A-Za-z0-9]+)"), take(link, r"/comments/([A-Za-z0-9]+)"))


def iso_time(epoch: Column) -> Column:
    """Epoch seconds as ISO 8601 with offset; microseconds only where there are some; null stays null."""
    micros = F.round((epoch - F.floor(epoch)) * 1_000_000).cast("long")
    stamp = F.timestamp_seconds(F.floor(epoch))
    fraction = F.when(micros > 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))).otherwise(F.lit(""))
    return F.concat(F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("+00:00"))


def time_bound(text: Column) -> Column:
    """Digits as epoch seconds, else an ISO date or time (UTC unless it says otherwise); null if it is neither."""
    return F.coalesce(F.try_to_number(F.when(text.rlike(r"^\d+$"), text), F.lit("9" * 18)).cast("double"), feed_time(text, None))


def feed_time(text: Column, otherwise: float | None = 0.0) -> Column:
    """A feed's date as epoch seconds; a `Z` is UTC."""
    got = F.unix_micros(F.try_to_timestamp(F.regexp_replace(text, "[zZ]$", "+00:00"))) / 1e6
    return got if otherwise is None else F.coalesce(got, F.lit(otherwise))
