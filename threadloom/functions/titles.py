"""Title parsing: five forms, tried in order; the first whose fields are valid counts.

`parse_titles` works in steps, one projection each, so that Catalyst evaluates no form's fields twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions import lookups as L
from threadloom.functions.text import built_once, canonical_campus, ci, clean_name, entity_id, has, joined, let, plausible_name, squeeze, strip, title_case, tokens, without_honorifics

_TAIL = r"\s*(?:\(.*\))?\s*$"
#: Fixed patterns of the forms: what stands where in a title.
FORMS = {
    "standard": (r"^\[([A-Za-z]+)\]\s*(.+?)\s*-\s*([^,]+?)\s*,\s*([^()\[\]]+?)" + _TAIL, {"campus": 1, "course": 2, "last": 3, "first": 4}),
    "swapped": (r"^\[([A-Za-z]+)\]\s*([^,]+?)\s*,\s*([^()\[\]]+?)\s*-\s*(.+?)" + _TAIL, {"campus": 1, "last": 2, "first": 3, "course": 4}),
    "bare": (r"^\s*(?!(?:" + "|".join(L.LEADING_CAMPUS) + r")\s)([A-Za-z0-9\s]+?)\s*-\s*([^,]+?)\s*,\s*([^()\[\]]+?)" + _TAIL, {"course": 1, "last": 2, "first": 3}),
    "informal": (r"^\[([A-Za-z]+)\]\s*(.+?)\s*-\s*([^()\[\],]+?)" + _TAIL, {"campus": 1, "course": 2, "name": 3}),
    "dashless": (r"^\[([A-Za-z]+)\]\s+(.+)$", {"campus": 1, "body": 2}),
}
#: What a title must hold to fit a form; looked for before the pattern, which is dear.
_HOLDS = {"standard": "[-,", "swapped": "[-,", "bare": "-,", "informal": "[-", "dashless": "["}
_CUT = "\x01"


def is_section(token: Column) -> Column:
    return has(strip(token), f"^(?:{L.SECTION_TOKEN})$")


def without_sections(text: Column) -> Column:
    """Drops section tokens, and from `TOKEN:rest` the token."""

    def part(t: Column) -> Column:
        at = F.instr(t, ":")
        left, right = F.substring(t, F.lit(1), at - 1), F.substr(t, at + 1)
        return F.when((at > 0) & is_section(left), right).otherwise(t)

    kept = F.filter(tokens(text), lambda t: ~is_section(t))
    return joined(F.filter(F.transform(kept, part), lambda t: t != ""))


def _name_part(text: Column) -> Column:
    """A name field without sections, honorifics and a leading `under`, `with` or `by`."""
    return without_honorifics(F.regexp_replace(without_sections(squeeze(text)), ci(r"^(?:under|with|by)\s+"), ""), L.HONORIFICS)


def clean_fields(course: Column, last: Column, first: Column) -> Column:
    """struct(course, last, first), cleaned. Of a surname that holds ` - ` only the last part is one; the rest belongs
    to the course."""

    def move(s: Column) -> Column:
        parts = F.filter(F.transform(F.split(s["last"], " - ", -1), lambda x: strip(x)), lambda p: p != "")
        return let(
            parts,
            lambda p: F.when(
                F.contains(s["last"], F.lit(" - ")) & (F.size(p) >= 2),
                F.struct(squeeze(F.concat(s["course"], F.lit(" - "), F.array_join(F.slice(p, F.lit(1), F.size(p) - 1), " - "))).alias("course"), F.element_at(p, -1).alias("last"), s["first"].alias("first")),
            ).otherwise(s),
        )

    def finish(s: Column) -> Column:
        lead = lambda c: strip(F.regexp_replace(c, r"^[-–— ]+", ""))
        return let(clean_name(lead(s["last"]), lead(s["first"])), lambda n: F.struct(s["course"].alias("course"), title_case(n["last"]).alias("last"), title_case(n["first"]).alias("first")))

    raw = F.struct(without_sections(squeeze(course)).alias("course"), _name_part(last).alias("last"), _name_part(first).alias("first"))
    return let(let(raw, move), finish)


def chatter(title: Column) -> Column:
    """Whether a title asks or looks for something: then it isn't parsed, whatever form it fits."""
    return F.contains(title, F.lit("?")) | has(title, L.CLASSMATE_HUNT) | has(title, L.META_HUNT)


def valid(course: Column, last: Column, first: Column) -> Column:
    """Whether cleaned fields are a parse, and not words that fit a form by accident."""
    bare = lambda c: F.regexp_replace(F.lower(c), "[!,.]+$", "")
    words = lambda c: F.size(tokens(c))
    bad = [
        course == "", last == "", first == "",
        last.rlike(r"(?U)\d"), first.rlike(r"(?U)\d"),
        bare(last).isin(L.TITLE_JUNK_NAMES), bare(first).isin(L.TITLE_JUNK_NAMES),
        F.lower(course).rlike("|".join(L.COURSE_PHRASES)),
        (words(course) > 6) & ~course.rlike(r"(?U)\d"), words(first) > 6,
    ]
    out = ~bad[0]
    for x in bad[1:]:
        out = out & ~x
    return out & plausible_name(last, first)


def primary_title(title: Column) -> Column:
    """The title up to its first `;` or `&`, dashes as hyphens."""
    return strip(F.regexp_extract(F.translate(strip(title), "–—−", "---"), r"^([^;&]*)", 1))


def _cut(form: str, t: Column) -> Column:
    """The groups of a form's pattern, found at one go; null where the title doesn't fit."""
    pattern, groups = FORMS[form]
    holds = F.lit(True)
    for c in _HOLDS[form]:
        holds = holds & (F.startswith(t, F.lit(c)) if c == "[" else F.contains(t, F.lit(c)))
    parts = F.split(F.regexp_replace(t, ci(pattern), _CUT.join(f"${i}" for i in groups.values())), _CUT)
    return F.when(holds, let(parts, lambda p: F.when(F.size(p) == len(groups), p)))


def _fields(form: str, groups: Column) -> Column:
    """struct(campus, course, last, first) from the groups of a form; a null campus if it is unknown."""
    names = list(FORMS[form][1])
    get = lambda name: F.get(groups, F.lit(names.index(name)))
    campus = (F.lit(L.DEFAULT_CAMPUS) if form == "bare" else canonical_campus(get("campus"))).alias("campus")
    if form == "informal":
        parts = F.filter(tokens(without_honorifics(F.regexp_replace(squeeze(get("name")), ci(r"^(?:under|with|by)\s+"), ""), L.HONORIFICS)), lambda w: ~is_section(w))
        return let(
            parts,
            lambda p: F.when(
                F.size(p) >= 2,
                F.struct(campus, without_sections(squeeze(get("course"))).alias("course"), title_case(F.element_at(p, -1)).alias("last"), title_case(joined(F.slice(p, F.lit(1), F.size(p) - 1))).alias("first")),
            ),
        )
    if form == "dashless":

        def cut(b: Column) -> Column:
            before, after = strip(F.regexp_extract(b, r"^(.*),", 1)), strip(F.regexp_extract(b, r"^.*,(.*)$", 1))

            def named(w: Column) -> Column:
                n = F.size(w)
                numbered = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda at, i: F.when(F.get(w, i - 1).rlike(r"(?U)\d"), i).otherwise(at))
                at = let(numbered, lambda i: F.when((i > 0) & (i < n), i).otherwise(n - 1))
                fields = let(at, lambda i: clean_fields(joined(F.slice(w, F.lit(1), i)), title_case(joined(F.slice(w, i + 1, n - i))), title_case(after)))
                return F.when((n >= 2) & (after != ""), fields)

            return F.when(F.contains(b, F.lit(",")) & ~b.rlike(r"(?U)\s-\s"), let(tokens(before), named))

        return let(let(squeeze(get("body")), cut), lambda f: F.when(f.isNotNull(), F.struct(campus, f["course"].alias("course"), f["last"].alias("last"), f["first"].alias("first"))))
    fields = clean_fields(get("course"), get("last"), get("first"))
    return let(fields, lambda f: F.struct(campus, f["course"].alias("course"), f["last"].alias("last"), f["first"].alias("first")))


@built_once
def parse(title: Column) -> Column:
    """struct(campus, course, last, first) of the first form whose fields are valid, or null. Forms after it aren't
    worked out: coalesce stops."""

    def form(name: str, t: Column) -> Column:
        good = lambda f: F.when(f["campus"].isNotNull() & valid(f["course"], f["last"], f["first"]), f)
        return let(_cut(name, t), lambda g: F.when(g.isNotNull(), let(_fields(name, g), good)))

    text = F.coalesce(title, F.lit(""))
    return F.when(~chatter(text), let(F.translate(primary_title(text), _CUT, " "), lambda t: F.coalesce(*[form(f, t) for f in FORMS])))


def parse_titles(df: DataFrame, title: str = "title") -> DataFrame:
    """df with campus, course, last_name, first_name and professor_id, all null where no form gives a valid parse.
    Columns of these names are replaced; null titles aren't parsed.

    The parse is exploded from an array of one: a filter on its fields is then not pushed below it, which would repeat
    the whole expression.
    """
    names = ["campus", "course", "last_name", "first_name", "professor_id"]
    out = df.drop(*names).select("*", F.explode(F.array(parse(F.col(title)))).alias("__p"))
    p = F.col("__p")
    out = out.withColumns({"campus": p["campus"], "course": p["course"], "last_name": p["last"], "first_name": p["first"], "professor_id": F.when(p.isNotNull(), entity_id(p["campus"], p["last"], p["first"]))})
    return out.drop("__p")


def parse_form(df: DataFrame, title: str = "title") -> DataFrame:
    """df with `form`: which form's pattern fits first; a diagnostic."""
    t = primary_title(F.coalesce(F.col(title), F.lit("")))
    return df.withColumn("form", F.coalesce(*[F.when(t.rlike(ci(p)), F.lit(f)) for f, (p, _) in FORMS.items()]))
