"""Personal data: regular expressions propose spans, checksums confirm them, nearby words adjust the score.

All of it is built from DataFrame functions. Positions come from splitting a text at its matches: the
lengths of the pieces between and of the matches, added up, are the code points where a match starts
and ends. Words around a match are looked for in the pieces next to it. So no step goes through a text
again for each match, and running sums go by groups as long as their number, not by growing arrays.
The patterns find what plain leftmost matching finds, but guards in front and possessive counts keep a
search from starting again inside a run of characters that has already failed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order in which spans with an equal start are listed.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "local")
#: Kinds whose confirmed spans stay whatever their score.
BASE = KINDS[:4]

_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    # a whole run of digits with single separators, and only where it has 12 to 19 digits
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    # a telephone number without its country
    "local": r"(?<![0-9+(])(?:\([0-9]{3}\)[\x20]?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
#: What a text must have before a pattern is tried at all.
HINTS = {"email": "[@]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"\+[0-9]", "iban": r"[A-Z]{2}[0-9]{2}[\x20A-Z0-9]", "ssn": "[0-9]-[0-9]{2}-[0-9]", "local": r"[0-9]{3}[\x20.-][0-9]{4}"}
#: Kinds that could be other numbers as well start below the usual least score, and need a word near them.
SCORES = {"email": 0.75, "ip": 0.6, "card": 0.75, "phone": 0.6, "iban": 0.7, "ssn": 0.5, "local": 0.5}
#: Words, with or without a plural s, that raise a score when they stand near, in lower case.
CONTEXT = {
    "email": ("mail", "contact", "write", "kontakt", "courriel", "correo"),
    "ip": ("ip", "address", "server", "host", "login", "adresse"),
    "card": ("card", "visa", "mastercard", "credit", "payment", "karte", "kreditkarte", "carte", "tarjeta"),
    "phone": ("phone", "telephone", "call", "tel", "mobile", "fax", "telefon", "telefonnummer"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social security", "tax", "taxpayer"),
    "local": ("phone", "telephone", "call", "tel", "mobile", "fax", "telefon", "telefonnummer"),
}
NEAR = 40  # code points before and after a span in which context counts
RAISED = 0.25
#: Matches on either side that can reach into the context; none is shorter than five characters.
BESIDE = NEAR // 5

_MATCHES = "struct<hits:array<string>,gaps:array<string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    d = _digits(value)
    n = F.length(d)

    def worth(i: Column) -> Column:
        x = F.substring(d, i, F.lit(1)).cast("int")
        twice = 2 * x
        return F.when((n - i) % 2 == 0, x).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, i: acc + worth(i)) % 10 == 0


def _mod97(value: Column) -> Column:
    v = F.replace(value, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(v, F.lit(5), F.length(v)), F.substring(v, 1, 4))

    def step(acc: Column, i: Column) -> Column:
        c = F.ascii(F.substring(moved, i, F.lit(1)))
        return F.when(c <= 57, (acc * 10 + c - 48) % 97).otherwise((acc * 100 + c - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), step) == 1


def _octets(value: Column) -> Column:
    def small(part: Column) -> Column:
        significant = F.ltrim(part, F.lit("0"))
        return (F.length(significant) < 3) | ((F.length(significant) == 3) & (significant <= "255"))

    return F.forall(F.split(value, r"\."), small)


CONFIRMED = {
    "email": lambda v: F.lit(True),
    "ip": _octets,
    "card": _luhn,
    "phone": lambda v: F.length(_digits(v)).between(9, 15),
    "iban": lambda v: F.length(F.replace(v, F.lit(" "), F.lit(""))).between(15, 34) & _mod97(v),
    "ssn": lambda v: ~v.rlike("^(?:000|666|9)|-00-|-0000$"),
    "local": lambda v: F.lit(True),
}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once, however often body's lambdas name it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _grouped(xs: Column) -> Column:
    """An array cut into about as many arrays as one of them has elements."""

    def cut(xs: Column) -> Column:
        each = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(xs).cast("double"))).cast("int"))
        return F.when(F.size(xs) > 0, F.transform(F.sequence(F.lit(1), F.size(xs), each), lambda i: F.slice(xs, i, each))).otherwise(F.array())

    return _let(xs, cut)


def _running(xs: Column, add: Callable[[Column, Column], Column]) -> Column:
    """Before each of the integers xs, all earlier ones added up, from 0; twice by groups, so no long array grows."""

    def through(part: Column, at: Column) -> Column:
        zero = F.struct(at.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(part, zero, lambda acc, x: F.struct(add(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    def over(groups: Column) -> Column:
        sums = F.transform(groups, lambda g: F.aggregate(g, F.lit(0), add))
        return F.flatten(F.zip_with(groups, through(sums, F.lit(0)), through))

    return _let(_grouped(xs), over)


def _proposed(text: Column, kind: str) -> Column:
    """The matches of a pattern, and the pieces of text before, between and after them."""
    pattern = PATTERNS[kind]
    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"), F.split(text, pattern, -1).alias("gaps"))
    none = F.struct(F.array().cast("array<string>").alias("hits"), F.array().cast("array<string>").alias("gaps"))
    return F.when(text.rlike(HINTS[kind]), found).otherwise(none).cast(_MATCHES)


def _placed(m: Column) -> Column:
    """By match: its start, and up to NEAR code points of what is before and after it."""

    def one(b: Column, start: Column, i: Column) -> Column:
        hits, gaps, heads, tails = (b[c] for c in ("hits", "gaps", "heads", "tails"))
        first = F.greatest(i - BESIDE, F.lit(0))
        earlier = F.zip_with(F.slice(tails, first + 1, i - first), F.slice(hits, first + 1, i - first), lambda g, h: F.concat(g, F.right(h, F.lit(NEAR))))
        later = F.zip_with(F.slice(heads, i + 2, F.lit(BESIDE)), F.slice(hits, i + 2, F.lit(BESIDE)), lambda g, h: F.concat(g, F.coalesce(F.left(h, F.lit(NEAR)), F.lit(""))))
        before = F.right(F.concat(F.array_join(earlier, ""), F.get(tails, i)), F.lit(NEAR))
        after = F.left(F.array_join(later, ""), F.lit(NEAR))
        return F.struct((start + F.length(F.get(gaps, i))).alias("start"), F.get(hits, i).alias("value"), F.concat(before, F.lit("\n"), after).alias("near"))

    def all_of(b: Column) -> Column:
        steps = F.zip_with(b["hits"], F.slice(b["gaps"], F.lit(1), F.size(b["hits"])), lambda h, g: F.length(h) + F.length(g))
        return _let(_running(steps, lambda x, y: x + y), lambda at: F.transform(at, lambda start, i: one(b, start, i)))

    heads, tails = F.transform(m["gaps"], lambda g: F.left(g, F.lit(NEAR))), F.transform(m["gaps"], lambda g: F.right(g, F.lit(NEAR)))
    return _let(F.struct(m["hits"].alias("hits"), m["gaps"].alias("gaps"), heads.alias("heads"), tails.alias("tails")), all_of)


def _scored(kind: str, matches: Column) -> Column:
    words = "|".join(CONTEXT[kind])

    def one(s: Column) -> Column:
        near = F.lower(s["near"]).rlike(rf"(?<![a-z])(?:{words})s?(?![a-z])")
        score = F.round(F.lit(SCORES[kind]) + F.when(near, F.lit(RAISED)).otherwise(F.lit(0.0)), 2)
        return F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), (s["start"] + F.length(s["value"])).alias("end"), F.lit(kind).alias("kind"), score.alias("score"), s["value"].alias("value"))

    return F.transform(F.filter(matches, lambda s: CONFIRMED[kind](s["value"])), one)


def find(docs: DataFrame, text_col: str = "text", spans_col: str = "spans", min_score: float = 0.7) -> DataFrame:
    """docs with spans_col, an array of (start, rank, end, kind, score, value) by start and kind.

    Null texts are searched as empty ones and have no spans. Spans of the base kinds stay whatever
    their score, others from min_score. Spans of different kinds may overlap. A column named spans_col
    is replaced; repeated rows have equal spans; an empty table gives no rows.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    kept = [docs[c] for c in docs.columns if c != spans_col]
    raw = docs.select(*kept, F.struct(*[_proposed(text, k).alias(k) for k in KINDS]).alias(spans_col))
    placed = raw.withColumn(spans_col, F.struct(*[_placed(raw[spans_col][k]).alias(k) for k in KINDS]))
    each = [_scored(k, placed[spans_col][k]) for k in KINDS]
    found = F.filter(F.concat(*each), lambda s: s["kind"].isin(*BASE) | (s["score"] >= min_score))
    return placed.withColumn(spans_col, F.array_sort(found))


def of_kinds(spans: Column, *kinds: str) -> Column:
    """The spans of some kinds."""
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def listed(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scores(spans: Column) -> Column:
    """The score of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: s["score"].cast("string")), ",")


def redacted(text: Column, spans: Column) -> Column:
    """text with every span, overlapping ones together, replaced by its kind in capitals; null stays null."""

    def replaced(group: Column) -> Column:
        first = F.get(group, F.lit(0))["at"]
        part = F.struct(F.substring(text, first + 1, F.element_at(group, -1)["start"] - first).alias("part"), first.alias("first"))
        each = lambda b, c: F.concat(F.substring(b["part"], c["at"] - b["first"] + 1, c["start"] - c["at"]), F.lit("["), F.upper(c["kind"]), F.lit("]"))
        return _let(part, lambda b: F.array_join(F.transform(group, lambda c: each(b, c)), ""))

    def whole(spans: Column) -> Column:
        reach = _running(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b))  # the furthest end before each span
        cuts = F.zip_with(spans, reach, lambda s, at: F.struct(at.alias("at"), s["start"].alias("start"), s["kind"].alias("kind")))
        last = F.array_max(F.transform(spans, lambda s: s["end"]))
        made = F.transform(_grouped(F.filter(cuts, lambda c: c["start"] >= c["at"])), replaced)
        return F.concat(F.array_join(made, ""), F.substring(text, last + 1, F.length(text)))

    return F.when(F.size(spans) > 0, _let(spans, whole)).otherwise(text)
