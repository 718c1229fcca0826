"""Scalar functions on filing and page texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Entities that are decoded, besides &amp;, which comes last so that nothing is decoded twice; others become spaces. Fixed values.
ENTITIES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": " ", "&#160;": " ",
    "&ldquo;": "\u201c", "&rdquo;": "\u201d", "&lsquo;": "\u2018", "&rsquo;": "\u2019", "&ndash;": "\u2013", "&mdash;": "\u2014",
    "&#8220;": "\u201c", "&#8221;": "\u201d", "&#8216;": "\u2018", "&#8217;": "\u2019", "&#8211;": "\u2013", "&#8212;": "\u2014",
}


def strip_html(html: Column) -> Column:
    """The text of a page: comments, scripts, styles and tags go, entities are decoded once, white space is collapsed and goes before punctuation."""
    x = F.regexp_replace(html, r"(?s)<!--.*?-->", " ")
    x = F.regexp_replace(x, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    x = F.regexp_replace(x, r"(?s)<[^>]*>", " ")
    for entity, plain in ENTITIES.items():
        x = F.replace(x, F.lit(entity), F.lit(plain))
    x = F.regexp_replace(x, r"&(?!amp;)#?[A-Za-z0-9]+;", " ")
    x = F.regexp_replace(x, r"[\s\u00a0]+", " ")
    return F.replace(F.trim(F.regexp_replace(x, r" ([,.;:)])", "$1")), F.lit("&amp;"), F.lit("&"))


#: An amount at the start of what follows a dollar sign.
_AMOUNT = r"^ ?([0-9]{1,3}(?:,[0-9]{3})+(?:\.[0-9]+)?|[0-9]+(?:\.[0-9]+)?)"


def dollar_amounts(text: Column, most: float = 10_000.0) -> Column:
    """Dollar amounts, thousands separated by commas, up to most, in the order of the text; amounts in millions or billions are none."""
    raw = F.regexp_extract_all(text, F.lit(r"\$\s?((?>(?:[0-9]{1,3}(?:,[0-9]{3})+|[0-9]+)(?:\.[0-9]+)?))(?!\s*(?:thousand|million|billion|trillion)\b)"), F.lit(1))
    return F.filter(F.transform(raw, lambda x: F.regexp_replace(x, ",", "").cast("double")), lambda x: x <= most)


def per_share_cash(text: Column, most: float = 10_000.0) -> Column:
    """Cash that a deal pays for a share, every mention in the order of the text.

    Each dollar amount is judged by what stands around it, up to the next dollar sign: by its own clause after it, and by the
    160 characters before. An amount per share counts where it is paid in cash, or is a price or consideration. One that says
    nothing of shares counts where holders receive it in cash, unless a word of totals stands before or it is over most.
    Millions and billions, dividends and sums plus dividends don't count.
    """
    parts = F.transform(F.split(text, r"\$"), lambda x: F.regexp_replace(x, r"\s+", " "))
    # everything before the first dollar sign has no amount, but is context
    places = F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1)))

    def at(i: Column) -> Column:
        before, after = F.lower(F.get(parts, i - 1)), F.lower(F.get(parts, i))
        near = F.substring(before, F.greatest(F.length(before) - 159, F.lit(1)), F.lit(160))
        number = F.regexp_extract(after, _AMOUNT, 1)
        clause = F.regexp_extract(F.regexp_replace(after, _AMOUNT, ""), r"^[^.;]{0,90}", 0)
        share = clause.rlike(r"^.{0,60}?\bper share\b") | near.rlike(r"\bper share consideration of $")
        cash = clause.rlike(r"^(?:,? ?(?:without interest|per share|net to the (?:seller|holder)))*,? ?,? in cash\b") | near.rlike(r"\bcash (?:in an amount )?equal to $")
        price = near.rlike(r"\bpurchase price of $") | near.rlike(r"\btender offer to (?:purchase|acquire) all\b[^.]*\bat (?:a price of )?$")
        gets = near.rlike(r"\bright to receive (?:\([a-z0-9]{1,4}\) ?)?$") | near.rlike(r"\bright to receive an? amount (?:in cash )?equal to $") | near.rlike(r"\bconsideration of $")
        total = F.substring(near, -130, 130).rlike(r"\b(?:aggregate|total|entire|combined|overall)\b")
        never = clause.rlike(r"^ ?(?:thousand|million|billion|trillion)\b") | clause.rlike(r"\b(?:accrued|unpaid|dividends?)\b") | near.rlike(r"\bdividends? of $")
        value = F.regexp_replace(number, ",", "").try_cast("double")
        good = F.when(share, cash | price | gets).otherwise(gets & cash & ~total & (value <= most))
        return F.when((number != "") & ~never & good, value)

    return F.array_compact(F.transform(places, at))


def tokens(evidence: Column) -> Column:
    """The map of key=value tokens in a list separated by bars; the last of equal keys counts."""
    parts = F.filter(F.split(evidence, r"\|"), lambda p: F.instr(p, "=") > 1)
    pairs = F.transform(parts, lambda p: F.struct(F.trim(F.substring_index(p, "=", 1)).alias("key"), F.trim(F.substr(p, F.instr(p, "=") + 1)).alias("value")))
    last = F.aggregate(pairs, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")), lambda m, p: F.map_concat(F.map_filter(m, lambda k, v: k != p["key"]), F.create_map(p["key"], p["value"])))
    return last


def has_item(items: Column, item: str) -> Column:
    """Whether a comma list names an item."""
    return F.array_contains(F.transform(F.split(items, ","), lambda x: F.trim(x)), item)


def plain_ticker(symbol: Column) -> Column:
    """Whether a symbol is of an ordinary class: capitals, digits and dots."""
    return symbol.rlike("^[A-Z][A-Z0-9.]*$")


#: Words of instruments that aren't common stock. Fixed values.
OTHER_INSTRUMENTS = ("note", "notes", "preferred", "unit", "units", "warrant", "warrants", "right", "rights", "debenture", "debentures")


def common_equity(name: Column, figi: Column | None = None) -> Column:
    """Whether a name is of common stock: a share-class id says so, else no word of other instruments, no due date and no rate is in it."""
    other = name.rlike(rf"(?i)\b(?:{'|'.join(OTHER_INSTRUMENTS)})\b|(?i)\bdue 20[0-9]{{2}}\b|%")
    known = F.lit(False) if figi is None else F.length(F.trim(figi)) > 0
    return F.coalesce(known, F.lit(False)) | ~F.coalesce(other, F.lit(False))
