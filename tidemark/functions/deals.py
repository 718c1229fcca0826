"""What texts of deals and delistings say: exchange ratios, acquirers, elections, and the rule a security was removed under."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.scalar import normal_name
from tidemark.functions.text import per_share_cash, strip_html

# Tokens that end a company's name, words that name a party without naming a company, words that begin a
# sentence, endings that don't tell companies apart, and how far a text is read around a heading or before a citation.
NAME_ENDS = ("inc", "incorporated", "corp", "corporation", "llc", "l.l.c", "ltd", "limited", "plc", "lp", "l.p", "n.v", "s.a", "co")
PARTIES = ("parent", "purchaser", "buyer", "company", "the company", "sub", "merger sub", "merger subsidiary", "acquiror", "acquirer")
SENTENCE_STARTS = ("The", "A", "An", "This", "It", "In", "On", "As", "At")
KEY_ENDS = ("inc", "incorporated", "corp", "corporation", "co", "company", "ltd", "limited", "llc", "plc", "lp", "nv", "sa", "holdings", "group")
SECTION_CHARS = 8000
MARK_CHARS = 90

_WORD = r"[A-Z0-9][A-Za-z0-9&.'’-]*"
_NAME = rf"({_WORD}(?: (?:{_WORD}|of|and|&)){{0,6}}(?:, ?(?:Inc|Incorporated|Corp|Corporation|Co|Company|Ltd|Limited|LLC|L\.L\.C|L\.P|LP|plc|PLC|N\.V|S\.A)\b\.?)?)"
_RATIO = r"(?i)([0-9]+\.[0-9]{1,6}) (?:validly issued[a-z0-9_ ,-]{0,60}? ?)?shares? of (.{0,100}?)for each share"
_CITED = r"(?i)12d2[-_]2\s*\(\s*([abc])\s*\)(?:\s*\(\s*([1-4])\s*\))?"
_CHECKED = r"[☒☑]|\[[Xx]\]|\(X\)"
_MARK = rf"{_CHECKED}|☐|\[\s*\]|\[_+\]"


def _flat(text: Column) -> Column:
    return F.regexp_replace(text, r"\s+", " ")


def company_name(found: Column) -> Column:
    """A name as found in a sentence, cut off at its first ending; null for parties that name no company, and for what is too short or long."""
    tokens = F.split(F.trim(found), " ")
    ends = F.transform(tokens, lambda t, i: (i >= 1) & F.regexp_replace(F.lower(t), r"^[.,]+|[.,]+$", "").isin(*NAME_ENDS))
    cut = F.array_position(ends, True)
    words = F.array_join(F.when(cut > 0, F.slice(tokens, 1, F.greatest(cut.cast("int"), F.lit(1)))).otherwise(tokens), " ")
    name = F.regexp_replace(F.regexp_replace(words, rf"(?:(?:^| )(?:{'|'.join(SENTENCE_STARTS)}))+$", ""), r"^[ ,;]+|[ ,;]+$", "")
    plain = F.regexp_replace(F.lower(name), r"\.+$", "")
    return F.when(F.length(name).between(3, 100) & ~plain.isin(*PARTIES) & ~plain.startswith("merger sub"), name)


def acquirers(text: Column) -> Column:
    """Names of who a company merges with, is bought by or belongs to from now on, and of who is defined as the parent."""
    x = _flat(text)
    bought = F.regexp_extract_all(x, F.lit(rf"(?:[Mm]erger with|[Aa]cquired by|[Ww]holly[ -]owned subsidiary of) {_NAME}"), F.lit(1))
    defined = F.regexp_extract_all(x, F.lit(rf"{_NAME} ?\((?:the )?[“\"']Parent[”\"']\)"), F.lit(1))
    return F.array_compact(F.transform(F.concat(bought, defined), company_name))


def stock_ratios(text: Column) -> Column:
    """(ratio, company) of every 'ratio shares of company for each share'; whole numbers of shares are no ratios, a company may be null."""
    found = F.regexp_extract_all(_flat(text), F.lit(_RATIO), F.lit(0))

    def one(x: Column) -> Column:
        of = F.regexp_replace(F.trim(F.regexp_extract(x, _RATIO, 2)), r"(?i)^(?:common|capital) stock of ", "")
        return F.struct(F.regexp_extract(x, _RATIO, 1).cast("double").alias("ratio"), company_name(F.regexp_extract(of, _NAME, 1)).alias("company"))

    return F.transform(found, one)


def elects(text: Column) -> Column:
    """Whether holders choose what they receive."""
    return F.coalesce(_flat(text).rlike(r"(?i)elect(?:ion|ed|s)? to receive|at the election of (?:the )?holders?"), F.lit(False))


def _starts(text: Column, pattern: str) -> Column:
    """Places, from 1, at which a pattern is found in a text."""
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern)
    length = lambda xs, n: F.aggregate(F.slice(xs, 1, n), F.lit(0), lambda acc, x: acc + F.length(x))
    return F.transform(found, lambda _, i: length(between, i + 1) + length(found, i) + 1)


def consideration_section(text: Column, chars: int = SECTION_CHARS) -> Column:
    """The stretch after the first heading of a merger consideration in which cash or a ratio is found; null where there is none."""
    windows = F.transform(_starts(text, r"(?i)(?:the\s+)?merger\s+consideration"), lambda at: F.substr(text, at, F.lit(chars)))
    return F.get(F.filter(windows, lambda w: (F.size(per_share_cash(w)) > 0) | (F.size(stock_ratios(w)) > 0)), F.lit(0))


def company_key(name: Column) -> Column:
    """What tells companies apart in a name: small letters and digits without endings, one word at least."""
    return normal_name(F.replace(name, F.lit("’"), F.lit("")), KEY_ENDS)


def _provisions(texts: Column) -> Column:
    """Keys a, a1 … a4, b, c of the first citation in each text; sections below b and c don't count."""
    letter = lambda x: F.lower(F.regexp_extract(x, _CITED, 1))
    keys = F.transform(texts, lambda x: F.when(letter(x) == "a", F.concat(letter(x), F.regexp_extract(x, _CITED, 2))).otherwise(letter(x)))
    return F.array_sort(F.array_distinct(F.filter(keys, lambda k: k != "")))


def removal_rule(doc: Column) -> Column:
    """(rule, note) of a notice of removal from listing.

    Where a notice is structured, the provisions it states count. In older ones it is a tag. In a form that lists all
    provisions with boxes, those count whose nearest box before them, 90 characters back at most, is ticked; without any
    boxes the one that is cited. Several of one family give the family, of different families nothing, with a note.
    """
    structured = doc.rlike(r"(?i)<\s*(?:ruleProvision|descriptionClassSecurity)\b")
    stated = _provisions(F.regexp_extract_all(doc, F.lit(r"(?is)<\s*ruleProvision\s*>(.*?)<\s*/\s*ruleProvision\s*>"), F.lit(1)))
    tags = F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(doc, F.lit(r"(?i)rule12d2[-_]?2([abc])\b"), F.lit(1)), F.lower)))
    boxes = F.replace(F.replace(F.replace(doc, F.lit("&#9746;"), F.lit("☒")), F.lit("&#9744;"), F.lit("☐")), F.lit("&#9745;"), F.lit("☑"))

    def read(text: Column) -> Column:
        """(cited, boxed, chosen) of the text of a form."""
        cited, boxed = F.regexp_extract_all(text, F.lit(_CITED), F.lit(0)), text.rlike(_MARK)

        def ticked(x: Column, at: Column) -> Column:
            from_ = F.greatest(at - MARK_CHARS, F.lit(1))
            last = F.regexp_extract(F.substr(text, from_, at - from_), rf"(?s)^.*({_MARK})", 1)
            return F.when(last.rlike(_CHECKED), x)

        return F.struct((F.size(cited) > 0).alias("cited"), boxed.alias("boxed"), F.when(boxed, F.array_compact(F.zip_with(cited, _starts(text, _CITED), ticked))).otherwise(cited).alias("chosen"))

    # the text is a variable of the lambda, so that it is made once a form, and only of forms
    form = F.get(F.transform(F.array(F.when(structured | (F.size(tags) > 0), "").otherwise(strip_html(boxes))), read), F.lit(0))
    keys = F.when(structured, stated).when(F.size(tags) > 0, tags).otherwise(_provisions(form["chosen"]))
    families = F.array_distinct(F.transform(keys, lambda k: F.substring(k, 1, 1)))
    rule = F.when(F.size(keys) == 1, F.get(keys, F.lit(0))).when(F.size(families) == 1, F.get(families, F.lit(0)))
    note = F.when(F.size(families) > 1, F.concat(F.lit("several families: "), F.array_join(keys, ","))).when(F.size(keys) > 1, F.concat(F.lit("one family: "), F.array_join(keys, ","))).when((F.size(keys) == 0) & form["boxed"] & form["cited"], "none ticked")
    return F.struct(rule.alias("rule"), note.alias("note"))
