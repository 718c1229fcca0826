"""Readers of feeds: their texts in a column, their rows out; all from built-in functions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def calendar(spark: SparkSession, first: str, last: str, is_open: Callable[[Column], Column], is_half: Callable[[Column], Column] | None = None) -> DataFrame:
    """(date, is_open, hours): every weekday from first to last; hours of trading are null on closed ones."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("date")).where("weekday(date) < 5")
    d = F.col("date")
    return days.select("date", is_open(d).alias("is_open"), F.when(is_open(d), F.when(is_half(d) if is_half else F.lit(False), 3.5).otherwise(6.5)).alias("hours"))


def fails_to_deliver(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """(cusip, symbol): distinct pairs of lines separated by bars; the header, short codes and blank symbols are left out."""
    p = F.split(F.col(value_col), r"\|")
    pairs = lines.select(F.upper(F.trim(F.get(p, F.lit(1)))).alias("cusip"), F.lower(F.trim(F.get(p, F.lit(2)))).alias("symbol"))
    return pairs.where((F.length("cusip") == 9) & (F.col("symbol") != "")).distinct()


def unpivoted_rates(wide: DataFrame, date_col: str) -> DataFrame:
    """(date, currency, rate) of a table with a text column for each currency; blanks and what is no number are left out."""
    names = [c for c in wide.columns if c != date_col]
    long = wide.unpivot([date_col], names, "currency", "text")
    rate = F.regexp_replace("text", ",", "").try_cast("double")
    return long.select(F.col(date_col).alias("date"), "currency", rate.alias("rate")).where("rate is not null")


def form_index(lines: DataFrame, forms: Sequence[str], value_col: str = "value") -> DataFrame:
    """lines with form, cik, filed and path, read from the right; lines that aren't of that shape or another form are left out."""
    t = F.split(F.trim(F.col(value_col)), r"\s+")
    filed = F.coalesce(F.try_to_timestamp(F.element_at(t, -2), F.lit("yyyy-MM-dd")), F.try_to_timestamp(F.element_at(t, -2), F.lit("yyyyMMdd"))).cast("date")
    found = lines.where(F.size(t) >= 4).select(*[c for c in lines.columns if c != value_col], F.substring_index(value_col, "  ", 1).alias("form"), F.element_at(t, -3).alias("cik"), filed.alias("filed"), F.element_at(t, -1).alias("path"))
    return found.where(F.col("form").isin(list(forms)) & F.col("cik").rlike("^[0-9]+$") & F.col("path").startswith("edgar/data") & F.col("filed").isNotNull())


_FACT = "struct<start:string,end:string,val:double,accn:string,filed:string,form:string,fy:int,fp:string>"


def company_facts(payloads: DataFrame, concepts: Sequence[str], since: str | None = None, payload_col: str = "payload") -> DataFrame:
    """payloads with a row for each fact: taxonomy, concept, unit, period_start, period_end, value, accession, filed.

    Facts of other concepts, without a filing, an end, a value or an accession are left out, and those
    filed before since. An instant's period starts where it ends.
    """
    parsed = F.from_json(payload_col, f"struct<facts:map<string,map<string,struct<units:map<string,array<{_FACT}>>>>>>")["facts"]
    keys = [c for c in payloads.columns if c != payload_col]
    t = payloads.select(*keys, F.explode(parsed).alias("taxonomy", "_c"))
    c = t.select(*keys, "taxonomy", F.explode("_c").alias("concept", "_u")).where(F.col("concept").isin(list(concepts)))
    u = c.select(*keys, "taxonomy", "concept", F.explode("_u.units").alias("unit", "_f"))
    f = u.select(*keys, "taxonomy", "concept", "unit", F.explode("_f").alias("f")).where("f.filed is not null and f.end is not null and f.val is not null and f.accn is not null")
    rows = f.select(*keys, "taxonomy", "concept", "unit", F.coalesce("f.start", "f.end").cast("date").alias("period_start"), F.col("f.end").cast("date").alias("period_end"), F.col("f.val").alias("value"), F.col("f.accn").alias("accession"), F.col("f.filed").cast("date").alias("filed"))
    return rows if since is None else rows.where(F.col("filed") >= F.lit(since).cast("date"))


def ownership(docs: DataFrame, xml_col: str = "xml") -> DataFrame:
    """docs with a row for each transaction and reporting owner: n, owner, code, shares, price, value."""
    schema = "owner array<string>, transaction array<struct<code:string,shares:double,price:double>>"
    x = F.from_xml(xml_col, schema, {"rowTag": "document"})
    keys = [c for c in docs.columns if c != xml_col]
    rows = docs.select(*keys, x.alias("x")).select(*keys, F.col("x.owner").alias("o"), F.posexplode("x.transaction").alias("n", "t"))
    return rows.select(*keys, "n", F.explode("o").alias("owner"), "t.code", "t.shares", "t.price", F.round(F.col("t.shares") * F.col("t.price"), 6).alias("value"))


_FILER = "headerData struct<submissionType:string,filerInfo:struct<filer:struct<credentials:struct<cik:string>>,periodOfReport:string>>, formData struct<coverPage:struct<filingManager:struct<name:string>,form13FFileNumber:string>>"
_HOLDING = "nameOfIssuer:string,titleOfClass:string,cusip:string,value:string,shrsOrPrnAmt:struct<sshPrnamt:string,sshPrnamtType:string>,putCall:string,investmentDiscretion:string,otherManager:string,votingAuthority:struct<Sole:string,Shared:string,None:string>"


def holdings_reports(filings: DataFrame, accession_col: str, filed_col: str | None = None, text_col: str = "text", dollars_since: str = "2023-01-03") -> DataFrame:
    """filings with a row for each holding of a whole submission: n, its place from 0, row_hash, filer and security columns.

    A submission holds a cover document and an information table among others, with any prefix of names. What the cover
    doesn't tell, because it is missing or broken, is read in the header before them: form, period and cik. A submission
    without a table gives no rows; equal holdings are rows of their own. Amounts that are no numbers are null. Values were
    reported in thousands before dollars_since; with filed_col there is value_usd, the value in dollars whenever it was filed.
    """
    keys = [c for c in filings.columns if c != text_col]
    # what stands between <XML> and the next </XML>: split at fixed marks, since a lazy pattern looks for the end at every letter
    parts = F.transform(F.slice("_parts", 1, F.size("_parts") - 1), lambda x: F.get(F.split(x, "<XML>", 2), F.lit(1)))
    bare = F.transform(F.array_compact(parts), lambda x: F.btrim(x, F.lit(" \t\n\x0b\f\r")))
    stripped = F.transform(bare, lambda x: F.regexp_replace(F.regexp_replace(x, r"(?s)^\s*<\?xml.*?\?>\s*", ""), r"(</?)[A-Za-z_][\w.-]*:", "$1"))
    plain = F.col("_plain")
    # a root that isn't closed is a broken document
    root = lambda tag: F.get(F.filter(plain, lambda x: x.rlike(rf"(?s)^<{tag}[\s>].*</{tag}>\s*$")), F.lit(0))
    header = lambda field: F.nullif(F.trim(F.regexp_extract(text_col, rf"(?m)^[ \t]*{field}:[ \t]*(\S.*)$", 1)), F.lit(""))
    x = filings.withColumn("_parts", F.split(text_col, "</XML>")).withColumn("_plain", stripped).select(
        *keys, F.from_xml(root("edgarSubmission"), _FILER, {"rowTag": "edgarSubmission"}).alias("_c"), F.from_xml(root("informationTable"), f"infoTable array<struct<{_HOLDING}>>", {"rowTag": "informationTable"})["infoTable"].alias("_t"),
        header("CONFORMED PERIOD OF REPORT").alias("_period"), header("CONFORMED SUBMISSION TYPE").alias("_form"), header("CENTRAL INDEX KEY").alias("_cik"),
    )
    date = lambda c, form: F.try_to_timestamp(c, F.lit(form)).cast("date")
    text = lambda c, width: F.substring(F.nullif(F.trim(c), F.lit("")), 1, width)
    number = lambda c: F.replace(F.trim(c), F.lit(","), F.lit("")).try_cast("decimal(28,4)")
    cik = F.coalesce(text(F.col("_c.headerData.filerInfo.filer.credentials.cik"), 10), F.col("_cik"))
    # what a submission tells is worked out once, before its holdings are rows; the outer explode keeps Spark from asking for
    # tables with rows below, in the condition of a join even, which would read every text twice
    told = x.select(
        *keys, F.lpad(F.when(cik.rlike("^[0-9]+$"), cik), 10, "0").alias("filer_cik"), text(F.coalesce("_c.headerData.submissionType", "_form"), 20).alias("form_type"),
        F.coalesce(date(F.col("_c.headerData.filerInfo.periodOfReport"), "MM-dd-yyyy"), date(F.col("_period"), "yyyyMMdd")).alias("period"),
        text(F.col("_c.formData.coverPage.filingManager.name"), 255).alias("filer_name"), text(F.col("_c.formData.coverPage.form13FFileNumber"), 50).alias("file_number"), "_t",
    )
    told = told.select(*keys, "filer_cik", "form_type", "period", "filer_name", "file_number", F.posexplode_outer("_t").alias("n", "_h")).where("n is not null").withColumn("_value", number(F.col("_h.value")))
    value = F.col("_value")
    usd = [] if filed_col is None else [F.when(F.col(filed_col) < F.lit(dollars_since).cast("date"), value * 1000).otherwise(value).cast("decimal(31,4)").alias("value_usd")]
    return told.select(
        *keys, "n", F.sha2(F.concat_ws("|", F.col(accession_col).cast("string"), F.col("n").cast("string")), 256).alias("row_hash"), "filer_cik", "form_type", "period", "filer_name", "file_number",
        text(F.col("_h.nameOfIssuer"), 255).alias("issuer_name"), text(F.col("_h.titleOfClass"), 100).alias("title_of_class"), text(F.col("_h.cusip"), 20).alias("cusip"), value.alias("market_value"), *usd,
        number(F.col("_h.shrsOrPrnAmt.sshPrnamt")).alias("amount"), text(F.col("_h.shrsOrPrnAmt.sshPrnamtType"), 10).alias("amount_type"), text(F.col("_h.putCall"), 10).alias("put_call"), text(F.col("_h.investmentDiscretion"), 20).alias("discretion"),
        text(F.col("_h.otherManager"), 255).alias("other_manager"), *[number(F.col(f"_h.votingAuthority.{v}")).alias(f"voting_{v.lower()}") for v in ("Sole", "Shared", "None")],
    )


def linked(holdings: DataFrame, codes: DataFrame, code: str, ident: str) -> DataFrame:
    """holdings with the id of their code, compared in capitals, where a code is of one id only."""
    one = codes.where(F.col(ident).isNotNull()).groupBy(F.upper(code).alias("_code")).agg(F.min(ident).alias(ident), F.max(ident).alias("_most")).where(F.col(ident) == F.col("_most"))
    return holdings.withColumn("_code", F.upper(code)).join(one.drop("_most"), "_code", "left").drop("_code")
