"""Deal texts, rules of removal and decisions on outcomes, by known values."""

import math
from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark import queries as q
from tidemark.functions import deals
from tidemark.operators import outcomes

ACQUIRERS = {
    "completed its merger with Acme Holdings, Inc. on June 27": ["Acme Holdings, Inc."],
    "the Company was acquired by Global Payments Inc. pursuant to the Merger Agreement": ["Global Payments Inc."],
    "the Company became a wholly owned subsidiary of Blackstone Inc.": ["Blackstone Inc."],
    "Falcon Bidco Corp. (“Parent”) caused Merger Sub to merge": ["Falcon Bidco Corp."],
    "the Company was acquired by Global Payments Inc. The transaction closed": ["Global Payments Inc."],
    "the merger with Merger Sub was completed": [],
    "the merger with the surviving corporation": [],
    "became a wholly owned subsidiary of Parent": [],
    "": [],
}
RATIOS = {
    "0.7136 shares of Acquirer Inc. common stock for each share of Company common stock": [(0.7136, "Acquirer Inc.")],
    "purchased 100 shares of common stock for each share plan participant": [],
    "the right to receive $3.50 per share in cash and 0.7136 shares of Acquirer Inc. common stock for each share of Company Common Stock": [(0.7136, "Acquirer Inc.")],
    "each share was converted into 0.3163 shares of Apollo Endosurgery, Inc. common stock for each share held": [(0.3163, "Apollo Endosurgery, Inc.")],
    "0.5000 shares of common stock of Acme Corp. for each share": [(0.5, "Acme Corp.")],
    "0.2500 shares of capital stock of Beta Holdings, Inc. for each share": [(0.25, "Beta Holdings, Inc.")],
    "0.4000 shares of Parent common stock for each share": [(0.4, None)],
    "": [],
}
KEYS = {"Acme Inc.": "acme", "Acme Holdings, Inc.": "acme", "Falcon Bidco Corp.": "falcon bidco", "Global Payments Inc.": "global payments", "O'Reilly Automotive, Inc.": "oreilly automotive", "O’Reilly": "oreilly", "Foo N.V.": "foo", "Holdings": "holdings"}
FORM = "<html><body><p>Common Stock</p>" + "".join(f"<p>{'&#9746;' if c == '(c)' else '&#9744;'} Pursuant to 17 CFR 240.12d2-2{c}, the Issuer has complied with the rules of the Exchange governing the removal of the class from listing.</p>" for c in ("(a)(1)", "(a)(2)", "(a)(3)", "(a)(4)", "(b)", "(c)")) + "</body></html>"
STATED = "<notice><descriptionClassSecurity>Common Stock</descriptionClassSecurity>%s</notice>"
A3, C = "<ruleProvision>17 CFR 240.12d2-2(a)(3)</ruleProvision>", "<ruleProvision>17 CFR 240.12d2-2(c)</ruleProvision>"
RULES = {
    STATED % A3: ("a3", None), STATED % C: ("c", None), STATED % "": (None, None), STATED % (A3 + A3): ("a3", None), STATED % (A3 + C): (None, "several families: a3,c"),
    FORM: ("c", None),
    "☐ 17 CFR 240.12d2-2(a)(1). The entire class has been redeemed. ☒ Pursuant to 17 CFR 240.12d2-2(c), the Issuer has complied with the rules.": ("c", None),
    "[ ] 17 CFR 240.12d2-2(a)(1). The entire class has been redeemed. [X] Pursuant to 17 CFR 240.12d2-2(c), the Issuer has complied with the rules.": ("c", None),
    "☒ 17 CFR 240.12d2-2(a)(1). The entire class of the security has been redeemed. ☐ Pursuant to 17 CFR 240.12d2-2(c), the Issuer has complied.": ("a1", None),
    "☒ 17 CFR 240.12d2-2(a)(3). The class has been exchanged. ☒ Pursuant to 17 CFR 240.12d2-2(c), the Issuer has complied.": (None, "several families: a3,c"),
    "☒ 17 CFR 240.12d2-2(a)(3). Exchanged for another security. ☒ 17 CFR 240.12d2-2(a)(4). Instrument evidences another security.": ("a", "one family: a3,a4"),
    "☐ 17 CFR 240.12d2-2(b). The Exchange has filed to strike the class. ☐ Pursuant to 17 CFR 240.12d2-2(c), the Issuer has complied.": (None, "none ticked"),
    "securities may be stricken under 17 CFR 240.12d2-2(a)(1), 17 CFR 240.12d2-2(b) or 17 CFR 240.12d2-2(c)": (None, "several families: a1,b,c"),
    "removal pursuant to Rule 12d2-2(c)(2) notice requirements": ("c", None),
    "pursuant to 17 CFR 240.12d2-2(b) the exchange...": ("b", None), "<rule12d2-2c>X</rule12d2-2c>": ("c", None),
    "12d2-2(a) [ ]  12d2-2(b) [ ]  12d2-2(c) [X]": (None, "none ticked"), "nothing relevant here": (None, None), "": (None, None),
    "Rule 12D2-2 ( A ) applies": ("a", None),
}


def by_text(spark, texts, f):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return {r.t: r.x for r in df.select("t", f(F.col("t")).alias("x")).collect()}


def test_names_of_acquirers(spark):
    assert by_text(spark, ACQUIRERS, deals.acquirers) == ACQUIRERS
    assert by_text(spark, KEYS, deals.company_key) == KEYS


def test_ratios(spark):
    got = {t: [tuple(x) for x in xs] for t, xs in by_text(spark, RATIOS, deals.stock_ratios).items()}
    assert got == RATIOS


def test_rules_of_removal(spark):
    got = {t: tuple(x) for t, x in by_text(spark, RULES, deals.removal_rule).items()}
    assert got == RULES


def test_nulls_in_texts(spark):
    one = spark.range(1).select(F.lit(None).cast("string").alias("t"))
    row = one.select(deals.acquirers(F.col("t")).alias("a"), deals.stock_ratios(F.col("t")).alias("s"), deals.removal_rule(F.col("t"))["rule"].alias("r"), deals.elects(F.col("t")).alias("e"), deals.consideration_section(F.col("t")).alias("c"), deals.company_key(F.col("t")).alias("k")).first()
    assert (row.a or [], row.s or [], row.r, row.e, row.c, row.k) == ([], [], None, False, None, None)


def test_section_with_terms(spark):
    toc = "The Merger Consideration, page 12. " + "x " * 5000
    body = "Merger Consideration. Each share becomes the right to receive $12.00, without interest, in cash."
    got = by_text(spark, [toc + body, toc, ""], deals.consideration_section)
    assert got == {toc + body: body, toc: None, "": None}


def terms(spark, *docs):
    df = spark.createDataFrame([(1, form, text) for form, text in docs], "id long, form string, text string")
    return outcomes.consideration(df, "id", "form", "text").first()


def test_what_texts_agree_on(spark):
    cash = "the right to receive $%s in cash"
    t = terms(spark, ("8-K", cash % "10.00"), ("8-K", cash % "10.00" + " and " + cash % "9.00"), ("8-K", None))
    assert (t.cash, t.ratio, t.acquirer, t.election, t.note) == (10.0, None, None, False, "")
    t = terms(spark, ("8-K", cash % "10.00"), ("8-K", cash % "9.00"))
    assert (t.cash, t.note) == (None, "several amounts")
    shares = "0.50 shares of Acme Corp. common stock for each share"
    t = terms(spark, ("8-K", shares), ("8-K", shares.replace("Corp.", "Corp") + ", at the election of the holders; acquired by Zed Holdings, Inc. today"))
    assert (t.ratio, t.priced_by, t.acquirer, t.election) == (0.5, "Acme Corp", "Zed Holdings, Inc.", True)
    t = terms(spark, ("8-K", shares), ("8-K", shares.replace("0.50", "0.60")))
    assert (t.ratio, t.note) == (None, "several ratios")
    t = terms(spark, ("DEF 14A", "you may elect to receive future proxy materials electronically"), ("8-K", cash % "10.00"))
    assert (t.cash, t.election) == (10.0, False)
    t = terms(spark, ("DEFM14A", "the right to receive $77.00 in cash. " + "Merger Consideration: " + cash % "5.00"))
    assert t.cash == 5.0


def test_acquirers_are_one_security_or_none(spark):
    s = spark.createDataFrame([(1, "Acme Inc."), (2, "Beta Corp"), (3, "Beta Holdings"), (4, None)], "sid long, firm string")
    names = spark.createDataFrame([("ACME Holdings, Inc.",), ("Beta, Ltd.",), ("Nobody",), (None,), ("",)], "name string")
    got = {r.name: (r.acquirer_id, r.candidates) for r in outcomes.named_security(names, "name", s, "sid", "firm").collect()}
    assert got == {"ACME Holdings, Inc.": (1, 1), "Beta, Ltd.": (None, 2), "Nobody": (None, 0), None: (None, 0), "": (None, 0)}


FIELDS = {"kind": "string", "form25": "boolean", "rule": "string", "item_201": "boolean", "item_103": "boolean", "item_301": "boolean", "merged": "boolean", "pattern": "string", "cash": "double", "ratio": "double", "election": "boolean", "acquirer_close": "double", "final_price": "double"}
HIGH25 = {"form25": True}
CASES = [
    ({"item_201": True}, ("MERGER", "HIGH", "8K", None, False)),
    ({"item_201": True, **HIGH25}, ("MERGER", "HIGH", "FORM25", None, False)),
    *[({**HIGH25, "rule": r}, (reason, "HIGH", "FORM25", None, False)) for r, reason in (("a", "MERGER"), ("a1", "LIQUIDATION"), ("a2", "LIQUIDATION"), ("a3", "MERGER"), ("a4", "MERGER"), ("b", "EXCHANGE_DROP"), ("c", "VOLUNTARY"))],
    ({**HIGH25, "rule": "c", "item_201": True}, ("MERGER", "HIGH", "FORM25", None, False)),
    *[({"kind": "ETF", **HIGH25, "rule": r}, ("FUND_CLOSURE", "HIGH", "FORM25", None, False)) for r in ("a1", "c")],
    ({"kind": "ETF", **HIGH25, "rule": "b", "item_103": True, "final_price": 0.05}, ("EXCHANGE_DROP", "HIGH", "FORM25", None, False)),
    (HIGH25, ("UNKNOWN", None, "FORM25", None, False)),
    ({"merged": True}, ("MERGER", "MEDIUM", "TICKER_EVENT", None, False)),
    ({"merged": True, "item_201": True}, ("MERGER", "HIGH", "8K", None, False)),
    ({"merged": True, "cash": 10.05}, ("MERGER", "MEDIUM", "TICKER_EVENT", None, False)),
    ({"kind": "ETF", "item_301": True}, ("FUND_CLOSURE", "MEDIUM", "TICKER_EVENT", None, False)),
    ({"item_301": True, "pattern": "EXCHANGE_DROP"}, ("EXCHANGE_DROP", "MEDIUM", "8K", None, False)),
    ({"merged": True, "item_301": True}, ("MERGER", "MEDIUM", "TICKER_EVENT", None, False)),
    ({"pattern": "ACQUISITION_CASH"}, ("ACQUISITION_CASH", "LOW", "PRICE_INFERRED", None, False)),
    ({}, ("UNKNOWN", None, None, None, False)),
    ({"item_201": True, "cash": 10.05}, ("ACQUISITION_CASH", "HIGH", "8K", 0.005, False)),
    ({"item_201": True, "cash": 10.05, "election": True}, ("ACQUISITION_CASH", "HIGH", "8K", 0.005, False)),
    ({"item_201": True, "cash": 10.05, "final_price": None}, ("ACQUISITION_CASH", "HIGH", "8K", None, False)),
    ({"item_201": True, "cash": 16.0}, ("ACQUISITION_CASH", "HIGH", "8K", None, True)),
    ({"item_201": True, "ratio": 0.7136}, ("ACQUISITION_STOCK", "HIGH", "8K", None, False)),
    ({"item_201": True, "ratio": 0.5, "acquirer_close": 21.0}, ("ACQUISITION_STOCK", "HIGH", "8K", 0.05, False)),
    ({"item_201": True, "ratio": 0.5, "acquirer_close": 21.0, "election": True}, ("ACQUISITION_STOCK", "HIGH", "8K", None, False)),
    ({"item_201": True, "ratio": 0.5, "cash": 2.5, "acquirer_close": 16.0}, ("MERGER", "HIGH", "8K", 0.05, False)),
    ({"item_201": True, "ratio": 0.5, "acquirer_close": 100.0}, ("ACQUISITION_STOCK", "HIGH", "8K", None, True)),
    *[({**HIGH25, "rule": r, "cash": 10.05}, ("ACQUISITION_CASH", "HIGH", "FORM25", 0.005, False)) for r in ("a", "a3", "a4")],
    ({**HIGH25, "rule": "a3", "ratio": 0.5, "cash": 2.5}, ("MERGER", "HIGH", "FORM25", None, False)),
    ({**HIGH25, "rule": "a1", "cash": 10.05}, ("LIQUIDATION", "HIGH", "FORM25", None, False)),
    ({**HIGH25, "rule": "b", "item_103": True, "cash": 0.05, "final_price": 0.05}, ("BANKRUPTCY", "HIGH", "FORM25", -1.0, False)),
    ({**HIGH25, "rule": "b", "item_103": True}, ("EXCHANGE_DROP", "HIGH", "FORM25", None, False)),
    ({**HIGH25, "rule": "b", "final_price": 0.05}, ("EXCHANGE_DROP", "HIGH", "FORM25", None, False)),
    ({**HIGH25, "rule": "b", "item_103": True, "item_201": True, "final_price": 0.05}, ("MERGER", "HIGH", "FORM25", None, False)),
]


def test_decisions(spark):
    rows = [(i, *[({"kind": "CS", "final_price": 10.0} | case).get(f) for f in FIELDS]) for i, (case, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i long, " + ", ".join(f"{f} {t}" for f, t in FIELDS.items()))
    got = {r.i: (r.reason, r.confidence, r.source, r.delisting_return, r.out_of_limits) for r in outcomes.decided(df).collect()}
    assert got == {i: pytest.approx(want) if want[3] else want for i, (_, want) in enumerate(CASES)}


def test_cash_that_is_believed(spark):
    rows = [(1.9, None, 10.0, None), (2.0, None, 10.0, 2.0), (50.0, None, 10.0, 50.0), (51.0, None, 10.0, None), (1.0, 0.5, 10.0, 1.0), (99.0, None, None, 99.0), (None, None, 10.0, None)]
    df = spark.createDataFrame(rows, "cash double, ratio double, final double, want double")
    assert all(r.got == r.want for r in df.select("want", outcomes.believable_cash(F.col("cash"), F.col("ratio"), F.col("final")).alias("got")).collect())


def test_filings_near_a_day(spark):
    filings = spark.createDataFrame([(1, "2025-05-01", "x"), (1, "2025-07-31", "y"), (2, "2025-06-01", "x"), (None, "2025-06-01", "x")], "id long, filed string, form string").withColumn("filed", F.to_date("filed"))
    cases = spark.createDataFrame([(1, "2025-06-30"), (2, "2025-06-30"), (2, "2024-06-30"), (3, "2025-06-30"), (3, None)], "id long, until string").withColumn("until", F.to_date("until"))
    got = {(r.id, str(r.until)): (r.x, r.y) for r in outcomes.near(filings, cases, "id", "filed", "until", x=(F.col("form") == "x", 60, 0), y=(F.col("form") == "y", 0, 30)).collect()}
    assert got == {(1, "2025-06-30"): (True, False), (2, "2025-06-30"): (True, False), (2, "2024-06-30"): (False, False), (3, "2025-06-30"): (False, False), (3, "None"): (False, False)}


def test_returns_are_rounded_once(spark):
    row = {"kind": "CS", "item_201": True, "cash": 15.887610000000002, "final_price": 20.0}
    df = spark.createDataFrame([tuple(row.get(f) for f in FIELDS)], ", ".join(f"{f} {t}" for f, t in FIELDS.items()))
    got = outcomes.decided(df, digits=None).select(F.round("delisting_return", 6)).first()[0]
    assert got == -0.205619 and outcomes.decided(df).select("delisting_return").first()[0] == -0.2056195


def test_limits_are_products_of_decimals(spark):
    """0.6 of 23 is 13.8 and 0.2 of it 4.6; products of doubles are 13.799999999999999 and 4.6000000000000005."""
    rows = [(23.0, 13.799999999999999, True), (23.0, 13.8, False), (0.05, 0.07500000000000001, True), (0.05, 0.075, False), (1e-14, 1e-14, False), (math.nan, 1.0, True), (math.inf, 1.0, True)]
    cases = [tuple({"kind": "CS", "item_201": True, "cash": worth, "final_price": price}.get(f) for f in FIELDS) for price, worth, _ in rows]
    df = spark.createDataFrame([(i, *case) for i, case in enumerate(cases)], "i long, " + ", ".join(f"{f} {t}" for f, t in FIELDS.items()))
    assert [r.out_of_limits for r in outcomes.decided(df).orderBy("i").collect()] == [beyond for *_, beyond in rows]
    cash = spark.createDataFrame([(4.6, 23.0), (4.6000000000000005, 23.0), (4.599999999999999, 23.0)], "cash double, final double")
    assert [r.c for r in cash.select(outcomes.believable_cash(F.col("cash"), F.lit(None), F.col("final")).alias("c")).collect()] == [4.6, 4.6000000000000005, None]


def test_firms_with_numbers_below_zero_are_firms_of_their_own(spark, tmp_path):
    """Supplier 0 is firm -1, which must not make firm 1, the acquirer, ambiguous."""
    day = lambda *x: datetime(*x)
    deals_ = [(k, 8, "F", 100.0, day(1999, 6, 1), "5-LOW") for k in (1, 12, 29)]  # ratios of firms 2 and 6, cash of firm 1
    tables = {
        "orders": ([*deals_, (2, 8, "F", 100.0, day(2000, 1, 21), "2-HIGH")], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": ([(2, 1, 1, 1, 10.0, 26000.0, day(2000, 1, 1))], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate timestamp"),
        "customer": ([(8,)], "c_custkey long"),
        "supplier": ([(0,), (1,), (2,)], "s_suppkey long"),
    }
    con = duckdb.connect()
    for t, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{t}.parquet")
        con.sql(f"CREATE VIEW {t} AS FROM '{tmp_path}/{t}.parquet/*.parquet'")
    columns = ["id", "reason", "confidence", "source", "acquirer", "delisting_return", "out_of_limits"]
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({q.SQL['delisting_outcomes']})").fetchall()
    got = [tuple(r) for r in entry.queries()["delisting_outcomes"](spark, str(tmp_path)).select(*columns).collect()]
    assert got == want == [(8, "MERGER", "HIGH", "8K", "Firm 1 Holdings, Inc.", -0.015385, False)]
