"""Amounts in deal texts, texts of pages, and replays of a plan as of an earlier date."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text as tx
from tidemark.operators import fundamentals as fm
from tidemark.plans import evaluate

CASH = {
    "each Share was converted into the right to receive $26.50 in cash, without interest and less applicable withholding taxes": [26.5],
    "holders became entitled to receive $1,264.00 per share in cash": [1264.0],
    "cash in an amount equal to $8.25 per share, without interest": [8.25],
    "the right to receive an amount in cash equal to $12.00 per share": [12.0],
    "the right to receive $12.00, without interest, in cash": [12.0],
    "the right to receive (i) $11.80 in cash, without interest, and (ii) 0.1612 shares of Parent": [11.8],
    "for an aggregate purchase price of $1,200,000,000 in cash": [],
    "in the aggregate, holders will have the right to receive $50,000,000 in cash": [],
    "for an aggregate consideration of $150,000,000, or $26.50 per share in cash": [26.5],
    "converted into the right to receive $26.50 in cash. As a result, each Share represents the right to receive $26.50 in cash.": [26.5, 26.5],
    "the Company repaid $45,000,000 of outstanding debt at closing": [],
    "offered to purchase all outstanding shares at $16.50 per share, net to the seller in cash, without interest": [16.5],
    "$18.00 per share, net to the holder in cash": [18.0],
    "the merger consideration of $12.50 per share in cash, without interest": [12.5],
    "each holder received a per share consideration of $9.00 in cash": [9.0],
    "the right to receive an amount in cash equal to $12.00, without interest, per share": [12.0],
    "the purchase price of $45.00 per share was paid at the effective time": [45.0],
    "commenced a tender offer to purchase all outstanding shares of common stock at a price of $18.00 per share": [18.0],
    "the Board declared a quarterly cash dividend of $0.25 per share payable July 1": [],
    "a tender offer to purchase all outstanding shares for an aggregate of $500,000,000 in cash": [],
    "the right to receive an amount equal to $25.00 plus accrued and unpaid dividends per share": [],
    "the right to receive $3 million in cash": [],
    "": [], "$": [], "no amount at all": [],
}


def test_cash_per_share(spark):
    df = spark.createDataFrame([(t,) for t in [*CASH, None]], "t string")
    got = {r.t: r.a for r in df.select("t", tx.per_share_cash(F.col("t")).alias("a")).collect()}
    assert got.pop(None) in (None, [])
    assert got == CASH


def test_millions_are_no_amounts(spark):
    df = spark.createDataFrame([("$3 million, $7.5 billion and $12.25",)], "t string")
    assert df.select(tx.dollar_amounts(F.col("t"))).first()[0] == [12.25]


def test_texts_of_pages(spark):
    pages = {
        "<p>the right to <b>receive</b> $26.50 in cash<i> , without</i> interest</p>": "the right to receive $26.50 in cash, without interest",
        "Falcon Corp. (&#8220;Parent&#8221;)": "Falcon Corp. (“Parent”)",
        "a &amp;lt; b &lt; c": "a &lt; b < c",
        "x<!-- <b>hidden</b> > --> y": "x y",
        "": "",
    }
    df = spark.createDataFrame([(h,) for h in pages], "h string")
    assert {r.h: r.t for r in df.select("h", tx.strip_html(F.col("h")).alias("t")).collect()} == pages


def test_a_planted_look_ahead_is_found(spark):
    """Assets by quarter, restated later: a lagged plan equals its replay, one that reads filings of the next month doesn't."""
    ends = [date(2021, 3, 31), date(2021, 6, 30), date(2021, 9, 30)]
    rows = [(s, "Assets", e, e, e + timedelta(days=after), 10 * i + k, 100 * s + i * k) for s in (1, 2) for i, e in enumerate(ends, 1) for k, after in ((1, 30), (2, 75))]
    facts = spark.createDataFrame(rows, "security_id long, concept string, period_start date, period_end date, filed date, accession long, value long")
    months = [date(2021, m, 28) for m in range(5, 12)]
    dates = spark.createDataFrame([(s, d) for s in (1, 2) for d in months], "security_id long, date date")
    metrics = {"assets": ("instant", ("Assets",))}

    def plan(delay):
        def run(tables):
            k = fm.known_on(tables["dates"], fm.metric_events(tables["facts"], metrics), ["assets"], delay=delay)
            return k.select("date", "security_id", F.col("assets.value").cast("double").alias("value"))

        return run

    sources = {"facts": (facts, F.col("filed")), "dates": (dates, F.col("date"))}
    at = evaluate.dates_before(dates, (1, 3, 5, 50))
    assert at == [months[2], months[4], months[6]]
    right = evaluate.pit_regression(plan(1), sources, at).collect()
    assert len(right) == 3 and all(r.cells == 2 and r.violations == 0 and r.largest == 0 for r in right)
    wrong = {r.date: (r.violations, r.largest) for r in evaluate.pit_regression(plan(-45), sources, at).collect()}
    assert any(v or big for v, big in wrong.values())
    early = evaluate.pit_regression(plan(-45), sources, [date(2021, 5, 28)]).first()  # a first filing seen before it was made
    assert early.violations == 0 and early.largest > 0 or early.violations > 0
