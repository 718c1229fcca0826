"""Metrics of facts, holdings as events, and joins on awkward rows, against values known beforehand."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import fundamentals as fm
from tidemark.operators import holdings as hd
from tidemark.operators import joins, records

METRICS = {"revenue": ("flow", ("Revenues", "Sales")), "assets": ("instant", ("Assets",))}
FACTS = "security_id long, concept string, period_start date, period_end date, filed date, accession long, value long"
YEAR21 = (date(2021, 1, 1), date(2021, 12, 31))
HALF21, HALF22 = (date(2021, 1, 1), date(2021, 6, 30)), (date(2022, 1, 1), date(2022, 6, 30))


def facts(spark, *rows):
    """Rows (concept, (start, end), filed, value) of security 1."""
    return spark.createDataFrame([(1, c, s, e, filed, i, v) for i, (c, (s, e), filed, v) in enumerate(rows)], FACTS)


def events(df, metric="revenue"):
    return sorted((r.period_end, r.visible, r.value) for r in fm.metric_events(df, METRICS).where(F.col("metric") == metric).collect())


BASE = [("Revenues", YEAR21, date(2022, 2, 20), 100), ("Revenues", HALF21, date(2021, 8, 1), 45), ("Revenues", HALF22, date(2022, 8, 1), 60)]


def test_reported_and_derived_years(spark):
    year, derived = (date(2021, 12, 31), date(2022, 2, 20), 100), (date(2022, 6, 30), date(2022, 8, 1), 115)
    assert events(facts(spark, BASE[0])) == [year]
    assert events(facts(spark, *BASE)) == [year, derived]
    assert events(facts(spark, BASE[0], BASE[2])) == [year]  # no half of the year before
    assert events(facts(spark, *BASE[1:])) == []  # no year
    assert events(facts(spark, *BASE[:2], ("Sales", HALF22, date(2022, 8, 1), 60))) == [year]  # parts of two concepts
    odd = ("Revenues", (date(2022, 1, 1), date(2022, 5, 1)), date(2022, 6, 1), 9)
    assert events(facts(spark, *BASE, odd)) == [year, derived]


def test_a_year_of_53_weeks(spark):
    rows = [("Revenues", (date(2020, 1, 26), date(2021, 1, 30)), date(2021, 3, 20), 200), ("Revenues", (date(2020, 1, 26), date(2020, 5, 2)), date(2020, 6, 1), 40), ("Revenues", (date(2021, 1, 31), date(2021, 5, 1)), date(2021, 6, 1), 55)]
    assert events(facts(spark, *rows))[-1] == (date(2021, 5, 1), date(2021, 6, 1), 215)


def test_restatements_are_events_of_their_own(spark):
    again = facts(spark, *BASE, ("Revenues", HALF22, date(2022, 9, 9), 62), ("Revenues", YEAR21, date(2022, 10, 1), 100), ("Revenues", HALF21, date(2022, 11, 1), 47))
    assert events(again) == [(date(2021, 12, 31), date(2022, 2, 20), 100), *((date(2022, 6, 30), at, v) for at, v in ((date(2022, 8, 1), 115), (date(2022, 9, 9), 117), (date(2022, 11, 1), 115)))]
    day = facts(spark, BASE[0], ("Revenues", YEAR21, date(2022, 2, 20), 130))
    assert events(day) == [(date(2021, 12, 31), date(2022, 2, 20), 130)]  # of one day the last


def test_one_concept_for_a_period(spark):
    both = facts(spark, ("Sales", YEAR21, date(2022, 1, 5), 90), ("Revenues", YEAR21, date(2022, 2, 20), 100), ("Sales", YEAR21, date(2022, 5, 1), 95))
    assert events(both) == [(date(2021, 12, 31), date(2022, 2, 20), 100)]


def test_late_reports_of_older_periods_are_left_out(spark):
    rows = [("Assets", (d, d), filed, v) for d, filed, v in ((date(2021, 6, 30), date(2021, 8, 1), 1), (date(2021, 3, 31), date(2021, 9, 1), 2), (date(2021, 6, 30), date(2021, 10, 1), 3))]
    assert [e[2] for e in events(facts(spark, *rows), "assets")] == [1, 3]


def test_known_on_a_date(spark):
    e = fm.metric_events(facts(spark, BASE[0]), METRICS)
    days = [date(2022, 2, 20), date(2022, 2, 21), date(2022, 9, 27), date(2022, 9, 28)]
    dates = spark.createDataFrame([(1, d) for d in days] + [(2, days[1])], "security_id long, date date")
    got = {(r.security_id, r.date): r.revenue and r.revenue.value for r in fm.known_on(dates, e, ["revenue"]).collect()}
    assert got == {(1, days[0]): None, (1, days[1]): 100, (1, days[2]): 100, (1, days[3]): None, (2, days[1]): None}


def test_pairs_are_told_anew_when_either_changes(spark):
    d = lambda y: (date(y, 12, 31),) * 2
    rows = [("Assets", d(2020), date(2021, 2, 1), 80), ("Assets", d(2021), date(2022, 2, 1), 100), ("Assets", d(2020), date(2022, 3, 1), 90), ("Assets", (date(2021, 9, 30),) * 2, date(2021, 11, 1), 5)]
    got = [tuple(r) for r in fm.pair_events(facts(spark, *rows), METRICS).orderBy("visible").select("metric", "period_end", "visible", "value", "prior_end", "prior").collect()]
    assert got == [("assets_pair", date(2021, 12, 31), at, 100, date(2020, 12, 31), p) for at, p in ((date(2022, 2, 1), 80), (date(2022, 3, 1), 90))]


def test_companies_have_what_their_first_member_has(spark):
    on, later = date(2022, 1, 31), date(2022, 2, 28)
    companies = spark.createDataFrame([(1, 9), (2, 9), (3, 9), (5, 8)], "security_id long, company_id long")
    universe = spark.createDataFrame([(2, on), (3, later), (4, on), (5, on)], "security_id long, date date")
    wide = fm.with_members(universe, companies)
    assert {tuple(r) for r in wide.collect()} == {(1, on), (2, on), (3, on), (1, later), (2, later), (3, later), (4, on), (5, on)}
    panel = spark.createDataFrame([(1, on, None), (2, on, 7), (3, on, 8), (3, later, 6), (4, on, 1), (9, on, 5)], "security_id long, date date, x int")
    got = {(r.security_id, r.date): r.x for r in fm.company_values(panel, companies, universe, ["x"]).collect()}
    assert got == {(2, on): 7, (3, later): 6, (4, on): 1, (5, on): None}


def test_scores_are_means_of_what_is_known(spark):
    rows = [(True, True, False, True, True), (True, None, False, True, True), (True, None, None, True, True), (None,) * 5]
    df = spark.createDataFrame(rows, "a boolean, b boolean, c boolean, d boolean, e boolean")
    assert [r[0] for r in df.select(fm.mean_of_known([F.col(c) for c in "abcde"], 4)).collect()] == [0.8, 0.75, None, None]


# Holdings

HELD = "filer long, security_id long, period date, accession long, filed date, value double, shares double"
Q1, Q2 = date(2025, 3, 31), date(2025, 6, 30)


def held(spark, *rows):
    return spark.createDataFrame([(f, 1, p, a, p + timedelta(days=after), v, s) for f, p, a, after, v, s in rows], HELD)


def told(df):
    return [(r.period, (r.visible - r.period).days, r.holders, r.shares) for r in hd.institutional_events(df).orderBy("visible", "period").collect()]


def test_a_late_filing_changes_nothing_before_it_comes(spark):
    in_time = held(spark, (1, Q1, 1, 40, 60.0, 6.0), (1, Q1, 1, 40, 40.0, 4.0), (2, Q1, 2, 44, 100.0, 10.0))
    assert told(in_time) == [(Q1, 44, 2, 20.0)]
    late = in_time.unionByName(held(spark, (3, Q1, 3, 80, 100.0, 5.0)))
    assert told(late) == [(Q1, 44, 2, 20.0), (Q1, 80, 3, 25.0)]
    amended = late.unionByName(held(spark, (1, Q1, 9, 85, 50.0, 5.0)))  # the first filer tells again, late
    assert told(amended) == [(Q1, 44, 2, 20.0), (Q1, 85, 3, 20.0)]
    hhi = {r.holders: r.hhi for r in hd.institutional_events(late).collect()}
    assert hhi == {2: pytest.approx(0.5), 3: pytest.approx(1 / 3)}


def test_a_late_end_after_the_next_quarter_is_left_out(spark):
    rows = [(1, Q1, 1, 40, 1.0, 10.0), (2, Q1, 2, 250, 1.0, 99.0), (1, Q2, 3, 41, 1.0, 12.0)]
    assert told(held(spark, *rows)) == [(Q1, 40, 1, 10.0), (Q2, 41, 1, 12.0)]


def test_changes_are_against_what_was_known(spark):
    """The quarter before is known in two versions; each event takes the newest that was visible with it."""
    rows = [(1, Q1, 1, 40, 1.0, 10.0), (2, Q1, 2, 120, 1.0, 10.0), (1, Q2, 3, 20, 1.0, 15.0), (2, Q2, 4, 60, 1.0, 25.0)]
    got = {(r.period, (r.visible - r.period).days): r.change for r in hd.changes_of_shares(hd.institutional_events(held(spark, *rows))).collect()}
    assert got == {(Q1, 40): None, (Q2, 20): pytest.approx(0.5), (Q2, 60): pytest.approx(3.0)}
    nothing = held(spark, (1, Q1, 1, 40, 0.0, 0.0), (1, Q2, 3, 20, 1.0, 15.0))
    assert [r.change for r in hd.changes_of_shares(hd.institutional_events(nothing)).collect()] == [None, None]


# Joins

def test_rows_that_repeat_stay_in_their_tenure(spark):
    t = spark.createDataFrame([("a", 1, date(2025, 1, 1), None), ("b", 2, date(2025, 1, 1), date(2025, 2, 1)), (None, 3, date(2025, 1, 1), None)], "k string, tenure_id int, start date, end date")
    asked = spark.createDataFrame([("a", date(2025, 1, 5), None)] * 2 + [("b", date(2025, 2, 1), 1), (None, date(2025, 1, 5), 1), ("a", None, 1)], "k string, day date, x int")
    assert [tuple(r) for r in joins.in_tenure(asked, t, "k", "day").collect()] == [("a", date(2025, 1, 5), None, 1)] * 2


@pytest.mark.parametrize("piece", [None, "month"])
def test_null_keys_meet_nothing(spark, piece):
    left = spark.createDataFrame([("a", date(2025, 3, 2)), (None, date(2025, 3, 2))], "k string, day date")
    right = spark.createDataFrame([("a", date(2025, 1, 2), 1, 2.0), (None, date(2025, 3, 1), 1, 3.0)], "k string, at date, tie int, value double")
    got = {r.k: r.asof_value for r in joins.as_of(left, right, "k", "day", "at", "tie", ["value"], piece=piece).collect()}
    assert got == {"a": 2.0, None: None}


def test_as_of_by_two_keys(spark):
    left = spark.createDataFrame([(1, "x", 5), (1, "y", 5), (1, None, 5)], "a int, b string, t int")
    right = spark.createDataFrame([(1, "x", 3, 30), (1, "y", 6, 60), (1, "x", 9, 90)], "a int, b string, s int, v int")
    to_day = lambda df, c: df.withColumn(c, F.date_add(F.lit("2025-01-01").cast("date"), F.col(c)))
    got = {r.b: r.asof_v for r in joins.as_of(to_day(left, "t"), to_day(right, "s"), ["a", "b"], "t", "s", "v", ["v"]).collect()}
    assert got == {"x": 30, "y": None, None: None}


def test_every_change_of_a_name_counts(spark):
    d = lambda n: date(2025, 1, n)
    history = spark.createDataFrame([(1, "A", d(1), None), (2, "A", d(1), d(2)), (3, "A", d(1), None)], "k int, symbol string, start date, end date")
    changes = spark.createDataFrame([(1, "C", d(9)), (1, "B", d(5)), (1, "A", d(3)), (2, "B", d(5)), (3, "A", d(5)), (1, "C", d(12))], "k int, symbol string, at date")
    got = sorted(tuple(r) for r in records.renamed(history, changes, "k").collect() if r.k == 1)
    assert got == [(1, "A", d(1), d(5)), (1, "B", d(5), d(9)), (1, "C", d(9), None)]
    assert sorted(tuple(r) for r in records.renamed(history, changes, "k").collect() if r.k > 1) == [(2, "A", d(1), d(2)), (3, "A", d(1), None)]


def test_rates_by_day_keep_for_a_week(spark):
    d = lambda n: date(2025, 1, n)
    rates = spark.createDataFrame([("EUR", d(1), 1.0), ("EUR", d(3), 2.0), ("EUR", d(20), None), ("GBP", d(2), 5.0)], "c string, d date, rate double")
    got = {(r.c, r.d): r.rate for r in joins.by_day(rates, ["c"], "d", "rate", 7).collect()}
    assert got[("EUR", d(2))] == 1.0 and got[("EUR", d(3))] == got[("EUR", d(10))] == 2.0 and ("EUR", d(11)) not in got and got[("GBP", d(9))] == 5.0 and len(got) == 18
