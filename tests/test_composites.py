"""Composites: ranks among eligible rows, residuals of ranks, halves for what is missing, holes in adjustments."""

from datetime import date

import numpy as np
import pandas as pd
import pytest

from tidemark.plans import composites

D = date(2020, 1, 3)


def values(df):
    return {(r.date, r.security_id): r.value for r in df.collect()}


def test_missing_legs_are_halves_and_the_base_is_required(spark):
    rows = [(D, 1, 0.1, 5.0), (D, 2, 0.2, None), (D, 3, None, 1.0), (D, 4, 0.2, 5.0)]
    df = spark.createDataFrame(rows, "date date, security_id bigint, a double, b double")
    assert values(composites.composite(df, "a", ["b"])) == pytest.approx({(D, 1): (1 / 3 + 2.5 / 3) / 2, (D, 2): (2.5 / 3 + 0.5) / 2, (D, 4): (2.5 / 3 + 2.5 / 3) / 2})


def test_a_base_without_variation_leaves_no_residual(spark):
    rows = [(D, 1, 0.1, 5.0), (D, 2, 0.1, 6.0), (date(2020, 1, 10), 1, 0.1, 5.0)]
    df = spark.createDataFrame(rows, "date date, security_id bigint, a double, b double")
    assert set(values(composites.composite(df, "a", ["b"], residual="b")).values()) == {(0.75 + 0.5) / 2, (1 + 0.5) / 2}


def test_against_a_plain_version(spark):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame([(date(2020, 1, 1 + d), s, *np.where(rng.random(3) < 0.2, np.nan, rng.normal(size=3))) for d in range(5) for s in range(40)], columns=["date", "security_id", "a", "b", "c"])
    want = {}
    for d, x in frame.groupby("date"):
        r = x.set_index("security_id")[["a", "b", "c"]].rank(pct=True)
        both = r.dropna(subset=["a", "b"])
        slope, start = np.polyfit(both["a"], both["b"], 1)
        r["b"] = (both["b"] - start - slope * both["a"]).round(9).rank(pct=True).reindex(r.index)
        want |= {(d, s): (v["a"] + (0.5 if np.isnan(v["b"]) else v["b"]) + (0.5 if np.isnan(v["c"]) else v["c"])) / 3 for s, v in r.iterrows() if not np.isnan(v["a"])}
    df = spark.createDataFrame(frame.astype(object).where(frame.notna(), None).values.tolist(), "date date, security_id bigint, a double, b double, c double")
    assert values(composites.composite(df, "a", ["b", "c"], residual="b")) == pytest.approx(want)
    assert composites.composite(df.where("false"), "a", ["b"], residual="b").count() == 0


def test_only_holes_inside_the_prices_count(spark):
    day = lambda m: date(2020, m, 1)
    prices = spark.createDataFrame([(s, day(m)) for s in range(1, 8) for m in (3, 9)], "security_id bigint, date date")
    actions = [(1, "split", day(5), "legacy"), (2, "split", day(3), "legacy"), (3, "split", day(9), "legacy"), (4, "split", day(10), "legacy"), (5, "split", day(5), "legacy"), (5, "split", day(5), "trusted"), (6, "split", day(5), "legacy"), (6, "dividend", day(5), "trusted"), (7, "split", day(5), None), (9, "split", day(5), "legacy"), (2, "dividend", day(5), "legacy")]
    a = spark.createDataFrame(actions, "security_id bigint, kind string, ex_date date, source string")
    found = lambda *x, **k: sorted(r.security_id for r in composites.with_holes(a, prices, *x, **k).collect())
    assert found("2020-01-01", "2020-12-31") == [1, 2, 3, 6, 7] and found("2020-01-01", "2020-12-31", kinds=["split"]) == [1, 3, 6, 7] and found("2020-06-01", "2020-12-31") == [3]
    panel = spark.createDataFrame([(s, s != 2) for s in range(1, 9)], "security_id bigint, eligible boolean")
    assert sorted(r.security_id for r in composites.gated(panel, composites.with_holes(a, prices, "2020-01-01", "2020-12-31")).collect()) == [4, 5, 8]


def test_slow_frames_see_the_rows_they_need_only(spark):
    import __spark_entry__ as entry

    plan = entry.queries()["composite_v1"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert ">= 1995-10-18)" in plan  # 63 weeks before the first date, below the frames of 63 rows
