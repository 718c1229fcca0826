"""Operators on small tables: known values, ties, nulls, empty tables and streams."""

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text as tx
from tidemark.functions.scalar import new_york, visible_at
from tidemark.operators import cross_section as xs
from tidemark.operators import events as ev
from tidemark.operators import identity as idn
from tidemark.operators import joins, records, windows, writes
from tidemark.plans import evaluate, factors, intraday
from tidemark.sources import feeds
from tidemark.sources.views import on_grid
from tidemark.streaming.sessions import windowed


def d(n, month=1, year=2025):
    return date(year, month, n)


def rows(df, *by):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, x) for x in r))


def test_as_of_values(spark):
    events = spark.createDataFrame([(1, d(1), 10.0, 1), (1, d(3), 20.0, 2)], "k int, at date, value double, tie int")
    days = spark.createDataFrame([(1, d(n)) for n in range(1, 5)] + [(2, d(1)), (None, d(1))], "k int, day date")
    got = joins.as_of(days, events, "k", "day", "at", "tie", ["value"])
    assert rows(got.select("k", "day", "asof_value")) == [(None, d(1), None), (1, d(1), 10.0), (1, d(2), 10.0), (1, d(3), 20.0), (1, d(4), 20.0), (2, d(1), None)]
    late = joins.as_of(days, events, "k", "day", "at", "tie", ["value"], delay="interval 40 days")
    assert {r.asof_value for r in late.collect()} == {None}
    aged = joins.as_of(days, events.where("tie = 1"), "k", "day", "at", "tie", ["value"], max_age="interval 2 days")
    assert [r[2] for r in rows(aged.where("k = 1").select("k", "day", "asof_value"))] == [10.0, 10.0, 10.0, None]


def test_as_of_in_pieces(spark):
    """Hot keys cut by time give what whole keys give."""
    right = spark.createDataFrame([(i % 3, d(1 + i * 7 % 28, 1 + i % 5), float(i), i) for i in range(200)], "k int, at date, value double, tie int")
    left = spark.createDataFrame([(i % 4, d(1 + i % 28, 1 + i % 6)) for i in range(160)] + [(None, d(1))], "k int, day date")
    for extra in ({}, {"max_age": "interval 9 days"}, {"delay": "interval 3 days"}):
        whole, cut = (joins.as_of(left, right, "k", "day", "at", "tie", ["value"], piece=p, **extra) for p in (None, "month"))
        assert rows(whole.select("k", "day", "asof_value")) == rows(cut.select("k", "day", "asof_value"))


def test_strictly_before_and_around(spark):
    prices = spark.createDataFrame([(1, d(1), 1.0), (1, d(3), 3.0)], "k int, day date, close double")
    asked = spark.createDataFrame([(1, d(n)) for n in (1, 2, 3, 4)], "k int, at date")
    got = ev.before(asked, prices, "k", "at", "day", "close", ["close"])
    assert [r[1:] for r in rows(got.select("k", "at", "asof_close"))] == [(d(1), None), (d(2), 1.0), (d(3), 1.0), (d(4), 3.0)]
    got = ev.around(asked, prices, "k", "at", "day", "close")
    assert [r[1:] for r in rows(got)] == [(d(1), None, 1.0), (d(2), 1.0, 3.0), (d(3), 1.0, 3.0), (d(4), 3.0, None)]


def test_nearest_is_before(spark):
    left = spark.createDataFrame([(1, 1, d(10, year=2025)), (2, 1, d(20, 6, 2024))], "id int, k int, day date")
    right = spark.createDataFrame([(11, 1, d(5, year=2024)), (12, 1, d(15, year=2024)), (13, 1, d(11, year=2025))], "id int, k int, day date")
    got = joins.nearest(left, right, ["k"], "day", "day", "id", 365, 35)
    assert rows(got.select("id", "match_id", "gap")) == [(1, 12, 361)]
    assert joins.nearest(left, right, ["k"], "day", "day", "id", 0, 5).count() == 0  # none ahead


def test_tenures_hold_one_row(spark):
    t = spark.createDataFrame([(1, "a", d(1), d(10)), (2, "a", d(10), None), (3, "b", d(1), d(20)), (4, "b", d(5), d(6))], "tenure_id int, k string, start date, end date")
    asked = spark.createDataFrame([("a", d(9)), ("a", d(10)), ("a", d(9, 9)), ("b", d(5)), ("b", d(7)), ("c", d(1)), (None, d(1))], "k string, day date")
    assert rows(joins.in_tenure(asked, t, "k", "day").select("k", "day", "tenure_id")) == [("a", d(9), 1), ("a", d(10), 2), ("a", d(9, 9), 2), ("b", d(7), 3)]
    s = spark.createDataFrame([(1, "x", d(1), d(10)), (2, "x", d(5), d(12)), (3, "x", d(20), d(22))], "id int, k string, s date, e date")
    assert rows(idn.alone(s, "k", "id", "s", "e")) == [("x", 1, d(1), d(5)), ("x", 2, d(10), d(12)), ("x", 3, d(20), d(22))]
    assert [r[:2] for r in rows(idn.overlaps(s, "k", "id", "s", "e", "2025-12-31"))] == [(1, 2)]


def test_ranks_and_flat_days(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0), (4, 4.0)], "security_id int, x double").withColumn("date", F.lit(1))
    assert [r[1] for r in rows(df.select("security_id", xs.percent_rank("x")))] == [1 / 3, None, 2 / 3, 1.0]
    p = spark.createDataFrame([(1, 1.0, 1.0), (1, 1.0, 2.0), (1, 2.0, 3.0), (2, 5.0, 1.0), (2, 5.0, 2.0), (2, 5.0, 3.0), (3, None, 1.0)], "date int, x double, y double")
    assert xs.rank_ic(p, "x", "y", 3).collect() == [(1, pytest.approx(0.8660254037844387), 3)]
    assert xs.rank_ic(p.where("false"), "x", "y", 3).count() == 0


def nw(values, lag):
    n, m = len(values), sum(values) / len(values)
    c = [x - m for x in values]
    lag = min(lag, n - 1)
    v = sum(x * x for x in c) / n + sum(2 * (1 - k / (lag + 1)) * sum(a * b for a, b in zip(c[k:], c)) / n for k in range(1, lag + 1))
    return m / math.sqrt(v / n)


def test_newey_west(spark):
    of = lambda xs: evaluate.newey_west(spark.createDataFrame(list(enumerate(xs)), "date int, x double"), "x", 4).first()
    assert tuple(of([])) == (0, None, None) and tuple(of([0.5])) == (1, 0.5, None) and tuple(of([0.0] * 9)) == (9, 0.0, None)
    assert of([1.0] * 9).t == math.inf and of([-1.0] * 9).t == -math.inf
    x = [math.sin(i) + 0.2 for i in range(150)]
    got = of([*x, None])
    assert got.n == 150 and got.t == pytest.approx(nw(x, evaluate.lag_rule(150, 4)))


def test_visibility(spark):
    cases = {
        datetime(2025, 6, 6, 9, 29): datetime(2025, 6, 6, 9, 30), datetime(2025, 6, 6, 9, 30): datetime(2025, 6, 6, 9, 30), datetime(2025, 6, 6, 16, 0): datetime(2025, 6, 6, 16, 0),
        datetime(2025, 6, 6, 16, 0, 0, 1): datetime(2025, 6, 9, 9, 30), datetime(2025, 6, 7, 12, 0): datetime(2025, 6, 9, 9, 30), datetime(2025, 6, 8, 23, 0): datetime(2025, 6, 9, 9, 30),
        datetime(2025, 6, 5, 20, 0): datetime(2025, 6, 6, 9, 30), datetime(2025, 6, 5, 0, 0): datetime(2025, 6, 5, 9, 30),
    }
    df = spark.createDataFrame([(a,) for a in [*cases, None]], "et timestamp_ntz")
    assert {r.et: r.v for r in df.select("et", visible_at(F.col("et")).alias("v")).collect()} == {**cases, None: None}
    utc = spark.createDataFrame([(datetime(2025, 3, 9, 6, 59),), (datetime(2025, 3, 9, 7, 0),)], "ts timestamp_ntz")  # clocks go forward
    assert [r[0] for r in rows(utc.select(new_york(F.col("ts"))))] == [datetime(2025, 3, 9, 1, 59), datetime(2025, 3, 9, 3, 0)]


def test_adjustments(spark):
    actions = spark.createDataFrame([(1, d(2), "dividend", 1.0, None, None, 100.0), (1, d(5), "dividend", 2.0, None, None, 200.0), (2, d(5), "split", None, 1.0, 4.0, None), (3, d(5), "dividend", 9.0, None, None, 5.0)], "k int, at date, kind string, cash double, f double, t double, prev double")
    single = actions.withColumn("factor", ev.single_factor(*(F.col(c) for c in ("kind", "cash", "f", "t", "prev"))))
    assert [r[1] for r in rows(single.select("k", "factor").where("k < 3"))] == [0.99, 0.99, 0.25]
    c = ev.cumulative_factors(single, "k", "at", "factor")
    assert rows(c) == [(1, d(2), 0.9801), (1, d(5), 0.99), (2, d(5), 0.25)]
    bars = spark.createDataFrame([(2, d(4)), (2, d(5)), (1, d(1)), (1, d(2)), (1, d(5)), (4, d(1))], "k int, day date")
    got = ev.adjustment(bars, c, "k", "day", "at")
    assert rows(got) == [(1, d(1), 0.9801), (1, d(2), 0.99), (1, d(5), 1.0), (2, d(4), 0.25), (2, d(5), 1.0), (4, d(1), 1.0)]
    until = ev.adjustment(bars, c, "k", "day", "at", F.lit("2025-01-03").cast("date"))
    assert [r[2] for r in rows(until) if r[0] == 1] == [pytest.approx(0.99), 1.0, pytest.approx(1 / 0.99)]


def test_spread_estimators(spark):
    bounce = [0.01 if i % 2 else -0.01 for i in range(40)]
    got = spark.createDataFrame([(bounce,), (bounce[:20],), ([0.01] * 40,), ([],)], "r array<double>").select(intraday.roll_spread(F.col("r")).alias("s")).collect()
    assert got[0].s == pytest.approx(0.02, abs=1e-9) and [r.s for r in got[1:]] == [None, None, None]
    b = [[(0, 100.5, 100.0), (1, 100.6, 100.1)], [(0, 100.5, 100.0), (2, 100.6, 100.1)], []]
    got = spark.createDataFrame([(x,) for x in b], "b array<struct<i:int,high:double,low:double>>").select(intraday.corwin_schultz(F.col("b"), 1).alias("s")).collect()
    assert got[0].s == pytest.approx(0.0025780, abs=1e-6) and got[1].s is None and got[2].s is None


def test_grid_and_gaps(spark):
    bars = spark.createDataFrame([(1, d(6), 10.0), (1, d(27), 15.0), (2, d(6), 1.0)], "security_id int, date date, close double")
    grid = on_grid(bars)
    assert rows(grid) == [(1, d(6), 10.0), (1, d(13), None), (1, d(20), None), (1, d(27), 15.0), (2, d(6), 1.0)]
    assert on_grid(bars.where("false")).count() == 0
    # held half at the gap's first row, sold within it: the gap's return still falls on that half
    w = grid.where("security_id = 1").withColumn("w", F.when(F.col("date") == d(6), 0.5).otherwise(0.0))
    assert [r[1] for r in rows(evaluate.runs_of_weights(w, 0.0))] == [0, 0, 0, 0.25]
    assert [r[1] for r in rows(evaluate.runs_of_weights(w, 0.0, freeze=False))] == [0, 0, 0, 0]
    ends = grid.where("security_id = 1 and date < date'2025-01-27'").withColumns({"w": F.lit(0.5), "t": F.lit(-1.0)})
    assert [r[1] for r in rows(evaluate.runs_of_weights(ends, 0.0, terminal="t"))] == [0, -0.5, 0]
    with pytest.raises(ValueError):
        factors.register("momentum", lambda: F.lit(0.0))


def test_upserts(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (None, "c", 3.0)], "k int, s string, v double")
    new = spark.createDataFrame([(1, None, None), (None, "z", 9.0), (4, "d", 4.0)], "k int, s string, v double")
    assert rows(writes.upsert(old, new, ["k"], overwrite=["v"], keep_known=["s"])) == [(None, "z", 9.0), (1, "a", None), (2, "b", None), (4, "d", 4.0)]
    again = writes.upsert(writes.upsert(old, new, ["k"], fill=["s", "v"]), new, ["k"], fill=["s", "v"])
    assert rows(again) == [(None, "c", 3.0), (1, "a", 1.0), (2, "b", None), (4, "d", 4.0)]
    stamped = writes.upsert(old.withColumn("at", F.lit("then")), new, ["k"], overwrite=["v"], stamp="at", now=F.lit("now"))
    assert {r.k: r["at"] for r in stamped.collect()} == {None: "now", 1: "now", 2: "then", 4: "now"}
    batch = spark.createDataFrame([(1, None, 7.0, ["v"]), (2, None, None, ["s"])], "k int, s string, v double, given array<string>")
    assert rows(writes.by_presence(old, batch, ["k"], "given")) == [(None, "c", 3.0), (1, "a", 7.0), (2, None, None)]
    assert rows(records.new_rows(old, new, ["k"])) == [(None, "c", 3.0), (1, "a", 1.0), (2, "b", None), (4, "d", 4.0)]


def test_vintages_and_runs(spark):
    f = spark.createDataFrame([(1, 1, 5.0), (1, 2, 5.0), (1, 3, 6.0), (1, 4, None), (1, 5, None), (1, 6, 6.0)], "k int, filed int, v double")
    assert [r[1] for r in rows(ev.changes(f, ["k"], ["filed"], "v"))] == [1, 3, 4, 6]
    p = spark.createDataFrame([(1, 1, 5), (1, 2, 4), (1, 3, 5), (1, 4, 6)], "k int, filed int, period int")
    assert [r[1] for r in rows(ev.no_regressions(p, "k", ["filed"], "period"))] == [1, 3, 4]
    ts = spark.createDataFrame([("a", datetime(2025, 1, 1, h)) for h in (0, 1, 3, 4)], "k string, ts timestamp")
    assert [r[1:2] + r[4:] for r in rows(windows.runs(ts, "k", "ts", 3600))] == [(0, 2), (1, 2)]


def test_texts_and_feeds(spark):
    one = lambda c, x: spark.createDataFrame([(x,)], "x string").select(c(F.col("x")).alias("y")).first().y
    assert one(tx.strip_html, "<p>a &amp; b</p><script>x<y</script>\n c&copy;d") == "a & b c d" and one(tx.strip_html, None) is None
    assert one(tx.dollar_amounts, "$1,234.50 and $ 7 and $99,999") == [1234.5, 7.0]
    assert one(tx.tokens, "a=1|b=2|a=3|=x|c") == {"b": "2", "a": "3"}
    assert one(lambda c: tx.common_equity(c), "Acme 5% Notes due 2031") is False and one(lambda c: tx.common_equity(c), "Unity Inc") is True
    lines = spark.createDataFrame([("8-K    A  B CO   12 2025-01-02  edgar/data/1.txt",), ("8-K x",), ("10-Q   A  1 20250102 edgar/data/2.txt",), ("8-K   A  1 2025-13-02 edgar/data/3.txt",)], "value string")
    assert [tuple(r) for r in feeds.form_index(lines, ["8-K"]).collect()] == [("8-K", "12", d(2), "edgar/data/1.txt")]
    assert feeds.company_facts(spark.createDataFrame([("{}",), (None,), ("no json",)], "payload string"), ["Assets"]).count() == 0


def test_streaming_windows(spark, tmp_path):
    """The stream in append mode gives the batch's windows, but for those that wait for the watermark."""
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    e.orderBy("ts").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = windowed(spark.readStream.schema(e.schema).parquet(str(tmp_path / "in")))
    run = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    run.awaitTermination(120)
    got, want = rows(spark.read.parquet(str(tmp_path / "out")).select("start", "event_type", "n")), rows(windowed(e).select("start", "event_type", "n"))
    assert set(got) <= set(want) and len(want) - len(got) <= 12


def test_ranks_hold_one_sort_for_each_column(spark):
    nan = float("nan")
    rows = [("d", 3.0, None), ("d", None, None), ("d", 3.0, 0.0), ("d", 1.0, -0.0), ("d", nan, 2.0), ("d", nan, None), ("e", None, 5.0)]
    df = spark.createDataFrame(rows, "date string, x double, y double").repartition("date")
    ranked = df.select("date", "x", "y", xs.average_rank("x").alias("a"), xs.percent_rank("y").alias("b"))
    assert ranked._jdf.queryExecution().sparkPlan().toString().count("Window [") == 3  # the order of each, and what all share
    got = sorted((r.date, str(r.x), str(r.y), r.a, r.b) for r in ranked.collect())
    assert got == sorted([("d", "3.0", "None", 2.5, None), ("d", "None", "None", None, None), ("d", "3.0", "0.0", 2.5, 0.5), ("d", "1.0", "-0.0", 1.0, 0.5), ("d", "nan", "2.0", 4.5, 1.0), ("d", "nan", "None", 4.5, None), ("e", "None", "5.0", None, 1.0)])
