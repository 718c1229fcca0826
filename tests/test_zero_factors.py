"""Prices under so many dividends that their rounded product is zero, against SQL."""

import math
import random
from datetime import datetime, timedelta

import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark import queries as q
from tidemark.operators import events as ev


def test_adjusted_prices_of_a_product_that_rounds_to_zero(spark, tmp_path):
    days = [datetime(1995, 1, 2) + timedelta(i) for i in range(16)]
    orders = [(i, 1, "F", 90000.0, d, "5-LOW") for i, d in enumerate(days)]
    lines = [(i, 1, 1, 1, 10.0, 10.0, 0.0, 0.0, "N", "F", d) for i, d in enumerate(days)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    spark.createDataFrame(lines, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect()
    for t in ("orders", "lineitem"):
        con.sql(f"CREATE VIEW {t} AS FROM '{tmp_path}/{t}.parquet/*.parquet'")
    columns = ["date", "log_adjusted", "security_id"]
    want = sorted(con.sql(f"SELECT date, log_adjusted, security_id FROM ({q.SQL['adjusted_prices']})").fetchall())
    got = sorted(tuple(r) for r in entry.queries()["adjusted_prices"](spark, str(tmp_path)).select(*columns).collect())
    assert got == want and got[0][1] == -math.inf and got[-1][1] == 0


def test_adjustment_over_a_factor_of_zero(spark):
    prices = spark.createDataFrame([(1, "2000-01-01"), (1, "2000-01-03")], "k int, d string").withColumn("d", F.to_date("d"))
    factors = spark.createDataFrame([(1, "2000-01-02", 0.0)], "k int, x string, cumulative_factor double").withColumn("x", F.to_date("x"))
    got = [r["factor"] for r in ev.adjustment(prices, factors, "k", "d", "x", F.lit("2000-01-01").cast("date")).orderBy("d").collect()]
    assert math.isnan(got[0]) and got[1] == math.inf


def test_cumulative_factors_are_the_same_in_any_order(spark):
    """Sums of logarithms have the error of one double, however many rows they have and in whatever order these come."""
    rng = random.Random(5)
    factors = [rng.choice((0.9, 1.1)) + rng.random() / 100 for _ in range(600)]
    rows = [(k, f"2000-01-{1 + i % 25:02}", f) for k, order in enumerate((factors, factors[::-1])) for i, f in (enumerate(order) if not k else zip(range(599, -1, -1), order))]
    events = spark.createDataFrame(rows, "k int, d string, f double").coalesce(1)
    got = {(r.k, r.d): r.cumulative_factor for r in ev.cumulative_factors(events, "k", "d", "f", digits=18).collect()}
    days = sorted({d for _, d, _ in rows})
    assert all(got[0, d] == got[1, d] for d in days)
    for d in days:
        total = math.fsum(math.log(f) for k, e, f in rows if k == 0 and e >= d)
        assert abs(got[0, d] / math.exp(total) - 1) < 1e-15 * max(1, abs(total))


def test_cumulative_factors_that_are_no_numbers(spark):
    events = spark.createDataFrame([(1, "2000-01-02", math.inf), (1, "2000-01-01", 0.5), (1, "2000-01-03", 0.5), (2, "2000-01-01", math.nan), (3, "2000-01-01", 0.0)], "k int, d string, f double")
    got = {(r.k, r.d): r.cumulative_factor for r in ev.cumulative_factors(events, "k", "d", "f").collect()}
    assert math.isnan(got.pop((2, "2000-01-01"))) and got == {(1, "2000-01-01"): math.inf, (1, "2000-01-02"): math.inf, (1, "2000-01-03"): 0.5}
