"""Windows that a row doesn't look through again."""

from datetime import date
from math import isnan

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.operators import events as ev
from tidemark.operators.windows import moving


def test_next_close_is_a_running_value(spark):
    day = lambda n: date(2020, 1, n)
    left = spark.createDataFrame([(1, day(1)), (1, day(3)), (1, day(5)), (1, day(9)), (1, None), (None, day(3)), (2, day(3))], "k long, d date")
    right = spark.createDataFrame([(1, day(1), 10.0), (1, day(4), None), (1, day(5), 50.0), (1, day(7), 70.0), (None, day(3), 1.0)], "k long, t date, close double")
    out = ev.around(left, right, "k", "d", "t", "close")
    got = {(r.k, r.d): (r.prev_close, r.next_close) for r in out.collect()}
    want = {(1, day(1)): (None, 10.0), (1, day(3)): (10.0, 50.0), (1, day(5)): (10.0, 50.0), (1, day(9)): (70.0, None), (1, None): (None, 10.0), (None, day(3)): (None, None), (2, day(3)): (None, None)}
    assert got == want
    assert "unboundedfollowing" not in out._jdf.queryExecution().executedPlan().toString().lower()


def test_moving_sums_are_those_of_their_frames(spark):
    values = [1.0, None, float("nan"), 2.5, 4.0, None, -1.0, 8.0]
    df = spark.createDataFrame([(s, date(2020, 1, i + 1), v) for s in (1, 2) for i, v in enumerate(values)], "security_id long, date date, x double")
    out = moving(df, {"x": F.col("x")}, 3, 1)
    for r in out.where("security_id = 2").collect():
        i = r.date.day - 1
        seen = [v for v in values[max(i - 3, 0) : i] if v is not None]
        assert r.x_n == len(seen) and (r.x_sum == sum(seen) or isnan(sum(seen)) and isnan(r.x_sum))


def test_residual_momentum_has_no_frame_to_go_through(spark):
    plan = entry.queries()["factor_residual_momentum"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "rowframe, -252, -1)" not in plan and "rowframe, -251, -21)" not in plan
