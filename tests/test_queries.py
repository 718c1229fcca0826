"""Every query with SQL against DuckDB on the same tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark import queries as q
from tidemark.plans.evaluate import lag_rule

SF = "/root/testdata/sf0.001"


def rounded(rows):
    def one(x):
        return round(x, 5) if isinstance(x, float) else x

    return sorted((tuple(map(one, r)) for r in rows), key=lambda r: tuple((x is not None, x) for x in r))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS FROM '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", list(q.SQL))
def test_query_equals_its_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    want = con.sql(q.SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    columns = sorted(df.columns)
    got, want = rounded(df.select(*columns).collect()), rounded(want.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall())
    assert len(got) == len(want) and got
    for a, b in zip(got, want):
        assert all(x == y or isinstance(x, float) and y is not None and math.isclose(x, y, abs_tol=2e-5, rel_tol=1e-6) for x, y in zip(a, b)), (a, b)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_lag_rule():
    assert [lag_rule(*x) for x in ((100, 1), (252, 21), (520, 1), (1000, 1))] == [4, 21, 5, 6]
