"""Cross-sectional operators: everything within one date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

def by_date() -> WindowSpec:
    return Window.partitionBy("date")


def average_rank(x: str, by: list[str] | None = None) -> Column:
    """Rank from 1 with ties averaged; null stays null and takes no rank.

    Nulls come first and are taken off, so that one order by keys and x serves ranks, ties and counts: a task holds one sort for each x.
    """
    keys = by or ["date"]
    whole = Window.partitionBy(*keys)
    nulls, ordered = F.count("*").over(whole) - F.count(x).over(whole), whole.orderBy(x)
    ties = ordered.rangeBetween(Window.currentRow, Window.currentRow)
    return F.when(F.col(x).isNotNull(), F.rank().over(ordered) - nulls + (F.count("*").over(ties) - 1) / 2)


def percent_rank(x: str, by: list[str] | None = None) -> Column:
    """Average rank over the number of non-null values."""
    return average_rank(x, by) / F.count(x).over(Window.partitionBy(*(by or ["date"])))


def buckets(x: str, n: int, least: int, tie: str = "security_id") -> Column:
    """1 … n by rank, ties in the order of tie; null on dates with fewer than least values."""
    first = F.row_number().over(Window.partitionBy("date", F.col(x).isNull()).orderBy(x, tie))
    count = F.count(x).over(by_date())
    return F.when(F.col(x).isNotNull() & (count >= least), F.least(F.floor((first - 1) * n / count) + 1, F.lit(n)).cast("int"))


def correlation(a: str, b: str) -> Column:
    """Pearson's correlation as an aggregate; null where either side doesn't vary."""
    spread = F.sqrt(F.var_pop(a) * F.var_pop(b))
    return F.covar_pop(a, b) / F.when(spread > 0, spread)


def rank_ic(df: DataFrame, x: str, y: str, least: int) -> DataFrame:
    """(date, ic, n): correlation of ranks, each made on its own non-nulls, over rows that have both.

    Dates with fewer than least such rows, or on which a side doesn't vary, are left out. One exchange.
    """
    ranked = df.repartition("date").select("date", average_rank(x).alias("a"), average_rank(y).alias("b")).where("a is not null and b is not null")
    return ranked.groupBy("date").agg(correlation("a", "b").alias("ic"), F.count("*").alias("n")).where((F.col("n") >= least) & F.col("ic").isNotNull())


def residual(y: str, x: str) -> Column:
    """Residual of the per-date regression y = a + b x over rows that have both; b is 0 where x doesn't vary."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    u, v = F.when(both, F.col(x)), F.when(both, F.col(y))
    var = F.var_pop(u).over(by_date())
    b = F.when(var > 1e-18, F.covar_pop(u, v).over(by_date()) / var).otherwise(0.0)
    return v - F.avg(v).over(by_date()) - b * (u - F.avg(u).over(by_date()))


def weighted_quantile(df: DataFrame, by: str, value: str, weight: str, q: float) -> DataFrame:
    """(by, quantile): the smallest value whose cumulative weight reaches q of the total."""
    w = Window.partitionBy(by).orderBy(value)
    totals = df.groupBy(by, value).agg(F.sum(weight).alias("w"))
    run = totals.select(by, value, F.sum("w").over(w).alias("c"), F.sum("w").over(Window.partitionBy(by)).alias("t"))
    return run.where(F.col("c") >= q * F.col("t")).groupBy(by).agg(F.min(value).alias("quantile"))


def clear_mode(df: DataFrame, by: str, value: str) -> DataFrame:
    """(by, mode, n): the most frequent value where it is strictly ahead of the next."""
    counts = df.groupBy(by, value).agg(F.count("*").alias("n"))
    w = Window.partitionBy(by).orderBy(F.desc("n"))
    ahead = counts.withColumn("r", F.row_number().over(w)).withColumn("next", F.lead("n").over(w)).where("r = 1 and (next is null or next < n)")
    return ahead.select(by, F.col(value).alias("mode"), "n")
