"""Point-in-time operators on event tables: vintages, running guards, adjustments and strict as-of lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import as_of


def changes(facts: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """The first report of every key and those later ones whose value differs from the report before."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return facts.withColumn("_before", F.lag(value).over(w)).withColumn("_n", F.row_number().over(w)).where((F.col("_n") == 1) | ~F.col(value).eqNullSafe(F.col("_before"))).drop("_before", "_n")


def no_regressions(df: DataFrame, key: str | Sequence[str], order: Sequence[str], period: str) -> DataFrame:
    """Rows whose period is not before the latest one that was visible earlier, or at once."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("_most", F.max(period).over(w)).where(F.col(period) >= F.col("_most")).drop("_most")


def single_factor(kind: Column, cash: Column, split_from: Column, split_to: Column, previous: Column) -> Column:
    """Price factor of one action: (previous - cash) / previous, or split_from / split_to; null where it is not positive or unknown."""
    dividend = F.when((previous > 0) & (cash > 0) & (cash < previous), (previous - cash) / previous)
    split = F.when((split_from > 0) & (split_to > 0), split_from / split_to)
    return F.when(kind == "dividend", dividend).when(kind == "split", split)


def cumulative_factors(events: DataFrame, key: str, ex_date: str, factor: str, digits: int = 12) -> DataFrame:
    """(key, ex_date, cumulative_factor): products of the positive factors from each date on, as sums of their logarithms, rounded to digits.

    A running sum over a key's dates from the last one on: nothing grows with the number of its events. Logarithms are added up as
    decimals, so that a sum is the same in any order of rows and has the error of one double, not of as many as there are events.
    """
    log = F.ln(F.col(factor).cast("double"))
    exact = log.try_cast("decimal(38,20)")  # null for what is no finite number, which stays what it is
    each = events.where(F.col(factor) > 0).groupBy(key, ex_date).agg(F.sum(exact).alias("_l"), F.sum(F.when(exact.isNull(), log)).alias("_odd"))
    w = Window.partitionBy(key).orderBy(F.desc(ex_date)).rowsBetween(Window.unboundedPreceding, 0)
    total = F.coalesce(F.sum("_odd").over(w), F.sum("_l").over(w).cast("double"))
    return each.select(key, ex_date, F.round(F.exp(total), digits).alias("cumulative_factor"))


def adjustment(prices: DataFrame, factors: DataFrame, key: str, date: str, ex_date: str, as_of: Column | None = None) -> DataFrame:
    """prices with factor: the cumulative factor of the first ex_date after the price's date over that after as_of, 1 where there is none.

    Prices and factors are united and ordered backwards in time once; a factor of a price's own date doesn't count.
    Null keys meet nothing.
    """
    bars = prices.select(F.col(key), F.col(date).alias("_d"), F.lit(0).alias("_side"), F.lit(None).cast("double").alias("_c"), F.struct("*").alias("_row"))
    events = factors.where(F.col(key).isNotNull()).select(F.col(key), F.col(ex_date).alias("_d"), F.lit(1).alias("_side"), F.col("cumulative_factor").alias("_c"), F.lit(None).cast(bars.schema["_row"].dataType).alias("_row"))
    w = Window.partitionBy(key).orderBy(F.desc("_d"), "_side").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(key)
    after = F.lit(1.0) if as_of is None else F.coalesce(F.min_by("_c", F.when((F.col("_side") == 1) & (F.col("_d") > as_of), F.col("_d"))).over(whole), F.lit(1.0))
    both = bars.unionByName(events).select("_row", "_side", F.coalesce(F.last("_c", ignorenulls=True).over(w), F.lit(1.0)).alias("_f"), after.alias("_after"))
    # rounded factors may be zero: over it, zero is no number and the rest is infinite
    ratio = F.when(F.col("_after") != 0, F.col("_f") / F.col("_after")).when(F.col("_f") == 0, float("nan")).otherwise(float("inf"))
    return both.where("_side = 0").select("_row.*", ratio.alias("factor"))


def before(left: DataFrame, right: DataFrame, key: str, left_on: str, right_on: str, tie: str, values: list[str]) -> DataFrame:
    """left with the values of the latest right row of its key strictly before its day, else nulls."""
    return as_of(left, right, key, left_on, right_on, tie, values, delay="interval 1 day")


def around(left: DataFrame, right: DataFrame, key: str, left_on: str, right_on: str, value: str) -> DataFrame:
    """left with prev_{value}, the last one before its date, and next_{value}, the first one at its date or later; two running sorts, so that a row doesn't look through all that follow."""
    r = right.where(F.col(key).isNotNull()).select(F.col(key), F.col(right_on).alias("_t"), F.lit(1).alias("_side"), F.col(value).alias("_v"), F.lit(None).cast(left.select(F.struct("*")).schema[0].dataType).alias("_left"))
    l = left.select(F.col(key), F.col(left_on).alias("_t"), F.lit(0).alias("_side"), F.lit(None).cast(right.schema[value].dataType).alias("_v"), F.struct("*").alias("_left"))
    until = Window.unboundedPreceding, 0
    both = l.unionByName(r).select(
        "_left",
        F.last("_v", ignorenulls=True).over(Window.partitionBy(key).orderBy("_t", "_side").rowsBetween(*until)).alias(f"prev_{value}"),
        F.last("_v", ignorenulls=True).over(Window.partitionBy(key).orderBy(F.desc("_t"), F.desc("_side")).rowsBetween(*until)).alias(f"next_{value}"),
    )
    return both.where("_left is not null").select("_left.*", f"prev_{value}", f"next_{value}")


def in_window(df: DataFrame, key: str, date: str, days: int, value: Column) -> DataFrame:
    """df with total: value summed over the rows of its key in the days up to and including its own."""
    w = Window.partitionBy(key).orderBy(F.datediff(F.col(date), F.lit("1970-01-01"))).rangeBetween(-days, 0)
    return df.withColumn("total", F.sum(value).over(w))
