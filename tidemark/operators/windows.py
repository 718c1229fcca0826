"""Rolling and ordered operators over long panels keyed by (security_id, date)."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from math import ceil

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: Megabytes of input files for each task that rows are dealt to.
MB_OF_A_TASK = 16


def dealt(df: DataFrame, *keys: str, mb: float = MB_OF_A_TASK) -> DataFrame:
    """df dealt by keys, to one task for each mb of the files it is read from, so that what a task holds doesn't grow with them.

    Inputs of fewer such tasks than there are cores, and rows of no files, are dealt as the session says. Only the lengths of files are read.
    """
    spark, files = df.sparkSession, df.inputFiles()
    size = spark.read.format("binaryFile").load(files).agg(F.sum("length")).first()[0] if files else 0
    n = ceil(size / (mb * 2**20))
    return df.repartition(n, *keys) if n > spark.sparkContext.defaultParallelism else df.repartition(*keys)


def ordered() -> WindowSpec:
    """The rows of a security by date."""
    return Window.partitionBy("security_id").orderBy("date")


def lagged(x: Column | str, n: int) -> Column:
    return F.lag(x, n).over(ordered())


def rolling(agg: Callable[[Column], Column], x: Column, n: int, least: int) -> Column:
    """agg of x over the last n grid rows, null unless least of them are non-null."""
    w = ordered().rowsBetween(1 - n, 0)
    return F.when(F.count(x).over(w) >= least, agg(x).over(w))


def moving(df: DataFrame, values: Mapping[str, Column], first: int, last: int) -> DataFrame:
    """df with {name}_sum and {name}_n, the sum and the number of the non-nulls of each value over the rows from first to last before.

    Differences of running totals, so that a row costs the same however long the frame is. A sum is zero where there are no
    values, and no number where one of them is none or infinite.
    """
    w = ordered().rowsBetween(Window.unboundedPreceding, 0)
    totals, found = {}, {}
    for name, x in values.items():
        odd = F.isnan(x) | (F.abs(x) == float("inf"))
        totals |= {f"_{name}_sum": F.sum(F.when(x.isNotNull() & ~odd, x).otherwise(0.0)).over(w), f"_{name}_n": F.count(x).over(w), f"_{name}_odd": F.count(F.when(odd, 1)).over(w)}
        total, n, odd = (F.lag(f"_{name}_{k}", last, 0).over(ordered()) - F.lag(f"_{name}_{k}", first + 1, 0).over(ordered()) for k in ("sum", "n", "odd"))
        found |= {f"{name}_sum": F.when(odd > 0, float("nan")).otherwise(total), f"{name}_n": n}
    return df.withColumns(totals).withColumns(found).drop(*totals)


def returns(price: Column | str = "close") -> Column:
    """Change from the previous grid row; null where either is missing, so gaps are not bridged."""
    p = F.col(price) if isinstance(price, str) else price
    return p / lagged(p, 1) - 1


def forward_filled(x: Column | str) -> Column:
    return F.last(x, ignorenulls=True).over(ordered().rowsBetween(Window.unboundedPreceding, 0))


def runs(df: DataFrame, key: str, ts: str, gap_seconds: int, least: int = 1) -> DataFrame:
    """Islands of rows at most gap_seconds apart: (key, run_id, first, last, n) with at least so many rows."""
    w = Window.partitionBy(key).orderBy(ts)
    new = (F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.lag(ts).over(w).cast("timestamp")) > gap_seconds * 1_000_000).cast("int")
    numbered = df.withColumn("_new", F.coalesce(new, F.lit(0))).withColumn("run_id", F.sum("_new").over(w.rangeBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(key, "run_id").agg(F.min(ts).alias("first"), F.max(ts).alias("last"), F.count("*").alias("n")).where(F.col("n") >= least)


def not_behind(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """Rows whose value is not below the running maximum of their key in order."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("_max", F.max(value).over(w)).where(F.col(value) >= F.col("_max")).drop("_max")
