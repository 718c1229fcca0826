"""Operators on master data: coverage flags, plans of changes, ledgers and step functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def flags(df: DataFrame, key: str, **tables: DataFrame) -> DataFrame:
    """df with a flag for each table: whether it has a row with the key. Keys are made distinct first, so rows don't multiply."""
    for name, t in tables.items():
        df = df.join(t.select(key).where(F.col(key).isNotNull()).distinct().withColumn(name, F.lit(True)), key, "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return df


def new_rows(ledger: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """ledger with the rows of batch whose keys it doesn't have; null keys are equal, of equal rows in batch one comes."""
    fresh = batch.dropDuplicates(list(keys)).alias("b")
    same = [F.col(f"b.{k}").eqNullSafe(F.col(f"l.{k}")) for k in keys]
    condition = same[0]
    for s in same[1:]:
        condition = condition & s
    return ledger.unionByName(fresh.join(ledger.alias("l"), condition, "left_anti"))


def retired(df: DataFrame, keys: Sequence[str], synthetic: Column, values: Sequence[str]) -> DataFrame:
    """df without synthetic rows that a real row of the same keys replaces: by equal values, nulls equal, or where there is exactly one of each."""
    w, same = Window.partitionBy(*keys), Window.partitionBy(*keys, *values)
    counted = df.withColumn("_s", synthetic).select("*", F.count_if(~F.col("_s")).over(same).alias("_same"), F.count_if(~F.col("_s")).over(w).alias("_real"), F.count_if("_s").over(w).alias("_made"))
    gone = F.col("_s") & ((F.col("_same") > 0) | ((F.col("_real") == 1) & (F.col("_made") == 1)))
    return counted.where(~gone).drop("_s", "_same", "_real", "_made")


def steps(legs: DataFrame, key: str, at: str, leg: str, value: str, names: Sequence[str]) -> DataFrame:
    """(key, at, names): every moment at which a leg changes, with the values of all legs as then known; equal states in a row come once."""
    wide = legs.groupBy(key, at).agg(*[F.max(F.when(F.col(leg) == n, F.col(value))).alias(n) for n in names])
    w = Window.partitionBy(key).orderBy(at)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    filled = wide.select(key, at, *[F.last(n, ignorenulls=True).over(run).alias(n) for n in names])
    state = F.struct(*names)
    return filled.withColumn("_b", F.lag(state).over(w)).where(F.col("_b").isNull() | ~F.col("_b").eqNullSafe(state)).drop("_b")


def renamed(history: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """history(key, symbol, start, end) after changes(key, symbol, at): the open span ends where the first new symbol begins, and each new span where the next does.

    Changes to the symbol that is there already don't count; of several on one day the last in order of symbols does. Keys
    without an open span stay as they are.
    """
    now = history.where(F.col("end").isNull()).select(key, F.col("symbol").alias("_now"))
    day = changes.groupBy(key, "at").agg(F.max("symbol").alias("symbol")).join(now, key)
    w = Window.partitionBy(key).orderBy("at")
    real = day.withColumn("_before", F.coalesce(F.lag("symbol").over(w), F.col("_now"))).where("symbol <> _before")
    chain = real.select(key, "symbol", F.col("at").alias("start"), F.lead("at").over(w).alias("end"))
    first = chain.groupBy(key).agg(F.min("start").alias("_first"))
    closed = history.join(first, key, "left").select(key, "symbol", "start", F.coalesce("end", "_first").alias("end"))
    return closed.unionByName(chain)


def best(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of every key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
