"""Upserts as whole-table rewrites: one full outer join on the key, columns chosen one by one."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_per_key(batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of every key in the order of a batch."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return batch.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], overwrite: Sequence[str] = (), keep_known: Sequence[str] = (), fill: Sequence[str] = (), stamp: str | None = None, now: Column | None = None) -> DataFrame:
    """old with the rows of new merged in by key; null keys are equal to each other.

    overwrite: a matched row takes the new value, null included. keep_known: the new value unless it is
    null. fill: the old value unless it is null. Other columns of a matched row stay as they are; those
    that new doesn't have stay in all. stamp, if given, becomes now in rows that new had.
    """
    o, n = old.withColumn("_was", F.lit(True)).alias("o"), new.withColumn("_came", F.lit(True)).alias("n")
    both = o.join(n, reduce(and_, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]), "full")
    was, came = F.col("o._was").isNotNull(), F.col("n._came").isNotNull()

    def column(c):
        a = F.col(f"o.{c}")
        if c == stamp:
            return F.when(came, now).otherwise(a)
        if c in keys:
            return F.when(was, a).otherwise(F.col(f"n.{c}"))
        if c not in new.columns:
            return a
        b = F.col(f"n.{c}")
        if c in fill:
            return F.coalesce(a, b)
        if c in overwrite:
            return F.when(came, b).otherwise(a)
        return F.coalesce(b, a) if c in keep_known else F.when(was, a).otherwise(b)

    return both.select(*[column(c).alias(c) for c in old.columns])


def by_presence(old: DataFrame, batch: DataFrame, keys: Sequence[str], given: str) -> DataFrame:
    """old upserted from a batch whose rows name the columns they give in the array given; a column that is given as null becomes null."""
    fields = [c for c in batch.columns if c not in (*keys, given)]
    o, n = old.withColumn("_was", F.lit(True)).alias("o"), batch.alias("n")
    both = o.join(n, reduce(and_, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]), "full")
    new = {c: F.when(F.array_contains(F.col(f"n.{given}"), c), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")) for c in fields}
    kept = [F.when(F.col("o._was").isNotNull(), F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")) if c in keys else new.get(c, F.col(f"o.{c}")) for c in old.columns]
    return both.select(*[x.alias(c) for x, c in zip(kept, old.columns)])


def replaced(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Newest version per key, as a replacing merge reads."""
    return last_per_key(df, keys, [version])
