"""Temporal and identity joins. None of them compares all pairs: each has an equality on its key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def as_of(left: DataFrame, right: DataFrame, key: str | Sequence[str], left_on: str, right_on: str, tie: str, values: list[str], max_age: str | None = None, delay: str = "interval 0 days", piece: str | None = None) -> DataFrame:
    """left with the values of the latest right row of its key that is visible at its time, else nulls.

    key is one column or several; null keys meet nothing. A right row is visible from right_on + delay; ties go to the largest tie. Rows older than max_age, an
    interval, give nulls. Both sides are united and ordered once, so a key's rows are never multiplied.
    piece, a unit of date_trunc, is for keys too large for a task: time is cut into pieces that tasks
    order on their own, and the last right row before a piece is carried into it.
    """
    by = [key] if isinstance(key, str) else list(key)
    payload = F.struct(*[F.col(c).alias(c) for c in dict.fromkeys((right_on, *values))])
    r = right.dropna(subset=by).select(*by, (F.col(right_on) + F.expr(delay)).alias("_t"), F.lit(0).alias("_side"), F.col(tie).alias("_tie"), payload.alias("_right"), F.lit(None).cast(left.select(F.struct("*")).schema[0].dataType).alias("_left"))
    l = left.select(*by, F.col(left_on).alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast(right.schema[tie].dataType).alias("_tie"), F.lit(None).cast(r.schema["_right"].dataType).alias("_right"), F.struct("*").alias("_left"))
    both, keys = r.unionByName(l), by
    if piece:
        both, keys = both.withColumn("_piece", F.date_trunc(piece, "_t")), [*by, "_piece"]
    w = Window.partitionBy(*keys).orderBy("_t", "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_found", F.last("_right", ignorenulls=True).over(w)).where("_side = 1")
    if piece:
        ends = both.groupBy(*keys).agg(F.max_by("_right", F.when(F.col("_side") == 0, F.struct("_t", "_tie"))).alias("_end"))
        earlier = Window.partitionBy(*by).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
        carried = ends.select(*keys, F.last("_end", ignorenulls=True).over(earlier).alias("_carried"))
        found = found.join(carried, keys, "left").withColumn("_found", F.coalesce("_found", "_carried"))
    fresh = F.lit(True) if max_age is None else F.col(f"_found.{right_on}") >= F.col("_t") - F.expr(max_age)
    return found.select("_left.*", *[F.when(fresh, F.col(f"_found.{c}")).alias(f"asof_{c}") for c in values])


def by_day(rows: DataFrame, keys: Sequence[str], on: str, value: str, days: int) -> DataFrame:
    """(keys, on, value) for every day: that of the last row of the keys on it or at most days before.

    For small tables of values by day, as rates are: each row is put on the days that it may be asked on, so that any number of
    asking rows meets it by an equality of key and day, and no key's rows have to be ordered in one task.
    """
    put = rows.where(F.col(value).isNotNull()).withColumn("_day", F.explode(F.sequence(F.col(on), F.date_add(on, days))))
    return put.groupBy(*keys, F.col("_day").alias("_on")).agg(F.max_by(value, on).alias(value)).withColumnRenamed("_on", on)


def nearest(left: DataFrame, right: DataFrame, by: list[str], left_on: str, right_on: str, id_col: str, target_days: int, tolerance: int) -> DataFrame:
    """left rows with the right row nearest to target_days before, within tolerance, and before them; ties to the earlier one.

    Dates are dealt into spans as wide as the tolerance reaches, and a left row meets three of them at
    most, so only rows in reach of each other are compared.
    """
    width = 2 * tolerance + 1
    span = lambda d: F.floor(F.datediff(d, F.lit("1970-01-01")) / width)
    r = right.select(*by, F.col(right_on).alias("_on"), F.col(id_col).alias("match_id"), span(F.col(right_on)).alias("_span"))
    aim = F.date_sub(F.col(left_on).cast("date"), target_days)
    spans = F.sequence(span(F.date_sub(aim, tolerance)), span(F.date_add(aim, tolerance)))
    gap = F.datediff(F.col(left_on), F.col("_on"))
    near = left.withColumn("_span", F.explode(spans)).join(r, [*by, "_span"]).where((F.abs(gap - target_days) <= tolerance) & (gap > 0))
    w = Window.partitionBy(id_col).orderBy(F.abs(gap - target_days), "_on", "match_id")
    return near.withColumn("gap", gap).withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "_on", "_span")


def unambiguous(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value) for keys with exactly one distinct value."""
    one = df.where(F.col(value).isNotNull()).groupBy(key).agg(F.min(value).alias(value), F.max(value).alias("_most"))
    return one.where(F.col(value) == F.col("_most")).drop("_most")


def in_tenure(left: DataFrame, tenures: DataFrame, key: str, on: str, span_days: int = 64) -> DataFrame:
    """left rows inside exactly one half-open tenure [start, end) of their key, with its tenure_id; a row that comes twice stays twice.

    Null ends are open until the last date of left. A tenure is put into every span of span_days that it touches, and the
    distinct moments of a key meet the tenures of their own span only. Null keys and moments are in no tenure.
    """
    span = lambda d: F.floor(F.datediff(d, F.lit("1970-01-01")) / span_days)
    last = left.agg(F.max(F.col(on).cast("date")).alias("_last"))
    until = F.coalesce(F.col("end").cast("date"), F.col("_last"))
    put = tenures.join(F.broadcast(last))  # a single row
    put = put.where(F.col("start").cast("date") <= until).withColumn("_span", F.explode(F.sequence(span(F.col("start")), span(until))))
    asked = left.select(F.col(key).alias("_k"), F.col(on).alias("_on")).distinct().withColumn("_span", span(F.col("_on")))
    held = put.select(F.col(key).alias("_k"), "_span", "start", "end", "tenure_id")
    inside = (F.col("_on") >= F.col("start")) & (F.col("end").isNull() | (F.col("_on") < F.col("end")))
    hits = asked.join(held, ["_k", "_span"]).where(inside).groupBy("_k", "_on").agg(F.min("tenure_id").alias("tenure_id"), F.count("*").alias("_n"))
    one = hits.where("_n = 1").drop("_n")
    return left.join(one, (left[key] == one["_k"]) & (left[on] == one["_on"])).select(*left.columns, "tenure_id")
