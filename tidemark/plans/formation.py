"""Portfolios formed on a date, frozen as snapshots, and settled by later prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.cross_section import buckets
from tidemark.operators.joins import as_of


def formed(panel: DataFrame, value: str, size: str, sizes: int = 3, groups: int = 5, least: int = 1) -> DataFrame:
    """(date, security_id, value, place): the best group by value among the smallest of sizes classes, best first, on every date of panel.

    Rows without a value or a size take no part. A date with fewer than least small ones has none. Ties go to the smaller id.
    """
    known = panel.where(F.col(value).isNotNull() & F.col(size).isNotNull()).select("date", "security_id", F.col(value).alias("value"), F.col(size).alias("_size"))
    small = known.withColumn("_class", buckets("_size", sizes, 1)).where("_class = 1").withColumn("_group", buckets("value", groups, least)).where(F.col("_group") == groups)
    return small.select("date", "security_id", "value", F.row_number().over(Window.partitionBy("date").orderBy(F.desc("value"), "security_id")).alias("place"))


def continued(chosen: DataFrame, previous: DataFrame, n: int) -> DataFrame:
    """(date, security_id, value, place): n of chosen; those of previous(security_id, place) that are chosen again first, in their order, then the best others."""
    before = previous.select("security_id", F.col("place").alias("_before"))
    order = Window.partitionBy("date").orderBy(F.col("_before").isNull(), "_before", "place")
    return chosen.join(before, "security_id", "left").withColumn("_p", F.row_number().over(order)).where(F.col("_p") <= n).select("date", "security_id", "value", F.col("_p").alias("place"))


def snapshot(chosen: DataFrame, n: int, digits: int = 9) -> DataFrame:
    """chosen up to place n with w, equal weights, and inputs, a hash that is the same only for the same securities with the same values in the same order.

    A date's snapshot has n rows at most, so its hash is of a short list.
    """
    top = chosen.where(F.col("place") <= n)
    line = F.concat_ws(":", "place", "security_id", F.format_number("value", digits))
    own = Window.partitionBy("date")
    lines = F.array_sort(F.collect_list(F.struct("place", line.alias("x"))).over(own))
    return top.withColumn("w", 1.0 / F.count("*").over(own)).withColumn("inputs", F.sha2(F.array_join(F.transform(lines, lambda r: r["x"]), "|"), 256))


def executed(snapshots: DataFrame, dates: DataFrame) -> DataFrame:
    """(date, entry, exit) of every formation date: the first date after it, and after the next formation, on which there are prices; the last one of all where there is none.

    Dates are few whatever the number of securities, so they meet in one task.
    """
    f = snapshots.select("date", F.lit(True).alias("_formed")).distinct()
    all_ = dates.select("date").distinct().join(f, "date", "left")
    w = Window.orderBy("date")
    days = all_.select("date", "_formed", F.lead("date").over(w).alias("entry"), F.max("date").over(Window.partitionBy()).alias("_last")).where("_formed")
    return days.where("entry is not null").select("date", "entry", F.coalesce(F.lead("entry").over(w), "_last").alias("exit")).where("entry < exit")


def settled(snapshots: DataFrame, prices: DataFrame, days: DataFrame) -> DataFrame:
    """snapshots with entry, exit, ret and note: what each position returned between the days of executed.

    Both prices are the last ones on their day or before. Where there is none on the day of exit the last one is frozen;
    a position without any price returns nothing. Snapshots that aren't executed yet are left out, and none is changed.
    """
    p = prices.where(F.col("close").isNotNull()).select("security_id", "date", "close")
    held = snapshots.join(days, "date")
    first = as_of(held, p, "security_id", "entry", "date", "close", ["close"]).withColumnRenamed("asof_close", "_a")
    both = as_of(first, p, "security_id", "exit", "date", "close", ["close", "date"])
    ret = F.when(F.col("_a") > 0, F.col("asof_close") / F.col("_a") - 1)
    note = F.when(F.col("asof_close").isNull(), "missing").when(F.col("asof_date") < F.col("exit"), "frozen").otherwise("")
    return both.select(*snapshots.columns, "entry", "exit", F.coalesce(ret, F.lit(0.0)).alias("ret"), note.alias("note"))
