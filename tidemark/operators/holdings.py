"""Institutional holdings as events: what filers told in time, and what they told at last."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.events import no_regressions
from tidemark.operators.joins import as_of

#: Days after a quarter's end until which a filing is in time: the term of 45 days, and one for a weekend. Fixed value.
ON_TIME_DAYS = 46


def staged(holdings: DataFrame, days: int = ON_TIME_DAYS) -> DataFrame:
    """(security_id, period, early, final), structs (visible, holders, total, shares, squares) of holdings(filer, security_id, period, accession, filed, value, shares).

    A filer's final accession of a period is the last one filed, its early one the last one filed in time. Rows of one
    accession are summed, visible is the last day on which a filing that counts was made. The choice is made over filings,
    which are few, and rows are only summed.
    """
    told = F.struct("filed", "accession")
    in_time = F.col("filed") <= F.date_add("period", days)
    picks = holdings.groupBy("filer", "period").agg(F.max(told).alias("_final"), F.max(F.when(in_time, told)).alias("_early"))
    mine = holdings.join(picks, ["filer", "period"]).withColumn("is_final", told == F.col("_final")).withColumn("is_early", F.coalesce(told == F.col("_early"), F.lit(False)))
    per = mine.where("is_final or is_early").groupBy("security_id", "period", "filer", "filed", "is_final", "is_early").agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("v"), F.sum("shares").cast("double").alias("n"))

    def stage(flag: str):
        v, n, at, who = (F.when(F.col(flag), F.col(c)) for c in ("v", "n", "filed", "filer"))
        return F.struct(F.max(at).alias("visible"), F.count(who).alias("holders"), F.sum(v).alias("total"), F.sum(n).alias("shares"), F.sum(v * v).alias("squares"))

    return per.groupBy("security_id", "period").agg(stage("is_early").alias("early"), stage("is_final").alias("final"))


def institutional_events(holdings: DataFrame, days: int = ON_TIME_DAYS) -> DataFrame:
    """(security_id, period, visible, holders, total, shares, hhi): up to two events for a security's quarter, each visible from its own last filing on.

    The early one is there where it was visible before the final one. A quarter's event that comes after one of a later
    quarter was visible is left out. hhi is null where the total isn't positive.
    """
    s = staged(holdings, days)
    early = F.when(F.col("early.visible").isNotNull() & (F.col("final.visible").isNull() | (F.col("early.visible") < F.col("final.visible"))), F.col("early"))
    both = F.array_compact(F.array(early, F.when(F.col("final.visible").isNotNull(), F.col("final"))))
    events = s.select("security_id", "period", F.inline(both))
    hhi = F.when(F.col("total") > 0, F.col("squares") / (F.col("total") * F.col("total"))).alias("hhi")
    return no_regressions(events, "security_id", ["visible", "period"], "period").select("security_id", "period", "visible", "holders", "total", "shares", hhi)


def changes_of_shares(events: DataFrame) -> DataFrame:
    """events with change: shares against those of the quarter before, as that was known when the event became visible.

    The quarter before is the one next to it among the security's events; null where none of its events was visible yet or
    its shares weren't positive.
    """
    w = Window.partitionBy("security_id").orderBy(F.datediff("period", F.lit("1970-01-01"))).rangeBetween(Window.unboundedPreceding, -1)
    before = events.withColumn("before", F.max("period").over(w))
    base = events.select("security_id", F.col("period").alias("before"), "visible", "shares")
    found = as_of(before, base, ["security_id", "before"], "visible", "visible", "shares", ["shares"])
    change = F.when(F.col("asof_shares") > 0, (F.col("shares") - F.col("asof_shares")) / F.col("asof_shares"))
    return found.withColumn("change", change).drop("before", "asof_shares")
