"""Composites of several factors: who is eligible, ranks among those only, and their mean."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.cross_section import by_date, percent_rank


def with_holes(actions: DataFrame, prices: DataFrame, first: str, last: str, kinds: Sequence[str] | None = None, trusted: str = "trusted") -> DataFrame:
    """(security_id) with an action from first to last that no trusted source tells and that lies inside the security's prices.

    An action before all prices has nothing to adjust, and one after them all moves them alike. actions(security_id, kind,
    ex_date, source): a trusted action of the same kind and day covers another one.
    """
    a = actions.where(F.col("ex_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    a = a if kinds is None else a.where(F.col("kind").isin(*kinds))
    key = ["security_id", "kind", "ex_date"]
    bare = a.where(~F.col("source").eqNullSafe(trusted)).join(a.where(F.col("source") == trusted).select(*key), key, "left_anti")
    spans = prices.groupBy("security_id").agg(F.min("date").alias("_a"), F.max("date").alias("_b"))
    return bare.join(spans, "security_id").where("_a < ex_date and ex_date <= _b").select("security_id").distinct()


def gated(panel: DataFrame, holes: DataFrame) -> DataFrame:
    """The eligible rows of panel, without securities in holes."""
    return panel.where("eligible").join(holes.select("security_id"), "security_id", "left_anti")


def rank_residual(y: str, x: str) -> Column:
    """What a date's line through (x, y) leaves of y; null where a side is missing or x doesn't vary."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    u, v = F.when(both, F.col(x)), F.when(both, F.col(y))
    var = F.var_pop(u).over(by_date())
    return F.when(var > 1e-18, v - F.avg(v).over(by_date()) - F.covar_pop(u, v).over(by_date()) / F.when(var > 1e-18, var) * (u - F.avg(u).over(by_date())))


def composite(panel: DataFrame, base: str, others: Sequence[str], residual: str | None = None) -> DataFrame:
    """(date, security_id, value) of panel(date, security_id, base, others), whose rows are all eligible; rows without base are left out.

    The mean of percentile ranks, one half for what is missing. The rank of residual, one of others, is replaced by the
    rank of what the line through the rank of base leaves of it, so that it doesn't count base twice. One exchange by date.
    """
    legs = (base, *others)
    ranked = panel.repartition("date").select("date", "security_id", *[percent_rank(c).alias(c) for c in legs])
    if residual is not None:
        # digits beyond the ninth are noise: residuals of two names are zeros but for it
        left = ranked.withColumn(residual, F.round(rank_residual(residual, base), 9) + 0.0)
        ranked = left.withColumn(residual, percent_rank(residual))
    total = sum((F.coalesce(F.col(c), F.lit(0.5)) for c in others), F.col(base))
    return ranked.where(F.col(base).isNotNull()).select("date", "security_id", (total / len(legs)).alias("value"))
