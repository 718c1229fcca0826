"""Checks of whole histories: what bars violate, counts that may only fall, and identities that look split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def source_of_bar() -> Column:
    """Where a bar came from, by what it has: trades are of files, vwap alone of the live source, neither of what was there before."""
    return F.when(F.col("trade_count").isNotNull(), "files").when(F.col("vwap").isNotNull(), "live").otherwise("old")


def bar_violations(bars: DataFrame, source: Column) -> DataFrame:
    """(source, kind, n) of bars that violate an invariant; kind 'any' counts each such bar once, source 'all' all sources.

    Bars without one of the four prices aren't judged; a null volume violates nothing. What doesn't occur has no row.
    """
    c = F.col
    kinds = {
        "high<low": c("high") < c("low"), "high<open": c("high") < c("open"), "high<close": c("high") < c("close"), "low>open": c("low") > c("open"), "low>close": c("low") > c("close"),
        "not positive": F.least("open", "high", "low", "close") <= 0, "negative volume": c("volume") < 0,
    }
    found = F.array_compact(F.array(*[F.when(x, k) for k, x in kinds.items()]))
    whole = bars.where(" and ".join(f"{x} is not null" for x in ("open", "high", "low", "close")))
    bad = whole.select(source.alias("source"), found.alias("_k")).where(F.size("_k") > 0)
    each = bad.select("source", F.explode(F.concat("_k", F.array(F.lit("any")))).alias("kind"))
    return each.select(F.explode(F.array("source", F.lit("all"))).alias("source"), "kind").groupBy("source", "kind").agg(F.count("*").alias("n"))


def ratchet(counts: DataFrame, allowed: DataFrame, by: Sequence[str], n: str = "n") -> DataFrame:
    """(by, n, allowed, beyond, state): counts against those allowed, which are known to be there.

    'new' has more than allowed, by beyond, and blocks; 'known' has as many; 'fewer' may be allowed less from now on. What
    either side lacks is 0; null keys are equal. Keys come once on each side.
    """
    a = allowed.select(*by, F.col(n).alias("allowed")).alias("a")
    condition = F.lit(True)
    for k in by:
        condition = condition & F.col(f"c.{k}").eqNullSafe(F.col(f"a.{k}"))
    both = counts.alias("c").join(a, condition, "full").select(*[F.coalesce(f"c.{k}", f"a.{k}").alias(k) for k in by], F.coalesce(F.col(f"c.{n}"), F.lit(0)).alias(n), F.coalesce("a.allowed", F.lit(0)).alias("allowed"))
    more = F.col(n) - F.col("allowed")
    return both.withColumn("beyond", F.greatest(more, F.lit(0))).withColumn("state", F.when(more > 0, "new").when(more < 0, "fewer").otherwise("known"))


def reconnectable(history: DataFrame, securities: DataFrame) -> DataFrame:
    """(security_id, symbol, active_id, active_symbol), each once: symbols of history that an active security of another id has now.

    Symbols are compared without regard to capitals. That is a sign of one security under two ids, or of a symbol used again.
    """
    h = history.select("security_id", "symbol", F.lower("symbol").alias("_s")).distinct()
    now = securities.where("is_active").select(F.col("security_id").alias("active_id"), F.col("symbol").alias("active_symbol"), F.lower("symbol").alias("_s"))
    return h.join(now, "_s").where("security_id <> active_id").drop("_s").distinct()
