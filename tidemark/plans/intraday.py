"""Features of a day from its ticks, and spread estimators; arrays hold one security's day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.windows import rolling


def minute_of_day(at: Column) -> Column:
    return F.hour(at) * 60 + F.minute(at)


def total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda acc, x: acc + x)


def pairs(xs: Column, f) -> Column:
    """f of every element and the one before it."""
    n = F.size(xs)
    return F.when(n > 1, F.zip_with(F.slice(xs, F.lit(2), n - 1), F.slice(xs, F.lit(1), n - 1), f)).otherwise(F.array().cast("array<double>"))


def roll_spread(rets: Column, least: int = 30) -> Column:
    """Twice the root of the negative covariance of neighbouring returns; null for too few, or where it is not negative."""
    n = F.size(rets)
    mean = total(rets) / F.when(n > 0, n)
    cov = total(pairs(rets, lambda a, b: (a - mean) * (b - mean))) / F.when(n > 1, n - 1)
    return F.when((n >= least) & (cov < 0), 2 * F.sqrt(-cov))


def corwin_schultz(buckets: Column, least: int = 10) -> Column:
    """The mean spread from highs and lows of adjoining buckets(i, high, low) in order; negative ones are left out, null for too few."""
    k = 3 - 2 * 2**0.5

    def one(b: Column, a: Column) -> Column:
        sq = lambda x: x * x
        beta = sq(F.ln(a["high"] / a["low"])) + sq(F.ln(b["high"] / b["low"]))
        gamma = sq(F.ln(F.greatest(a["high"], b["high"]) / F.least(a["low"], b["low"])))
        alpha = (F.sqrt(2 * beta) - F.sqrt(beta)) / k - F.sqrt(gamma / k)
        fit = (b["i"] - a["i"] == 1) & (F.least(a["low"], b["low"], a["high"], b["high"]) > 0)
        return F.when(fit, 2 * F.tanh(alpha / 2))

    n = F.size(buckets)
    spreads = F.when(n > 1, F.zip_with(F.slice(buckets, F.lit(2), n - 1), F.slice(buckets, F.lit(1), n - 1), one))
    kept = F.filter(spreads, lambda s: s >= 0)
    return F.when(F.size(kept) >= least, total(kept) / F.size(kept))


def daily_features(ticks: DataFrame, open_: int, close: int, first: int, last: int, bucket: int = 5, least_bars: int = 100, least_returns: int = 30, least_pairs: int = 10) -> DataFrame:
    """Features by (security_id, date) from ticks(security_id, at, price, size), at a local timestamp.

    Minutes open_ to close are the session, up to first its beginning and from last on its end. Sums and
    shares without a base are 0, spreads null. Returns are of the last prices of buckets of minutes.
    """
    t = ticks.withColumn("md", minute_of_day(F.col("at"))).withColumn("date", F.col("at").cast("date")).withColumn("rth", F.col("md").between(open_, close))
    rth = lambda x, c=None: F.when(F.col("rth") if c is None else F.col("rth") & c, x)
    order = F.struct("at", "id")
    b = t.withColumn("i", F.floor(F.col("md") / bucket))
    at = b.where("rth").groupBy("security_id", "date", "i").agg(F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", order).alias("close"))
    arrays = at.groupBy("security_id", "date").agg(F.array_sort(F.collect_list(F.struct("i", "high", "low", "close"))).alias("b"))
    sums = t.groupBy("security_id", "date").agg(
        F.count_if("rth").alias("n_bars"), F.coalesce(F.sum(rth(F.col("size"))), F.lit(0)).alias("rth_volume"), F.sum("size").alias("total_volume"),
        F.coalesce(F.sum(rth(F.col("size"), F.col("md") >= last)), F.lit(0)).alias("vol_last"),
        F.min_by("price", rth(order)).alias("open"), F.max_by("price", rth(order, F.col("md") < first)).alias("first"),
        F.max_by("price", rth(order, F.col("md") < last)).alias("before"), F.max_by("price", rth(order)).alias("close"),
    )
    f = sums.join(arrays, ["security_id", "date"], "left")
    logs = F.transform("b", lambda x: F.ln(x["close"]))
    f = f.withColumn("rets", F.when((F.col("n_bars") >= least_bars) & (F.size("b") >= least_returns), pairs(logs, lambda x, y: x - y)).otherwise(F.array().cast("array<double>")))
    squares = lambda keep: total(F.transform("rets", lambda x: F.when(keep(x), x * x).otherwise(0.0)))
    f = f.withColumn("rv", squares(lambda x: F.lit(True)))
    n = F.size("rets")
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    move = lambda a, b: F.coalesce(F.col(b) / F.col(a) - 1, F.lit(0.0))
    return f.select(
        "security_id", "date", "n_bars", "rth_volume", "total_volume", move("open", "first").alias("ret_first"), move("before", "close").alias("ret_last"), "rv",
        squares(lambda x: x > 0).alias("rv_up"), squares(lambda x: x < 0).alias("rv_down"),
        F.when((F.col("rv") > 0) & (n >= least_returns - 1), F.sqrt(n.cast("double")) * total(F.transform("rets", lambda x: x * x * x)) / F.pow("rv", F.lit(1.5))).otherwise(0.0).alias("rskew"),
        F.when(n >= least_returns - 1, total(pairs(F.col("rets"), lambda a, b: F.abs(a) * F.abs(b)))).otherwise(0.0).alias("bipower"),
        (1 - share("rth_volume", "total_volume")).alias("ext_share"), share("vol_last", "rth_volume").alias("last_share"),
        F.when(F.col("n_bars") >= least_bars, corwin_schultz(F.col("b"), least_pairs)).alias("cs_spread"), roll_spread(F.col("rets"), least_returns - 1).alias("roll_spread"),
    )


def known(features: DataFrame, least_bars: int) -> DataFrame:
    """features with every feature null on days of too few bars, and a skew of nothing as null."""
    names = [c for c in features.columns if c not in ("security_id", "date", "n_bars")]
    enough = features.select("security_id", "date", "n_bars", *[F.when(F.col("n_bars") >= least_bars, F.col(c)).alias(c) for c in names])
    return enough.withColumn("rskew", F.when(F.col("rskew") != 0, F.col("rskew")))


FACTORS = {
    "realized_skew": lambda n, k: -rolling(F.avg, F.col("rskew"), n, k),
    "signed_jump": lambda n, k: -rolling(F.avg, (F.col("rv_up") - F.col("rv_down")) / F.when(F.col("rv") > 0, F.col("rv")), n, k),
    "last_persistence": lambda n, k: rolling(F.avg, F.col("ret_last"), n, k),
    "smart_money_gap": lambda n, k: rolling(F.avg, F.col("ret_last") - F.col("ret_first"), n, k),
    "end_reversal": lambda n, k: -F.col("ret_last"),
    "end_reversal_flow": lambda n, k: -F.col("ret_last") * F.least(F.col("last_share") / F.when((m := rolling(F.avg, F.col("last_share"), n, k)) > 0, m), F.when(m.isNotNull(), 3.0)),
}
