"""Price and volume factors: columns over a gridded panel of bars; each is one sort by security at most.

Windows count grid rows, gates count the values in them, as (rows, least number of values).
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.cross_section import percent_rank, residual
from tidemark.operators.windows import lagged, moving, ordered, returns, rolling


def _positive(x: Column) -> Column:
    return F.when(x > 0, x)


def _row() -> Column:
    return F.row_number().over(ordered())


def momentum(skip: int = 21, year: int = 252) -> Column:
    return lagged(F.col("close"), skip) / lagged(F.col("close"), year) - 1


def high_year(n: int = 252, least: int = 126) -> Column:
    return F.col("close") / rolling(F.max, F.col("close"), n, least)


def low_vol(n: int = 63, least: int = 42) -> Column:
    return -rolling(F.stddev_samp, F.col("ret"), n, least)


def max_lottery(n: int = 21, least: int = 15) -> Column:
    return -rolling(F.max, F.col("ret"), n, least)


def reversal(n: int = 21) -> Column:
    return -(lagged(F.col("close"), 1) / lagged(F.col("close"), n) - 1)


def shadow_asymmetry(n: int = 21, least: int = 15) -> Column:
    upper, lower = F.col("high") - F.greatest("open", "close"), F.least("open", "close") - F.col("low")
    return -rolling(F.avg, (upper - lower) / _positive(F.col("high") - F.col("low")), n, least)


def vwap_pressure(n: int = 5, least: int = 3) -> Column:
    return -rolling(F.avg, F.ln(_positive(F.col("close")) / _positive(F.col("vwap"))), n, least)


def money_flow(n: int = 14, least: int = 10) -> Column:
    """Days that rise, fall or are the first after a gap count in the gate; those without a rise or fall have no flow."""
    flow, change = F.col("typical") * F.col("volume"), F.col("typical") - F.col("typical_1")
    up, down = (rolling(F.sum, F.coalesce(F.when(c, flow), F.lit(0.0)), n, least) for c in (change > 0, change < 0))
    return -100 * up / _positive(up + down)


def strength(n: int = 14, least: int = 10) -> Column:
    gain, loss = (rolling(F.avg, F.greatest(s * F.col("change"), F.when(F.col("change").isNotNull(), 0.0)), n, least) for s in (1, -1))
    return -100 * gain / _positive(gain + loss)


def bollinger(n: int = 20, least: int = 15) -> Column:
    mid, sd = (rolling(f, F.col("close"), n, least) for f in (F.avg, F.stddev_samp))
    return -(F.col("close") - (mid - 2 * sd)) / (4 * _positive(sd))


def donchian(n: int = 55, least: int = 40) -> Column:
    low, high = (rolling(f, F.col("close"), n, least) for f in (F.min, F.max))
    return (F.col("close") - low) / _positive(high - low)


def sma_gap(n: int = 50, least: int = 38) -> Column:
    return F.col("close") / rolling(F.avg, F.col("close"), n, least) - 1


def _slope(flow: Column, n: int, least: int) -> Column:
    """What a running sum of flow gained over n rows, in average volumes."""
    gained = F.when(_row() > n, rolling(F.sum, F.coalesce(flow, F.lit(0.0)), n, 1))
    return gained / (_positive(rolling(F.avg, F.col("volume"), n, least)) * n)


def volume_slope(n: int = 21, least: int = 15) -> Column:
    return _slope(F.signum(F.col("change")) * F.col("volume"), n, least)


def close_location_slope(n: int = 21, least: int = 15) -> Column:
    place = ((F.col("close") - F.col("low")) - (F.col("high") - F.col("close"))) / _positive(F.col("high") - F.col("low"))
    return _slope(place * F.col("volume"), n, least)


def trend_in_ranges(n: int = 50, least: int = 38, range_n: int = 21, range_least: int = 15) -> Column:
    true_range = F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - F.col("close_1")), F.abs(F.col("low") - F.col("close_1")))
    return (F.col("close") - rolling(F.avg, F.col("close"), n, least)) / _positive(rolling(F.avg, true_range, range_n, range_least))


def volume_confirmed_reversal(n: int = 20, least: int = 15, volume_n: int = 21, cap: float = 3.0) -> Column:
    """The band position around its middle, times volume in averages up to cap."""
    unusual = F.col("volume") / _positive(rolling(F.avg, F.col("volume"), volume_n, least))
    return (bollinger(n, least) + 0.5) * F.when(unusual.isNotNull(), F.least(unusual, F.lit(cap)))


def information_discreteness(first: int = 251, last: int = 21, least: int = 231) -> Column:
    """Days that fell less days that rose, in the share of all, with the sign of the whole return."""
    w = ordered().rowsBetween(-first, -last)
    n, up, down = (F.count(x).over(w) for x in (F.col("ret"), F.when(F.col("ret") > 0, 1), F.when(F.col("ret") < 0, 1)))
    whole = lagged(F.col("close"), last) / lagged(F.col("close"), first + 1) - 1
    return F.when(n >= least, F.signum(whole) * (down - up) / n)


FACTORS: dict[str, Callable[[], Column]] = {
    f.__name__: f
    for f in (momentum, high_year, low_vol, max_lottery, reversal, shadow_asymmetry, vwap_pressure, money_flow, strength, bollinger, donchian, sma_gap, volume_slope, close_location_slope, trend_in_ranges, volume_confirmed_reversal)
}


def register(name: str, column: Callable[[], Column]) -> None:
    """Adds a factor of one's own; a name can be taken once."""
    if name in FACTORS:
        raise ValueError(f"there is a factor {name} already")
    FACTORS[name] = column


def prepared(grid: DataFrame) -> DataFrame:
    """The grid with returns and previous values, which several factors take."""
    typical = (F.col("high") + F.col("low") + F.col("close")) / 3
    return grid.withColumns({"ret": returns(), "change": F.col("close") - lagged(F.col("close"), 1), "close_1": lagged(F.col("close"), 1), "typical": typical, "typical_1": lagged(typical, 1)})


def factor(grid: DataFrame, name: str) -> DataFrame:
    """(date, security_id, value), rows without a value left out."""
    return prepared(grid).select("date", "security_id", FACTORS[name]().alias("value")).where("value is not null")


def eligible(grid: DataFrame, min_price: float = 3.0, min_median_dollar_volume: float = 2e6, n: int = 63, least: int = 42) -> DataFrame:
    """grid with eligible: price and median dollar volume of the last n rows reach their least values; false where one is missing."""
    dollars = F.col("close") * F.col("volume")
    median = rolling(lambda x: F.percentile(x, F.lit(0.5)), dollars, n, least)
    return grid.withColumn("eligible", F.coalesce((median >= min_median_dollar_volume) & (F.col("close") >= min_price), F.lit(False)))


def with_market(grid: DataFrame) -> DataFrame:
    """prepared(grid) with market, the mean return of its date."""
    p = prepared(grid)
    return p.withColumn("market", F.avg("ret").over(Window.partitionBy("date")))


def residual_vol(grid: DataFrame, n: int = 63, least: int = 42) -> DataFrame:
    """(date, security_id, value): volatility left by the market model, its moments taken where the security has a return."""
    r, m = F.col("ret"), F.when(F.col("ret").isNotNull(), F.col("market"))
    moments = {k: rolling(F.avg, x, n, least) for k, x in (("r", r), ("rr", r * r), ("m", m), ("mm", m * m), ("rm", r * m))}
    e = with_market(grid).select("date", "security_id", *[x.alias(k) for k, x in moments.items()])
    own, market = F.col("rr") - F.col("r") * F.col("r"), F.col("mm") - F.col("m") * F.col("m")
    left = own - F.pow(F.col("rm") - F.col("r") * F.col("m"), 2) / _positive(market)
    return e.select("date", "security_id", F.when((own > 0) & (left > -1e-12), -F.sqrt(F.greatest(left, F.lit(0.0)))).alias("value")).where("value is not null")


def residual_momentum(grid: DataFrame, n: int = 252, least: int = 126, first: int = 251, last: int = 21, formation: int = 231) -> DataFrame:
    """(date, security_id, value): residuals of a market model fitted on the n rows before each, summed over rows first to last before."""
    r, m = F.col("ret"), F.when(F.col("ret").isNotNull(), F.col("market"))
    seen = moving(with_market(grid).select("date", "security_id", "ret", "market"), {"r": r, "m": m, "mm": m * m, "rm": r * m}, n, 1)
    count = F.when(F.col("r_n") > 0, F.col("r_n"))
    fitted = seen.select("date", "security_id", "ret", "market", F.col("r_n").alias("n"), *[(F.col(f"{k}_sum") / count).alias(k) for k in ("r", "m", "mm", "rm")])
    var = F.col("mm") - F.col("m") * F.col("m")
    beta = (F.col("rm") - F.col("r") * F.col("m")) / F.when(var > 1e-18, var)
    left = F.when(F.col("n") >= least, F.col("ret") - (F.col("r") - beta * F.col("m")) - beta * F.col("market"))
    rest = moving(fitted.select("date", "security_id", left.alias("left")), {"left": F.col("left")}, first, last)
    return rest.select("date", "security_id", F.when((_row() > first) & (F.col("left_n") >= max(formation, 1)), F.col("left_sum")).alias("value")).where("value is not null")


def macd(grid: DataFrame, fast: tuple[int, int] = (12, 10), slow: tuple[int, int] = (26, 20), signal: tuple[int, int] = (9, 7)) -> DataFrame:
    """(date, security_id, value): difference of exponential means less its own, over the price; (span, least number of values).

    Exponential means weigh by the distance in grid rows, a recursion that window functions don't
    have; a group is one security's closes.
    """

    def of(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("date")
        mean = lambda x, span, least: x.ewm(span=span, min_periods=least).mean()
        line = mean(rows["close"], *fast) - mean(rows["close"], *slow)
        return rows.assign(value=(line - mean(line, *signal)) / rows["close"])[["date", "security_id", "value"]]

    closes = grid.select("date", "security_id", F.col("close").cast("double").alias("close"))
    found = closes.groupBy("security_id").applyInPandas(of, f"date date, security_id {grid.schema['security_id'].dataType.simpleString()}, value double")
    return found.where(F.col("value").isNotNull() & ~F.isnan("value"))


def reversal_ensemble(grid: DataFrame) -> DataFrame:
    """(date, security_id, value): mean percentile rank of four oscillators; all are required."""
    three = prepared(grid).select("date", "security_id", *[FACTORS[n]().alias(n) for n in ("bollinger", "money_flow", "strength")])
    four = three.join(macd(grid).withColumn("value", -F.col("value")), ["date", "security_id"], "left").withColumnRenamed("value", "macd")
    names = ("bollinger", "money_flow", "strength", "macd")
    ranked = four.repartition("date").select("date", "security_id", *[percent_rank(n).alias(n) for n in names])
    return ranked.select("date", "security_id", (sum((F.col(n) for n in names[1:]), F.col(names[0])) / len(names)).alias("value")).where("value is not null")


def combined(df: DataFrame, backbone: str, *others: str) -> Column:
    """Mean of percentile ranks, half for a missing one; null where the backbone is missing."""
    ranks = [F.coalesce(percent_rank(c), F.lit(0.5)) for c in others]
    return sum(ranks, percent_rank(backbone)) / (1 + len(others))


def composite(grid: DataFrame) -> DataFrame:
    """Mean of percentile ranks of low volatility and of the year-high ratio without its part in it; low_vol is required."""
    f = prepared(grid).select("date", "security_id", low_vol().alias("lv"), high_year().alias("hy"))
    # digits beyond the ninth are noise: residuals of two names are zeros but for it
    f = f.where("lv is not null").withColumn("res", F.round(residual("hy", "lv"), 9) + 0.0)
    return f.select("date", "security_id", combined(f, "lv", "res").alias("value"))
