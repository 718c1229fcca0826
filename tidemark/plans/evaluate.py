"""Evaluation of a factor: rank IC, Newey-West statistics, quantile portfolios with costs, performance."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.cross_section import average_rank, buckets, correlation, rank_ic
from tidemark.operators.windows import forward_filled, ordered


def forward_return(horizon: int, price: str = "close") -> Column:
    """Filled price horizon rows ahead over the base price, where the base itself is priced."""
    return F.lead("filled", horizon).over(ordered()) / F.col(price) - 1


def with_forward(grid: DataFrame, horizon: int) -> DataFrame:
    return grid.withColumn("filled", forward_filled("close")).withColumn("forward", forward_return(horizon))


def with_terminal_forward(grid: DataFrame, horizon: int, terminal: str, step_days: int) -> DataFrame:
    """with_forward, with the terminal return of a security that left the market compounded into windows that it falls in.

    A security has left where its last price is before the last date of all; from its last price on, the return of the
    column terminal counts, once. A null terminal compounds nothing: the last price is then held as long as there are dates.
    Rows after the last price have no forward return.
    """
    g = with_forward(grid, horizon)
    own = Window.partitionBy("security_id")
    last = F.max(F.when(F.col("close").isNotNull(), F.col("date"))).over(own)
    g = g.withColumn("_last", last).withColumn("_final", F.max_by("close", F.when(F.col("close").isNotNull(), F.col("date"))).over(own))
    g = g.join(F.broadcast(grid.agg(F.max("date").alias("_end"))))  # a single row
    rows = lambda a, b: F.datediff(b, a) / step_days
    inside = (F.col("date") <= F.col("_last")) & (rows(F.col("date"), F.col("_last")) < horizon)
    out = F.col("_last") < F.col("_end")
    held = F.when(rows(F.col("date"), F.col("_end")) >= horizon, F.col("_final") / F.col("close") - 1)
    ended = F.col("_final") / F.col("close") * (1 + F.col(terminal)) - 1
    forward = F.when(inside & out & F.col(terminal).isNotNull(), ended).when(inside & out, held).when(F.col("date") <= F.col("_last"), F.col("forward"))
    return g.withColumn("forward", forward).drop("_last", "_final", "_end")


def lag_rule(n: int, horizon: int) -> int:
    return max(horizon, math.floor(4 * (n / 100) ** (2 / 9)))


def newey_west(series: DataFrame, value: str, horizon: int, order: str = "date") -> DataFrame:
    """(n, mean, t) of an ordered series of one row for each date, nulls left out; one row.

    t has Bartlett weights and population moments. It is null for fewer than two values and where a
    series without variation has mean zero, and infinite with the mean's sign where only the variance
    is not positive. The series, not the panel, meets in one array: it grows with dates alone.
    """
    rows = series.where(F.col(value).isNotNull()).agg(F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).cast("double").alias("x")))), lambda r: r["x"]).alias("x"))
    n = F.size("x")
    lags = F.least(F.greatest(F.lit(horizon), F.floor(4 * F.pow(n / 100, F.lit(2 / 9))).cast("int")), n - 1)
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda acc, x: acc + x)
    centred = rows.select("x", n.alias("n"), lags.alias("lags"), (total("x") / F.when(n > 0, n)).alias("mean")).withColumn("d", F.transform("x", lambda x: x - F.col("mean")))

    def covariance(k: Column) -> Column:
        return total(F.zip_with(F.slice("d", k + 1, F.greatest(F.col("n") - k, F.lit(0))), F.slice("d", F.lit(1), F.greatest(F.col("n") - k, F.lit(0))), lambda a, b: a * b)) / F.col("n")

    weighted = F.transform(F.sequence(F.lit(0), F.greatest("lags", F.lit(0))), lambda k: covariance(k) * F.when(k == 0, 1.0).otherwise(2 * (1 - k / (F.col("lags") + 1))))
    out = centred.withColumn("v", F.when(F.col("n") >= 2, total(weighted)))
    t = F.when(F.col("v") > 0, F.col("mean") / F.sqrt(F.col("v") / F.col("n"))).when((F.col("v") <= 0) & (F.col("mean") != 0), F.signum("mean") * float("inf"))
    return out.select(F.col("n").cast("long").alias("n"), "mean", t.alias("t"))


def quantile_returns(panel: DataFrame, n: int, least: int) -> DataFrame:
    """(date, bucket, ret, n): equal-weighted forward returns of the factor's buckets."""
    b = panel.where("value is not null").withColumn("bucket", buckets("value", n, least)).where("bucket is not null")
    return b.groupBy("date", "bucket").agg(F.avg("forward").alias("ret"), F.count("forward").alias("n"))


def long_short(panel: DataFrame, n: int, least: int) -> DataFrame:
    """panel with w: half a unit long in the top bucket of value and half a unit short in the bottom one, equally weighted."""
    b = panel.withColumn("bucket", buckets("value", n, least))
    size = F.count("*").over(Window.partitionBy("date", "bucket"))
    return b.withColumn("w", F.when(F.col("bucket") == n, 0.5 / size).when(F.col("bucket") == 1, -0.5 / size).otherwise(0.0)).drop("bucket")


def runs_of_weights(weights: DataFrame, cost: float | str, freeze: bool = True, terminal: str | None = None) -> DataFrame:
    """(date, gross, net, turnover) of weights(date, security_id, close, w), a row for each security and date of the grid.

    Weights are held from the next date on. Across a gap in the prices the weight held at its first row
    stays, and the whole gap's return falls on the first price after it. terminal names a column with
    the return of a long position on the first row after a security's last price; without one it is
    nothing. Cost is paid on traded weight: one fraction for all, or a column with that of each row, which must not be
    null where weight is traded.
    """
    before = ordered().rowsBetween(Window.unboundedPreceding, -1)
    past = F.last("close", ignorenulls=True).over(before)
    future = F.count("close").over(ordered().rowsBetween(0, Window.unboundedFollowing)) > 0
    missing = F.col("close").isNull()
    own_cost = cost if isinstance(cost, str) else None
    columns = ["date", "security_id", "close", "w", *([terminal] if terminal else []), *([own_cost] if own_cost else [])]
    held = weights.select(*columns, F.coalesce(F.lag("w").over(ordered()), F.lit(0.0)).alias("held"), past.alias("past"), future.alias("future"), F.lag(missing, 1, False).over(ordered()).alias("was_missing"))
    entry = F.when(missing & ~F.col("was_missing"), F.col("held"))
    kept = F.when(missing | F.col("was_missing"), F.last(entry, ignorenulls=True).over(ordered().rowsBetween(Window.unboundedPreceding, 0)))
    ret = F.when(~missing, F.col("close") / F.col("past") - 1)
    over = missing & ~F.col("future") & (F.col("held") > 0)
    rows = held.select("*", (F.coalesce(kept, F.col("held")) if freeze else F.col("held")).alias("carried"), over.alias("over"))
    if terminal:
        first = F.col("over") & ~F.coalesce(F.lag("over").over(ordered()), F.lit(False))
        ret = F.when(first, F.col(terminal)).otherwise(ret)
    traded = F.abs(F.col("w") - F.col("held"))
    totals = [F.sum(F.col("carried") * F.coalesce("ret", F.lit(0.0))).alias("gross"), F.sum("traded").alias("turnover")]
    if own_cost is None:
        daily = rows.select("date", traded.alias("traded"), "carried", ret.alias("ret")).groupBy("date").agg(*totals)
        return daily.select("date", "gross", (F.col("gross") - cost * F.col("turnover")).alias("net"), "turnover")
    unknown = F.raise_error(F.concat(F.lit("no cost of traded security "), F.col("security_id").cast("string"))).cast("double")
    paid = F.when(traded > 0, traded * F.coalesce(F.col(own_cost), unknown)).otherwise(0.0)
    daily = rows.select("date", traded.alias("traded"), paid.alias("paid"), "carried", ret.alias("ret")).groupBy("date").agg(*totals, F.sum("paid").alias("paid"))
    return daily.select("date", "gross", (F.col("gross") - F.col("paid")).alias("net"), "turnover")


def backtest(panel: DataFrame, n: int, least: int, cost: float) -> DataFrame:
    """(date, gross, net, turnover) of the long-short portfolio of panel(date, security_id, value, close)."""
    return runs_of_weights(long_short(panel, n, least), cost)


def last_of(df: DataFrame, period: str) -> DataFrame:
    """df with rebalance: whether a date is the last one that any security has in its period ('month', 'week')."""
    last = df.groupBy(F.date_trunc(period, "date").alias("_p")).agg(F.max("date").alias("_last"))
    return df.withColumn("_p", F.date_trunc(period, "date")).join(F.broadcast(last), "_p").withColumn("rebalance", F.col("date") == F.col("_last")).drop("_p", "_last")


def hold_between(weights: DataFrame) -> DataFrame:
    """weights(…, w, rebalance) with the weight of the last rebalance on every date; nothing before the first."""
    at = F.last(F.when(F.col("rebalance"), F.coalesce("w", F.lit(0.0))), ignorenulls=True).over(ordered().rowsBetween(Window.unboundedPreceding, 0))
    return weights.withColumn("w", F.coalesce(at, F.lit(0.0)))


def equal_weight(df: DataFrame, chosen: Column) -> DataFrame:
    """df with w: one over the number chosen on the date for those, nothing for others."""
    return df.withColumn("_in", F.coalesce(chosen, F.lit(False))).withColumn("w", F.when(F.col("_in"), 1.0 / F.count_if("_in").over(Window.partitionBy("date"))).otherwise(0.0)).drop("_in")


def ic_decay(panel: DataFrame, lags: int, least: int) -> DataFrame:
    """(lag, ic, n): the mean rank IC of value against the forward return of the row lag later, over the dates that have one."""
    ahead = panel.select("date", "security_id", "value", *[F.lead("forward", k).over(ordered()).alias(f"f{k}") for k in range(lags + 1)])
    shifted = ahead.select("date", "value", F.inline(F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"f{k}").alias("forward")) for k in range(lags + 1)])))
    ranked = shifted.repartition("date", "lag").select("date", "lag", average_rank("value", ["date", "lag"]).alias("a"), average_rank("forward", ["date", "lag"]).alias("b")).where("a is not null and b is not null")
    ics = ranked.groupBy("date", "lag").agg(correlation("a", "b").alias("ic"), F.count("*").alias("n")).where((F.col("n") >= least) & F.col("ic").isNotNull())
    return ics.groupBy("lag").agg(F.avg("ic").alias("ic"), F.count("*").alias("n"))


def half_life(decay: DataFrame) -> DataFrame:
    """(lag): the first lag whose absolute IC is at most half of that of lag 0; null if there is none."""
    base = F.max_by(F.abs("ic"), F.when(F.col("lag") == 0, 1))
    rows = decay.agg(base.alias("base"), F.collect_list(F.struct("lag", F.abs("ic").alias("a"))).alias("r"))
    return rows.select(F.array_min(F.transform(F.filter("r", lambda r: r["a"] <= F.col("base") / 2), lambda r: r["lag"])).alias("lag"))


def rank_correlations(df: DataFrame, names: list[str], least: int) -> DataFrame:
    """(a, b, corr, dates): mean over dates of the correlation of two columns' ranks; pairs in the order of names."""
    ranked = df.repartition("date").select("date", *[average_rank(n).alias(n) for n in names])
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    both = lambda a, b, x: F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.col(x))
    per = ranked.select("date", *[both(a, b, x).alias(f"{a}|{b}|{x}") for a, b in pairs for x in (a, b)])
    by_date = per.groupBy("date").agg(*[F.when(F.count(f"`{a}|{b}|{a}`") >= least, correlation(f"`{a}|{b}|{a}`", f"`{a}|{b}|{b}`")).alias(f"{a}|{b}") for a, b in pairs])
    long = by_date.unpivot(["date"], [f"`{a}|{b}`" for a, b in pairs], "pair", "corr")
    parts = F.split("pair", r"\|")
    return long.groupBy(parts[0].alias("a"), parts[1].alias("b")).agg(F.avg("corr").alias("corr"), F.count("corr").alias("dates"))


def capm(daily: DataFrame, port: str, bench: str, periods: int) -> DataFrame:
    """(beta, alpha, up_capture, down_capture, tracking): population beta, yearly alpha, captures and tracking error of one return on another."""
    b = F.covar_pop(port, bench) / F.when(F.var_pop(bench) > 0, F.var_pop(bench))
    mean = lambda c, side: F.avg(F.when(side, F.col(c)))
    up, down = F.col(bench) > 0, F.col(bench) < 0
    return daily.agg(
        b.alias("beta"), ((F.avg(port) - b * F.avg(bench)) * periods).alias("alpha"),
        (mean(port, up) / F.when(mean(bench, up) != 0, mean(bench, up))).alias("up_capture"), (mean(port, down) / F.when(mean(bench, down) != 0, mean(bench, down))).alias("down_capture"),
        (F.stddev_samp(F.col(port) - F.col(bench)) * math.sqrt(periods)).alias("tracking"),
    )


def spells(daily: DataFrame, ret: str) -> DataFrame:
    """(spell): the longest run of dates under an earlier top of the compounded series; one row for each date meets in one task."""
    w = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    equity = daily.withColumn("_e", F.product(1 + F.col(ret)).over(w))
    under = equity.withColumn("_u", F.col("_e") < F.greatest(F.max("_e").over(w), F.lit(1.0)))
    runs = under.withColumn("_g", F.count_if(~F.col("_u")).over(w)).where("_u").groupBy("_g").agg(F.count("*").alias("n"))
    return runs.agg(F.coalesce(F.max("n"), F.lit(0)).alias("spell"))


def performance(daily: DataFrame, ret: str, periods: int) -> DataFrame:
    """(total, volatility, sharpe, max_drawdown) of a series of one row for each date; returns compound as products, also below -1."""
    w = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    equity = daily.withColumn("_e", F.product(1 + F.col(ret)).over(w))
    peak = F.greatest(F.max("_e").over(w), F.lit(1.0))
    curve = equity.withColumn("_dd", F.col("_e") / peak - 1)
    sd = F.stddev_samp(ret)
    return curve.agg((F.product(1 + F.col(ret)) - 1).alias("total"), (sd * math.sqrt(periods)).alias("volatility"), F.when(sd > 0, F.avg(ret) / sd * math.sqrt(periods)).alias("sharpe"), F.min("_dd").alias("max_drawdown"))


def evaluation(panel: DataFrame, horizon: int, lags: int, n: int, least: int, cost: float, periods: int) -> DataFrame:
    """(dates, mean_ic, t, half_life, coverage, gross, net, turnover, sharpe) of panel(date, security_id, value, close, forward); one row.

    Means of the long-short portfolio are of its dates, sharpe is of its net returns, without a riskless rate. Each part is a
    single row, so putting them side by side compares nothing.
    """
    ic = newey_west(rank_ic(panel, "value", "forward", least), "ic", horizon).select(F.col("n").alias("dates"), F.col("mean").alias("mean_ic"), "t")
    life = half_life(ic_decay(panel, lags, least)).select(F.col("lag").cast("int").alias("half_life"))
    covered = panel.agg((F.count("value") / F.count("*")).alias("coverage"))
    sd = F.stddev_samp("net")
    run = backtest(panel, n, least, cost).agg(F.avg("gross").alias("gross"), F.avg("net").alias("net"), F.avg("turnover").alias("turnover"), F.when(sd > 0, F.avg("net") / sd * math.sqrt(periods)).alias("sharpe"))
    return ic.crossJoin(life).crossJoin(covered).crossJoin(run)


def pit_regression(compute: Callable[[Mapping[str, DataFrame]], DataFrame], sources: Mapping[str, tuple[DataFrame, Column]], at: Sequence[date]) -> DataFrame:
    """(date, cells, violations, largest) for each date of at: a plan's values against those it gives with only what was visible then.

    compute makes (date, security_id, value) of tables by name; sources has each table with the moment from which a row of it
    is visible. cells are the securities that either has a value for, violations those that only one has, largest the largest
    difference of the others' values, null where there are none. A plan that looks ahead differs from its own replay. Each
    date is a replay of its own, so at is a short list.
    """
    live = compute({n: df for n, (df, _) in sources.items()}).where(F.col("date").isin(list(at)))

    def replay(d: date) -> DataFrame:
        return compute({n: df.where(seen <= F.lit(d)) for n, (df, seen) in sources.items()}).where(F.col("date") == F.lit(d))

    again = reduce(DataFrame.unionByName, map(replay, at)).withColumnRenamed("value", "_replayed")
    both = live.where("value is not null").join(again.where("_replayed is not null"), ["date", "security_id"], "full_outer")
    one = F.col("value").isNull() != F.col("_replayed").isNull()
    return both.groupBy("date").agg(F.count("*").alias("cells"), F.count_if(one).alias("violations"), F.max(F.abs(F.col("value") - F.col("_replayed"))).alias("largest"))


def dates_before(dates: DataFrame, offsets: Sequence[int]) -> list[date]:
    """The dates that stand offsets places from the end of all distinct dates; those that there are. At most the largest offset comes to the driver."""
    last = [r.date for r in dates.select("date").distinct().orderBy(F.desc("date")).limit(max(offsets)).collect()]
    return [last[k - 1] for k in sorted(offsets, reverse=True) if k <= len(last)]
