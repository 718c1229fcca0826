"""Queries on portfolios and statistics over the weekly grid."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import cross_section as xs
from tidemark.operators.windows import lagged, ordered, rolling
from tidemark.plans import evaluate, factors
from tidemark.queries import _PANEL, _RANKED, _TEST, _WEIGHTS, FACTOR_SQL, FRAMES, GRID, _panel, _percent_rank, _run, grid, r6
from tidemark.registry import query


def day(x):
    return F.date_format(x, "yyyy-MM-dd")


def _daily(d: DataFrame) -> DataFrame:
    return d.select("date", r6("gross").alias("gross"), r6("net").alias("net"), r6("turnover").alias("turnover"))


_DAILY = "SELECT date, round(gross, 6) AS gross, round(gross - 0.001 * turnover, 6) AS net, round(turnover, 6) AS turnover FROM daily"


@query(f"WITH {_WEIGHTS}, {_run('q', freeze=False)} {_DAILY}")
def backtest_without_freeze(spark, sf_dir):
    return _daily(evaluate.runs_of_weights(evaluate.long_short(_panel(spark, sf_dir), 5, 5), 0.001, freeze=False))


# Every third security is cut off after 1999, its price missing for good while the grid goes on.
_CUT = "cut AS (SELECT date, security_id, CASE WHEN security_id % 3 = 0 AND date > DATE '1999-06-28' THEN NULL ELSE close END AS close, w FROM q)"


@query(f"WITH {_WEIGHTS}, {_CUT}, {_run('cut', '-0.3')} {_DAILY}")
def backtest_terminal(spark, sf_dir):
    w = evaluate.long_short(_panel(spark, sf_dir), 5, 5)
    gone = (F.col("security_id") % 3 == 0) & (F.col("date") > F.lit("1999-06-28").cast("date"))
    cut = w.withColumn("close", F.when(~gone, F.col("close"))).withColumn("terminal", F.lit(-0.3))
    return _daily(evaluate.runs_of_weights(cut, 0.001, terminal="terminal"))


_MONTHLY = "last AS (SELECT date_trunc('month', date) AS m, max(date) AS l FROM {0} GROUP BY 1), held_ AS (SELECT {0}.date, security_id, close, coalesce(last_value(CASE WHEN date = l THEN coalesce(w, 0) END IGNORE NULLS) OVER (PARTITION BY security_id ORDER BY date), 0) AS w FROM {0} JOIN last ON date_trunc('month', date) = m)"


@query(f"WITH {_WEIGHTS}, {_MONTHLY.format('q')}, {_run('held_')} {_DAILY}")
def backtest_monthly(spark, sf_dir):
    """Weights of month ends, held between."""
    w = evaluate.last_of(evaluate.long_short(_panel(spark, sf_dir), 5, 5), "month")
    return _daily(evaluate.runs_of_weights(evaluate.hold_between(w), 0.001))


def _strategy(name: str, sql: str, chosen, monthly: bool = True) -> None:
    """Registers an equally weighted strategy: sql says over prep what is chosen, chosen builds the same from the grid."""
    source = f"{GRID}, v AS ({sql}), q AS (SELECT date, security_id, close, CASE WHEN coalesce(c, false) THEN 1.0 / count(*) FILTER (WHERE c) OVER (PARTITION BY date) ELSE 0 END AS w FROM v)"
    text = f"WITH {source}, {_MONTHLY.format('q')}, {_run('held_')} {_DAILY}" if monthly else f"WITH {source}, {_run('q')} {_DAILY}"

    def run(spark, sf_dir):
        w = evaluate.equal_weight(*chosen(factors.prepared(grid(spark, sf_dir))))
        return _daily(evaluate.runs_of_weights(evaluate.hold_between(evaluate.last_of(w, "month")) if monthly else w, 0.001))

    query(text, name)(run)


_strategy(
    "strategy_momentum", f"SELECT date, security_id, close, {_percent_rank('m')} >= 0.9 AS c FROM (SELECT *, {FACTOR_SQL['momentum']} AS m FROM prep {FRAMES})",
    lambda g: (g.withColumn("m", factors.momentum()), xs.percent_rank("m") >= 0.9),
)
_strategy(
    "strategy_reversal", f"SELECT date, security_id, close, {_percent_rank('m')} <= 0.1 AS c FROM (SELECT *, close / lag(close, 5) OVER o - 1 AS m FROM prep {FRAMES})",
    lambda g: (g.withColumn("m", F.col("close") / lagged("close", 5) - 1), xs.percent_rank("m") <= 0.1), monthly=False,
)
_strategy(
    "strategy_trend", "SELECT date, security_id, close, CASE WHEN count(close) OVER a >= 12 AND count(close) OVER b >= 40 THEN avg(close) OVER a > avg(close) OVER b END AS c FROM prep WINDOW a AS (PARTITION BY security_id ORDER BY date ROWS 19 PRECEDING), b AS (PARTITION BY security_id ORDER BY date ROWS 59 PRECEDING)",
    lambda g: (g.withColumn("m", rolling(F.avg, F.col("close"), 20, 12) > rolling(F.avg, F.col("close"), 60, 40)), F.col("m")), monthly=False,
)
_strategy("strategy_equal", "SELECT date, security_id, close, close IS NOT NULL AS c FROM prep", lambda g: (g, F.col("close").isNotNull()))
_strategy(
    "strategy_hold", "SELECT date, security_id, close, count(close) OVER (PARTITION BY security_id ORDER BY date) > 0 AND security_id = 1 AS c FROM prep",
    lambda g: (g.withColumn("m", (F.count("close").over(ordered()) > 0) & (F.col("security_id") == 1)), F.col("m")), monthly=False,
)


@query(f"""WITH {_PANEL}, l AS (SELECT date, value, k AS lag, CASE k WHEN 0 THEN forward WHEN 1 THEN f1 WHEN 2 THEN f2 ELSE f3 END AS forward FROM (SELECT *, lead(forward, 1) OVER o AS f1, lead(forward, 2) OVER o AS f2, lead(forward, 3) OVER o AS f3 FROM panel WINDOW o AS (PARTITION BY security_id ORDER BY date)), (SELECT unnest([0, 1, 2, 3]) AS k)),
  k AS (SELECT date, lag, CASE WHEN value IS NOT NULL THEN rank() OVER (PARTITION BY date, lag, value IS NULL ORDER BY value) + (count(*) OVER (PARTITION BY date, lag, value) - 1) / 2 END AS a, CASE WHEN forward IS NOT NULL THEN rank() OVER (PARTITION BY date, lag, forward IS NULL ORDER BY forward) + (count(*) OVER (PARTITION BY date, lag, forward) - 1) / 2 END AS b FROM l),
  ic AS (SELECT date, lag, corr(a, b) AS ic FROM k WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 5 AND var_pop(a) > 0 AND var_pop(b) > 0) SELECT lag, round(avg(ic), 6) AS ic, count(*) AS n FROM ic GROUP BY 1""")
def ic_decay(spark, sf_dir):
    return evaluate.ic_decay(_panel(spark, sf_dir), 3, 5).select("lag", r6("ic").alias("ic"), "n")


@query(f"""WITH {_PANEL} SELECT strftime(date, '%Y-%m-%d') AS date, count(*) AS listed, count(close) AS priced, count(value) AS valued, count(CASE WHEN value IS NOT NULL AND forward IS NOT NULL THEN 1 END) AS evaluated, round(count(value) / count(*), 6) AS coverage FROM panel GROUP BY 1""")
def coverage(spark, sf_dir):
    p = _panel(spark, sf_dir)
    both = F.count_if(F.col("value").isNotNull() & F.col("forward").isNotNull())
    return p.groupBy("date").agg(F.count("*").alias("listed"), F.count("close").alias("priced"), F.count("value").alias("valued"), both.alias("evaluated"), r6(F.count("value") / F.count("*")).alias("coverage")).withColumn("date", day("date"))


_THREE = f"three AS (SELECT date, security_id, {FACTOR_SQL['reversal']} AS reversal, {FACTOR_SQL['bollinger']} AS bollinger, {FACTOR_SQL['low_vol']} AS low_vol FROM prep {FRAMES})"


def _three(spark, sf_dir) -> DataFrame:
    return factors.prepared(grid(spark, sf_dir)).select("date", "security_id", *[factors.FACTORS[n]().alias(n) for n in ("reversal", "bollinger", "low_vol")])


def _avg_rank(x: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN rank() OVER (PARTITION BY date, {x} IS NULL ORDER BY {x}) + (count(*) OVER (PARTITION BY date, {x}) - 1) / 2 END"


_CORR = f"""{GRID}, {_THREE}, k AS (SELECT date, {", ".join(f"{_avg_rank(n)} AS {n}" for n in ("reversal", "bollinger", "low_vol"))} FROM three),
  l AS (SELECT date, 'reversal' AS a, 'bollinger' AS b, reversal AS x, bollinger AS y FROM k UNION ALL SELECT date, 'reversal', 'low_vol', reversal, low_vol FROM k UNION ALL SELECT date, 'bollinger', 'low_vol', bollinger, low_vol FROM k),
  c AS (SELECT date, a, b, corr(x, y) AS c FROM l WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) >= 5 AND var_pop(x) > 0 AND var_pop(y) > 0)"""


@query(f"WITH {_CORR} SELECT a, b, round(avg(c), 6) AS corr, count(*) AS dates FROM c GROUP BY 1, 2")
def factor_correlations(spark, sf_dir):
    return evaluate.rank_correlations(_three(spark, sf_dir), ["reversal", "bollinger", "low_vol"], 5).withColumn("corr", r6("corr"))


@query(f"""WITH {_PANEL}, f AS (SELECT p.date, p.value AS x, t.low_vol AS z, p.forward AS y FROM panel p JOIN (SELECT date, security_id, {FACTOR_SQL['low_vol']} AS low_vol FROM prep {FRAMES}) t USING (date, security_id)),
  k AS (SELECT date, {_avg_rank('x')} AS x, {_avg_rank('z')} AS z, {_avg_rank('y')} AS y FROM f),
  c AS (SELECT date, corr(x, y) AS a, corr(z, y) AS b, corr(x, z) AS r FROM k WHERE x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL GROUP BY 1 HAVING count(*) >= 5 AND var_pop(x) > 0 AND var_pop(y) > 0 AND var_pop(z) > 0)
  SELECT count(*) AS dates, round(avg((a - r * b) / sqrt(greatest(1 - r * r, 1e-12))), 6) AS partial FROM c""")
def partial_ic(spark, sf_dir):
    """What a factor's IC keeps once another's is taken off, by date, then on average."""
    p = _panel(spark, sf_dir).withColumn("low_vol", factors.low_vol())
    k = p.repartition("date").select("date", *[xs.average_rank(c).alias(n) for c, n in (("value", "x"), ("low_vol", "z"), ("forward", "y"))]).dropna()
    c = k.groupBy("date").agg(F.count("*").alias("n"), *[xs.correlation(*pair).alias("".join(pair)) for pair in (("x", "y"), ("z", "y"), ("x", "z"))]).dropna().where("n >= 5")
    partial = (F.col("xy") - F.col("xz") * F.col("zy")) / F.sqrt(F.greatest(1 - F.col("xz") * F.col("xz"), F.lit(1e-12)))
    return c.agg(F.count("*").alias("dates"), r6(F.avg(partial)).alias("partial"))


_BENCH = f"{_TEST}, mkt AS (SELECT date, avg(ret) AS m FROM panel GROUP BY 1), both_ AS (SELECT date, gross AS p, coalesce(m, 0) AS m FROM daily JOIN mkt USING (date))"


def _against_market(spark, sf_dir) -> DataFrame:
    p = _panel(spark, sf_dir)
    market = p.groupBy("date").agg(F.coalesce(F.avg("ret"), F.lit(0.0)).alias("m"))
    return evaluate.backtest(p, 5, 5, 0.0).select("date", F.col("gross").alias("p")).join(market, "date")


@query(f"""WITH {_BENCH} SELECT round(regr_slope(p, m), 6) AS beta, round((avg(p) - regr_slope(p, m) * avg(m)) * 52, 5) AS alpha, round(avg(p) FILTER (WHERE m > 0) / avg(m) FILTER (WHERE m > 0), 6) AS up_capture, round(avg(p) FILTER (WHERE m < 0) / avg(m) FILTER (WHERE m < 0), 6) AS down_capture, round(stddev_samp(p - m) * sqrt(52), 5) AS tracking FROM both_""")
def capm(spark, sf_dir):
    c = evaluate.capm(_against_market(spark, sf_dir), "p", "m", 52)
    return c.select(r6("beta").alias("beta"), F.round("alpha", 5).alias("alpha"), r6("up_capture").alias("up_capture"), r6("down_capture").alias("down_capture"), F.round("tracking", 5).alias("tracking"))


@query(f"""WITH {_TEST}, e AS (SELECT date, product(1 + gross / 100) OVER (ORDER BY date) AS e FROM daily), u AS (SELECT *, e < greatest(max(e) OVER (ORDER BY date), 1) AS u FROM e), g AS (SELECT *, count(*) FILTER (WHERE NOT u) OVER (ORDER BY date) AS g FROM u)
  SELECT coalesce(max(n), 0) AS spell FROM (SELECT count(*) AS n FROM g WHERE u GROUP BY g)""")
def underwater(spark, sf_dir):
    return evaluate.spells(evaluate.backtest(_panel(spark, sf_dir), 5, 5, 0.0).withColumn("gross", F.col("gross") / 100), "gross")


@query(f"WITH {_TEST} SELECT year(date) AS year, round(avg(gross), 6) AS mean, count(*) AS n, round(avg(gross) FILTER (WHERE rank > 3), 6) AS without_extremes FROM (SELECT *, row_number() OVER (PARTITION BY year(date) ORDER BY abs(gross) DESC, date) AS rank FROM daily) GROUP BY 1")
def annual_means(spark, sf_dir):
    """Means by calendar year, with and without the three largest moves."""
    w = Window.partitionBy(F.year("date")).orderBy(F.abs("gross").desc(), "date")
    d = evaluate.backtest(_panel(spark, sf_dir), 5, 5, 0.0).withColumn("r", F.row_number().over(w))
    return d.groupBy(F.year("date").cast("long").alias("year")).agg(r6(F.avg("gross")).alias("mean"), F.count("*").alias("n"), r6(F.avg(F.when(F.col("r") > 3, F.col("gross")))).alias("without_extremes"))


_HORIZONS = f"""{GRID}, fill AS (SELECT *, last_value(close IGNORE NULLS) OVER o AS filled FROM prep WINDOW o AS (PARTITION BY security_id ORDER BY date)),
  h AS (SELECT date, security_id, -(lag(close, 1) OVER o / lag(close, 21) OVER o - 1) AS value, lead(filled, 1) OVER o / close - 1 AS f1, lead(filled, 4) OVER o / close - 1 AS f4, lead(filled, 12) OVER o / close - 1 AS f12 FROM fill WINDOW o AS (PARTITION BY security_id ORDER BY date)),
  b AS (SELECT *, least((row_number() OVER (PARTITION BY date ORDER BY value, security_id) - 1) * 5 // count(*) OVER (PARTITION BY date) + 1, 5) AS bucket, count(*) OVER (PARTITION BY date) AS m FROM h WHERE value IS NOT NULL),
  d AS (SELECT date, bucket, avg(f1) AS f1, avg(f4) AS f4, avg(f12) AS f12 FROM b WHERE m >= 5 GROUP BY 1, 2),
  u AS (UNPIVOT d ON f1, f4, f12 INTO NAME h VALUE r)"""


@query(f"WITH {_HORIZONS} SELECT h AS horizon, bucket::INT AS bucket, round(avg(r), 6) AS mean, round(stddev_samp(r), 6) AS sd, count(*) AS dates FROM u GROUP BY 1, 2")
def quantile_table(spark, sf_dir):
    """Bucket returns at several horizons in one pass over the panel."""
    g = factors.prepared(grid(spark, sf_dir)).withColumn("filled", F.last("close", ignorenulls=True).over(ordered()))
    h = g.select("date", "security_id", factors.reversal().alias("value"), *[evaluate.forward_return(n).alias(f"f{n}") for n in (1, 4, 12)]).where("value is not null")
    b = h.withColumn("bucket", xs.buckets("value", 5, 5)).where("bucket is not null").groupBy("date", "bucket").agg(*[F.avg(f"f{n}").alias(f"f{n}") for n in (1, 4, 12)])
    return b.unpivot(["date", "bucket"], ["f1", "f4", "f12"], "horizon", "r").groupBy("horizon", "bucket").agg(r6(F.avg("r")).alias("mean"), r6(F.stddev_samp("r")).alias("sd"), F.count("r").alias("dates"))


_CELLS = f"""{_PANEL}, z AS (SELECT p.*, t.v FROM panel p JOIN (SELECT date, security_id, {FACTOR_SQL['low_vol']} AS v FROM prep {FRAMES}) t USING (date, security_id) WHERE value IS NOT NULL AND t.v IS NOT NULL),
  one AS (SELECT *, (row_number() OVER (PARTITION BY date ORDER BY value, security_id) - 1) * 2 // count(*) OVER (PARTITION BY date) + 1 AS i FROM z), two AS (SELECT *, (row_number() OVER (PARTITION BY date, i ORDER BY v, security_id) - 1) * 2 // count(*) OVER (PARTITION BY date, i) + 1 AS j FROM one)"""


@query(f"WITH {_CELLS} SELECT i::INT AS i, j::INT AS j, round(avg(forward), 6) AS mean, count(forward) AS n FROM two GROUP BY 1, 2 HAVING count(forward) >= 3")
def double_sort(spark, sf_dir):
    """Mean forward returns by halves of a factor, and halves of another inside each."""
    z = _panel(spark, sf_dir).withColumn("v", factors.low_vol()).where("value is not null and v is not null")

    def halves(x: str, *by: str):
        w = Window.partitionBy(*by)
        return (F.floor((F.row_number().over(w.orderBy(x, "security_id")) - 1) * 2 / F.count("*").over(w)) + 1).cast("int")

    cells = z.repartition("date").withColumn("i", halves("value", "date")).withColumn("j", halves("v", "date", "i"))
    return cells.groupBy("i", "j").agg(r6(F.avg("forward")).alias("mean"), F.count("forward").alias("n")).where("n >= 3")


@query(f"""WITH {_PANEL}, r AS (SELECT date, security_id, {_percent_rank('value')} AS r FROM panel), s AS (SELECT date, security_id, CASE WHEN r > 0.8 THEN 1.0 / count(*) FILTER (WHERE r > 0.8) OVER (PARTITION BY date) WHEN r <= 0.2 THEN -1.0 / count(*) FILTER (WHERE r <= 0.2) OVER (PARTITION BY date) END AS w FROM r)
  SELECT strftime(date, '%Y-%m-%d') AS date, security_id, round(w, 6) AS w FROM s WHERE w IS NOT NULL""")
def percentile_weights(spark, sf_dir):
    """Long above the percentile 1 - 1/n, short up to 1/n, each side adding up to one."""
    p = _panel(spark, sf_dir).repartition("date").select("date", "security_id", xs.percent_rank("value").alias("r"))
    by = Window.partitionBy("date")
    w = F.when(F.col("r") > 0.8, 1.0 / F.count_if(F.col("r") > 0.8).over(by)).when(F.col("r") <= 0.2, -1.0 / F.count_if(F.col("r") <= 0.2).over(by))
    return p.select(day("date").alias("date"), "security_id", r6(w).alias("w")).where("w is not null")


@query(f"""WITH {GRID}, m AS (SELECT security_id, date_trunc('month', date)::DATE AS m, arg_max(close, date) FILTER (WHERE close IS NOT NULL) AS c FROM grid GROUP BY 1, 2), r AS (SELECT security_id, m, c / lag(c) OVER (PARTITION BY security_id ORDER BY m) - 1 AS r FROM m)
  SELECT security_id, strftime(m, '%Y-%m') AS month, round(avg(r) OVER w, 6) AS value FROM r WINDOW w AS (PARTITION BY security_id, month(m) ORDER BY year(m) RANGE BETWEEN 10 PRECEDING AND 1 PRECEDING) QUALIFY count(r) OVER w >= 3""")
def same_month_mean(spark, sf_dir):
    """The mean return of the same month in up to ten years before, three at least."""
    g = grid(spark, sf_dir)
    m = g.groupBy("security_id", F.trunc("date", "month").alias("m")).agg(F.max_by("close", F.when(F.col("close").isNotNull(), F.col("date"))).alias("c"))
    r = m.withColumn("r", F.col("c") / F.lag("c").over(Window.partitionBy("security_id").orderBy("m")) - 1)
    w = Window.partitionBy("security_id", F.month("m")).orderBy(F.year("m")).rangeBetween(-10, -1)
    out = r.select("security_id", F.date_format("m", "yyyy-MM").alias("month"), r6(F.avg("r").over(w)).alias("value"), F.count("r").over(w).alias("n"))
    return out.where("n >= 3").drop("n")


@query(f"""WITH {GRID}, t AS (SELECT date, security_id, close > CASE WHEN count(close) OVER w >= 20 THEN avg(close) OVER w END AS above FROM grid WINDOW w AS (PARTITION BY security_id ORDER BY date ROWS 29 PRECEDING)),
  b AS (SELECT date, avg(above::INT) AS breadth, count(above) AS n FROM t GROUP BY 1) SELECT strftime(date, '%Y-%m-%d') AS date, round(breadth, 6) AS breadth, breadth > 0.5 AS risk_on FROM b WHERE n > 0""")
def market_breadth(spark, sf_dir):
    """The share of securities above their moving average, and whether it is more than half."""
    g = grid(spark, sf_dir).withColumn("above", (F.col("close") > rolling(F.avg, F.col("close"), 30, 20)).cast("int"))
    b = g.groupBy("date").agg(F.avg("above").alias("breadth"))
    return b.where("breadth is not null").select(day("date").alias("date"), r6("breadth").alias("breadth"), (F.col("breadth") > 0.5).alias("risk_on"))


@query(f"""WITH {GRID}, c AS (SELECT date, security_id, open / lag(close) OVER o - 1 AS overnight, close / open - 1 AS intraday, close / lag(close) OVER o - 1 AS whole FROM grid WINDOW o AS (PARTITION BY security_id ORDER BY date))
  SELECT strftime(date, '%Y-%m-%d') AS date, round(avg(overnight), 6) AS overnight, round(avg(intraday), 6) AS intraday, round(avg(whole), 6) AS whole FROM c GROUP BY 1""")
def return_parts(spark, sf_dir):
    g = grid(spark, sf_dir)
    c = g.select("date", (F.col("open") / lagged("close", 1) - 1).alias("overnight"), (F.col("close") / F.col("open") - 1).alias("intraday"), (F.col("close") / lagged("close", 1) - 1).alias("whole"))
    return c.groupBy("date").agg(*[r6(F.avg(n)).alias(n) for n in ("overnight", "intraday", "whole")]).withColumn("date", day("date"))


@query(f"SELECT 25 AS m, round({NormalDist().inv_cdf(1 - 0.05 / 2 / 25)!r}::DOUBLE, 9) AS z")
def bonferroni(spark, sf_dir):
    """The two-sided critical value for many trials: a constant of their number."""
    m = 25
    return spark.range(1).select(F.lit(m).alias("m"), F.lit(round(NormalDist().inv_cdf(1 - 0.05 / 2 / m), 9)).alias("z"))


@query(f"""WITH {_PANEL}, {_RANKED}, d AS (SELECT date, ic - avg(ic) OVER () AS d FROM ic) SELECT count(*) AS n, round(avg(d * d), 6) AS variance FROM d""")
def ic_variance(spark, sf_dir):
    i = xs.rank_ic(_panel(spark, sf_dir), "value", "forward", 5)
    return i.agg(F.count("*").alias("n"), r6(F.var_pop("ic")).alias("variance"))
