"""Composites of price, size and profitability legs, among eligible securities only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import fundamentals as fm
from tidemark.operators.joins import as_of
from tidemark.plans import composites, factors
from tidemark.queries import FACTOR_SQL, FRAMES, GRID, _percent_rank, grid, r6
from tidemark.queries_fundamentals import _EVENTS, _facts, _known_sql, _some
from tidemark.registry import query
from tidemark.sources.market import ctes, view

# A year of weeks; splits that only the old source tells make a hole. Price and volume limits are below those of daily bars.
_FIRST, _LAST, _PRICE, _DOLLARS = "1997-01-01", "1997-12-31", 900, 20000

_GATE = f"""{ctes('actions', 'shares')}, ends AS (SELECT security_id, min(date) AS a, max(date) AS b FROM bars GROUP BY 1),
  holes AS (SELECT security_id FROM actions x JOIN ends USING (security_id) WHERE kind = 'split' AND source <> 'trusted' AND ex_date BETWEEN DATE '{_FIRST}' AND DATE '{_LAST}' AND a < ex_date AND ex_date <= b
    AND NOT EXISTS (FROM actions t WHERE t.source = 'trusted' AND t.kind = 'split' AND t.security_id = x.security_id AND t.ex_date = x.ex_date)),
  legs AS (SELECT date, security_id, close, {FACTOR_SQL['low_vol']} AS low_vol, {FACTOR_SQL['high_year']} AS high_year, quantile_cont(close * volume, 0.5) OVER w63 AS m, count(close * volume) OVER w63 AS k FROM prep {FRAMES}),
  fit AS (SELECT * FROM legs WHERE date BETWEEN DATE '{_FIRST}' AND DATE '{_LAST}' AND m >= {_DOLLARS} AND close >= {_PRICE} AND k >= 42 AND security_id NOT IN (SELECT security_id FROM holes)),
  sh AS (SELECT security_id, visible, arg_max(total_shares, id) AS n, arg_max(period_end, id) AS period_end FROM shares GROUP BY 1, 2),
  sized AS (SELECT fit.*, CASE WHEN date - period_end <= 400 AND close * n > 0 THEN ln(close * n) END AS size FROM fit ASOF LEFT JOIN sh ON fit.security_id = sh.security_id AND date >= visible + 1)"""


def _composite_sql(others: tuple[str, ...]) -> str:
    legs = ("low_vol", "high_year", *others)
    return f"""ranks AS (SELECT date, security_id, {', '.join(f'{_percent_rank(c)} AS {c}' for c in legs)} FROM judged),
  line AS (SELECT date, regr_slope(high_year, low_vol) AS b, avg(high_year) FILTER (WHERE low_vol IS NOT NULL) AS y, avg(low_vol) FILTER (WHERE high_year IS NOT NULL) AS x, var_pop(low_vol) FILTER (WHERE high_year IS NOT NULL) AS v FROM ranks GROUP BY 1),
  rest AS (SELECT ranks.* EXCLUDE (high_year), CASE WHEN v > 1e-18 THEN round(high_year - y - b * (low_vol - x), 9) + 0.0 END AS high_year FROM ranks JOIN line USING (date)),
  last AS (SELECT * EXCLUDE (high_year), {_percent_rank('high_year')} AS high_year FROM rest)
  SELECT date, security_id, round((low_vol + {' + '.join(f'coalesce({c}, 0.5)' for c in legs[1:])}) / {len(legs)}, 6) AS value FROM last WHERE low_vol IS NOT NULL"""


def _panel(spark, sf_dir) -> DataFrame:
    """(date, security_id, close, low_vol, high_year, size) of eligible rows."""
    # the frames of 63 rows are slow, and a year's rows need no more than the 62 weeks before
    p = factors.prepared(grid(spark, sf_dir)).where(F.col("date") <= F.lit(_LAST).cast("date")).withColumn("high_year", factors.high_year())
    g = factors.eligible(p.where(F.col("date") >= F.date_sub(F.lit(_FIRST).cast("date"), 63 * 7)), _PRICE, _DOLLARS)
    legs = g.select("date", "security_id", "close", "eligible", factors.low_vol().alias("low_vol"), "high_year")
    bars = grid(spark, sf_dir).where("close is not null")
    fit = composites.gated(legs.where(F.col("date").between(_FIRST, _LAST)), composites.with_holes(view(spark, sf_dir, "actions"), bars, _FIRST, _LAST, kinds=["split"]))
    held = as_of(fit.drop("eligible"), view(spark, sf_dir, "shares"), "security_id", "date", "visible", "id", ["total_shares", "period_end"], delay="interval 1 day")
    cap = F.when(F.datediff("date", "asof_period_end") <= 400, F.col("close") * F.col("asof_total_shares"))
    return held.select("date", "security_id", "low_vol", "high_year", F.when(cap > 0, F.ln(cap)).alias("size"))


@query(f"WITH {GRID}, {_GATE} SELECT date, security_id, round(size, 6) AS size FROM sized")
def composite_eligibility(spark, sf_dir):
    """Rows that a composite ranks: price and volume high enough, no hole in the chain of adjustments."""
    return _panel(spark, sf_dir).select("date", "security_id", r6("size").alias("size"))


@query(f"WITH {GRID}, {_GATE}, judged AS (SELECT * FROM sized), {_composite_sql(('size',))}")
def composite_v1(spark, sf_dir):
    """Low volatility, the year's high without it, and size."""
    return composites.composite(_panel(spark, sf_dir), "low_vol", ["high_year", "size"], residual="high_year").withColumn("value", r6("value"))


_PROFIT = f"""{ctes('companies')}, dates AS (SELECT security_id, date FROM sized), alld AS (SELECT security_id, date FROM dates UNION SELECT m.security_id, d.date FROM dates d JOIN companies c ON d.security_id = c.security_id JOIN companies m ON c.company_id = m.company_id),
  {_known_sql(('operating_income', 'assets'))}, judged AS (SELECT s.*, CASE WHEN assets.value > 0 THEN operating_income.value / assets.value::DOUBLE END AS profit FROM sized s JOIN known USING (security_id, date))"""


@query(f"WITH {GRID}, {_GATE}, {_EVENTS}, {_PROFIT}, {_composite_sql(('size', 'profit'))}")
def composite_v2(spark, sf_dir):
    """composite_v1 with trailing operating income over assets."""
    panel, metrics, companies = _panel(spark, sf_dir), ("operating_income", "assets"), view(spark, sf_dir, "companies")
    universe = panel.select("security_id", "date")
    known = fm.company_values(fm.known_on(fm.with_members(universe, companies), fm.metric_events(_facts(spark, sf_dir), _some(*metrics)), metrics), companies, universe, metrics)
    profit = F.when(F.col("assets.value") > 0, F.col("operating_income.value") / F.when(F.col("assets.value") > 0, F.col("assets.value")))
    legs = panel.join(known.select("security_id", "date", profit.alias("profit")), ["security_id", "date"], "left")
    return composites.composite(legs, "low_vol", ["high_year", "size", "profit"], residual="high_year").withColumn("value", r6("value"))
