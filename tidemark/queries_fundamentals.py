"""Queries on filed facts as a researcher meets them: trailing years, pairs a year apart, companies, ratios and scores as known on a date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import fundamentals as fm
from tidemark.operators.joins import as_of
from tidemark.plans import evaluate
from tidemark.registry import query
from tidemark.sources.market import ctes, view

METRICS = {
    "revenue": ("flow", ("Revenues", "SalesRevenueNet")), "gross_profit": ("flow", ("GrossProfit",)), "cost": ("flow", ("CostOfRevenue",)),
    "operating_income": ("flow", ("OperatingIncomeLoss",)), "net_income": ("flow", ("NetIncomeLoss",)), "cash_flow": ("flow", ("OperatingCashFlow",)),
    "assets": ("instant", ("Assets",)), "shares": ("instant", ("SharesOutstanding",)),
}


def day(x: str):
    return F.date_format(x, "yyyy-MM-dd")


def r6(x):
    return F.round(x, 6)


# The SQL of the same events, by inequalities and as-of joins

_SPEC = ", ".join(f"('{c}', '{m}', {i}, '{kind}')" for m, (kind, concepts) in METRICS.items() for i, c in enumerate(concepts))
_IDENT = "security_id, metric, concept, rank"
_SAME = "{0}.security_id = {1}.security_id AND {0}.metric = {1}.metric AND {0}.concept = {1}.concept"


def _legs(table: str, key: str, legs: dict[str, str], source: str) -> str:
    """ticks and values of legs at every moment that one of them changes."""
    ticks = " UNION ".join(f"SELECT {', '.join('t.' + k for k in key.split(', '))}, v.filed FROM {table} t JOIN {source} v ON {on}" for on in legs.values())
    cols = ", ".join(f"v_{n}.value AS {n}" for n in legs)
    joins = " ".join(f"ASOF JOIN {source} v_{n} ON {on.replace('v.', f'v_{n}.')} AND t.filed >= v_{n}.filed" for n, on in legs.items())
    return f"SELECT t.*, {cols} FROM (SELECT k.filed, t.* FROM ({ticks}) k JOIN {table} t USING ({key})) t {joins}"


_TRI_KEY = f"{_IDENT}, period_end"
_EVERY = f"""{ctes('reports')}, spec(concept, metric, rank, kind) AS (VALUES {_SPEC}),
  lagged AS (SELECT *, lag(value) OVER w AS b, row_number() OVER w AS n FROM reports WINDOW w AS (PARTITION BY security_id, concept, period_start, period_end ORDER BY filed, accession)),
  vint AS (SELECT l.*, metric, rank, kind, CASE WHEN kind = 'flow' THEN CASE WHEN d BETWEEN 80 AND 100 THEN 'Q' WHEN d BETWEEN 170 AND 192 THEN 'H' WHEN d BETWEEN 258 AND 285 THEN 'N' WHEN d BETWEEN 350 AND 380 THEN 'Y' END END AS duration
    FROM (SELECT *, period_end - period_start AS d FROM lagged WHERE n = 1 OR value IS DISTINCT FROM b QUALIFY row_number() OVER (PARTITION BY security_id, concept, period_start, period_end, filed ORDER BY accession DESC) = 1) l JOIN spec USING (concept)),
  periods AS (SELECT DISTINCT {_IDENT}, duration, period_start, period_end FROM vint WHERE duration IS NOT NULL),
  near AS (SELECT p.*, y.period_start AS y_start, y.period_end AS y_end, e.period_start AS p_start, e.period_end AS p_end FROM periods p
    JOIN periods y ON {_SAME.format('p', 'y')} AND y.duration = 'Y' AND abs(p.period_start - 1 - y.period_end) <= 7 JOIN periods e ON {_SAME.format('p', 'e')} AND e.duration = p.duration AND abs(p.period_end - 365 - e.period_end) <= 14 WHERE p.duration <> 'Y'
    QUALIFY row_number() OVER (PARTITION BY p.security_id, p.metric, p.concept, p.duration, p.period_start, p.period_end ORDER BY abs(p.period_start - 1 - y.period_end), y.period_end, y.period_start, abs(p.period_end - 365 - e.period_end), e.period_end, e.period_start) = 1),
  tri AS (SELECT * FROM near QUALIFY row_number() OVER (PARTITION BY {_TRI_KEY} ORDER BY period_start) = 1),
  sums AS (SELECT {_TRI_KEY}, filed, a + y - e AS value FROM ({_legs('tri', _TRI_KEY, {n: f"{_SAME.format('t', 'v')} AND t.{s} = v.period_start AND t.{u} = v.period_end" for n, s, u in (('a', 'period_start', 'period_end'), ('y', 'y_start', 'y_end'), ('e', 'p_start', 'p_end'))}, 'vint')})),
  derived AS (SELECT *, lag(value) OVER w AS b, row_number() OVER w AS n FROM sums WINDOW w AS (PARTITION BY {_TRI_KEY} ORDER BY filed)),
  every AS (SELECT {_TRI_KEY}, filed, value, 0 AS source FROM vint WHERE kind = 'instant' OR duration = 'Y' UNION ALL SELECT {_TRI_KEY}, filed, value, 1 FROM derived WHERE n = 1 OR value <> b)"""


def _guarded(table: str) -> str:
    return f"""SELECT * FROM (SELECT *, max(period_end) OVER (PARTITION BY security_id, metric ORDER BY filed, period_end ROWS UNBOUNDED PRECEDING) AS most
    FROM (SELECT * FROM {table} QUALIFY source * 100 + rank = min(source * 100 + rank) OVER (PARTITION BY security_id, metric, period_end))) WHERE period_end >= most"""


_EVENTS = f"{_EVERY}, ev AS (SELECT security_id, metric, period_end, filed AS visible, value, NULL::DATE AS prior_end, NULL::BIGINT AS prior FROM ({_guarded('every')}))"
_PAIR_KEY = f"{_IDENT}, source, period_end, prior_end, p_source"
_PAIRS = f"""{_EVENTS}, told AS (SELECT DISTINCT {_IDENT}, source, period_end FROM every),
  twins AS (SELECT p.*, e.period_end AS prior_end, e.source AS p_source FROM told p JOIN told e ON {_SAME.format('p', 'e')} AND abs(p.period_end - 365 - e.period_end) <= 35
    QUALIFY row_number() OVER (PARTITION BY p.security_id, p.metric, p.concept, p.source, p.period_end ORDER BY abs(p.period_end - 365 - e.period_end), e.period_end, e.source) = 1),
  both_ AS ({_legs('twins', _PAIR_KEY, {'now': f"{_SAME.format('t', 'v')} AND t.source = v.source AND t.period_end = v.period_end", 'before': f"{_SAME.format('t', 'v')} AND t.p_source = v.source AND t.prior_end = v.period_end"}, 'every')}),
  moved AS (SELECT *, row_number() OVER w AS n, lag(now) OVER w AS b_now, lag(before) OVER w AS b_before FROM both_ WINDOW w AS (PARTITION BY {_PAIR_KEY} ORDER BY filed)),
  changed AS (SELECT * FROM moved WHERE n = 1 OR now <> b_now OR before <> b_before),
  pair_ev AS (SELECT security_id, concat(metric, '_pair') AS metric, period_end, filed AS visible, now AS value, prior_end, before AS prior FROM ({_guarded('changed')}))"""


def _facts(spark, sf_dir) -> DataFrame:
    return view(spark, sf_dir, "reports")


def _some(*names: str) -> dict:
    return {n: METRICS[n] for n in names}


@query(f"WITH {_EVENTS} SELECT security_id, metric, strftime(period_end, '%Y-%m-%d') AS period_end, strftime(visible, '%Y-%m-%d') AS visible, value FROM ev")
def metric_events(spark, sf_dir):
    """All metrics: years as reported or derived, instants, each with its restatements, of one concept for each period."""
    return fm.metric_events(_facts(spark, sf_dir), METRICS).select("security_id", "metric", day("period_end").alias("period_end"), day("visible").alias("visible"), "value")


@query(f"WITH {_EVERY} SELECT security_id, concept, strftime(period_end, '%Y-%m-%d') AS period_end, strftime(filed, '%Y-%m-%d') AS visible, source, value AS ttm FROM every WHERE metric = 'revenue'")
def trailing_year(spark, sf_dir):
    """Trailing years by either route, of every concept: as reported, or the year to date and the last year less the same part of it."""
    every = fm.all_histories(_facts(spark, sf_dir), _some("revenue")).select("security_id", "concept", "period_end", "source", F.inline("history"))
    return every.select("security_id", "concept", day("period_end").alias("period_end"), day("filed").alias("visible"), "source", F.col("value").alias("ttm"))


@query(f"WITH {_PAIRS} SELECT security_id, metric, strftime(period_end, '%Y-%m-%d') AS period_end, strftime(prior_end, '%Y-%m-%d') AS prior_end, strftime(visible, '%Y-%m-%d') AS visible, value, prior FROM pair_ev WHERE metric IN ('net_income_pair', 'assets_pair')")
def year_pairs(spark, sf_dir):
    """Values with those of a year before, both as known at each moment that either changed."""
    days = [day(c).alias(c) for c in ("period_end", "prior_end", "visible")]
    return fm.pair_events(_facts(spark, sf_dir), _some("net_income", "assets")).select("security_id", "metric", *days, "value", "prior")


# As known on month ends, by company

_UNIVERSE = f"""{ctes('daily', 'securities', 'companies')}, dates AS (SELECT DISTINCT security_id, last_day(date) AS date FROM daily JOIN securities USING (security_id) WHERE is_active),
  alld AS (SELECT security_id, date FROM dates UNION SELECT m.security_id, d.date FROM dates d JOIN companies c ON d.security_id = c.security_id JOIN companies m ON c.company_id = m.company_id)"""


def _known_sql(metrics: tuple[str, ...], source: str = "ev") -> str:
    """known: the universe's rows with a struct for each metric, those of companies from their first member that has one."""
    each = ", ".join(
        f"""{m}_e AS (SELECT security_id, visible, max({{'period_end': period_end, 'value': value, 'prior_end': prior_end, 'prior': prior}}) AS e FROM {source} WHERE metric = '{m}' GROUP BY 1, 2),
  {m}_k AS (SELECT a.security_id, a.date, CASE WHEN a.date - e.period_end <= 270 THEN e END AS {m} FROM alld a ASOF LEFT JOIN {m}_e k ON a.security_id = k.security_id AND a.date >= k.visible + 1)"""
        for m in metrics
    )
    joined = " ".join(f"JOIN {m}_k USING (security_id, date)" for m in metrics)
    first = ", ".join(f"arg_min({m}, p.security_id) FILTER (WHERE {m} IS NOT NULL) AS {m}" for m in metrics)
    return f"""{each}, panel AS (SELECT * FROM alld {joined}),
  firsts AS (SELECT coalesce(company_id, -1) AS c, CASE WHEN company_id IS NULL THEN p.security_id ELSE -1 END AS o, date, {first} FROM panel p LEFT JOIN companies c ON p.security_id = c.security_id GROUP BY 1, 2, 3),
  known AS (SELECT d.security_id, d.date, {', '.join(metrics)} FROM dates d LEFT JOIN companies c ON d.security_id = c.security_id JOIN firsts f ON coalesce(company_id, -1) = f.c AND CASE WHEN company_id IS NULL THEN d.security_id ELSE -1 END = f.o AND d.date = f.date)"""


def _universe(spark, sf_dir) -> DataFrame:
    active = view(spark, sf_dir, "securities").where("is_active").select("security_id")
    return view(spark, sf_dir, "daily").join(active, "security_id").select("security_id", F.last_day("date").alias("date")).distinct()


def _known(spark, sf_dir, *metrics: str) -> DataFrame:
    events = fm.metric_events(_facts(spark, sf_dir), _some(*metrics))
    universe, companies = _universe(spark, sf_dir), view(spark, sf_dir, "companies")
    panel = fm.known_on(fm.with_members(universe, companies), events, metrics)
    return fm.company_values(panel, companies, universe, metrics)


@query(f"WITH {_EVENTS}, {_UNIVERSE}, {_known_sql(('net_income', 'assets'))} SELECT security_id, strftime(date, '%Y-%m-%d') AS date, net_income.value AS net_income, strftime(net_income.period_end, '%Y-%m-%d') AS period_end, assets.value AS assets FROM known")
def company_panel(spark, sf_dir):
    """Facts that one security of a company files, on all its members; others have their own."""
    k = _known(spark, sf_dir, "net_income", "assets")
    return k.select("security_id", day("date").alias("date"), F.col("net_income.value").alias("net_income"), day("net_income.period_end").alias("period_end"), F.col("assets.value").alias("assets"))


def _ratio(name: str, metrics: tuple[str, ...], expr: str) -> None:
    """Registers a ratio to assets, read alike by both engines; expr says which parts must be of one period."""
    sql = f"WITH {_EVENTS}, {_UNIVERSE}, {_known_sql((*metrics, 'assets'))} SELECT security_id, strftime(date, '%Y-%m-%d') AS date, round(({expr}) / assets.value::DOUBLE, 6) AS value FROM known WHERE assets.value > 0 AND ({expr}) IS NOT NULL"

    def run(spark, sf_dir):
        k = _known(spark, sf_dir, *metrics, "assets").where("assets.value > 0").where(f"({expr}) is not null")
        return k.select("security_id", day("date").alias("date"), r6(F.expr(expr) / F.col("assets.value")).alias("value"))

    query(sql, name)(run)


_ratio("factor_operating_profitability", ("operating_income",), "operating_income.value")
_ratio("factor_accruals", ("net_income", "cash_flow"), "CASE WHEN net_income.period_end = cash_flow.period_end THEN net_income.value - cash_flow.value END")
_ratio("factor_gross_profitability", ("gross_profit", "revenue", "cost"), "COALESCE(gross_profit.value, CASE WHEN revenue.period_end = cost.period_end THEN revenue.value - cost.value END)")


_CAPS = f"""{ctes('shares')}, month AS (SELECT security_id, last_day(date) AS date, arg_max(close, date) AS close FROM daily GROUP BY 1, 2), sh AS (SELECT security_id, visible, arg_max(total_shares, id) AS n, arg_max(period_end, id) AS period_end FROM shares GROUP BY 1, 2),
  caps AS (SELECT m.security_id, m.date, m.close * n AS cap FROM month m ASOF JOIN sh ON m.security_id = sh.security_id AND m.date >= sh.visible + 1 WHERE m.date - sh.period_end <= 400),
  company_cap AS (SELECT coalesce(company_id, -1) AS c, CASE WHEN company_id IS NULL THEN x.security_id ELSE -1 END AS o, date, sum(cap) AS cap FROM caps x LEFT JOIN companies c ON x.security_id = c.security_id GROUP BY 1, 2, 3)"""


@query(f"""WITH {_EVENTS}, {_UNIVERSE}, {_known_sql(('net_income',))}, {_CAPS} SELECT k.security_id, strftime(k.date, '%Y-%m-%d') AS date, round(1e3 * net_income.value / cap, 6) AS value FROM known k LEFT JOIN companies c ON k.security_id = c.security_id
  JOIN company_cap m ON coalesce(company_id, -1) = m.c AND CASE WHEN company_id IS NULL THEN k.security_id ELSE -1 END = m.o AND k.date = m.date WHERE cap > 0 AND net_income IS NOT NULL""")
def factor_earnings_yield(spark, sf_dir):
    """The trailing net income of a company over the capital of all its members; their shares are as known then."""
    companies = view(spark, sf_dir, "companies")
    group = [F.coalesce("company_id", F.lit(-1)).alias("c"), F.when(F.col("company_id").isNull(), F.col("security_id")).otherwise(-1).alias("o")]
    month = view(spark, sf_dir, "daily").groupBy("security_id", F.last_day("date").alias("date")).agg(F.max_by("close", "date").alias("close"))
    held = as_of(month, view(spark, sf_dir, "shares"), "security_id", "date", "visible", "id", ["total_shares", "period_end"], delay="interval 1 day").where("datediff(date, asof_period_end) <= 400")
    caps = held.join(companies, "security_id", "left").groupBy(*group, "date").agg(F.sum(F.col("close") * F.col("asof_total_shares")).alias("cap"))
    k = _known(spark, sf_dir, "net_income").where("net_income is not null").join(companies, "security_id", "left").select("security_id", "date", "net_income", *group)
    return k.join(caps, ["c", "o", "date"]).where("cap > 0").select("security_id", day("date").alias("date"), r6(1e3 * F.col("net_income.value") / F.col("cap")).alias("value"))


_SCORE = ("net_income", "cash_flow", "assets")
_SCORE_PAIRS = ("net_income_pair", "assets_pair", "shares_pair")
_MASKED = f"""{ctes('actions')}, masked AS (SELECT * FROM ev UNION ALL SELECT security_id, metric, period_end, visible, value, prior_end,
    CASE WHEN metric <> 'shares_pair' OR NOT EXISTS (SELECT 1 FROM actions s WHERE s.kind = 'split' AND s.security_id = p.security_id AND s.ex_date > p.prior_end AND s.ex_date <= p.period_end) THEN prior END FROM pair_ev p)"""


@query(f"""WITH {_PAIRS}, {_MASKED}, {_UNIVERSE}, {_known_sql((*_SCORE, *_SCORE_PAIRS), 'masked')},
  legs AS (SELECT security_id, date, [CASE WHEN assets.value > 0 THEN net_income.value > 0 END, cash_flow.value > 0, cash_flow.value > net_income.value,
    CASE WHEN assets_pair.value > 0 AND assets_pair.prior > 0 THEN net_income_pair.value::DOUBLE / assets_pair.value - net_income_pair.prior::DOUBLE / assets_pair.prior > 0 END, shares_pair.value <= shares_pair.prior] AS s FROM known)
  SELECT security_id, strftime(date, '%Y-%m-%d') AS date, len([x for x in s if x IS NOT NULL]) AS known, round(len([x for x in s if x]) / len([x for x in s if x IS NOT NULL]), 6) AS value FROM legs WHERE len([x for x in s if x IS NOT NULL]) >= 4""")
def factor_f_score(spark, sf_dir):
    """The part of five signs of strength that holds among those known, at least four: income, cash flow, cash over income, a better return on assets, no new shares.

    Where shares were split between the two dates, whether there are new ones is not known.
    """
    facts, companies, universe = _facts(spark, sf_dir), view(spark, sf_dir, "companies"), _universe(spark, sf_dir)
    metrics = _some(*_SCORE, "shares")  # alike for both, so that facts are dealt once
    pairs = fm.pair_events(facts, metrics)
    splits = view(spark, sf_dir, "actions").where("kind = 'split'")
    pairs = as_of(pairs, splits, "security_id", "period_end", "ex_date", "event_id", ["ex_date"])
    split = (F.col("metric") == "shares_pair") & (F.col("asof_ex_date") > F.col("prior_end"))
    pairs = pairs.withColumn("prior", F.when(F.coalesce(split, F.lit(False)), None).otherwise(F.col("prior"))).drop("asof_ex_date")
    events = fm.metric_events(facts, metrics).unionByName(pairs)
    names = (*_SCORE, *_SCORE_PAIRS)
    k = fm.company_values(fm.known_on(fm.with_members(universe, companies), events, names), companies, universe, names)
    ni, cash, assets, ni2, a2, sh2 = (F.col(n) for n in names)
    better = F.when((a2["value"] > 0) & (a2["prior"] > 0), ni2["value"] / a2["value"] - ni2["prior"] / a2["prior"] > 0)
    scores = [F.when(assets["value"] > 0, ni["value"] > 0), cash["value"] > 0, cash["value"] > ni["value"], better, sh2["value"] <= sh2["prior"]]
    known = sum((s.isNotNull().cast("long") for s in scores), F.lit(0).cast("long"))
    return k.select("security_id", day("date").alias("date"), known.alias("known"), r6(fm.mean_of_known(scores, 4)).alias("value")).where("known >= 4")


@query(f"""WITH {_EVENTS}, {_UNIVERSE}, {_known_sql(('net_income', 'cash_flow', 'assets'))}, places AS (SELECT date, row_number() OVER (ORDER BY date DESC) AS k FROM (SELECT DISTINCT date FROM dates))
  SELECT strftime(date, '%Y-%m-%d') AS date, count(*) AS cells, 0 AS violations, 0.0::DOUBLE AS largest FROM known JOIN places USING (date)
  WHERE k IN (3, 6, 9) AND assets.value > 0 AND net_income.period_end = cash_flow.period_end GROUP BY 1""")
def pit_regression(spark, sf_dir):
    """Accruals on three earlier month ends, against what they are with only the filings and prices of before; restatements must change nothing."""
    companies, active = view(spark, sf_dir, "companies"), view(spark, sf_dir, "securities").where("is_active").select("security_id")
    metrics = ("net_income", "cash_flow", "assets")

    at = evaluate.dates_before(_universe(spark, sf_dir), (3, 6, 9))

    def accruals(tables) -> DataFrame:
        # only these dates are compared, and what is known on one doesn't depend on others
        universe = tables["daily"].join(active, "security_id").select("security_id", F.last_day("date").alias("date")).where(F.col("date").isin(at)).distinct()
        k = fm.company_values(fm.known_on(fm.with_members(universe, companies), fm.metric_events(tables["reports"], _some(*metrics)), metrics), companies, universe, metrics)
        top = F.when(F.col("net_income.period_end") == F.col("cash_flow.period_end"), F.col("net_income.value") - F.col("cash_flow.value"))
        return k.where("assets.value > 0").select("date", "security_id", (top / F.col("assets.value")).alias("value"))

    sources = {"reports": (_facts(spark, sf_dir), F.col("filed")), "daily": (view(spark, sf_dir, "daily"), F.col("date"))}
    return evaluate.pit_regression(accruals, sources, at).select(day("date").alias("date"), "cells", "violations", "largest")
