"""Queries on events: corporate actions, fundamentals, shares, holdings, insiders and short sales."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.windows import dealt
from tidemark.operators import events as ev
from tidemark.operators import holdings, joins, writes
from tidemark.registry import query
from tidemark.sources.market import ctes, view
from tidemark.sources.views import table


def r6(x):
    return F.round(x, 6)


def day(x: str):
    return F.date_format(x, "yyyy-MM-dd")


# Corporate actions

_PREVIOUS = f"{ctes('actions', 'daily')}, prev AS (SELECT a.*, d.close AS previous FROM actions a ASOF LEFT JOIN daily d ON a.security_id = d.security_id AND a.ex_date > d.date)"
_SINGLE = f"""{_PREVIOUS}, single AS (SELECT *, CASE WHEN kind = 'split' THEN split_from / split_to WHEN previous > 0 AND cash > 0 AND cash < previous THEN (previous - cash) / previous END AS factor FROM prev)"""


def _with_previous(spark, sf_dir) -> DataFrame:
    closes = view(spark, sf_dir, "daily").select("security_id", "date", "close")
    return ev.before(view(spark, sf_dir, "actions"), closes, "security_id", "ex_date", "date", "close", ["close"]).withColumnRenamed("asof_close", "previous")


def _factors(spark, sf_dir) -> DataFrame:
    a = _with_previous(spark, sf_dir)
    return a.withColumn("factor", ev.single_factor(*(F.col(c) for c in ("kind", "cash", "split_from", "split_to", "previous"))))


@query(f"WITH {_PREVIOUS} SELECT event_id, round(previous, 6) AS previous FROM prev")
def previous_close(spark, sf_dir):
    return _with_previous(spark, sf_dir).select("event_id", r6("previous").alias("previous"))


@query(f"WITH {_SINGLE} SELECT event_id, round(factor, 6) AS factor FROM single")
def single_event_factor(spark, sf_dir):
    return _factors(spark, sf_dir).select("event_id", r6("factor").alias("factor"))


_CUMULATIVE = f"""{_SINGLE}, logs AS (SELECT security_id, ex_date, sum(ln(factor)) AS l FROM single WHERE factor > 0 GROUP BY 1, 2),
  cumulative AS (SELECT security_id, ex_date, round(exp(sum(l) OVER (PARTITION BY security_id ORDER BY ex_date DESC)), 12) AS c FROM logs)"""


@query(f"WITH {_CUMULATIVE} SELECT security_id, strftime(ex_date, '%Y-%m-%d') AS ex_date, round(c, 6) AS factor FROM cumulative")
def cumulative_factor(spark, sf_dir):
    c = ev.cumulative_factors(_factors(spark, sf_dir), "security_id", "ex_date", "factor")
    return c.select("security_id", day("ex_date").alias("ex_date"), r6("cumulative_factor").alias("factor"))


@query(f"""WITH {_CUMULATIVE}, base AS (SELECT security_id, arg_min(c, ex_date) AS b FROM cumulative WHERE ex_date > DATE '1999-06-30' GROUP BY 1),
  p AS (SELECT d.security_id, d.date, d.close, coalesce(c.c, 1) / coalesce(b, 1) AS f FROM daily d ASOF LEFT JOIN cumulative c ON d.security_id = c.security_id AND d.date < c.ex_date LEFT JOIN base ON base.security_id = d.security_id)
  SELECT security_id, strftime(date, '%Y-%m-%d') AS date, round(ln(close * f), 9) AS log_adjusted FROM p""")
def adjusted_prices(spark, sf_dir):
    c = ev.cumulative_factors(_factors(spark, sf_dir), "security_id", "ex_date", "factor")
    p = ev.adjustment(view(spark, sf_dir, "daily"), c, "security_id", "date", "ex_date", F.lit("1999-06-30").cast("date"))
    x = F.col("close") * F.col("factor")
    # a product of factors that rounds to zero has a logarithm in SQL, and none in Spark
    return p.select("security_id", day("date").alias("date"), F.round(F.when(x == 0, float("-inf")).otherwise(F.ln(x)), 9).alias("log_adjusted"))


@query(f"""WITH {ctes('actions', 'daily')}, b AS (SELECT a.event_id, d.close AS prev_close FROM actions a ASOF LEFT JOIN daily d ON a.security_id = d.security_id AND a.ex_date > d.date),
  n AS (SELECT a.event_id, d.close AS next_close FROM actions a ASOF LEFT JOIN daily d ON a.security_id = d.security_id AND a.ex_date <= d.date)
  SELECT event_id, round(prev_close, 6) AS prev_close, round(next_close, 6) AS next_close FROM b JOIN n USING (event_id)""")
def closes_around(spark, sf_dir):
    a = ev.around(view(spark, sf_dir, "actions"), view(spark, sf_dir, "daily"), "security_id", "ex_date", "date", "close")
    return a.select("event_id", r6("prev_close").alias("prev_close"), r6("next_close").alias("next_close"))


@query(f"""WITH {ctes('actions', 'daily')}, s AS (SELECT security_id, min(date) AS a, max(date) AS b FROM daily GROUP BY 1)
  SELECT event_id FROM actions JOIN s USING (security_id) WHERE source = 'legacy' AND a < ex_date AND ex_date <= b AND NOT EXISTS (SELECT 1 FROM actions t WHERE t.security_id = actions.security_id AND t.kind = actions.kind AND t.ex_date = actions.ex_date AND t.source = 'trusted')""")
def uncovered_events(spark, sf_dir):
    """Events of no trusted source and no trusted twin on their day, inside their security's price history."""
    a = view(spark, sf_dir, "actions")
    twins = a.where("source = 'trusted'").select("security_id", "kind", "ex_date")
    spans = view(spark, sf_dir, "daily").groupBy("security_id").agg(F.min("date").alias("a"), F.max("date").alias("b"))
    return a.where("source = 'legacy'").join(twins, ["security_id", "kind", "ex_date"], "left_anti").join(spans, "security_id").where("a < ex_date and ex_date <= b").select("event_id")


@query(f"""WITH {ctes('actions')}, d AS (SELECT *, count(DISTINCT split_from / split_to) OVER (PARTITION BY security_id, ex_date) AS n, min(event_id) OVER (PARTITION BY security_id, ex_date) AS first FROM actions WHERE kind = 'split')
  SELECT event_id, CASE WHEN n > 1 THEN 'quarantine' WHEN event_id = first THEN 'keep' ELSE 'duplicate' END AS verdict FROM d""")
def split_sifting(spark, sf_dir):
    """Splits of one day: several ratios isolate the day, equal ones keep the smallest id."""
    w = Window.partitionBy("security_id", "ex_date")
    s = view(spark, sf_dir, "actions").where("kind = 'split'").withColumn("ratio", F.col("split_from") / F.col("split_to"))
    verdict = F.when(F.min("ratio").over(w) < F.max("ratio").over(w), "quarantine").when(F.col("event_id") == F.min("event_id").over(w), "keep").otherwise("duplicate")
    return s.select("event_id", verdict.alias("verdict"))


@query(f"""WITH {ctes('actions')}, g AS (SELECT security_id, kind, ex_date, round(cash, 10) AS cash, bool_or(source = 'trusted') AS real FROM actions WHERE kind = 'dividend' GROUP BY 1, 2, 3, 4)
  SELECT event_id FROM actions JOIN g ON g.security_id = actions.security_id AND g.ex_date = actions.ex_date AND g.kind = actions.kind AND round(actions.cash, 10) = g.cash WHERE NOT real OR source = 'trusted'""")
def economic_dedupe(spark, sf_dir):
    """Placeholders go where a real row of the same economic key exists; several real ones stay."""
    d = view(spark, sf_dir, "actions").where("kind = 'dividend'")
    w = Window.partitionBy("security_id", "ex_date", F.round("cash", 10))
    return d.withColumn("real", F.bool_or(F.col("source") == "trusted").over(w)).where("not real or source = 'trusted'").select("event_id")


@query(f"""WITH {ctes('actions', 'shares')}, s AS (SELECT security_id, ex_date, sum(ln(split_to / split_from)) AS l FROM actions WHERE kind = 'split' GROUP BY 1, 2), c AS (SELECT security_id, ex_date, sum(l) OVER (PARTITION BY security_id ORDER BY ex_date) AS l FROM s),
  a AS (SELECT id, coalesce(c.l, 0) AS at_visible FROM shares v ASOF LEFT JOIN c ON v.security_id = c.security_id AND v.visible >= c.ex_date), b AS (SELECT id, coalesce(c.l, 0) AS at_anchor FROM shares v ASOF LEFT JOIN c ON v.security_id = c.security_id AND v.period_end >= c.ex_date)
  SELECT id, round(total_shares * exp(at_visible - at_anchor) / 1000, 3) AS rolled FROM shares JOIN a USING (id) JOIN b USING (id)""")
def rolled_shares(spark, sf_dir):
    """Share counts rolled forward from their anchor by the splits since: a running sum of logs at two moments."""
    s = view(spark, sf_dir, "actions").where("kind = 'split'").groupBy("security_id", "ex_date").agg(F.sum(F.ln(F.col("split_to") / F.col("split_from"))).alias("l"))
    c = s.withColumn("l", F.sum("l").over(Window.partitionBy("security_id").orderBy("ex_date")))
    v = view(spark, sf_dir, "shares")
    for at, name in (("visible", "now"), ("period_end", "then")):
        v = joins.as_of(v, c, "security_id", at, "ex_date", "l", ["l"]).withColumnRenamed("asof_l", name)
    return v.select("id", F.round(F.col("total_shares") * F.exp(F.coalesce("now", F.lit(0.0)) - F.coalesce("then", F.lit(0.0))) / 1000, 3).alias("rolled"))


# Fundamentals

_VINTAGES = f"""{ctes('facts')}, lagged AS (SELECT *, lag(value) OVER w AS b, row_number() OVER w AS n FROM facts WINDOW w AS (PARTITION BY security_id, concept, period_end ORDER BY filed, accession)),
  vintages AS (SELECT security_id, concept, period_end, filed, accession, value FROM lagged WHERE n = 1 OR value IS DISTINCT FROM b)"""


def _vintages(spark, sf_dir) -> DataFrame:
    return ev.changes(view(spark, sf_dir, "facts"), ["security_id", "concept", "period_end"], ["filed", "accession"], "value")


@query(f"WITH {_VINTAGES} SELECT accession, value FROM vintages")
def vintages(spark, sf_dir):
    return _vintages(spark, sf_dir).select("accession", "value")


_GUARDED = f"""{_VINTAGES}, m AS (SELECT *, max(period_end) OVER (PARTITION BY security_id, concept ORDER BY filed, accession ROWS UNBOUNDED PRECEDING) AS most FROM vintages), guarded AS (SELECT * FROM m WHERE period_end >= most)"""


def _guarded(spark, sf_dir) -> DataFrame:
    return ev.no_regressions(_vintages(spark, sf_dir), ["security_id", "concept"], ["filed", "accession"], "period_end")


@query(f"WITH {_GUARDED} SELECT concept, count(*) AS n, sum(value)::BIGINT AS total FROM guarded GROUP BY 1")
def period_guard(spark, sf_dir):
    return _guarded(spark, sf_dir).groupBy("concept").agg(F.count("*").alias("n"), F.sum("value").cast("long").alias("total"))


def _metric_dates(spark, sf_dir) -> DataFrame:
    return view(spark, sf_dir, "daily").select("security_id", F.last_day("date").alias("date")).distinct()


_YOY = f"""{_VINTAGES}, a AS (SELECT * FROM vintages WHERE concept = 'assets'),
  pairs AS (SELECT c.accession, c.security_id, c.filed, c.period_end, c.value AS cur, p.value AS prior, p.period_end AS prior_period FROM a c JOIN a p ON c.security_id = p.security_id AND p.filed <= c.filed AND c.period_end - p.period_end BETWEEN 330 AND 400
    QUALIFY row_number() OVER (PARTITION BY c.accession ORDER BY abs(c.period_end - p.period_end - 365), p.period_end, p.filed DESC, p.accession DESC) = 1)"""


def _yoy(spark, sf_dir) -> DataFrame:
    """Pairs of a vintage and that of the period nearest to a year before, as it was known then; dealt by year of period, so rows meet in reach only."""
    a = _vintages(spark, sf_dir).where("concept = 'assets'").select("accession", "security_id", "filed", "period_end", F.col("value").alias("cur"))
    p = a.select("security_id", F.col("filed").alias("p_filed"), F.col("period_end").alias("prior_period"), F.col("cur").alias("prior"), F.col("accession").alias("p_acc"), F.year("period_end").alias("span"))
    gap = F.datediff("period_end", "prior_period")
    near = a.withColumn("span", F.explode(F.sequence(F.year(F.date_sub("period_end", 400)), F.year(F.date_sub("period_end", 330))))).join(p, ["security_id", "span"]).where((F.col("p_filed") <= F.col("filed")) & gap.between(330, 400))
    w = Window.partitionBy("accession").orderBy(F.abs(gap - 365), "prior_period", F.desc("p_filed"), F.desc("p_acc"))
    return near.withColumn("r", F.row_number().over(w)).where("r = 1")


@query(f"WITH {_YOY} SELECT accession, round((cur - prior) / prior, 6) AS growth FROM pairs WHERE prior > 0")
def factor_asset_growth(spark, sf_dir):
    return _yoy(spark, sf_dir).where("prior > 0").select("accession", r6((F.col("cur") - F.col("prior")) / F.col("prior")).alias("growth"))


@query(f"""WITH {_YOY}, {ctes('actions')} SELECT accession, CASE WHEN EXISTS (SELECT 1 FROM actions s WHERE s.kind = 'split' AND s.security_id = pairs.security_id AND s.ex_date > prior_period AND s.ex_date <= period_end) THEN NULL ELSE cur END AS kept FROM pairs""")
def split_contamination(spark, sf_dir):
    """Cells with a split between the two periods are masked: the last split up to the later one is after the earlier one."""
    splits = view(spark, sf_dir, "actions").where("kind = 'split'")
    y = joins.as_of(_yoy(spark, sf_dir), splits, "security_id", "period_end", "ex_date", "event_id", ["ex_date"])
    hit = F.coalesce(F.col("asof_ex_date") > F.col("prior_period"), F.lit(False))
    return y.select("accession", F.when(~hit, F.col("cur")).alias("kept"))


_CAP = f"""{ctes('shares', 'daily')}, sh AS (SELECT security_id, visible, arg_max(total_shares, id) AS total_shares, arg_max(period_end, id) AS period_end FROM shares GROUP BY 1, 2),
  cap AS (SELECT d.security_id, d.date, CASE WHEN d.date - period_end <= 400 THEN d.close * total_shares END AS cap FROM daily d ASOF LEFT JOIN sh ON d.security_id = sh.security_id AND d.date >= sh.visible + 1)"""


def _cap(spark, sf_dir) -> DataFrame:
    d = view(spark, sf_dir, "daily").select("security_id", "date", "close")
    s = joins.as_of(d, view(spark, sf_dir, "shares"), "security_id", "date", "visible", "id", ["total_shares", "period_end"], delay="interval 1 day")
    return s.select("security_id", "date", F.when(F.datediff("date", "asof_period_end") <= 400, F.col("close") * F.col("asof_total_shares")).alias("cap"))


@query(f"WITH {_CAP} SELECT security_id, strftime(date, '%Y-%m-%d') AS date, round(ln(cap), 6) AS value FROM cap WHERE cap > 0")
def factor_size(spark, sf_dir):
    return _cap(spark, sf_dir).where("cap > 0").select("security_id", day("date").alias("date"), r6(F.ln("cap")).alias("value"))


@query(f"WITH {_CAP}, {ctes('securities')} SELECT cik, strftime(date, '%Y-%m-%d') AS date, round(sum(cap) / 1e6, 3) AS cap, count(cap) AS n, arg_min(cap, c.security_id) FILTER (WHERE cap IS NOT NULL) / 1e6 AS first_cap FROM cap c JOIN securities USING (security_id) GROUP BY 1, 2")
def company_caps(spark, sf_dir):
    """A company's capital: the sum of its members', null only where all are; and the first member's that is known."""
    m = view(spark, sf_dir, "securities").select("security_id", "cik")
    first = F.min_by("cap", F.when(F.col("cap").isNotNull(), F.col("security_id"))) / 1e6
    return _cap(spark, sf_dir).join(m, "security_id").groupBy("cik", day("date").alias("date")).agg(F.round(F.sum("cap") / 1e6, 3).alias("cap"), F.count("cap").alias("n"), first.alias("first_cap"))


# Holdings

_HELD = f"""{ctes('holdings')}, held AS (SELECT * FROM holdings WHERE kind = 'SH' AND put_call IS NULL AND (form IS NULL OR form NOT LIKE '%/A%')),
  filings AS (SELECT DISTINCT filer, period, accession, filed FROM held), last AS (SELECT filer, period, arg_max(accession, (filed, accession)) AS accession FROM filings GROUP BY 1, 2), first AS (SELECT filer, period, arg_max(accession, (filed, accession)) AS accession FROM filings WHERE filed <= period + 46 GROUP BY 1, 2)"""


def _stage_sql(picks: str) -> str:
    per = f"SELECT security_id, h.period, h.filer, filed, sum(value::DECIMAL(18, 2))::DOUBLE AS v, sum(shares)::DOUBLE AS n FROM held h JOIN {picks} USING (filer, period, accession) GROUP BY 1, 2, 3, 4"
    return f"SELECT security_id, period, max(filed) AS visible, count(DISTINCT filer) AS holders, sum(v) AS total, sum(n) AS shares, sum(v * v) AS squares FROM ({per}) GROUP BY 1, 2"


_INSTITUTIONAL = f"""{_HELD}, final AS ({_stage_sql('last')}), early AS ({_stage_sql('first')}),
  staged AS (SELECT * FROM final UNION ALL SELECT e.* FROM early e LEFT JOIN final f USING (security_id, period) WHERE f.visible IS NULL OR e.visible < f.visible),
  aggs AS (SELECT security_id, period, visible, holders, total, shares, CASE WHEN total > 0 THEN squares / (total * total) END AS hhi FROM (SELECT *, max(period) OVER (PARTITION BY security_id ORDER BY visible, period ROWS UNBOUNDED PRECEDING) AS most FROM staged) WHERE period >= most)"""


def _institutional(spark, sf_dir) -> DataFrame:
    h = view(spark, sf_dir, "holdings").where("kind = 'SH' and put_call is null and (form is null or form not like '%/A%')")
    return holdings.institutional_events(h)


@query(f"WITH {_INSTITUTIONAL} SELECT security_id, strftime(period, '%Y-%m-%d') AS period, strftime(visible, '%Y-%m-%d') AS visible, holders, round(total, 2) AS total, shares, round(hhi, 6) AS hhi FROM aggs")
def institutional_events(spark, sf_dir):
    """Holdings of a quarter as told in time, then as told at last, each from the day its last filing came."""
    return _institutional(spark, sf_dir).select("security_id", day("period").alias("period"), day("visible").alias("visible"), "holders", F.round("total", 2).alias("total"), "shares", r6("hhi").alias("hhi"))


@query(f"WITH {_HELD}, final AS ({_stage_sql('last')}), early AS ({_stage_sql('first')}) SELECT security_id, strftime(period, '%Y-%m-%d') AS period, f.holders, round(f.total, 2) AS total, coalesce(e.holders, 0) AS on_time_holders, round(f.squares / (f.total * f.total), 6) AS hhi FROM final f LEFT JOIN early e USING (security_id, period)")
def institutional_aggregates(spark, sf_dir):
    h = view(spark, sf_dir, "holdings").where("kind = 'SH' and put_call is null and (form is null or form not like '%/A%')")
    a = holdings.staged(h).where("final.visible is not null")
    return a.select("security_id", day("period").alias("period"), "final.holders", F.round("final.total", 2).alias("total"), F.col("early.holders").alias("on_time_holders"), r6(F.col("final.squares") / (F.col("final.total") * F.col("final.total"))).alias("hhi"))


_MONTHS = "months AS (SELECT DISTINCT security_id, last_day(date) AS date FROM daily)"


def _holding_factor(name: str, column: str, digits: int) -> None:
    """Registers what was known of holdings on month ends: the events whose day has come, of a period at most 200 days ago."""
    sql = f"""WITH {_INSTITUTIONAL}, {ctes('daily')}, {_MONTHS}, e AS (SELECT security_id, visible, max({{'period': period, 'value': {column}::DOUBLE}}) AS e FROM aggs GROUP BY 1, 2)
  SELECT m.security_id, strftime(m.date, '%Y-%m-%d') AS date, round(e.value, {digits}) AS value FROM months m ASOF JOIN e ON m.security_id = e.security_id AND m.date >= e.visible WHERE m.date - e.period <= 200 AND e.value IS NOT NULL"""

    def run(spark, sf_dir):
        d = joins.as_of(_metric_dates(spark, sf_dir), _institutional(spark, sf_dir), "security_id", "date", "visible", "period", [column, "period"])
        return d.where(F.datediff("date", "asof_period") <= 200).select("security_id", day("date").alias("date"), F.round(F.col(f"asof_{column}").cast("double"), digits).alias("value")).where("value is not null")

    query(sql, name)(run)


_holding_factor("factor_institutional_breadth", "holders", 0)
_holding_factor("factor_ownership_concentration", "hhi", 6)


@query(f"""WITH {_INSTITUTIONAL}, {ctes('daily')}, {_MONTHS}, quarters AS (SELECT security_id, period, lag(period) OVER (PARTITION BY security_id ORDER BY period) AS before FROM (SELECT DISTINCT security_id, period FROM aggs)),
  base AS (SELECT a.security_id, a.period, a.visible, a.shares, b.shares AS before FROM (SELECT a.*, q.before AS p FROM aggs a JOIN quarters q USING (security_id, period)) a ASOF LEFT JOIN aggs b ON a.security_id = b.security_id AND a.p = b.period AND a.visible >= b.visible),
  e AS (SELECT security_id, visible, max({{'period': period, 'value': CASE WHEN before > 0 THEN (shares - before) / before END}}) AS e FROM base GROUP BY 1, 2)
  SELECT m.security_id, strftime(m.date, '%Y-%m-%d') AS date, round(e.value, 6) AS value FROM months m ASOF JOIN e ON m.security_id = e.security_id AND m.date >= e.visible WHERE m.date - e.period <= 200 AND e.value IS NOT NULL""")
def factor_delta_ownership(spark, sf_dir):
    """The change of shares held against the quarter before as that was known when this one was told; in time and at last each has its own base."""
    changed = holdings.changes_of_shares(_institutional(spark, sf_dir))
    d = joins.as_of(_metric_dates(spark, sf_dir), changed, "security_id", "date", "visible", "period", ["change", "period"])
    return d.where(F.datediff("date", "asof_period") <= 200).select("security_id", day("date").alias("date"), r6("asof_change").alias("value")).where("value is not null")


# Insiders and short sales

_ENTRIES = f"""{ctes('insider')}, entries AS (SELECT min(id) AS id, security_id, owner, trade_date, filed, code, shares, round(price, 6) AS price FROM insider GROUP BY 2, 3, 4, 5, 6, 7, 8)"""


def _entries(spark, sf_dir, *deal) -> DataFrame:
    i = view(spark, sf_dir, "insider", *deal).withColumn("price", r6("price"))
    return i.groupBy("security_id", "owner", "trade_date", "filed", "code", "shares", "price").agg(F.min("id").alias("id"))


@query(f"WITH {_ENTRIES} SELECT id FROM entries")
def insider_entries(spark, sf_dir):
    return _entries(spark, sf_dir).select("id")


@query(f"""WITH {_ENTRIES}, {ctes('daily')}, d AS (SELECT security_id, filed + 1 AS date, sum(CASE code WHEN 'P' THEN shares ELSE -shares END) AS s FROM entries WHERE code IN ('P', 'S') GROUP BY 1, 2)
  SELECT t.security_id, strftime(t.date, '%Y-%m-%d') AS date, round(coalesce(sum(s) FILTER (WHERE t.date - d.date <= 89), 0), 4) AS value FROM daily t JOIN d ON t.security_id = d.security_id AND d.date <= t.date GROUP BY 1, 2""")
def factor_insider_net_buy(spark, sf_dir):
    """Shares bought less sold by insiders, told in the 90 days up to each trading day, from the first telling on."""
    signed = F.when(F.col("code") == "P", F.col("shares")).otherwise(-F.col("shares"))
    by_security = lambda lines: dealt(lines, "l_suppkey", mb=4)  # noqa: E731  pairs and entries are added up where lines are dealt to
    d = _entries(spark, sf_dir, by_security).where("code in ('P', 'S')").groupBy("security_id", F.date_add("filed", 1).alias("date")).agg(F.sum(signed).alias("s"))
    days = view(spark, sf_dir, "daily", by_security).select("security_id", "date", F.lit(None).cast("double").alias("s"), F.lit(True).alias("asked"))
    w = Window.partitionBy("security_id").orderBy(F.datediff("date", F.lit("1970-01-01")))
    told = F.count("s").over(w.rangeBetween(Window.unboundedPreceding, 0))
    both = dealt(days.unionByName(d.select("security_id", "date", "s", F.lit(False).alias("asked"))), "security_id", mb=4)
    value = F.coalesce(F.sum("s").over(w.rangeBetween(-89, 0)), F.lit(0.0))
    return both.select("security_id", "date", "asked", told.alias("told"), value.alias("value")).where("asked and told > 0").select("security_id", day("date").alias("date"), F.round("value", 4).alias("value"))


_ROUTINE = f"""{_ENTRIES}, bought AS (SELECT DISTINCT security_id, owner, year(trade_date) AS y, month(trade_date) AS m FROM entries WHERE code = 'P'), flagged AS (SELECT e.*, (SELECT count(*) FROM bought b WHERE b.security_id = e.security_id AND b.owner = e.owner AND b.m = month(e.trade_date) AND b.y BETWEEN year(e.trade_date) - 3 AND year(e.trade_date) - 1) = 3 AS routine FROM entries e WHERE code = 'P')"""


def _flagged(spark, sf_dir) -> DataFrame:
    """Purchases with routine: the owner bought in the same month of each of the three years before."""
    e = _entries(spark, sf_dir).where("code = 'P'").withColumn("y", F.year("trade_date")).withColumn("m", F.month("trade_date"))
    w = Window.partitionBy("security_id", "owner", "m").orderBy("y").rangeBetween(-3, -1)
    return e.withColumn("routine", F.size(F.collect_set("y").over(w)) == 3)


@query(f"WITH {_ROUTINE} SELECT id, routine FROM flagged")
def routine_insiders(spark, sf_dir):
    return _flagged(spark, sf_dir).select("id", "routine")


@query(f"""WITH {_ROUTINE}, {ctes('daily')}, f AS (SELECT security_id, owner, filed FROM flagged WHERE NOT routine)
  SELECT t.security_id, strftime(t.date, '%Y-%m-%d') AS date, count(DISTINCT f.owner) FILTER (WHERE t.date - f.filed <= 90) AS value FROM daily t JOIN f ON t.security_id = f.security_id AND f.filed <= t.date GROUP BY 1, 2""")
def factor_insider_cluster(spark, sf_dir):
    """Different insiders who bought out of routine in the 91 days up to each trading day, from the first such purchase on."""
    w = Window.partitionBy("security_id").orderBy(F.datediff("date", F.lit("1970-01-01")))
    f = _flagged(spark, sf_dir).where("not routine").groupBy("security_id", F.col("filed").alias("date")).agg(F.collect_set("owner").alias("o"))
    days = view(spark, sf_dir, "daily").select("security_id", "date", F.lit(None).cast(f.schema["o"].dataType).alias("o"), F.lit(True).alias("asked"))
    both = days.unionByName(f.select("security_id", "date", "o", F.lit(False).alias("asked")))
    owners = F.size(F.array_distinct(F.flatten(F.collect_list("o").over(w.rangeBetween(-90, 0))))).cast("long")
    told = F.count("o").over(w.rangeBetween(Window.unboundedPreceding, 0))
    return both.select("security_id", "date", "asked", told.alias("told"), owners.alias("value")).where("asked and told > 0").select("security_id", day("date").alias("date"), "value")


@query(f"""WITH {ctes('short')} SELECT security_id, strftime(trade_date + 1, '%Y-%m-%d') AS date, round(short_volume / total_volume, 6) AS value FROM short WHERE total_volume > 0""")
def factor_short_volume(spark, sf_dir):
    s = view(spark, sf_dir, "short").where("total_volume > 0")
    return s.select("security_id", day(F.date_add("trade_date", 1)).alias("date"), r6(F.col("short_volume") / F.col("total_volume")).alias("value"))


_SI = f"""{ctes('short')}, si AS (SELECT security_id, last_day(trade_date) AS settled, sum(short_volume) AS si FROM short GROUP BY 1, 2)"""


def _interest(spark, sf_dir) -> DataFrame:
    return view(spark, sf_dir, "short").groupBy("security_id", F.last_day("trade_date").alias("settled")).agg(F.sum("short_volume").alias("si"))


@query(f"""WITH {_SI}, v AS (SELECT security_id, trade_date AS date, avg(total_volume) OVER w AS m, count(*) OVER w AS n FROM short WINDOW w AS (PARTITION BY security_id ORDER BY trade_date ROWS 19 PRECEDING))
  SELECT v.security_id, strftime(v.date, '%Y-%m-%d') AS date, round(si.si / m, 6) AS value FROM v ASOF JOIN si ON v.security_id = si.security_id AND v.date >= si.settled + 14 WHERE n >= 10 AND m > 0 AND v.date - si.settled <= 60""")
def factor_days_to_cover(spark, sf_dir):
    w = Window.partitionBy("security_id").orderBy("date").rowsBetween(-19, 0)
    v = view(spark, sf_dir, "short").withColumnRenamed("trade_date", "date").select("security_id", "date", F.avg("total_volume").over(w).alias("m"), F.count("*").over(w).alias("n")).where("n >= 10 and m > 0")
    s = joins.as_of(v, _interest(spark, sf_dir), "security_id", "date", "settled", "si", ["si", "settled"], delay="interval 14 days")
    return s.where(F.datediff("date", "asof_settled") <= 60).select("security_id", day("date").alias("date"), r6(F.col("asof_si") / F.col("m")).alias("value"))


@query(f"""WITH {_SI}, {ctes('shares', 'daily')}, {_MONTHS}, sh AS (SELECT security_id, visible, arg_max(total_shares, id) AS s, arg_max(period_end, id) AS p FROM shares GROUP BY 1, 2),
  a AS (SELECT m.security_id, m.date, si.si FROM months m ASOF JOIN si ON m.security_id = si.security_id AND m.date >= si.settled + 14 WHERE m.date - si.settled <= 60)
  SELECT a.security_id, strftime(a.date, '%Y-%m-%d') AS date, round(1e6 * a.si / sh.s, 6) AS value FROM a ASOF JOIN sh ON a.security_id = sh.security_id AND a.date >= sh.visible WHERE a.date - sh.p <= 400 AND sh.s > 0""")
def factor_short_interest(spark, sf_dir):
    d = joins.as_of(_metric_dates(spark, sf_dir), _interest(spark, sf_dir), "security_id", "date", "settled", "si", ["si", "settled"], delay="interval 14 days").where(F.datediff("date", "asof_settled") <= 60).select("security_id", "date", F.col("asof_si").alias("si"))
    s = joins.as_of(d, view(spark, sf_dir, "shares"), "security_id", "date", "visible", "id", ["total_shares", "period_end"])
    return s.where((F.datediff("date", "asof_period_end") <= 400) & (F.col("asof_total_shares") > 0)).select("security_id", day("date").alias("date"), r6(1e6 * F.col("si") / F.col("asof_total_shares")).alias("value"))
