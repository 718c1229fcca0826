"""Queries on scans, master data, ledgers of trials, terminal events and event studies."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import events as ev
from tidemark.operators import joins, records, writes
from tidemark.operators.windows import ordered
from tidemark.plans import evaluate, factors
from tidemark.queries import _TEST, GRID, _panel, grid, r6
from tidemark.registry import query
from tidemark.sources.market import ctes, view
from tidemark.sources.views import table


def day(x):
    return F.date_format(x, "yyyy-MM-dd")


# Scans


@query(f"WITH {ctes('daily', 'securities')} SELECT d.security_id, strftime(date, '%Y-%m-%d') AS date, round(close, 6) AS close, volume FROM daily d JOIN securities s USING (security_id) WHERE is_active AND date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31' AND cik % 2 = 0")
def price_scan(spark, sf_dir):
    """A range of bars of chosen securities; range and columns reach the scan of the line items."""
    s = view(spark, sf_dir, "securities").where("is_active and cik % 2 = 0").select("security_id")
    d = view(spark, sf_dir, "daily").where("date between date'1997-01-01' and date'1998-12-31'")
    return d.join(s, "security_id", "left_semi").select("security_id", day("date").alias("date"), r6("close").alias("close"), "volume")


@query(f"WITH {ctes('daily')}, l AS (SELECT max(date) AS date FROM daily GROUP BY date_trunc('month', date)) SELECT security_id, strftime(date, '%Y-%m-%d') AS date, round(close, 6) AS close FROM daily JOIN l USING (date) WHERE close IS NOT NULL")
def closes_at_dates(spark, sf_dir):
    d = view(spark, sf_dir, "daily")
    dates = d.groupBy(F.date_trunc("month", "date")).agg(F.max("date").alias("date")).select("date")
    return d.join(dates, "date", "left_semi").where("close is not null").select("security_id", day("date").alias("date"), r6("close").alias("close"))


@query(f"WITH {ctes('actions')} SELECT security_id, strftime(ex_date, '%Y-%m-%d') AS ex_date, max(split_from / split_to) AS factor FROM actions WHERE kind = 'split' AND NOT EXISTS (SELECT 1 FROM actions m WHERE m.security_id = actions.security_id AND m.ex_date = actions.ex_date AND m.kind = 'split' AND m.split_to = 4) GROUP BY 1, 2")
def split_scan(spark, sf_dir):
    """Splits by day; a marker on a day suppresses all splits of it."""
    s = view(spark, sf_dir, "actions").where("kind = 'split'")
    marked = s.where("split_to = 4").select("security_id", "ex_date")
    kept = s.join(marked, ["security_id", "ex_date"], "left_anti")
    return kept.groupBy("security_id", day("ex_date").alias("ex_date")).agg(F.max(F.col("split_from") / F.col("split_to")).alias("factor"))


@query("""SELECT o_orderkey AS id, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN 'EUR' END, 'USD') AS currency, round(o_totalprice / 1000 - 100, 6) AS cash FROM orders WHERE o_totalprice / 1000 - 100 > 0""")
def dividend_rows(spark, sf_dir):
    """Rows without a positive amount are bad; a missing currency is the dollar."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 3 == 0, "EUR").alias("currency"), (F.col("o_totalprice") / 1000 - 100).alias("cash"))
    return o.where("id is not null and cash > 0").select("id", F.coalesce("currency", F.lit("USD")).alias("currency"), r6("cash").alias("cash"))


@query("""SELECT o_orderkey, o_custkey::VARCHAR AS accession, strftime(o_orderdate, '%Y-%m-%d') AS filed FROM orders WHERE o_orderkey % 2 = 0 AND o_orderdate >= TIMESTAMP '1996-06-01'""")
def filing_block(spark, sf_dir):
    """Parallel arrays of one filer, taken together by place; form and date are filtered after."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("cik"), F.struct("o_orderkey", F.col("o_custkey").cast("string").alias("a"), F.when(F.col("o_orderkey") % 2 == 0, "4").otherwise("8-K").alias("f"), day("o_orderdate").alias("d")).alias("r"))
    block = o.groupBy("cik").agg(F.sort_array(F.collect_list("r")).alias("r"))
    arrays = block.select("cik", F.col("r.o_orderkey").alias("key"), F.col("r.a").alias("accession"), F.col("r.f").alias("form"), F.col("r.d").alias("filed"))
    rows = arrays.select("cik", F.inline(F.arrays_zip("key", "accession", "form", "filed")))
    return rows.where("form = '4' and filed >= '1996-06-01'").select(F.col("key").alias("o_orderkey"), "accession", "filed")


# Master data


@query(f"WITH {ctes('securities', 'actions', 'shares')} SELECT security_id, EXISTS (SELECT 1 FROM actions a WHERE a.security_id = s.security_id) AS acted, EXISTS (SELECT 1 FROM shares h WHERE h.security_id = s.security_id) AS counted FROM securities s")
def coverage_flags(spark, sf_dir):
    s = view(spark, sf_dir, "securities").select("security_id")
    return records.flags(s, "security_id", acted=view(spark, sf_dir, "actions"), counted=view(spark, sf_dir, "shares"))


@query(f"WITH {ctes('securities')} SELECT security_id, is_active AND security_id % 4 <> 1 AS is_active FROM securities")
def deactivate_missing(spark, sf_dir):
    """Securities that an active list doesn't name become inactive; an empty list is an error, and changes nothing."""
    s = view(spark, sf_dir, "securities")
    active = s.where("security_id % 4 <> 1").select("security_id", F.lit(True).alias("named"))
    if active.isEmpty():
        raise ValueError("the active list is empty")
    return s.join(active, "security_id", "left").select("security_id", (F.col("is_active") & F.col("named").isNotNull()).alias("is_active"))


@query(f"WITH {ctes('securities')}, f AS (SELECT security_id, CASE WHEN security_id % 2 = 0 THEN NULL ELSE symbol END AS symbol, name FROM securities) SELECT security_id, coalesce(symbol, 'X' || security_id) AS symbol, symbol IS NULL AS changed FROM f")
def enrich_identity(spark, sf_dir):
    s = view(spark, sf_dir, "securities").select("security_id", F.when(F.col("security_id") % 2 != 0, F.col("symbol")).alias("symbol"))
    fills = s.select("security_id", F.concat(F.lit("X"), F.col("security_id").cast("string")).alias("fill"))
    return s.join(fills, "security_id", "left").select("security_id", F.coalesce("symbol", "fill").alias("symbol"), (F.col("symbol").isNull() & F.col("fill").isNotNull()).alias("changed"))


@query("""WITH h AS (SELECT c_custkey AS k, 'OLD' AS symbol, DATE '1995-01-01' AS s, CASE WHEN c_custkey % 3 = 0 THEN DATE '1996-01-01' END AS e FROM customer), c AS (SELECT c_custkey AS k, DATE '1997-01-01' + (c_custkey % 9)::INT AS moved FROM customer WHERE c_custkey % 2 = 0)
  SELECT k, symbol, strftime(s, '%Y-%m-%d') AS start, strftime(CASE WHEN e IS NULL THEN moved ELSE e END, '%Y-%m-%d') AS until FROM h LEFT JOIN c USING (k) UNION ALL SELECT k, 'NEW', strftime(moved, '%Y-%m-%d'), NULL FROM h JOIN c USING (k) WHERE e IS NULL""")
def renames(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    h = c.select(F.col("c_custkey").alias("k"), F.lit("OLD").alias("symbol"), F.lit("1995-01-01").cast("date").alias("start"), F.when(F.col("c_custkey") % 3 == 0, F.lit("1996-01-01").cast("date")).alias("end"))
    new = c.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k"), F.lit("NEW").alias("symbol"), F.date_add(F.lit("1997-01-01").cast("date"), (F.col("c_custkey") % 9).cast("int")).alias("at"))
    return records.renamed(h, new, "k").select("k", "symbol", day("start").alias("start"), day("end").alias("until"))


@query(f"""WITH {ctes('actions')}, a AS (SELECT *, source = 'legacy' AS made FROM actions WHERE kind = 'dividend'), c AS (SELECT *, count(*) FILTER (WHERE NOT made) OVER (PARTITION BY security_id, ex_date, round(cash, 2)) AS same, count(*) FILTER (WHERE NOT made) OVER (PARTITION BY security_id, ex_date) AS reals, count(*) FILTER (WHERE made) OVER (PARTITION BY security_id, ex_date) AS mades FROM a) SELECT event_id FROM c WHERE NOT (made AND (same > 0 OR (reals = 1 AND mades = 1)))""")
def synthetic_cleanup(spark, sf_dir):
    a = view(spark, sf_dir, "actions").where("kind = 'dividend'").withColumn("amount", F.round("cash", 2))
    return records.retired(a, ["security_id", "ex_date"], F.col("source") == "legacy", ["amount"]).select("event_id")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN -1 ELSE u.s END AS link FROM part LEFT JOIN (SELECT l_partkey, min(l_suppkey) AS s FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) = 1) u ON l_partkey = p_partkey""")
def link_backfill(spark, sf_dir):
    """Links that are missing come from keys with one partner only; known ones stay."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 5 == 0, F.lit(-1).cast("long")).alias("known"))
    one = joins.unambiguous(table(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey")
    return p.join(one, p.p_partkey == one.l_partkey, "left").select("p_partkey", F.coalesce("known", "l_suppkey").alias("link"))


@query("""SELECT o_orderkey, t AS ticker, i AS place FROM orders, (SELECT unnest(['a', 'b', 'c']) AS t, unnest([0, 1, 2]) AS i) WHERE o_orderkey % 4 = 0 AND i <= o_orderkey % 3""")
def news_insights(spark, sf_dir):
    """Articles with a list of insights, one row for each ticker and its place."""
    o = table(spark, sf_dir, "orders").where("o_orderkey % 4 = 0").select("o_orderkey", F.slice(F.array(F.lit("a"), F.lit("b"), F.lit("c")), F.lit(1), (F.col("o_orderkey") % 3 + 1).cast("int")).alias("insights"))
    return o.select("o_orderkey", F.posexplode("insights").alias("place", "ticker"))


# Ledgers of trials

_TRIALS = "trials AS (SELECT o_orderkey AS id, o_orderpriority AS factor, (o_custkey % 4) * 5 + 1 AS horizon, o_totalprice - 100000 AS t, o_custkey % 7 AS params, o_orderdate AS created FROM orders)"


def _trials(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("factor"), (F.col("o_custkey") % 4 * 5 + 1).alias("horizon"), (F.col("o_totalprice") - 100000).alias("t"), (F.col("o_custkey") % 7).alias("params"), F.col("o_orderdate").alias("created"))


@query(f"WITH {_TRIALS} SELECT id FROM trials WHERE id % 3 = 0 UNION ALL SELECT id FROM trials WHERE id % 3 <> 0 AND id % 2 = 0")
def append_trials(spark, sf_dir):
    """Appending is idempotent: rows whose id the ledger has are left out."""
    t = _trials(spark, sf_dir)
    return records.new_rows(t.where("id % 3 = 0"), t.where("id % 2 = 0"), ["id"]).select("id")


@query(f"WITH {_TRIALS} SELECT id, factor, horizon, params FROM trials QUALIFY row_number() OVER (PARTITION BY factor, horizon, params ORDER BY created DESC, id DESC) = 1")
def latest_trials(spark, sf_dir):
    return records.best(_trials(spark, sf_dir), ["factor", "horizon", "params"], F.desc("created"), F.desc("id")).select("id", "factor", "horizon", "params")


@query(f"WITH {_TRIALS} SELECT factor, count(DISTINCT id) AS trials, count(DISTINCT params) AS params, strftime(max(created), '%Y-%m-%d') AS newest, max(abs(t)) AS most FROM trials GROUP BY 1")
def trial_overview(spark, sf_dir):
    return _trials(spark, sf_dir).groupBy("factor").agg(F.countDistinct("id").alias("trials"), F.countDistinct("params").alias("params"), day(F.max("created")).alias("newest"), F.max(F.abs("t")).alias("most"))


@query(f"WITH {_TRIALS} SELECT horizon, id, factor, t FROM trials QUALIFY row_number() OVER (PARTITION BY horizon ORDER BY abs(t) DESC, id) = 1")
def best_by_horizon(spark, sf_dir):
    return records.best(_trials(spark, sf_dir), ["horizon"], F.abs("t").desc(), F.col("id")).select("horizon", "id", "factor", "t")


@query(f"WITH {_TRIALS}, w AS (SELECT id, t, params::DOUBLE AS params, horizon::DOUBLE AS horizon FROM trials) SELECT id, metric, value FROM (UNPIVOT w ON t, params, horizon INTO NAME metric VALUE value)")
def trial_rows(spark, sf_dir):
    """Wide results as rows of metric and value."""
    t = _trials(spark, sf_dir).select("id", "t", F.col("params").cast("double").alias("params"), F.col("horizon").cast("double").alias("horizon"))
    return t.unpivot(["id"], ["t", "params", "horizon"], "metric", "value")


# Step functions, revisions


@query(f"""WITH {ctes('facts')}, l AS (SELECT security_id, filed, concept, max(value) AS v FROM facts WHERE concept IN ('assets', 'revenue') GROUP BY 1, 2, 3), w AS (SELECT security_id, filed, max(v) FILTER (WHERE concept = 'assets') AS assets, max(v) FILTER (WHERE concept = 'revenue') AS revenue FROM l GROUP BY 1, 2),
  f AS (SELECT security_id, filed, last_value(assets IGNORE NULLS) OVER o AS assets, last_value(revenue IGNORE NULLS) OVER o AS revenue FROM w WINDOW o AS (PARTITION BY security_id ORDER BY filed)), c AS (SELECT *, lag((assets, revenue)) OVER (PARTITION BY security_id ORDER BY filed) IS NOT DISTINCT FROM (assets, revenue) AS same FROM f) SELECT security_id, strftime(filed, '%Y-%m-%d') AS filed, assets, revenue FROM c WHERE NOT same""")
def step_functions(spark, sf_dir):
    f = view(spark, sf_dir, "facts").where("concept in ('assets', 'revenue')")
    s = records.steps(f, "security_id", "filed", "concept", "value", ["assets", "revenue"])
    return s.select("security_id", day("filed").alias("filed"), "assets", "revenue")


@query(f"""WITH {ctes('facts')} SELECT security_id, concept, strftime(period_end, '%Y-%m-%d') AS period_end, accession FROM facts QUALIFY row_number() OVER (PARTITION BY security_id, concept, period_end ORDER BY filed, accession) = 1""")
def earliest_disclosures(spark, sf_dir):
    f = records.best(view(spark, sf_dir, "facts"), ["security_id", "concept", "period_end"], F.col("filed"), F.col("accession"))
    return f.select("security_id", "concept", day("period_end").alias("period_end"), "accession")


@query(f"""WITH {ctes('shares', 'facts')}, v AS (SELECT security_id, min(visible) AS first FROM shares GROUP BY 1), x AS (SELECT f.security_id, f.filed AS visible, f.value * 1000 AS total, 'filing' AS source FROM facts f JOIN v USING (security_id) WHERE concept = 'assets' AND f.filed < v.first), a AS (SELECT security_id, visible, total_shares::DOUBLE AS total, 'vendor' AS source FROM shares UNION ALL SELECT * FROM x)
  SELECT security_id, source, count(*) AS n, round(sum(total) / 1000, 3) AS total FROM a GROUP BY 1, 2""")
def stitched_shares(spark, sf_dir):
    """The vendor's events, and filings from before its first one."""
    s = view(spark, sf_dir, "shares").select("security_id", "visible", F.col("total_shares").cast("double").alias("total"), F.lit("vendor").alias("source"))
    first = s.groupBy("security_id").agg(F.min("visible").alias("first"))
    x = view(spark, sf_dir, "facts").where("concept = 'assets'").join(first, "security_id").where("filed < first").select("security_id", F.col("filed").alias("visible"), (F.col("value") * 1000).alias("total"), F.lit("filing").alias("source"))
    return s.unionByName(x).groupBy("security_id", "source").agg(F.count("*").alias("n"), F.round(F.sum("total") / 1000, 3).alias("total"))


# Terminal events and event studies


@query(f"""WITH {ctes('securities', 'daily')}, l AS (SELECT security_id, delist_date FROM securities WHERE delist_date IS NOT NULL), b AS (SELECT l.security_id, l.delist_date, d.date, d.close FROM l ASOF LEFT JOIN (SELECT * FROM daily WHERE close > 0) d ON l.security_id = d.security_id AND l.delist_date + 5 >= d.date)
  SELECT security_id, CASE WHEN delist_date - date <= 5 THEN round(close, 6) END AS final_price, CASE WHEN date IS NULL THEN 'no history' WHEN delist_date - date <= 5 THEN 'covered' ELSE 'ends early' END AS bucket FROM b""")
def final_prices(spark, sf_dir):
    """The last positive close up to five days after a delisting, and why there is none."""
    s = view(spark, sf_dir, "securities").where("delist_date is not null").select("security_id", "delist_date", F.date_add("delist_date", 5).alias("until"))
    d = view(spark, sf_dir, "daily").where("close > 0").select("security_id", "date", "close")
    f = joins.as_of(s, d, "security_id", "until", "date", "close", ["close", "date"])
    near = F.datediff("delist_date", "asof_date") <= 5
    bucket = F.when(F.col("asof_date").isNull(), "no history").when(near, "covered").otherwise("ends early")
    return f.select("security_id", F.when(near, r6("asof_close")).alias("final_price"), bucket.alias("bucket"))


@query("""WITH e AS (SELECT o_custkey AS k, o_orderkey, o_orderdate, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE round(o_totalprice / 1000000, 6) END AS r, o_orderpriority AS reason FROM orders)
  SELECT k, coalesce(r, CASE reason WHEN '1-URGENT' THEN 0.0 WHEN '2-HIGH' THEN -1.0 END, -0.3) AS ret FROM e QUALIFY row_number() OVER (PARTITION BY k ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def delisting_returns(spark, sf_dir):
    """The newest event of each security: what was realised, else what its reason stands for, else one number for all."""
    o = table(spark, sf_dir, "orders").withColumn("r", F.when(F.col("o_orderkey") % 3 != 0, r6(F.col("o_totalprice") / 1000000)))
    e = records.best(o, ["o_custkey"], F.desc("o_orderdate"), F.desc("o_orderkey"))
    by_reason = F.when(F.col("o_orderpriority") == "1-URGENT", 0.0).when(F.col("o_orderpriority") == "2-HIGH", -1.0)
    return e.select(F.col("o_custkey").alias("k"), F.coalesce("r", by_reason, F.lit(-0.3)).alias("ret"))


_GAPS = f"""{GRID}, s AS (SELECT date, security_id, open / lag(close) OVER o - 1 AS gap, volume / CASE WHEN count(volume) OVER w >= 10 THEN avg(volume) OVER w END AS ratio, close / lag(close) OVER o - 1 AS ret, avg(close) OVER w AS m FROM grid WINDOW o AS (PARTITION BY security_id ORDER BY date), w AS (PARTITION BY security_id ORDER BY date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))"""


@query(f"WITH {_GAPS} SELECT strftime(date, '%Y-%m-%d') AS date, security_id, round(gap, 6) AS gap, round(least(ratio, 5), 6) AS ratio FROM s WHERE abs(gap) > 0.5 AND ratio > 1")
def event_signals(spark, sf_dir):
    """Gaps with unusual volume, against the rows before."""
    w = ordered().rowsBetween(-20, -1)
    g = grid(spark, sf_dir).select("date", "security_id", (F.col("open") / F.lag("close").over(ordered()) - 1).alias("gap"), (F.col("volume") / F.when(F.count("volume").over(w) >= 10, F.avg("volume").over(w))).alias("ratio"))
    return g.where((F.abs("gap") > 0.5) & (F.col("ratio") > 1)).select(day("date").alias("date"), "security_id", r6("gap").alias("gap"), r6(F.least("ratio", F.lit(5.0))).alias("ratio"))


@query(f"""WITH {GRID}, r AS (SELECT security_id, date, row_number() OVER (PARTITION BY security_id ORDER BY date) AS i, ret FROM prep), e AS (SELECT DISTINCT security_id, date, i FROM r WHERE i % 40 = 0),
  x AS (SELECT e.security_id, e.i, r.i - e.i AS k, ret FROM e JOIN r ON e.security_id = r.security_id AND r.i BETWEEN e.i - 3 AND e.i + 3), c AS (SELECT security_id, i FROM x GROUP BY 1, 2 HAVING count(ret) = 7) SELECT k, count(*) AS n, round(avg(ret), 6) AS mean FROM x JOIN c USING (security_id, i) GROUP BY 1""")
def event_paths(spark, sf_dir):
    """Mean returns by position around events, of those whose whole path is there."""
    r = factors.prepared(grid(spark, sf_dir)).select("security_id", "ret", F.row_number().over(ordered()).alias("i"), "date")
    path = F.array(*[F.lead("ret", k).over(ordered()) if k >= 0 else F.lag("ret", -k).over(ordered()) for k in range(-3, 4)])
    e = r.withColumn("path", path).where("i % 40 = 0").where(F.size(F.array_compact("path")) == 7)
    return e.select(F.posexplode("path").alias("p", "ret")).groupBy((F.col("p") - 3).cast("long").alias("k")).agg(F.count("*").alias("n"), r6(F.avg("ret")).alias("mean"))


@query(f"""WITH {_TEST}, n AS (SELECT date, (gross - 0.001 * turnover) / 100 AS r FROM daily), k AS (SELECT *, row_number() OVER (ORDER BY r) AS i, count(*) OVER () AS n FROM n)
  SELECT round(avg(r) / sqrt(avg(CASE WHEN r < 0 THEN r * r ELSE 0 END)) * sqrt(52), 4) AS sortino, round(avg(r) FILTER (WHERE i <= ceil(0.05 * n)), 6) AS worst, round(quantile_cont(r, 0.05), 6) AS q05 FROM k""")
def tail_metrics(spark, sf_dir):
    """Sortino, the mean of the worst twentieth, and its border; one row for each date meets in one task."""
    d = evaluate.backtest(_panel(spark, sf_dir), 5, 5, 0.001).select("date", (F.col("net") / 100).alias("r"))
    k = d.withColumn("i", F.row_number().over(Window.orderBy("r"))).withColumn("n", F.count("*").over(Window.partitionBy()))
    down = F.sqrt(F.avg(F.when(F.col("r") < 0, F.col("r") * F.col("r")).otherwise(0.0)))
    return k.agg(F.round(F.avg("r") / down * F.sqrt(F.lit(52.0)), 4).alias("sortino"), r6(F.avg(F.when(F.col("i") <= F.ceil(0.05 * F.col("n")), F.col("r")))).alias("worst"), r6(F.percentile("r", F.lit(0.05))).alias("q05"))


@query(f"""WITH {_TEST}, x AS (SELECT date, gross AS y, lag(gross) OVER (ORDER BY date) AS x FROM daily) SELECT count(*) AS n, round(regr_slope(y, x), 6) AS beta, round(avg(sign(x) * y - CASE WHEN x <> 0 THEN 0.0002 ELSE 0 END), 6) AS rule FROM x WHERE x IS NOT NULL""")
def sign_rule(spark, sf_dir):
    """The slope of a return on the one before, and what a rule that follows its sign earns after cost."""
    d = evaluate.backtest(_panel(spark, sf_dir), 5, 5, 0.0).select("date", F.col("gross").alias("y"), F.lag("gross").over(Window.orderBy("date")).alias("x")).where("x is not null")
    return d.agg(F.count("*").alias("n"), r6(F.regr_slope("y", "x")).alias("beta"), r6(F.avg(F.signum("x") * F.col("y") - F.when(F.col("x") != 0, 0.0002).otherwise(0.0))).alias("rule"))


@query(f"""WITH {ctes('daily')}, s AS (SELECT security_id, date, (high - low) / low AS x FROM daily), m AS (SELECT *, quantile_cont(x, 0.5) OVER w AS q, count(x) OVER w AS n FROM s WINDOW w AS (PARTITION BY security_id ORDER BY date ROWS 62 PRECEDING)) SELECT security_id, strftime(date, '%Y-%m-%d') AS date, round(CASE WHEN n >= 20 THEN q / 2 * 1.5 * 10000 ELSE 40 END, 4) AS bps FROM m""")
def measured_costs(spark, sf_dir):
    """Half the median spread of 63 days with a margin, in basis points; a fixed cost where there are too few."""
    w = Window.partitionBy("security_id").orderBy("date").rowsBetween(-62, 0)
    s = view(spark, sf_dir, "daily").select("security_id", "date", ((F.col("high") - F.col("low")) / F.col("low")).alias("x"))
    return s.select("security_id", day("date").alias("date"), F.round(F.when(F.count("x").over(w) >= 20, F.percentile("x", F.lit(0.5)).over(w) / 2 * 1.5 * 10000).otherwise(40.0), 4).alias("bps"))


@query(f"""WITH {GRID}, p AS (SELECT date, security_id, close, row_number() OVER (PARTITION BY date ORDER BY volume DESC, security_id) AS big FROM grid WHERE close IS NOT NULL), z AS (SELECT *, count(*) OVER (PARTITION BY date) AS n FROM p), v AS (SELECT date, security_id, (big - 1) * 3 // n AS size, close FROM z), r AS (SELECT *, row_number() OVER (PARTITION BY date, size ORDER BY close, security_id) AS k, count(*) OVER (PARTITION BY date, size) AS m FROM v)
  SELECT size::INT AS size, ((k - 1) * 2 // m)::INT AS half, count(*) AS n FROM r GROUP BY 1, 2""")
def size_neutral(spark, sf_dir):
    """Halves of price inside thirds of size, so each half has all sizes alike."""
    by = Window.partitionBy("date")
    p = grid(spark, sf_dir).where("close is not null").select("date", "security_id", "close", F.row_number().over(by.orderBy(F.desc("volume"), "security_id")).alias("big"), F.count("*").over(by).alias("n"))
    v = p.withColumn("size", F.floor((F.col("big") - 1) * 3 / F.col("n")).cast("int"))
    inside = Window.partitionBy("date", "size")
    half = F.floor((F.row_number().over(inside.orderBy("close", "security_id")) - 1) * 2 / F.count("*").over(inside)).cast("int")
    return v.withColumn("half", half).groupBy("size", "half").agg(F.count("*").alias("n"))
