"""Queries on plans of updates, reconciliation, lineage, and reports of portfolios."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import cross_section as xs
from tidemark.operators import events as ev
from tidemark.operators import identity as idn
from tidemark.operators import joins, records
from tidemark.operators.windows import lagged, ordered
from tidemark.plans import evaluate, factors
from tidemark.queries import _PANEL, _TEST, GRID, _avg_rank_sql, _panel, grid, r6
from tidemark.registry import query
from tidemark.sources.market import ctes, view
from tidemark.sources.views import table


def day(x):
    return F.date_format(x, "yyyy-MM-dd")


# Plans of updates


@query(f"""WITH {ctes('securities', 'daily')}, w AS (SELECT s.*, m FROM securities s LEFT JOIN (SELECT security_id, max(date) AS m FROM daily GROUP BY 1) USING (security_id)), p AS (SELECT security_id, greatest(coalesce(m + 1, DATE '1995-01-01'), list_date) AS a, CASE WHEN NOT is_active AND delist_date IS NOT NULL THEN delist_date ELSE DATE '2002-06-30' END AS b FROM w)
  SELECT security_id, strftime(a, '%Y-%m-%d') AS first, strftime(b, '%Y-%m-%d') AS until, a > b AS current FROM p""")
def update_plan(spark, sf_dir):
    """The days to fetch for each security: after its watermark and listing, up to its delisting if it is inactive."""
    m = view(spark, sf_dir, "daily").groupBy("security_id").agg(F.max("date").alias("m"))
    s = view(spark, sf_dir, "securities").join(m, "security_id", "left")
    a = F.greatest(F.coalesce(F.date_add("m", 1), F.lit("1995-01-01").cast("date")), "list_date")
    b = F.when(~F.col("is_active") & F.col("delist_date").isNotNull(), F.col("delist_date")).otherwise(F.lit("2002-06-30").cast("date"))
    return s.select("security_id", day(a).alias("first"), day(b).alias("until"), (a > b).alias("current"))


@query(f"""WITH {ctes('securities', 'actions')} SELECT event_id FROM actions JOIN securities USING (security_id) WHERE ex_date >= list_date AND (is_active OR delist_date IS NULL OR ex_date <= delist_date)""")
def tenure_clamp(spark, sf_dir):
    """Actions from a listing on; those after a delisting go for inactive names only."""
    s = view(spark, sf_dir, "securities").select("security_id", "list_date", "delist_date", "is_active")
    return view(spark, sf_dir, "actions").join(s, "security_id").where("ex_date >= list_date and (is_active or delist_date is null or ex_date <= delist_date)").select("event_id")


@query("""WITH l AS (SELECT o_orderkey AS accession, o_custkey % 30 AS cik FROM orders WHERE o_orderkey % 2 = 0), t AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_linenumber > 3) SELECT accession, cik FROM l WHERE NOT EXISTS (SELECT 1 FROM t WHERE l_orderkey = accession)""")
def pending_filings(spark, sf_dir):
    """Filings of an index that nothing has been loaded for."""
    loaded = table(spark, sf_dir, "lineitem").where("l_linenumber > 3").select(F.col("l_orderkey").alias("accession"))
    return table(spark, sf_dir, "orders").where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("accession"), (F.col("o_custkey") % 30).alias("cik")).join(loaded, "accession", "left_anti")


@query("""SELECT DISTINCT o_custkey % 30 AS cik FROM orders WHERE o_orderdate >= TIMESTAMP '2001-06-01' AND o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def recent_filers(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_orderdate >= timestamp_ntz'2001-06-01'").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return o.select((F.col("o_custkey") % 30).alias("cik")).distinct()


@query(f"""WITH {ctes('securities')}, k AS (SELECT security_id, lpad(cik::VARCHAR, 10, '0') AS cik FROM securities), f AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN (o_custkey % 30)::VARCHAR ELSE lpad((o_custkey % 30)::VARCHAR, 10, '0') END AS raw FROM orders), one AS (SELECT ltrim(cik, '0') AS c, min(security_id) AS s FROM k GROUP BY 1 HAVING count(*) = 1)
  SELECT o_orderkey, coalesce(s, -1) AS security_id FROM f LEFT JOIN one ON ltrim(raw, '0') = c""")
def issuer_resolution(spark, sf_dir):
    """Numbers with and without leading zeros are one; only one security may have it, else a fallback."""
    key = lambda c: F.ltrim(c, F.lit("0"))
    k = joins.unambiguous(view(spark, sf_dir, "securities").select(key(F.col("cik").cast("string")).alias("c"), "security_id"), "c", "security_id")
    raw = (F.col("o_custkey") % 30).cast("string")
    f = table(spark, sf_dir, "orders").select("o_orderkey", key(F.when(F.col("o_orderkey") % 2 == 0, raw).otherwise(F.lpad(raw, 10, "0"))).alias("c"))
    return f.join(k, "c", "left").select("o_orderkey", F.coalesce("security_id", F.lit(-1)).alias("security_id"))


@query("""WITH s AS (SELECT s_suppkey AS id, 'BRK' || CASE WHEN s_suppkey % 3 = 0 THEN '.' ELSE '' END || (s_suppkey % 6) AS symbol FROM supplier), e AS (SELECT symbol, min(id) AS id FROM s GROUP BY 1 HAVING count(*) = 1), d AS (SELECT replace(symbol, '.', '') AS symbol, min(id) AS id FROM s GROUP BY 1 HAVING count(*) = 1), q AS (SELECT c_custkey, 'BRK' || CASE WHEN c_custkey % 2 = 0 THEN '.' ELSE '' END || (c_custkey % 6) AS symbol FROM customer)
  SELECT c_custkey, coalesce(e.id, d.id) AS id, CASE WHEN e.id IS NOT NULL THEN 'exact' WHEN d.id IS NOT NULL THEN 'dotless' END AS how FROM q LEFT JOIN e USING (symbol) LEFT JOIN d ON d.symbol = replace(q.symbol, '.', '')""")
def symbol_maps(spark, sf_dir):
    """An exact symbol, else the one without dots; ambiguous ones are in neither map."""
    symbol = lambda k, n: F.concat(F.lit("BRK"), F.when(F.col(k) % n == 0, ".").otherwise(""), (F.col(k) % 6).cast("string"))
    bare = lambda c: F.replace(c, F.lit("."), F.lit(""))

    def only(c, name):
        s = table(spark, sf_dir, "supplier").select(c.alias(name), "s_suppkey")
        return s.groupBy(name).agg(F.min("s_suppkey").alias(f"{name}_id"), F.count("*").alias("n")).where("n = 1").drop("n")

    q = table(spark, sf_dir, "customer").select("c_custkey", symbol("c_custkey", 2).alias("exact"), bare(symbol("c_custkey", 2)).alias("dotless"))
    found = q.join(only(symbol("s_suppkey", 3), "exact"), "exact", "left").join(only(bare(symbol("s_suppkey", 3)), "dotless"), "dotless", "left")
    return found.select("c_custkey", F.coalesce("exact_id", "dotless_id").alias("id"), F.when(F.col("exact_id").isNotNull(), "exact").when(F.col("dotless_id").isNotNull(), "dotless").alias("how"))


@query(f"WITH {ctes('actions')} SELECT event_id, CASE WHEN event_id % 3 = 0 THEN kind || ':' || event_id ELSE concat_ws(':', kind, strftime(ex_date, '%Y-%m-%d'), split_from::INT, split_to::INT) END AS key FROM actions")
def factor_keys(spark, sf_dir):
    """A surrogate where the vendor has no id."""
    given = F.when(F.col("event_id") % 3 == 0, F.concat_ws(":", "kind", F.col("event_id").cast("string")))
    made = F.concat_ws(":", "kind", day("ex_date"), F.col("split_from").cast("int").cast("string"), F.col("split_to").cast("int").cast("string"))
    return view(spark, sf_dir, "actions").select("event_id", F.coalesce(given, made).alias("key"))


@query(f"""WITH {ctes('spans')}, q AS (SELECT o_orderkey, concat('S', ((o_custkey - o_custkey % 3) // 3)::VARCHAR) AS symbol, o_orderdate::DATE AS d FROM orders), h AS (SELECT o_orderkey, count(tenure_id) AS n, min(security_id) AS s FROM q LEFT JOIN spans t ON q.symbol = t.symbol AND d >= start_date AND (end_date IS NULL OR d < end_date) GROUP BY 1)
  SELECT CASE WHEN n = 0 THEN 'out of tenure' WHEN n = 1 THEN 'mapped' ELSE 'ambiguous' END AS bucket, count(*) AS n FROM h GROUP BY 1""")
def tenure_buckets(spark, sf_dir):
    """Days by the tenures of their symbol that they fall in; a running count of open spans answers without pairs."""
    t = view(spark, sf_dir, "spans").where("end_date is null or end_date > start_date")
    edges = t.select("symbol", F.col("start_date").alias("d"), F.lit(1).alias("n")).unionByName(t.where("end_date is not null").select("symbol", F.col("end_date").alias("d"), F.lit(-1).alias("n")))
    q = table(spark, sf_dir, "orders").select(F.concat(F.lit("S"), F.floor(F.col("o_custkey") / 3).cast("string")).alias("symbol"), F.col("o_orderdate").cast("date").alias("d"), F.lit(0).alias("n"), F.lit(True).alias("asked"))
    both = edges.withColumn("asked", F.lit(False)).unionByName(q)
    w = Window.partitionBy("symbol").orderBy("d").rangeBetween(Window.unboundedPreceding, 0)
    hits = both.withColumn("open", F.sum("n").over(w)).where("asked")
    return hits.groupBy(F.when(F.col("open") == 0, "out of tenure").when(F.col("open") == 1, "mapped").otherwise("ambiguous").alias("bucket")).agg(F.count("*").alias("n"))


# Reconciliation


@query(f"""WITH {ctes('actions')}, v AS (SELECT event_id, security_id, ex_date, split_from / split_to AS ours, round(split_from / split_to * CASE WHEN event_id % 7 = 0 THEN 1.001 ELSE 1 END, 8) AS theirs FROM actions WHERE kind = 'split' AND ex_date <= DATE '2001-01-01') SELECT CASE WHEN abs(theirs / ours - 1) <= 1e-6 THEN 'agrees' ELSE 'differs' END AS verdict, count(*) AS n FROM v GROUP BY 1""")
def vendor_factors(spark, sf_dir):
    """Factors against another's within a relative tolerance; later events than the vendor's date don't count."""
    a = view(spark, sf_dir, "actions").where("kind = 'split' and ex_date <= date'2001-01-01'").withColumn("ours", F.col("split_from") / F.col("split_to"))
    theirs = F.round(F.col("ours") * F.when(F.col("event_id") % 7 == 0, 1.001).otherwise(1.0), 8)
    return a.groupBy(F.when(F.abs(theirs / F.col("ours") - 1) <= 1e-6, "agrees").otherwise("differs").alias("verdict")).agg(F.count("*").alias("n"))


@query("""WITH a AS (SELECT o_custkey % 20 AS k, o_orderdate::DATE AS d, max(o_totalprice) AS v FROM orders WHERE o_orderkey % 5 <> 0 GROUP BY 1, 2), b AS (SELECT o_custkey % 20 AS k, o_orderdate::DATE AS d, max(o_totalprice) AS v FROM orders WHERE o_orderkey % 7 <> 0 GROUP BY 1, 2)
  SELECT k, count(*) FILTER (WHERE b.v IS NULL) AS only_ours, count(*) FILTER (WHERE a.v IS NULL) AS only_theirs, count(*) FILTER (WHERE abs(a.v / b.v - 1) > 1e-6) AS differ FROM a FULL JOIN b USING (k, d) GROUP BY 1""")
def vendor_audit(spark, sf_dir):
    """Days of either side that the other lacks, and closes that differ."""
    o = table(spark, sf_dir, "orders")
    side = lambda n, c: o.where(f"o_orderkey % {n} <> 0").groupBy((F.col("o_custkey") % 20).alias("k"), F.col("o_orderdate").cast("date").alias("d")).agg(F.max("o_totalprice").alias(c))
    both = side(5, "a").join(side(7, "b"), ["k", "d"], "full")
    return both.groupBy("k").agg(F.count_if(F.col("b").isNull()).alias("only_ours"), F.count_if(F.col("a").isNull()).alias("only_theirs"), F.count_if(F.abs(F.col("a") / F.col("b") - 1) > 1e-6).alias("differ"))


@query(f"""WITH {ctes('actions', 'daily')}, p AS (SELECT a.event_id, a.security_id, a.ex_date, a.cash, d.close AS prev FROM (SELECT * FROM actions WHERE kind = 'dividend') a ASOF LEFT JOIN daily d ON a.security_id = d.security_id AND a.ex_date > d.date), n AS (SELECT p.*, d.close AS next FROM p ASOF LEFT JOIN daily d ON p.security_id = d.security_id AND p.ex_date <= d.date)
  SELECT event_id, CASE WHEN prev IS NULL OR next IS NULL OR cash / prev < 0.001 THEN 'inconclusive' WHEN 1 - next / prev < 0.25 * cash / prev THEN 'refuted' ELSE 'plausible' END AS verdict FROM n""")
def dividend_drops(spark, sf_dir):
    """Whether a price fell by about its dividend; too small a yield says nothing."""
    a = ev.around(view(spark, sf_dir, "actions").where("kind = 'dividend'"), view(spark, sf_dir, "daily"), "security_id", "ex_date", "date", "close")
    rate = F.col("cash") / F.col("prev_close")
    unknown = F.col("prev_close").isNull() | F.col("next_close").isNull() | (rate < 0.001)
    return a.select("event_id", F.when(unknown, "inconclusive").when(1 - F.col("next_close") / F.col("prev_close") < 0.25 * rate, "refuted").otherwise("plausible").alias("verdict"))


@query(f"""WITH {ctes('actions')}, v AS (SELECT event_id // 3 AS archive, security_id, event_id FROM actions), n AS (SELECT *, count(DISTINCT security_id) OVER (PARTITION BY archive) AS n FROM (SELECT * FROM v)) SELECT event_id, CASE WHEN n > 1 THEN 'manual' ELSE 'promote' END AS verdict FROM n""")
def promotion_collisions(spark, sf_dir):
    """One archive event promoted for several securities leaves all of them to a person."""
    a = view(spark, sf_dir, "actions").select("event_id", "security_id", F.floor(F.col("event_id") / 3).alias("archive"))
    several = a.groupBy("archive").agg((F.min("security_id") < F.max("security_id")).alias("several"))
    return a.join(several, "archive").select("event_id", F.when(F.col("several"), "manual").otherwise("promote").alias("verdict"))


@query(f"""WITH {ctes('securities')}, n AS (SELECT security_id, cik AS company_id, CASE WHEN security_id % 3 = 0 THEN NULL WHEN security_id % 3 = 1 THEN cik ELSE cik + 1 END AS was FROM securities) SELECT security_id, company_id, was IS DISTINCT FROM company_id AS changes, was IS NOT NULL AND was <> company_id AS conflict FROM n""")
def company_changes(spark, sf_dir):
    """What a new grouping changes, and where it contradicts an old one; nulls are compared as values."""
    k = F.col("security_id") % 3
    was = F.when(k == 1, F.col("cik")).when(k == 2, F.col("cik") + 1)
    n = view(spark, sf_dir, "securities").select("security_id", F.col("cik").alias("company_id"), was.alias("was"))
    return n.select("security_id", "company_id", (~F.col("was").eqNullSafe(F.col("company_id"))).alias("changes"), F.coalesce(F.col("was") != F.col("company_id"), F.lit(False)).alias("conflict"))


# Lineage and reports


@query(f"""WITH {ctes('securities')}, e AS (SELECT o_custkey % 10 + 1 AS pred, o_orderkey % 10 + 1 AS succ, o_orderdate::DATE AS d, o_orderkey FROM orders WHERE o_orderkey % 9 = 0), c AS (SELECT p.cik AS a, s.cik AS b, d, min(o_orderkey) AS evidence FROM e JOIN securities p ON p.security_id = pred JOIN securities s ON s.security_id = succ WHERE p.cik <> s.cik GROUP BY 1, 2, 3) SELECT a, b, strftime(d, '%Y-%m-%d') AS date, evidence FROM c""")
def lineage_edges(spark, sf_dir):
    """Mergers as edges between companies: none to itself or nowhere, one for each pair and date."""
    s = view(spark, sf_dir, "securities").select("security_id", "cik")
    e = table(spark, sf_dir, "orders").where("o_orderkey % 9 = 0").select((F.col("o_custkey") % 10 + 1).alias("pred"), (F.col("o_orderkey") % 10 + 1).alias("succ"), F.col("o_orderdate").cast("date").alias("d"), "o_orderkey")
    named = e.join(s.toDF("pred", "a"), "pred").join(s.toDF("succ", "b"), "succ").where("a <> b")
    return named.groupBy("a", "b", "d").agg(F.min("o_orderkey").alias("evidence")).select("a", "b", day("d").alias("date"), "evidence")


@query("""SELECT o_orderpriority AS task, count(*) AS runs, count(*) FILTER (WHERE o_orderstatus = 'F') AS failed, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS last_status, strftime(max(o_orderdate), '%Y-%m-%d') AS last_run FROM orders GROUP BY 1""")
def task_report(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("task")).agg(F.count("*").alias("runs"), F.count_if(F.col("o_orderstatus") == "F").alias("failed"), F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("last_status"), day(F.max("o_orderdate")).alias("last_run"))


@query(f"""WITH {ctes('holdings')} SELECT strftime(period, '%Y-%m-%d') AS period, count(DISTINCT accession) AS filings, count(DISTINCT filer) AS filers, round(100.0 * count(*) FILTER (WHERE security_id % 4 <> 0) / count(*), 2) AS mapped FROM holdings GROUP BY period ORDER BY period DESC LIMIT 4""")
def quarter_coverage(spark, sf_dir):
    """The four newest quarters: exact counts of filings, and the share that has a security."""
    h = view(spark, sf_dir, "holdings").groupBy("period").agg(F.countDistinct("accession").alias("filings"), F.countDistinct("filer").alias("filers"), F.round(100.0 * F.count_if(F.col("security_id") % 4 != 0) / F.count("*"), 2).alias("mapped"))
    return h.orderBy(F.desc("period")).limit(4).withColumn("period", day("period"))


@query(f"""WITH {_TEST}, e AS (SELECT date, product(1 + gross / 100) OVER (ORDER BY date) AS e FROM daily), d AS (SELECT *, e / greatest(max(e) OVER (ORDER BY date), 1) - 1 AS dd FROM e) SELECT strftime(date, '%Y-%m') AS month, round(arg_max(e, date), 6) AS equity, round(arg_max(dd, date), 6) AS drawdown FROM d GROUP BY 1""")
def monthly_equity(spark, sf_dir):
    """The last equity and drawdown of each month; one row for each date meets in one task."""
    w = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    e = evaluate.backtest(_panel(spark, sf_dir), 5, 5, 0.0).withColumn("e", F.product(1 + F.col("gross") / 100).over(w))
    dd = e.withColumn("dd", F.col("e") / F.greatest(F.max("e").over(w), F.lit(1.0)) - 1)
    return dd.groupBy(F.date_format("date", "yyyy-MM").alias("month")).agg(r6(F.max_by("e", "date")).alias("equity"), r6(F.max_by("dd", "date")).alias("drawdown"))


@query(f"""WITH {_TEST}, y AS (SELECT year(date) AS year, product(1 + gross / 100) - 1 AS ret, sum(turnover) AS turnover, count(*) AS n FROM daily GROUP BY 1) SELECT year, round(ret, 6) AS ret, round(turnover, 6) AS turnover, n FROM y WHERE year IN (1998, 2000)""")
def crisis_years(spark, sf_dir):
    d = evaluate.backtest(_panel(spark, sf_dir), 5, 5, 0.0).where(F.year("date").isin(1998, 2000))
    return d.groupBy(F.year("date").cast("long").alias("year")).agg(r6(F.product(1 + F.col("gross") / 100) - 1).alias("ret"), r6(F.sum("turnover")).alias("turnover"), F.count("*").alias("n"))


@query(f"""WITH {GRID}, m AS (SELECT security_id, date_trunc('month', date)::DATE AS m, arg_max(close, date) FILTER (WHERE close IS NOT NULL) AS c FROM grid GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY m ORDER BY c DESC, security_id) AS k FROM m WHERE c IS NOT NULL), p AS (SELECT *, lag(k) OVER (PARTITION BY security_id ORDER BY m) AS pk, lag(m) OVER (PARTITION BY security_id ORDER BY m) AS pm FROM r)
  SELECT strftime(m, '%Y-%m') AS month, count(*) FILTER (WHERE k <= 4) AS held, count(*) FILTER (WHERE k <= 4 AND NOT coalesce(pk <= 4 AND pm = m - INTERVAL 1 MONTH, false)) AS joined FROM p GROUP BY 1""")
def holdings_turnover(spark, sf_dir):
    """Names held each month, and those that were not held in the month before."""
    g = grid(spark, sf_dir)
    m = g.groupBy("security_id", F.trunc("date", "month").alias("m")).agg(F.max_by("close", F.when(F.col("close").isNotNull(), F.col("date"))).alias("c")).where("c is not null")
    r = m.withColumn("k", F.row_number().over(Window.partitionBy("m").orderBy(F.desc("c"), "security_id")))
    own = Window.partitionBy("security_id").orderBy("m")
    before = F.coalesce((F.lag("k").over(own) <= 4) & (F.lag("m").over(own) == F.add_months("m", -1)), F.lit(False))
    p = r.withColumn("before", before)
    return p.groupBy(F.date_format("m", "yyyy-MM").alias("month")).agg(F.count_if(F.col("k") <= 4).alias("held"), F.count_if((F.col("k") <= 4) & ~F.col("before")).alias("joined"))


@query(f"""WITH {_PANEL}, r AS (SELECT date, security_id, {_avg_rank_sql('value')} AS a, {_avg_rank_sql('forward')} AS b FROM panel WHERE value IS NOT NULL AND forward IS NOT NULL) SELECT count(*) AS dates, round(avg(c), 6) AS spearman FROM (SELECT date, corr(a, b) AS c FROM r GROUP BY 1 HAVING count(*) >= 5 AND var_pop(a) > 0 AND var_pop(b) > 0)""")
def spearman(spark, sf_dir):
    """Ranks made on the rows that have both, unlike the rank IC's."""
    p = _panel(spark, sf_dir).where("value is not null and forward is not null")
    return xs.rank_ic(p, "value", "forward", 5).agg(F.count("*").alias("dates"), r6(F.avg("ic")).alias("spearman"))


@query(f"""WITH {_PANEL}, z AS (SELECT date, security_id, {_avg_rank_sql('value')} AS y, {_avg_rank_sql('close')} AS x FROM panel WHERE value IS NOT NULL AND close IS NOT NULL), s AS (SELECT date, regr_slope(y, x) AS b, avg(y) AS my, avg(x) AS mx, var_pop(x) AS v FROM z GROUP BY 1)
  SELECT strftime(date, '%Y-%m-%d') AS date, security_id, round(y - my - CASE WHEN v > 1e-18 THEN b ELSE 0 END * (x - mx), 5) AS residual FROM z JOIN s USING (date)""")
def residual_ranks(spark, sf_dir):
    """The rank of a factor without its linear part in the rank of another."""
    p = _panel(spark, sf_dir).where("value is not null and close is not null").repartition("date")
    z = p.select("date", "security_id", xs.average_rank("value").alias("y"), xs.average_rank("close").alias("x"))
    return z.select(day("date").alias("date"), "security_id", F.round(xs.residual("y", "x"), 5).alias("residual"))


@query(f"""WITH {GRID}, w AS (SELECT date, security_id, ret, lag(close) OVER (PARTITION BY security_id ORDER BY date) * 1000 AS cap FROM prep) SELECT strftime(date, '%Y-%m-%d') AS date, round(sum(cap * ret) / sum(CASE WHEN ret IS NOT NULL THEN cap END), 6) AS market, round(1.0 * count(ret) / count(*), 6) AS coverage FROM w GROUP BY date HAVING sum(CASE WHEN ret IS NOT NULL THEN cap END) > 0""")
def weighted_market(spark, sf_dir):
    """The mean return weighted by the capital before, of the names that have both, and how many those are."""
    w = factors.prepared(grid(spark, sf_dir)).select("date", "ret", (F.col("close_1") * 1000).alias("cap"))
    base = F.sum(F.when(F.col("ret").isNotNull(), F.col("cap")))
    return w.groupBy("date").agg(r6(F.sum(F.col("cap") * F.col("ret")) / F.when(base > 0, base)).alias("market"), r6(F.count("ret") / F.count("*")).alias("coverage"), base.alias("b")).where("b > 0").select(day("date").alias("date"), "market", "coverage")


@query("""WITH s AS (SELECT d, row_number() OVER (ORDER BY d) AS n FROM (SELECT DISTINCT o_orderdate::DATE AS d FROM orders)) SELECT strftime(s.d, '%Y-%m-%d') AS date, strftime(a.d, '%Y-%m-%d') AS after_three, strftime(b.d, '%Y-%m-%d') AS before_two FROM s LEFT JOIN s a ON a.n = s.n + 3 LEFT JOIN s b ON b.n = s.n - 2""")
def session_shift(spark, sf_dir):
    """Sessions so many places on; a row for each session meets in one task."""
    w = Window.orderBy("d")
    s = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    return s.select(day("d").alias("date"), day(F.lead("d", 3).over(w)).alias("after_three"), day(F.lag("d", 2).over(w)).alias("before_two"))


@query(f"""WITH {ctes('daily')}, b AS (SELECT security_id, date, close, row_number() OVER (PARTITION BY security_id ORDER BY date DESC) AS k, volume FROM daily) SELECT security_id, round(quantile_cont(close, 0.5) FILTER (WHERE k <= 20), 6) AS recent, round(quantile_cont(close, 0.5) FILTER (WHERE k BETWEEN 21 AND 60), 6) AS earlier, coalesce(quantile_cont(close, 0.5) FILTER (WHERE k <= 20) < quantile_cont(close, 0.5) FILTER (WHERE k BETWEEN 21 AND 60) AND avg(volume) FILTER (WHERE k <= 20) < avg(volume) FILTER (WHERE k BETWEEN 21 AND 60), false) AS fading FROM b GROUP BY 1""")
def price_patterns(spark, sf_dir):
    """Median prices of a security's last bars and of those before, and whether price and volume both shrank."""
    b = view(spark, sf_dir, "daily").withColumn("k", F.row_number().over(Window.partitionBy("security_id").orderBy(F.desc("date")))).where("k <= 60")
    late = F.col("k") <= 20
    med = lambda c: F.percentile(F.when(c, F.col("close")), F.lit(0.5))
    vol = lambda c: F.avg(F.when(c, F.col("volume")))
    fading = (med(late) < med(~late)) & (vol(late) < vol(~late))
    return b.groupBy("security_id").agg(r6(med(late)).alias("recent"), r6(med(~late)).alias("earlier"), F.coalesce(fading, F.lit(False)).alias("fading"))
