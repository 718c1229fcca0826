"""Queries on ticks, calendars, rates and the texts of feeds."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import joins, windows
from tidemark.plans import intraday
from tidemark.queries import r6
from tidemark.registry import query
from tidemark.sources import feeds
from tidemark.sources.market import ctes, view
from tidemark.sources.views import events, table


def day(x):
    return F.date_format(x, "yyyy-MM-dd")


# Each user's events of a day are a security's ticks; thresholds are small, as there are few of them.
_OPEN, _CLOSE, _FIRST, _LAST, _BARS, _RETURNS, _PAIRS = 60, 1380, 480, 960, 4, 4, 1

_TICKS = f"""t AS (SELECT user_id % 5 AS security_id, ts, event_id, value + 1 AS price, 1 + event_id % 9 AS size, hour(ts) * 60 + minute(ts) AS md, ts::DATE AS date, hour(ts) * 60 + minute(ts) BETWEEN {_OPEN} AND {_CLOSE} AS rth FROM events),
  bk AS (SELECT security_id, date, md // 30 AS i, max(price) AS high, min(price) AS low, arg_max(price, (ts, event_id)) AS close FROM t WHERE rth GROUP BY 1, 2, 3),
  bl AS (SELECT *, ln(close) - lag(ln(close)) OVER o AS r, lag(i) OVER o AS pi, lag(high) OVER o AS ph, lag(low) OVER o AS pl FROM bk WINDOW o AS (PARTITION BY security_id, date ORDER BY i)),
  s AS (SELECT security_id, date, count(*) FILTER (WHERE rth) AS n_bars, coalesce(sum(size) FILTER (WHERE rth), 0) AS rth_volume, sum(size) AS total_volume, coalesce(sum(size) FILTER (WHERE rth AND md >= {_LAST}), 0) AS vol_last,
    arg_min(price, (ts, event_id)) FILTER (WHERE rth) AS open, arg_max(price, (ts, event_id)) FILTER (WHERE rth AND md < {_FIRST}) AS first, arg_max(price, (ts, event_id)) FILTER (WHERE rth AND md < {_LAST}) AS before, arg_max(price, (ts, event_id)) FILTER (WHERE rth) AS close FROM t GROUP BY 1, 2),
  ok AS (SELECT s.security_id, s.date FROM s JOIN (SELECT security_id, date, count(*) AS n FROM bk GROUP BY 1, 2) USING (security_id, date) WHERE n_bars >= {_BARS} AND n >= {_RETURNS}),
  rr AS (SELECT bl.*, lag(r) OVER (PARTITION BY security_id, date ORDER BY i) AS pr, avg(r) OVER (PARTITION BY security_id, date) AS rm FROM bl JOIN ok USING (security_id, date)),
  g AS (SELECT security_id, date, count(r) AS n, sum(r * r) AS rv, coalesce(sum(r * r) FILTER (WHERE r > 0), 0) AS up, coalesce(sum(r * r) FILTER (WHERE r < 0), 0) AS down, sum(r * r * r) AS r3, coalesce(sum(abs(r) * abs(pr)), 0) AS bip, sum((r - rm) * (pr - rm)) / (count(r) - 1) AS cov FROM rr GROUP BY 1, 2),
  cs0 AS (SELECT security_id, date, pow(ln(ph / pl), 2) + pow(ln(high / low), 2) AS beta, pow(ln(greatest(high, ph) / least(low, pl)), 2) AS gamma FROM bl WHERE i - pi = 1 AND least(low, pl) > 0),
  cs1 AS (SELECT security_id, date, 2 * ((exp(a) - 1) / (exp(a) + 1)) AS x FROM (SELECT *, (sqrt(2 * beta) - sqrt(beta)) / (3 - 2 * sqrt(2)) - sqrt(gamma / (3 - 2 * sqrt(2))) AS a FROM cs0)), cs AS (SELECT security_id, date, avg(x) AS cs FROM cs1 WHERE x >= 0 GROUP BY 1, 2 HAVING count(*) >= {_PAIRS}),
  f AS (SELECT s.security_id, s.date, n_bars, coalesce(first / open - 1, 0) AS ret_first, coalesce(close / before - 1, 0) AS ret_last, coalesce(rv, 0) AS rv, coalesce(up, 0) AS rv_up, coalesce(down, 0) AS rv_down, CASE WHEN rv > 0 AND n >= {_RETURNS - 1} THEN sqrt(n) * r3 / pow(rv, 1.5) ELSE 0 END AS rskew,
    CASE WHEN n >= {_RETURNS - 1} THEN bip ELSE 0 END AS bipower, 1 - CASE WHEN total_volume > 0 THEN rth_volume / total_volume ELSE 0 END AS ext_share, CASE WHEN rth_volume > 0 THEN vol_last / rth_volume ELSE 0 END AS last_share, CASE WHEN n_bars >= {_BARS} THEN cs END AS cs_spread, CASE WHEN n >= {_RETURNS - 1} AND cov < 0 THEN 2 * sqrt(-cov) END AS roll_spread
    FROM s LEFT JOIN g USING (security_id, date) LEFT JOIN cs USING (security_id, date))"""


def _features(spark, sf_dir):
    t = events(spark, sf_dir).select((F.col("user_id") % 5).alias("security_id"), F.col("ts").alias("at"), F.col("event_id").alias("id"), (F.col("value") + 1).alias("price"), (1 + F.col("event_id") % 9).alias("size"))
    return intraday.daily_features(t, _OPEN, _CLOSE, _FIRST, _LAST, 30, _BARS, _RETURNS, _PAIRS)


_SHOWN = ("ret_first", "ret_last", "rv", "rv_up", "rv_down", "bipower", "ext_share", "last_share", "cs_spread", "roll_spread")


@query(f"WITH {_TICKS} SELECT security_id, strftime(date, '%Y-%m-%d') AS date, n_bars, round(rskew, 5) AS rskew, {', '.join(f'round({c}, 6) AS {c}' for c in _SHOWN)} FROM f")
def minute_features(spark, sf_dir):
    return _features(spark, sf_dir).select("security_id", day("date").alias("date"), "n_bars", F.round("rskew", 5).alias("rskew"), *[r6(c).alias(c) for c in _SHOWN])


_FACTOR_SQL = {
    "realized_skew": "CASE WHEN count(CASE WHEN rskew <> 0 THEN rskew END) OVER w >= 3 THEN -avg(CASE WHEN rskew <> 0 THEN rskew END) OVER w END",
    "signed_jump": "CASE WHEN count(CASE WHEN rv > 0 THEN rv END) OVER w >= 3 THEN -avg((rv_up - rv_down) / CASE WHEN rv > 0 THEN rv END) OVER w END",
    "last_persistence": "CASE WHEN count(ret_last) OVER w >= 3 THEN avg(ret_last) OVER w END",
    "smart_money_gap": "CASE WHEN count(ret_last) OVER w >= 3 THEN avg(ret_last - ret_first) OVER w END",
    "end_reversal": "-ret_last",
    "end_reversal_flow": "CASE WHEN count(last_share) OVER w >= 3 AND avg(last_share) OVER w > 0 THEN -ret_last * least(last_share / avg(last_share) OVER w, 3) END",
}


def _register(name: str) -> None:
    names = ", ".join(c for c in ("rskew", "rv", "rv_up", "rv_down", "ret_first", "ret_last", "last_share"))
    known = f"known AS (SELECT security_id, date, {', '.join(f'CASE WHEN n_bars >= {_BARS} THEN {c} END AS {c}' for c in names.split(', '))} FROM f)"

    def run(spark, sf_dir):
        k = intraday.known(_features(spark, sf_dir), _BARS)
        return k.select("security_id", day("date").alias("date"), F.round(intraday.FACTORS[name](5, 3), 5).alias("value")).where("value is not null")

    query(f"WITH {_TICKS}, {known}, v AS (SELECT security_id, date, {_FACTOR_SQL[name]} AS value FROM known WINDOW w AS (PARTITION BY security_id ORDER BY date ROWS 4 PRECEDING)) SELECT security_id, strftime(date, '%Y-%m-%d') AS date, round(value, 5) AS value FROM v WHERE value IS NOT NULL", f"factor_{name}")(run)


for _name in _FACTOR_SQL:
    _register(_name)


# Calendars: every weekday, sessions but for the first of a month


@query("""WITH d AS (SELECT unnest(generate_series(DATE '1997-01-01', DATE '1998-12-31', INTERVAL 1 DAY))::DATE AS d) SELECT strftime(d, '%Y-%m-%d') AS date, day(d) <> 1 AS is_open, CASE WHEN day(d) <> 1 THEN CASE WHEN month(d) = 12 AND day(d) = 24 THEN 3.5 ELSE 6.5 END END::DOUBLE AS hours FROM d WHERE isodow(d) < 6""")
def calendar(spark, sf_dir):
    c = feeds.calendar(spark, "1997-01-01", "1998-12-31", lambda d: F.dayofmonth(d) != 1, lambda d: (F.month(d) == 12) & (F.dayofmonth(d) == 24))
    return c.select(day("date").alias("date"), "is_open", "hours")


_SESSIONS = "sess AS (SELECT d, row_number() OVER (ORDER BY d) AS n FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2002-12-31', INTERVAL 1 DAY))::DATE AS d) WHERE isodow(d) < 6 AND day(d) <> 1)"


@query(f"""WITH {_SESSIONS}, e AS (SELECT o_orderkey, o_orderdate::DATE AS d, o_orderkey % 24 AS h FROM orders), f AS (SELECT e.*, s.d AS on_, s.n FROM e ASOF LEFT JOIN sess s ON e.d <= s.d)
  SELECT o_orderkey, strftime(CASE WHEN on_ > f.d OR h < 9 THEN on_ WHEN h > 16 THEN x.d END, '%Y-%m-%d') AS reaction FROM f LEFT JOIN sess x ON x.n = f.n + 1""")
def reaction_days(spark, sf_dir):
    """The session that answers to an event: its own if it comes before the opening, the next one after the close or on a closed day, none within the session."""
    s = feeds.calendar(spark, "1995-01-01", "2002-12-31", lambda d: F.dayofmonth(d) != 1).where("is_open").select("date")
    s = s.withColumn("next", F.lead("date").over(Window.orderBy("date")))  # a row for each session, not for each event
    e = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"), (F.col("o_orderkey") % 24).alias("h"))
    # an event's session is within ten days: a closed week is the longest break
    near = e.withColumn("date", F.explode(F.sequence("d", F.date_add("d", 10)))).join(F.broadcast(s), "date").groupBy("o_orderkey", "d", "h").agg(F.min(F.struct("date", "next")).alias("s"))
    reaction = F.when((F.col("s.date") > F.col("d")) | (F.col("h") < 9), F.col("s.date")).when(F.col("h") > 16, F.col("s.next"))
    return e.join(near, ["o_orderkey", "d", "h"], "left").select("o_orderkey", day(reaction).alias("reaction"))


# Rates

_RATES = "rates AS (SELECT o_orderdate::DATE AS d, CASE o_custkey % 3 WHEN 0 THEN 'GBP' WHEN 1 THEN 'USD' ELSE 'CHF' END AS currency, arg_max(o_totalprice / 100000, o_orderkey) AS rate FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1, 2)"


@query(f"""WITH {_RATES}, p AS (SELECT o_orderkey, o_orderdate::DATE AS d, CASE o_custkey % 3 WHEN 0 THEN 'GBP' ELSE 'CHF' END AS currency FROM orders WHERE o_orderkey % 2 = 1), a AS (SELECT p.*, CASE WHEN p.d - r.d <= 7 THEN rate END AS own FROM p ASOF LEFT JOIN rates r ON p.currency = r.currency AND p.d >= r.d),
  b AS (SELECT a.*, CASE WHEN a.d - r.d <= 7 THEN rate END AS usd FROM a ASOF LEFT JOIN (SELECT * FROM rates WHERE currency = 'USD') r ON a.d >= r.d) SELECT o_orderkey, round(usd / own, 6) AS to_usd FROM b""")
def currency_cross(spark, sf_dir):
    """Rates to the dollar by way of a common base, each no older than seven days."""
    o = table(spark, sf_dir, "orders").withColumn("d", F.col("o_orderdate").cast("date"))
    name = F.when(F.col("o_custkey") % 3 == 0, "GBP").when(F.col("o_custkey") % 3 == 1, "USD").otherwise("CHF")
    rates = o.where("o_orderkey % 2 = 0").groupBy("d", name.alias("currency")).agg(F.max_by(F.col("o_totalprice") / 100000, "o_orderkey").alias("rate"))
    p = o.where("o_orderkey % 2 = 1").select("o_orderkey", "d", F.when(F.col("o_custkey") % 3 == 0, "GBP").otherwise("CHF").alias("currency"))
    known = joins.by_day(rates, ["currency"], "d", "rate", 7)
    p = p.join(known.withColumnRenamed("rate", "own"), ["currency", "d"], "left")
    p = p.join(known.where("currency = 'USD'").select("d", F.col("rate").alias("usd")), "d", "left")
    return p.select("o_orderkey", r6(F.col("usd") / F.col("own")).alias("to_usd"))


@query("""WITH r AS (SELECT DISTINCT o_orderdate::DATE AS d FROM orders), g AS (SELECT d, coalesce(d - lag(d) OVER (ORDER BY d), 1) AS gap FROM r) SELECT strftime(d, '%Y-%m-%d') AS date, round(2.5 / 100 * gap / 360, 9) AS ret FROM g""")
def risk_free(spark, sf_dir):
    """A rate's return over the days since the session before; a row for each date meets in one task."""
    d = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    gap = F.coalesce(F.datediff("d", F.lag("d").over(Window.orderBy("d"))), F.lit(1))
    return d.select(day("d").alias("date"), F.round(F.lit(2.5) / 100 * gap / 360, 9).alias("ret"))


# Feeds: texts as they come, made from the tables and read back


@query("""SELECT DISTINCT upper(lpad((o_custkey % 50)::VARCHAR, 9, 'C')) AS cusip, lower('SYM' || (o_custkey % 50)::VARCHAR) AS symbol FROM orders WHERE o_custkey % 50 <> 7""")
def fails_to_deliver(spark, sf_dir):
    k = (F.col("o_custkey") % 50).cast("string")
    text = F.concat_ws("|", F.date_format("o_orderdate", "yyyyMMdd"), F.lpad(k, 9, "c"), F.when(k == "7", " ").otherwise(F.concat(F.lit("Sym"), k)), F.lit("100"), F.lit("NAME"))
    lines = table(spark, sf_dir, "orders").select(text.alias("value"))
    return feeds.fails_to_deliver(lines.unionByName(spark.createDataFrame([("SETTLEMENT DATE|CUSIP|SYMBOL|QUANTITY|DESCRIPTION",)], "value string")))


@query("""SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, 'USD' AS currency, round(max(o_totalprice) / 1000, 5) AS rate FROM orders GROUP BY 1 UNION ALL SELECT strftime(o_orderdate, '%Y-%m-%d'), 'JPY', round(min(o_totalprice) / 10, 4) FROM orders GROUP BY 1""")
def exchange_rates(spark, sf_dir):
    """A wide table of text, unpivoted; what is no number is left out."""
    o = table(spark, sf_dir, "orders").groupBy(day("o_orderdate").alias("Date"))
    wide = o.agg(F.format_string("%.5f", F.max("o_totalprice") / 1000).alias("USD"), F.format_string("%,.4f", F.min("o_totalprice") / 10).alias("JPY"), F.lit("N/A").alias("CYP"))
    return feeds.unpivoted_rates(wide, "Date").select(F.col("date"), "currency", "rate")


@query("""SELECT o_orderkey, o_custkey::VARCHAR AS cik, '8-K' AS form, strftime(o_orderdate, '%Y-%m-%d') AS filed, 'edgar/data/' || o_orderkey || '.txt' AS path FROM orders WHERE o_orderkey % 3 = 0""")
def form_index(spark, sf_dir):
    k = F.col("o_orderkey").cast("string")
    form = F.when(F.col("o_orderkey") % 3 == 0, "8-K").otherwise("10-Q")
    line = F.concat(form, F.lit("         ACME AND SONS INC    "), F.col("o_custkey").cast("string"), F.lit("   "), F.when(F.col("o_orderkey") % 2 == 0, day("o_orderdate")).otherwise(F.date_format("o_orderdate", "yyyyMMdd")), F.lit("  edgar/data/"), k, F.lit(".txt"))
    found = feeds.form_index(table(spark, sf_dir, "orders").select("o_orderkey", line.alias("value")), ["8-K"])
    return found.select("o_orderkey", "cik", "form", day("filed").alias("filed"), "path")


@query("""SELECT o_custkey AS security_id, CASE WHEN o_orderkey % 2 = 0 THEN 'Assets' ELSE 'Revenues' END AS concept, 'USD' AS unit, strftime(o_orderdate, '%Y-%m-%d') AS period_end, o_totalprice AS value, o_orderkey::VARCHAR AS accession FROM orders WHERE o_orderkey % 5 <> 0""")
def company_facts(spark, sf_dir):
    """Nested facts of one filer in a text: taxonomy, concept, unit, values; rows without a date of filing are left out."""
    o = table(spark, sf_dir, "orders")
    fact = F.struct(day("o_orderdate").alias("end"), F.col("o_totalprice").alias("val"), F.col("o_orderkey").cast("string").alias("accn"), F.when(F.col("o_orderkey") % 5 != 0, day("o_orderdate")).alias("filed"))
    concept = F.when(F.col("o_orderkey") % 2 == 0, "Assets").otherwise("Revenues")
    units = o.groupBy("o_custkey", concept.alias("c")).agg(F.struct(F.create_map(F.lit("USD"), F.collect_list(fact)).alias("units")).alias("u"))
    payload = units.groupBy("o_custkey").agg(F.to_json(F.struct(F.create_map(F.lit("us-gaap"), F.map_from_entries(F.collect_list(F.struct("c", "u")))).alias("facts"))).alias("payload"))
    found = feeds.company_facts(payload.withColumnRenamed("o_custkey", "security_id"), ["Assets", "Revenues"])
    return found.select("security_id", "concept", "unit", day("period_end").alias("period_end"), "value", "accession")


@query("""SELECT o_orderkey AS id, o_custkey % 3 AS owner, n, CASE n WHEN 0 THEN 'P' ELSE 'S' END AS code, round((10 + n)::DOUBLE * round(o_totalprice, 2), 6) AS value FROM orders, (SELECT unnest([0, 1]) AS n) WHERE o_orderkey % 10 = 0""")
def ownership_documents(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_orderkey % 10 = 0")
    one = lambda n, code: f"<transaction><code>{code}</code><shares>{10 + n}</shares><price>%s</price></transaction>"
    text = "<document><owner>%s</owner>" + one(0, "P") + one(1, "S") + "</document>"
    price = F.round("o_totalprice", 2).cast("decimal(18,2)").cast("string")
    docs = o.select(F.col("o_orderkey").alias("id"), F.format_string(text, (F.col("o_custkey") % 3).cast("string"), price, price).alias("xml"))
    return feeds.ownership(docs).select("id", F.col("owner").cast("long").alias("owner"), F.col("n").cast("int").alias("n"), "code", "value")


# Hashes


@query("""SELECT o_orderkey, sha256('{"horizon":' || (o_orderkey % 9)::VARCHAR || ',"name":"' || o_orderpriority || '"}')[:12] AS hash FROM orders""")
def parameter_hash(spark, sf_dir):
    """The hash of parameters as JSON with sorted names and no spaces."""
    j = F.to_json(F.struct((F.col("o_orderkey") % 9).alias("horizon"), F.col("o_orderpriority").alias("name")))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.substring(F.sha2(j, 256), 1, 12).alias("hash"))
