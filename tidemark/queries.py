"""Every query of the library, each with an independent SQL formulation over the same tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import new_york, normal_name, quarter_end, visible_at
from tidemark.operators import cross_section as xs
from tidemark.operators import joins, windows, writes
from tidemark.plans import evaluate, factors
from tidemark.registry import QUERIES, SQL, query  # noqa: F401
from tidemark.sources.views import bars, events, on_grid, table
from tidemark.streaming.sessions import windowed

BARS = """ticks AS (SELECT l_suppkey, l_quantity, l_extendedprice, l_extendedprice / l_quantity AS p, date_trunc('week', l_shipdate)::DATE AS wk,
    {'a': l_shipdate, 'b': l_orderkey, 'c': l_linenumber, 'p': l_extendedprice / l_quantity} AS t FROM lineitem),
  bars AS (SELECT l_suppkey AS security_id, wk AS date, min(t).p AS open, max(p) AS high, min(p) AS low, max(t).p AS close,
    sum(l_quantity) AS volume, sum(l_extendedprice::DECIMAL(18, 2))::DOUBLE / sum(l_quantity) AS vwap, count(*) AS n_bars FROM ticks GROUP BY 1, 2)"""
GRID = BARS + """,
  days AS (SELECT security_id, unnest(generate_series(min(date), max(date), INTERVAL 7 DAY))::DATE AS date FROM bars GROUP BY 1),
  grid AS (SELECT days.security_id, days.date, open, high, low, close, volume, vwap, n_bars FROM days LEFT JOIN bars USING (security_id, date)),
  prep AS (SELECT *, close / lag(close) OVER o - 1 AS ret, close - lag(close) OVER o AS change, lag(close) OVER o AS close_1,
    (high + low + close) / 3 AS typical, lag((high + low + close) / 3) OVER o AS typical_1 FROM grid WINDOW o AS (PARTITION BY security_id ORDER BY date))"""


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return on_grid(bars(spark, sf_dir))


def r6(x: Column | str) -> Column:
    return F.round(x, 6)


# Scans, filters and aggregations


@query(f"WITH {BARS} SELECT security_id, date, round(open, 9) AS open, round(high, 9) AS high, round(low, 9) AS low, round(close, 9) AS close, volume, round(vwap, 9) AS vwap, n_bars FROM bars")
def weekly_bars(spark, sf_dir):
    return bars(spark, sf_dir).select("security_id", "date", *[F.round(x, 9).alias(x) for x in ("open", "high", "low", "close", "vwap")], "volume", "n_bars")


@query(f"""WITH {BARS} SELECT count(*) AS n, count(*) FILTER (WHERE high < low) AS inverted, count(*) FILTER (WHERE vwap > high + 1e-9 OR vwap < low - 1e-9) AS vwap_outside,
  count(*) FILTER (WHERE high > 1.5 * greatest(open, close) OR low < 0.5 * least(open, close)) AS extreme, count(DISTINCT security_id) AS securities FROM bars""")
def bar_quality(spark, sf_dir):
    return bars(spark, sf_dir).agg(
        F.count("*").alias("n"), F.count_if(F.col("high") < F.col("low")).alias("inverted"),
        F.count_if((F.col("vwap") > F.col("high") + 1e-9) | (F.col("vwap") < F.col("low") - 1e-9)).alias("vwap_outside"),
        F.count_if((F.col("high") > 1.5 * F.greatest("open", "close")) | (F.col("low") < 0.5 * F.least("open", "close"))).alias("extreme"),
        F.countDistinct("security_id").alias("securities"),
    )


@query("""SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_price, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc, round(avg(l_discount), 6) AS avg_disc, count(*) AS n
  FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def pricing_summary(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem").where("l_shipdate <= timestamp_ntz '1998-09-02'")
    return t.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_price"), F.round(F.sum(F.expr("l_extendedprice * (1 - l_discount)")), 2).alias("sum_disc"), r6(F.avg("l_discount")).alias("avg_disc"), F.count("*").alias("n"))


@query("""WITH s AS (SELECT o_custkey, o_orderpriority, sum(o_totalprice) AS v FROM orders GROUP BY 1, 2)
  SELECT o_custkey, round(sum(v), 2) AS total, round(sum(v * v) / (sum(v) * sum(v)), 6) AS hhi, count(*) AS holders FROM s GROUP BY 1""")
def concentration(spark, sf_dir):
    s = table(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.sum("o_totalprice").alias("v"))
    return s.groupBy("o_custkey").agg(F.round(F.sum("v"), 2).alias("total"), r6(F.sum(F.col("v") * F.col("v")) / (F.sum("v") * F.sum("v"))).alias("hhi"), F.count("*").alias("holders"))


@query("""WITH t AS (SELECT l_suppkey, l_quantity AS q, sum(l_extendedprice) AS w FROM lineitem GROUP BY 1, 2),
  r AS (SELECT *, sum(w) OVER (PARTITION BY l_suppkey ORDER BY q) AS c, sum(w) OVER (PARTITION BY l_suppkey) AS t FROM t)
  SELECT l_suppkey, min(q) AS quantile FROM r WHERE c >= 0.5 * t GROUP BY 1""")
def weighted_median(spark, sf_dir):
    return xs.weighted_quantile(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_quantity", "l_extendedprice", 0.5)


@query("""WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2), r AS (SELECT *, rank() OVER (PARTITION BY user_id ORDER BY n DESC) AS r FROM c)
  SELECT user_id, min(event_type) AS mode, min(n) AS n FROM r WHERE r = 1 GROUP BY 1 HAVING count(*) = 1""")
def clear_mode(spark, sf_dir):
    return xs.clear_mode(events(spark, sf_dir), "user_id", "event_type")


@query("""SELECT user_id, count(DISTINCT event_type) AS kinds, array_to_string(list(DISTINCT event_type ORDER BY event_type), ',') AS names,
  sum((props->>'k')::BIGINT) AS k, strftime(max(ts), '%Y-%m-%d') AS newest FROM events GROUP BY 1""")
def event_profile(spark, sf_dir):
    e = events(spark, sf_dir)
    return e.groupBy("user_id").agg(F.countDistinct("event_type").alias("kinds"), F.array_join(F.sort_array(F.collect_set("event_type")), ",").alias("names"), F.sum("k").alias("k"), F.date_format(F.max("ts"), "yyyy-MM-dd").alias("newest"))


@query("""SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def event_windows(spark, sf_dir):
    return windowed(table(spark, sf_dir, "events")).select(F.date_format("start", "yyyy-MM-dd HH").alias("hour"), "event_type", "n", F.round("total", 4).alias("total"))


@query(f"""WITH {GRID}, f AS (SELECT *, quantile_cont(close * volume, 0.5) OVER w AS m, count(close * volume) OVER w AS k FROM grid WINDOW w AS (PARTITION BY security_id ORDER BY date ROWS BETWEEN 62 PRECEDING AND CURRENT ROW))
  SELECT security_id, date, coalesce(m >= 20000 AND close >= 900 AND k >= 42, false) AS eligible FROM f""")
def eligibility(spark, sf_dir):
    return factors.eligible(grid(spark, sf_dir), min_price=900, min_median_dollar_volume=20000).select("security_id", "date", "eligible")


# Joins


@query("""SELECT p.event_id, p.user_id, CASE WHEN v.ts >= p.ts - INTERVAL 6 HOUR THEN v.value END AS asof_value FROM (SELECT * FROM events WHERE event_type = 'click') p
  ASOF LEFT JOIN (SELECT ts + INTERVAL 10 MINUTE AS seen, ts, user_id, max(event_id) AS e, arg_max(value, event_id) AS value FROM events WHERE event_type = 'view' GROUP BY 1, 2, 3) v ON p.user_id = v.user_id AND p.ts >= v.seen""")
def as_of_join(spark, sf_dir):
    e = events(spark, sf_dir).select("event_id", "user_id", F.col("ts"), "event_type", "value")
    left = e.where("event_type = 'click'").select("event_id", "user_id", "ts")
    found = joins.as_of(left, e.where("event_type = 'view'"), "user_id", "ts", "ts", "event_id", ["value"], "interval 6 hours", "interval 10 minutes", piece="day")
    return found.select("event_id", "user_id", "asof_value")


@query("""WITH p AS (SELECT a.o_orderkey, b.o_orderkey AS match_id, date_diff('day', b.o_orderdate::DATE, a.o_orderdate::DATE) AS gap, b.o_orderdate AS d
    FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND abs(date_diff('day', b.o_orderdate::DATE, a.o_orderdate::DATE) - 365) <= 35)
  SELECT o_orderkey, match_id, gap FROM p QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY abs(gap - 365), d, match_id) = 1""")
def year_ago_pairs(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return joins.nearest(o, o, ["o_custkey"], "o_orderdate", "o_orderdate", "o_orderkey", 365, 35).select("o_orderkey", "match_id", F.col("gap").cast("long").alias("gap"))


@query("""SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""")
def uncovered(spark, sf_dir):
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    c = table(spark, sf_dir, "customer")
    return c.join(urgent, c.c_custkey == urgent.o_custkey, "left_anti").select("c_custkey", "c_name")


@query("""SELECT l_orderkey, min(l_returnflag) AS l_returnflag FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY 1 HAVING count(DISTINCT l_returnflag) = 1""")
def unambiguous_map(spark, sf_dir):
    return joins.unambiguous(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_returnflag")


@query("""WITH t AS (SELECT o_orderkey AS tenure_id, o_custkey, o_orderdate AS start, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS "end" FROM orders)
  SELECT tenure_id, o_custkey, strftime(start, '%Y-%m-%d') AS start, coalesce(strftime("end", '%Y-%m-%d'), 'open') AS until FROM t""")
def tenures(spark, sf_dir):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("tenure_id"), "o_custkey", F.col("o_orderdate").alias("start"), F.lead("o_orderdate").over(w).alias("end"))
    return o.select("tenure_id", "o_custkey", F.date_format("start", "yyyy-MM-dd").alias("start"), F.coalesce(F.date_format("end", "yyyy-MM-dd"), F.lit("open")).alias("until"))


@query("""WITH t AS (SELECT o_orderkey AS tenure_id, o_custkey AS k, o_orderdate AS s, o_orderdate + INTERVAL 30 DAY AS e FROM orders), p AS (SELECT o_orderkey, o_custkey AS k, o_orderdate + INTERVAL 15 DAY AS d FROM orders)
  SELECT o_orderkey, min(tenure_id) AS tenure_id FROM p JOIN t ON p.k = t.k AND d >= s AND d < e GROUP BY 1 HAVING count(*) = 1""")
def tenure_join(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    t = o.select(F.col("o_orderkey").alias("tenure_id"), "o_custkey", F.col("o_orderdate").alias("start"), (F.col("o_orderdate") + F.expr("interval 30 days")).alias("end"))
    p = o.select("o_orderkey", "o_custkey", (F.col("o_orderdate") + F.expr("interval 15 days")).alias("d"))
    return joins.in_tenure(p, t, "o_custkey", "d").select("o_orderkey", "tenure_id")


@query("""SELECT n_name, count(*) AS orders, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderstatus = 'F' GROUP BY 1""")
def revenue_by_nation(spark, sf_dir):
    t = {n: table(spark, sf_dir, n) for n in ("lineitem", "orders", "customer", "nation")}
    j = t["lineitem"].join(t["orders"].where("o_orderstatus = 'F'"), F.col("l_orderkey") == F.col("o_orderkey")).join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("n_name").agg(F.count("*").alias("orders"), F.round(F.sum(F.expr("l_extendedprice * (1 - l_discount)")), 2).alias("revenue"))


# Writes


@query("""WITH n AS (SELECT o_custkey AS id, o_totalprice AS bal, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS seg FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
  SELECT coalesce(c_custkey, id) AS id, c_name AS name, CASE WHEN id IS NOT NULL THEN bal ELSE c_acctbal END AS bal, coalesce(seg, c_mktsegment) AS seg FROM customer FULL JOIN n ON c_custkey = id""")
def upsert(spark, sf_dir):
    old = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("seg"))
    batch = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), F.col("o_totalprice").alias("bal"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("seg"), "o_orderdate", "o_orderkey")
    return writes.upsert(old, writes.last_per_key(batch, ["id"], ["o_orderdate", "o_orderkey"]).select("id", "bal", "seg"), ["id"], overwrite=["bal"], keep_known=["seg"])


# Windows


@query("""WITH a AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 1 HOUR THEN 1 ELSE 0 END AS g FROM events),
  b AS (SELECT *, sum(g) OVER (PARTITION BY user_id ORDER BY ts) AS run_id FROM a) SELECT user_id, run_id::BIGINT AS run_id, count(*) AS n FROM b GROUP BY 1, 2 HAVING count(*) >= 2""")
def gaps_and_islands(spark, sf_dir):
    return windows.runs(events(spark, sf_dir), "user_id", "ts", 3600, 2).select("user_id", "run_id", "n")


@query("""SELECT o_orderkey FROM (SELECT *, max(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS m FROM orders) WHERE o_totalprice >= m""")
def running_max_guard(spark, sf_dir):
    return windows.not_behind(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], "o_totalprice").select("o_orderkey")


@query(f"WITH {GRID}, f AS (SELECT security_id, date, last_value(close IGNORE NULLS) OVER (PARTITION BY security_id ORDER BY date) AS c, close FROM grid) SELECT security_id, date, round(c, 9) AS filled, close IS NULL AS gap FROM f")
def forward_fill(spark, sf_dir):
    return grid(spark, sf_dir).select("security_id", "date", F.round(windows.forward_filled("close"), 9).alias("filled"), F.col("close").isNull().alias("gap"))


@query("""WITH a AS (SELECT l_suppkey, l_shipdate::DATE AS ex_date, sum(ln(1 - l_discount)) AS s FROM lineitem WHERE l_linenumber = 1 GROUP BY 1, 2)
  SELECT l_suppkey, ex_date, round(exp(sum(s) OVER (PARTITION BY l_suppkey ORDER BY ex_date DESC)), 6) AS factor FROM a""")
def adjustment_factors(spark, sf_dir):
    a = table(spark, sf_dir, "lineitem").where("l_linenumber = 1").groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("ex_date")).agg(F.sum(F.expr("ln(1 - l_discount)")).alias("s"))
    return a.select("l_suppkey", "ex_date", r6(F.exp(F.sum("s").over(Window.partitionBy("l_suppkey").orderBy(F.desc("ex_date"))))).alias("factor"))


# Cross sections


@query(f"""WITH {BARS}, r AS (SELECT *, rank() OVER (PARTITION BY date ORDER BY volume) + (count(*) OVER (PARTITION BY date, volume) - 1) / 2 AS avg_rank, count(*) OVER (PARTITION BY date) AS n, row_number() OVER (PARTITION BY date ORDER BY volume, security_id) AS first FROM bars)
  SELECT security_id, date, avg_rank::DOUBLE AS avg_rank, round(avg_rank / n, 6) AS pct, CASE WHEN n >= 5 THEN least((first - 1) * 5 // n + 1, 5)::INT END AS bucket FROM r""")
def ranks(spark, sf_dir):
    return bars(spark, sf_dir).select("security_id", "date", xs.average_rank("volume").alias("avg_rank"), r6(xs.percent_rank("volume")).alias("pct"), xs.buckets("volume", 5, 5).alias("bucket"))


@query(f"""WITH {BARS}, s AS (SELECT date, count(*) AS n, regr_slope(vwap, volume) AS b, avg(vwap) AS y, avg(volume) AS x, var_pop(volume) AS v FROM bars GROUP BY 1)
  SELECT security_id, date, round(vwap - y - (CASE WHEN v > 1e-18 THEN b ELSE 0 END) * (volume - x), 5) AS res FROM bars JOIN s USING (date)""")
def residuals(spark, sf_dir):
    return bars(spark, sf_dir).select("security_id", "date", F.round(xs.residual("vwap", "volume"), 5).alias("res"))


# Factors

FACTOR_SQL = {
    "momentum": "lag(close, 21) OVER o / lag(close, 252) OVER o - 1",
    "high_year": "close / CASE WHEN count(close) OVER w252 >= 126 THEN max(close) OVER w252 END",
    "low_vol": "-CASE WHEN count(ret) OVER w63 >= 42 THEN stddev_samp(ret) OVER w63 END",
    "max_lottery": "-CASE WHEN count(ret) OVER w21 >= 15 THEN max(ret) OVER w21 END",
    "reversal": "-(lag(close, 1) OVER o / lag(close, 21) OVER o - 1)",
    "shadow_asymmetry": "-CASE WHEN count(CASE WHEN high > low THEN 1 END) OVER w21 >= 15 THEN avg(CASE WHEN high > low THEN ((high - greatest(open, close)) - (least(open, close) - low)) / (high - low) END) OVER w21 END",
    "vwap_pressure": "CASE WHEN count(close) OVER w5 >= 3 THEN -avg(ln(close / vwap)) OVER w5 END",
    "money_flow": "CASE WHEN row_number() OVER o >= 10 AND sum(CASE WHEN typical <> typical_1 THEN typical * volume END) OVER w14 > 0 THEN -100 * coalesce(sum(CASE WHEN typical > typical_1 THEN typical * volume END) OVER w14, 0) / sum(CASE WHEN typical <> typical_1 THEN typical * volume END) OVER w14 END",
    "strength": "CASE WHEN count(change) OVER w14 >= 10 AND sum(abs(change)) OVER w14 > 0 THEN -100 * sum(CASE WHEN change > 0 THEN change ELSE 0 END) OVER w14 / sum(abs(change)) OVER w14 END",
    "bollinger": "CASE WHEN count(close) OVER w20 >= 15 AND stddev_samp(close) OVER w20 > 0 THEN -(close - avg(close) OVER w20 + 2 * stddev_samp(close) OVER w20) / (4 * stddev_samp(close) OVER w20) END",
    "donchian": "CASE WHEN count(close) OVER w55 >= 40 AND max(close) OVER w55 > min(close) OVER w55 THEN (close - min(close) OVER w55) / (max(close) OVER w55 - min(close) OVER w55) END",
    "sma_gap": "CASE WHEN count(close) OVER w50 >= 38 THEN close / avg(close) OVER w50 - 1 END",
    "volume_slope": "CASE WHEN row_number() OVER o > 21 AND count(volume) OVER w21 >= 15 AND avg(volume) OVER w21 > 0 THEN coalesce(sum(sign(change) * volume) OVER w21, 0) / (avg(volume) OVER w21 * 21) END",
    "close_location_slope": "CASE WHEN row_number() OVER o > 21 AND count(volume) OVER w21 >= 15 AND avg(volume) OVER w21 > 0 THEN coalesce(sum(CASE WHEN high > low THEN ((close - low) - (high - close)) / (high - low) * volume END) OVER w21, 0) / (avg(volume) OVER w21 * 21) END",
    "trend_in_ranges": "CASE WHEN count(close) OVER w50 >= 38 AND count(high) OVER w21 >= 15 AND avg(greatest(high - low, abs(high - close_1), abs(low - close_1))) OVER w21 > 0 THEN (close - avg(close) OVER w50) / avg(greatest(high - low, abs(high - close_1), abs(low - close_1))) OVER w21 END",
    "volume_confirmed_reversal": "CASE WHEN count(close) OVER w20 >= 15 AND stddev_samp(close) OVER w20 > 0 AND count(volume) OVER w21 >= 15 AND avg(volume) OVER w21 > 0 THEN (0.5 - (close - avg(close) OVER w20 + 2 * stddev_samp(close) OVER w20) / (4 * stddev_samp(close) OVER w20)) * CASE WHEN volume IS NOT NULL THEN least(volume / avg(volume) OVER w21, 3) END END",
}
FRAMES = "WINDOW o AS (PARTITION BY security_id ORDER BY date), f AS (PARTITION BY security_id ORDER BY date ROWS BETWEEN 251 PRECEDING AND 21 PRECEDING), " + ", ".join(f"w{n} AS (PARTITION BY security_id ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in (5, 14, 20, 21, 50, 55, 63, 252))


def _register_factor(name: str) -> None:
    digits = 9 if name.endswith("_slope") else 6  # slopes are quotients of whole numbers, often with a five as the seventh digit

    def run(spark, sf_dir):
        return factors.factor(grid(spark, sf_dir), name).withColumn("value", F.round("value", digits))

    query(f"WITH {GRID} SELECT date, security_id, round(value, {digits}) AS value FROM (SELECT date, security_id, {FACTOR_SQL[name]} AS value FROM prep {FRAMES}) WHERE value IS NOT NULL", f"factor_{name}")(run)


for _name in FACTOR_SQL:
    _register_factor(_name)


# Few weeks in a row have a return here, so the gates of the factors with a year's formation are lower than their own.


@query(f"""WITH {GRID} SELECT date, security_id, round(CASE WHEN count(ret) OVER f >= 120 THEN sign(lag(close, 21) OVER o / lag(close, 252) OVER o - 1) * (count(CASE WHEN ret < 0 THEN 1 END) OVER f - count(CASE WHEN ret > 0 THEN 1 END) OVER f) / count(ret) OVER f END, 6) AS value
  FROM prep {FRAMES} QUALIFY value IS NOT NULL""")
def factor_information_discreteness(spark, sf_dir):
    p = factors.prepared(grid(spark, sf_dir))
    return p.select("date", "security_id", r6(factors.information_discreteness(least=120)).alias("value")).where("value is not null")


_MARKET = f"""{GRID}, m AS (SELECT date, security_id, ret AS r, avg(ret) OVER (PARTITION BY date) AS mkt, CASE WHEN ret IS NOT NULL THEN avg(ret) OVER (PARTITION BY date) END AS x FROM prep)"""


@query(f"""WITH {_MARKET}, e AS (SELECT date, security_id, avg(r) OVER w AS r, avg(r * r) OVER w AS rr, avg(x) OVER w AS x, avg(x * x) OVER w AS xx, avg(r * x) OVER w AS rx, count(r) OVER w AS n FROM m WINDOW w AS (PARTITION BY security_id ORDER BY date ROWS 62 PRECEDING)),
  v AS (SELECT *, rr - r * r - pow(rx - r * x, 2) / CASE WHEN xx - x * x > 0 THEN xx - x * x END AS left_ FROM e WHERE n >= 42)
  SELECT date, security_id, round(-sqrt(greatest(left_, 0)), 6) AS value FROM v WHERE rr - r * r > 0 AND left_ > -1e-12""")
def factor_residual_vol(spark, sf_dir):
    return factors.residual_vol(grid(spark, sf_dir)).withColumn("value", r6("value"))


@query(f"""WITH {_MARKET}, e AS (SELECT *, avg(r) OVER w AS er, avg(x) OVER w AS ex, avg(x * x) OVER w AS exx, avg(r * x) OVER w AS erx, count(r) OVER w AS n FROM m WINDOW w AS (PARTITION BY security_id ORDER BY date ROWS BETWEEN 252 PRECEDING AND 1 PRECEDING)),
  b AS (SELECT *, (erx - er * ex) / CASE WHEN exx - ex * ex > 1e-18 THEN exx - ex * ex END AS beta FROM e),
  l AS (SELECT date, security_id, CASE WHEN n >= 126 THEN r - (er - beta * ex) - beta * mkt END AS l FROM b)
  SELECT date, security_id, round(sum(l) OVER f, 5) AS value FROM l WINDOW o AS (PARTITION BY security_id ORDER BY date), f AS (PARTITION BY security_id ORDER BY date ROWS BETWEEN 251 PRECEDING AND 21 PRECEDING) QUALIFY row_number() OVER o > 251 AND count(l) OVER f >= 40""")
def factor_residual_momentum(spark, sf_dir):
    return factors.residual_momentum(grid(spark, sf_dir), formation=40).withColumn("value", F.round("value", 5))


def _ewm(x: str, span: int, least: int, source: str) -> str:
    """SQL of an exponential mean of x over source(security_id, i, ...)."""
    d = 1 - 2 / (span + 1)
    return f"""SELECT a.security_id, a.i, CASE WHEN count(b.{x}) >= {least} THEN sum(b.{x} * pow({d}, a.i - b.i)) / sum(CASE WHEN b.{x} IS NOT NULL THEN pow({d}, a.i - b.i) END) END AS m FROM {source} a JOIN {source} b ON a.security_id = b.security_id AND b.i <= a.i GROUP BY 1, 2"""


_MACD = f"""{GRID}, s AS (SELECT security_id, date, close, row_number() OVER (PARTITION BY security_id ORDER BY date) AS i FROM grid), fast AS ({_ewm('close', 12, 10, 's')}), slow AS ({_ewm('close', 26, 20, 's')}),
  line AS (SELECT security_id, i, fast.m - slow.m AS x FROM fast JOIN slow USING (security_id, i)), sig AS ({_ewm('x', 9, 7, 'line')}),
  macd AS (SELECT date, security_id, (x - sig.m) / close AS value FROM s JOIN line USING (security_id, i) JOIN sig USING (security_id, i) WHERE x - sig.m IS NOT NULL AND close IS NOT NULL)"""


@query(f"WITH {_MACD} SELECT date, security_id, round(value, 6) AS value FROM macd")
def factor_macd(spark, sf_dir):
    return factors.macd(grid(spark, sf_dir)).withColumn("value", r6("value"))


def _percent_rank(x: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN (rank() OVER (PARTITION BY date, {x} IS NULL ORDER BY {x}) + (count(*) OVER (PARTITION BY date, {x}) - 1) / 2) / count({x}) OVER (PARTITION BY date) END"


@query(f"""WITH {_MACD}, t AS (SELECT date, security_id, {FACTOR_SQL['bollinger']} AS b, {FACTOR_SQL['money_flow']} AS m, {FACTOR_SQL['strength']} AS s FROM prep {FRAMES}),
  f AS (SELECT t.*, -value AS d FROM t LEFT JOIN macd USING (date, security_id)), r AS (SELECT date, security_id, ({_percent_rank('b')} + {_percent_rank('m')} + {_percent_rank('s')} + {_percent_rank('d')}) / 4 AS value FROM f)
  SELECT date, security_id, round(value, 6) AS value FROM r WHERE value IS NOT NULL""")
def factor_reversal_ensemble(spark, sf_dir):
    return factors.reversal_ensemble(grid(spark, sf_dir)).withColumn("value", r6("value"))


@query(f"""WITH {GRID}, f AS (SELECT date, security_id, {FACTOR_SQL['low_vol']} AS lv, {FACTOR_SQL['high_year']} AS hy FROM prep {FRAMES}), g AS (SELECT * FROM f WHERE lv IS NOT NULL),
  s AS (SELECT date, regr_slope(hy, lv) AS b, avg(hy) FILTER (WHERE hy IS NOT NULL) AS y, avg(lv) FILTER (WHERE hy IS NOT NULL) AS x, var_pop(lv) FILTER (WHERE hy IS NOT NULL) AS v FROM g GROUP BY 1),
  h AS (SELECT g.*, round(hy - y - (CASE WHEN v > 1e-18 THEN b ELSE 0 END) * (lv - x), 9) + 0.0 AS res FROM g JOIN s USING (date)),
  k AS (SELECT *, (rank() OVER (PARTITION BY date ORDER BY lv) + (count(*) OVER (PARTITION BY date, lv) - 1) / 2) / count(lv) OVER (PARTITION BY date) AS a,
    CASE WHEN res IS NOT NULL THEN (rank() OVER (PARTITION BY date, res IS NULL ORDER BY res) + (count(*) OVER (PARTITION BY date, res) - 1) / 2) / count(res) OVER (PARTITION BY date) END AS r FROM h)
  SELECT date, security_id, round((a + coalesce(r, 0.5)) / 2, 6) AS value FROM k""")
def composite(spark, sf_dir):
    return factors.composite(grid(spark, sf_dir)).withColumn("value", r6("value"))


# Evaluation

_PANEL = f"""{GRID}, fill AS (SELECT *, last_value(close IGNORE NULLS) OVER (PARTITION BY security_id ORDER BY date) AS filled FROM prep),
  panel AS (SELECT date, security_id, close, ret, -(lag(close, 1) OVER o / lag(close, 21) OVER o - 1) AS value, lead(filled, 4) OVER o / close - 1 AS forward FROM fill WINDOW o AS (PARTITION BY security_id ORDER BY date))"""


def _panel(spark, sf_dir) -> DataFrame:
    g = evaluate.with_forward(factors.prepared(grid(spark, sf_dir)), 4)
    return g.select("date", "security_id", "close", "ret", factors.reversal().alias("value"), "forward")


def _avg_rank_sql(x: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN rank() OVER (PARTITION BY date, {x} IS NULL ORDER BY {x}) + (count(*) OVER (PARTITION BY date, {x}) - 1) / 2 END"


_RANKED = """k AS (SELECT date, CASE WHEN value IS NOT NULL THEN rank() OVER (PARTITION BY date, value IS NULL ORDER BY value) + (count(*) OVER (PARTITION BY date, value) - 1) / 2 END AS a,
    CASE WHEN forward IS NOT NULL THEN rank() OVER (PARTITION BY date, forward IS NULL ORDER BY forward) + (count(*) OVER (PARTITION BY date, forward) - 1) / 2 END AS b FROM panel),
  ic AS (SELECT date, corr(a, b) AS ic, count(*) AS n FROM k WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY 1 HAVING count(*) >= 5 AND var_pop(a) > 0 AND var_pop(b) > 0)"""


@query(f"WITH {_PANEL}, {_RANKED} SELECT date, round(ic, 6) AS ic, n FROM ic")
def rank_ic(spark, sf_dir):
    return xs.rank_ic(_panel(spark, sf_dir), "value", "forward", 5).withColumn("ic", r6("ic"))


@query(f"""WITH {_PANEL}, {_RANKED}, x AS (SELECT date, ic - avg(ic) OVER () AS d, ic, row_number() OVER (ORDER BY date) AS i FROM ic), c AS (SELECT count(*) AS n, greatest(4, floor(4 * pow(count(*) / 100, 2.0 / 9)))::INT AS lags FROM x),
  g AS (SELECT b.i - a.i AS k, sum(a.d * b.d) AS s FROM x a JOIN x b ON b.i - a.i BETWEEN 0 AND (SELECT least(lags, n - 1) FROM c) GROUP BY 1),
  v AS (SELECT sum(s * CASE WHEN k = 0 THEN 1 ELSE 2 * (1 - k / (least(lags, n - 1) + 1)) END) / any_value(n) AS v, any_value(n) AS n FROM g, c)
  SELECT n, round((SELECT avg(ic) FROM ic), 6) AS mean, round((SELECT avg(ic) FROM ic) / sqrt(v / n), 4) AS t FROM v""")
def ic_significance(spark, sf_dir):
    return evaluate.newey_west(xs.rank_ic(_panel(spark, sf_dir), "value", "forward", 5), "ic", 4).select("n", r6("mean").alias("mean"), F.round("t", 4).alias("t"))


@query(f"""WITH {_PANEL}, b AS (SELECT *, least((row_number() OVER (PARTITION BY date ORDER BY value, security_id) - 1) * 5 // count(*) OVER (PARTITION BY date) + 1, 5)::INT AS bucket, count(*) OVER (PARTITION BY date) AS m FROM panel WHERE value IS NOT NULL)
  SELECT date, bucket, round(avg(forward), 6) AS ret, count(forward) AS n FROM b WHERE m >= 5 GROUP BY 1, 2""")
def quantile_returns(spark, sf_dir):
    return evaluate.quantile_returns(_panel(spark, sf_dir), 5, 5).withColumn("ret", r6("ret"))


_WEIGHTS = f"""{_PANEL}, b AS (SELECT *, CASE WHEN value IS NOT NULL AND count(value) OVER (PARTITION BY date) >= 5 THEN least((row_number() OVER (PARTITION BY date, value IS NULL ORDER BY value, security_id) - 1) * 5 // count(value) OVER (PARTITION BY date) + 1, 5) END AS bucket FROM panel),
  q AS (SELECT *, CASE bucket WHEN 5 THEN 0.5 / count(*) OVER (PARTITION BY date, bucket) WHEN 1 THEN -0.5 / count(*) OVER (PARTITION BY date, bucket) ELSE 0 END AS w FROM b)"""


def _run(weights: str, terminal: str = "NULL", freeze: bool = True) -> str:
    """SQL of daily(date, gross, turnover) from a table of weights(date, security_id, close, w)."""
    carried = "CASE WHEN close IS NULL OR was THEN coalesce(last_value(CASE WHEN close IS NULL AND NOT was THEN held END IGNORE NULLS) OVER o, held) ELSE held END" if freeze else "held"
    return f"""p1 AS (SELECT *, coalesce(lag(w) OVER o, 0) AS held, lag(close IS NULL, 1, false) OVER o AS was, last_value(close IGNORE NULLS) OVER (PARTITION BY security_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS past, count(close) OVER (PARTITION BY security_id ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS future FROM {weights} WINDOW o AS (PARTITION BY security_id ORDER BY date)),
  p2 AS (SELECT *, {carried} AS carried, close IS NULL AND future = 0 AND held > 0 AS over FROM p1 WINDOW o AS (PARTITION BY security_id ORDER BY date)),
  p3 AS (SELECT *, CASE WHEN over AND NOT coalesce(lag(over) OVER o, false) THEN {terminal} WHEN close IS NOT NULL THEN close / past - 1 END AS r FROM p2 WINDOW o AS (PARTITION BY security_id ORDER BY date)),
  daily AS (SELECT date, sum(carried * coalesce(r, 0)) AS gross, sum(abs(w - held)) AS turnover FROM p3 GROUP BY 1)"""


_TEST = f"{_WEIGHTS}, {_run('q')}"


@query(f"WITH {_TEST} SELECT date, round(gross, 6) AS gross, round(gross - 0.001 * turnover, 6) AS net, round(turnover, 6) AS turnover FROM daily")
def backtest(spark, sf_dir):
    d = evaluate.backtest(_panel(spark, sf_dir), 5, 5, 0.001)
    return d.select("date", r6("gross").alias("gross"), r6("net").alias("net"), r6("turnover").alias("turnover"))


_DECAY_SQL = ", ".join(f"lead(forward, {k}) OVER (PARTITION BY security_id ORDER BY date) AS f{k}" for k in range(4))


@query(f"""WITH {_TEST}, {_RANKED}, x AS (SELECT date, ic - avg(ic) OVER () AS d, ic, row_number() OVER (ORDER BY date) AS i FROM ic), c AS (SELECT count(*) AS n, greatest(4, floor(4 * pow(count(*) / 100, 2.0 / 9)))::INT AS lags FROM x),
  g AS (SELECT b.i - a.i AS k, sum(a.d * b.d) AS s FROM x a JOIN x b ON b.i - a.i BETWEEN 0 AND (SELECT least(lags, n - 1) FROM c) GROUP BY 1),
  v AS (SELECT sum(s * CASE WHEN k = 0 THEN 1 ELSE 2 * (1 - k / (least(lags, n - 1) + 1)) END) / any_value(n) AS v, any_value(n) AS n FROM g, c),
  ahead AS (SELECT date, value, unnest([0, 1, 2, 3]) AS lag, unnest([f0, f1, f2, f3]) AS f FROM (SELECT *, {_DECAY_SQL} FROM panel)),
  kd AS (SELECT date, lag, CASE WHEN value IS NOT NULL THEN rank() OVER (PARTITION BY date, lag, value IS NULL ORDER BY value) + (count(*) OVER (PARTITION BY date, lag, value) - 1) / 2 END AS a, CASE WHEN f IS NOT NULL THEN rank() OVER (PARTITION BY date, lag, f IS NULL ORDER BY f) + (count(*) OVER (PARTITION BY date, lag, f) - 1) / 2 END AS b FROM ahead),
  dec AS (SELECT lag, avg(ic) AS ic FROM (SELECT date, lag, corr(a, b) AS ic FROM kd WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 5 AND var_pop(a) > 0 AND var_pop(b) > 0) GROUP BY 1)
  SELECT n AS dates, round((SELECT avg(ic) FROM ic), 6) AS mean_ic, round((SELECT avg(ic) FROM ic) / sqrt(v / n), 4) AS t, (SELECT min(lag)::INT FROM dec WHERE abs(ic) <= (SELECT abs(ic) FROM dec WHERE lag = 0) / 2) AS half_life,
    (SELECT round(count(value) / count(*), 6) FROM panel) AS coverage, (SELECT round(avg(gross), 6) FROM daily) AS gross, (SELECT round(avg(gross - 0.001 * turnover), 6) FROM daily) AS net, (SELECT round(avg(turnover), 6) FROM daily) AS turnover,
    (SELECT round(avg(gross - 0.001 * turnover) / stddev_samp(gross - 0.001 * turnover) * sqrt(52), 4) FROM daily) AS sharpe FROM v""")
def factor_evaluation(spark, sf_dir):
    """A factor's whole evaluation in one row: rank IC with its significance and half life, coverage, and the long-short portfolio before and after cost."""
    e = evaluate.evaluation(_panel(spark, sf_dir), horizon=4, lags=3, n=5, least=5, cost=0.001, periods=52)
    digits = {"dates": None, "half_life": None, "t": 4, "sharpe": 4}
    return e.select(*[F.col(c) if digits.get(c, 6) is None else F.round(c, digits.get(c, 6)).alias(c) for c in e.columns])


# At a hundredth of the capital: weekly prices of suppliers move so much that whole capital would be lost at once.
@query(f"""WITH {_TEST}, n AS (SELECT date, (gross - 0.001 * turnover) / 100 AS r FROM daily), e AS (SELECT *, product(1 + r) OVER (ORDER BY date) AS e FROM n), d AS (SELECT *, e / greatest(max(e) OVER (ORDER BY date), 1) - 1 AS dd FROM e)
  SELECT round(ln(product(1 + r)), 5) AS log_total, round(stddev_samp(r) * sqrt(52), 5) AS volatility, round(avg(r) / stddev_samp(r) * sqrt(52), 4) AS sharpe, round(min(dd), 5) AS max_drawdown FROM d""")
def performance(spark, sf_dir):
    p = evaluate.performance(evaluate.backtest(_panel(spark, sf_dir), 5, 5, 0.001).withColumn("net", F.col("net") / 100), "net", 52)
    return p.select(F.round(F.log1p("total"), 5).alias("log_total"), F.round("volatility", 5).alias("volatility"), F.round("sharpe", 4).alias("sharpe"), F.round("max_drawdown", 5).alias("max_drawdown"))


# Scalar functions


@query("""WITH a AS (SELECT event_id, ts, timezone('America/New_York', timezone('UTC', ts)) AS et FROM events), b AS (SELECT *, isodow(et) AS d, et::TIME AS t FROM a),
  c AS (SELECT *, d < 6 AND t >= TIME '09:30:00' AND t <= TIME '16:00:00' AS at_once, CASE WHEN d = 6 THEN 2 WHEN d = 7 THEN 1 WHEN t <= TIME '16:00:00' THEN 0 WHEN d = 5 THEN 3 ELSE 1 END AS ahead FROM b)
  SELECT event_id, NOT at_once AS late, strftime(CASE WHEN at_once THEN et ELSE et::DATE + ahead::INT + INTERVAL '9 hours 30 minutes' END, '%Y-%m-%d %H:%M:%S') AS visible,
  strftime(last_day(date_trunc('quarter', ts)::DATE + INTERVAL 2 MONTH), '%Y-%m-%d') AS quarter FROM c""")
def visibility(spark, sf_dir):
    et = new_york(F.col("ts"))
    v = visible_at(et)
    return events(spark, sf_dir).select("event_id", (v != et).alias("late"), F.date_format(v, "yyyy-MM-dd HH:mm:ss").alias("visible"), F.date_format(quarter_end(F.col("ts").cast("date")), "yyyy-MM-dd").alias("quarter"))


@query("""SELECT p_partkey, regexp_replace(trim(regexp_replace(replace(replace(lower(concat(p_name, ' & Co., Inc.')), '.', ''), '''', ''), '[^a-z0-9]+', ' ', 'g')), '( (inc|corp|ltd|llc|co|plc))+$', '') AS name FROM part""")
def normal_names(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", normal_name(F.concat("p_name", F.lit(" & Co., Inc."))).alias("name"))


from tidemark import queries_archives, queries_checks, queries_composites, queries_evaluation, queries_filings, queries_fundamentals, queries_intraday, queries_master, queries_outcomes, queries_quality, queries_records  # noqa: E402, F401
