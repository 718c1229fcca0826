"""Queries on data quality, identity, universes and texts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import text as tx
from tidemark.operators import identity as idn
from tidemark.operators import joins, windows, writes
from tidemark.plans import factors
from tidemark.queries import GRID, grid, r6
from tidemark.registry import query
from tidemark.sources.market import ctes, view
from tidemark.sources.views import events, table


def day(x):
    return F.date_format(x, "yyyy-MM-dd")


# Bars and calendars


@query(f"""WITH {ctes('daily')} SELECT count(*) AS n, count(*) FILTER (WHERE high < low OR high < open OR high < close OR low > open OR low > close) AS disordered, count(*) FILTER (WHERE least(open, high, low, close) <= 0) AS not_positive,
  count(*) FILTER (WHERE volume < 0) AS negative_volume, count(*) FILTER (WHERE open IS NULL) AS without_open FROM daily""")
def bar_validity(spark, sf_dir):
    c = F.col
    bad = (c("high") < c("low")) | (c("high") < c("open")) | (c("high") < c("close")) | (c("low") > c("open")) | (c("low") > c("close"))
    return view(spark, sf_dir, "daily").agg(F.count("*").alias("n"), F.count_if(bad).alias("disordered"), F.count_if(F.least("open", "high", "low", "close") <= 0).alias("not_positive"), F.count_if(c("volume") < 0).alias("negative_volume"), F.count_if(c("open").isNull()).alias("without_open"))


@query(f"""WITH {ctes('daily')} SELECT CASE WHEN open IS NULL AND volume < 20 THEN 'neither' WHEN open IS NULL THEN 'volume' WHEN volume < 20 THEN 'open' ELSE 'both' END AS source, count(*) AS n, count(*) FILTER (WHERE high > 1.5 * low) AS wide FROM daily GROUP BY 1""")
def source_fingerprint(spark, sf_dir):
    """Bars by the pattern of what they lack, with the violations of each."""
    d = view(spark, sf_dir, "daily")
    no_open, thin = F.col("open").isNull(), F.col("volume") < 20
    return d.groupBy(F.when(no_open & thin, "neither").when(no_open, "volume").when(thin, "open").otherwise("both").alias("source")).agg(F.count("*").alias("n"), F.count_if(F.col("high") > 1.5 * F.col("low")).alias("wide"))


@query(f"""WITH {GRID}, cal AS (SELECT DISTINCT date FROM bars), s AS (SELECT security_id, min(date) AS a, max(date) AS b FROM bars GROUP BY 1),
  m AS (SELECT security_id, cal.date FROM s JOIN cal ON cal.date BETWEEN a AND b WHERE NOT EXISTS (SELECT 1 FROM bars WHERE bars.security_id = s.security_id AND bars.date = cal.date)),
  g AS (SELECT *, CASE WHEN date - lag(date) OVER (PARTITION BY security_id ORDER BY date) <= 7 THEN 0 ELSE 1 END AS new FROM m), r AS (SELECT *, sum(new) OVER (PARTITION BY security_id ORDER BY date) AS run FROM g)
  SELECT security_id, strftime(min(date), '%Y-%m-%d') AS first, count(*) AS sessions FROM r GROUP BY security_id, run HAVING count(*) >= 3""")
def calendar_gaps(spark, sf_dir):
    """Runs of three sessions and more that a security has no bar for, inside its own history."""
    missing = grid(spark, sf_dir).where("close is null").select("security_id", F.col("date").cast("timestamp").alias("at"))
    r = windows.runs(missing, "security_id", "at", 7 * 86400, 3)
    return r.select("security_id", day("first").alias("first"), F.col("n").alias("sessions"))


@query(f"""WITH {ctes('daily', 'actions')}, j AS (SELECT security_id, date, lag(date) OVER o AS prev_date, close / lag(close) OVER o - 1 AS ret FROM daily WINDOW o AS (PARTITION BY security_id ORDER BY date))
  SELECT security_id, strftime(date, '%Y-%m-%d') AS date, round(ret, 6) AS ret FROM j WHERE abs(ret) > 0.8 AND NOT EXISTS (SELECT 1 FROM actions a WHERE a.security_id = j.security_id AND a.ex_date > prev_date AND a.ex_date <= date)""")
def unexplained_jumps(spark, sf_dir):
    """Large moves without an action since the bar before: the latest action up to the day is older than that bar."""
    w = Window.partitionBy("security_id").orderBy("date")
    j = view(spark, sf_dir, "daily").select("security_id", "date", F.lag("date").over(w).alias("prev_date"), (F.col("close") / F.lag("close").over(w) - 1).alias("ret")).where(F.abs("ret") > 0.8)
    a = joins.as_of(j, view(spark, sf_dir, "actions"), "security_id", "date", "ex_date", "event_id", ["ex_date"])
    return a.where("asof_ex_date is null or asof_ex_date <= prev_date").select("security_id", day("date").alias("date"), r6("ret").alias("ret"))


@query(f"""WITH {ctes('daily', 'actions')}, p AS (SELECT a.*, b.close AS prev FROM (SELECT * FROM actions WHERE kind = 'split' AND split_from <> split_to) a ASOF LEFT JOIN daily b ON a.security_id = b.security_id AND a.ex_date > b.date), n AS (SELECT p.*, d.close AS next FROM p ASOF LEFT JOIN daily d ON p.security_id = d.security_id AND p.ex_date <= d.date)
  SELECT event_id, CASE WHEN prev IS NULL OR next IS NULL THEN 'inconclusive' WHEN abs(next / prev / (split_from / split_to) - 1) <= 0.25 THEN 'corroborated' WHEN abs(next / prev - 1) <= 0.25 THEN 'refuted' ELSE 'inconclusive' END AS verdict FROM n""")
def split_corroboration(spark, sf_dir):
    from tidemark.operators.events import around

    s = view(spark, sf_dir, "actions").where("kind = 'split' and split_from <> split_to")
    a = around(s, view(spark, sf_dir, "daily"), "security_id", "ex_date", "date", "close")
    moved, asked = F.col("next_close") / F.col("prev_close"), F.col("split_from") / F.col("split_to")
    verdict = F.when(F.col("prev_close").isNull() | F.col("next_close").isNull(), "inconclusive").when(F.abs(moved / asked - 1) <= 0.25, "corroborated").when(F.abs(moved - 1) <= 0.25, "refuted").otherwise("inconclusive")
    return a.select("event_id", verdict.alias("verdict"))


@query(f"""WITH {ctes('daily', 'securities')}, m AS (SELECT security_id, max(date) AS newest, count(*) AS n FROM daily GROUP BY 1)
  SELECT s.security_id, strftime(newest, '%Y-%m-%d') AS newest, n, newest IS DISTINCT FROM delist_date AS differs FROM securities s LEFT JOIN m USING (security_id)""")
def watermarks(spark, sf_dir):
    m = view(spark, sf_dir, "daily").groupBy("security_id").agg(F.max("date").alias("newest"), F.count("*").alias("n"))
    s = view(spark, sf_dir, "securities").join(m, "security_id", "left")
    return s.select("security_id", day("newest").alias("newest"), "n", (~F.col("newest").eqNullSafe(F.col("delist_date"))).alias("differs"))


@query(f"""WITH {ctes('daily', 'securities')} SELECT max(date)::VARCHAR AS newest, count(DISTINCT security_id) AS securities, date_diff('day', max(date), DATE '2002-01-01') AS age, date_diff('day', max(date), DATE '2002-01-01') > 30 AS stale FROM daily""")
def staleness(spark, sf_dir):
    age = F.datediff(F.lit("2002-01-01").cast("date"), F.max("date"))
    return view(spark, sf_dir, "daily").agg(F.max("date").cast("string").alias("newest"), F.countDistinct("security_id").alias("securities"), age.cast("long").alias("age"), (age > 30).alias("stale"))


# Universe

_LISTED = f"""{GRID}, {ctes('securities')}, u AS (SELECT g.security_id, g.date, g.date >= coalesce(list_date, DATE '1900-01-01') AND g.date <= coalesce(delist_date, DATE '2999-12-31') AS listed, close IS NOT NULL AS priced,
  coalesce(quantile_cont(close * volume, 0.5) OVER w >= 20000 AND close >= 900 AND count(close * volume) OVER w >= 42, false) AS fit FROM grid g JOIN securities s USING (security_id) WINDOW w AS (PARTITION BY g.security_id ORDER BY g.date ROWS 62 PRECEDING))"""


def _universe(spark, sf_dir):
    """The grid with listed, priced and fit; the day of delisting itself is listed, and a null date is open."""
    s = view(spark, sf_dir, "securities").select("security_id", "list_date", "delist_date")
    e = factors.eligible(grid(spark, sf_dir), 900, 20000).withColumnRenamed("eligible", "fit").join(s, "security_id")
    listed = (F.col("date") >= F.coalesce("list_date", F.lit("1900-01-01").cast("date"))) & (F.col("date") <= F.coalesce("delist_date", F.lit("2999-12-31").cast("date")))
    return e.select("security_id", "date", listed.alias("listed"), F.col("close").isNotNull().alias("priced"), "fit")


@query(f"WITH {_LISTED} SELECT security_id, count(*) FILTER (WHERE listed) AS listed, count(*) FILTER (WHERE listed AND priced) AS priced, count(*) FILTER (WHERE listed AND priced AND fit) AS eligible FROM u GROUP BY 1")
def universe_layers(spark, sf_dir):
    return _universe(spark, sf_dir).groupBy("security_id").agg(F.count_if("listed").alias("listed"), F.count_if(F.col("listed") & F.col("priced")).alias("priced"), F.count_if(F.col("listed") & F.col("priced") & F.col("fit")).alias("eligible"))


@query(f"WITH {_LISTED}, i AS (SELECT DISTINCT security_id FROM u WHERE listed AND priced) SELECT count(*) AS n, sha256('1995-01-01|2001-12-31|' || string_agg(security_id::VARCHAR, ',' ORDER BY security_id))[:16] AS hash FROM i")
def universe_hash(spark, sf_dir):
    """The first digits of a hash of range and ids; the ids meet in one array, of one universe."""
    i = _universe(spark, sf_dir).where("listed and priced").agg(F.sort_array(F.collect_set("security_id")).alias("ids"))
    return i.select(F.size("ids").cast("long").alias("n"), F.substring(F.sha2(F.concat(F.lit("1995-01-01|2001-12-31|"), F.array_join(F.col("ids").cast("array<string>"), ",")), 256), 1, 16).alias("hash"))


# Industries: fixed values, the ranges of a small scheme, the first match counts
RANGES = ((0, 4, "Durables"), (5, 9, "Energy"), (10, 14, "Finance"), (15, 19, "Health"))


@query(f"""SELECT s_suppkey, CASE {" ".join(f"WHEN s_nationkey BETWEEN {a} AND {b} THEN '{n}'" for a, b, n in RANGES)} ELSE 'Other' END AS industry FROM supplier""")
def industries(spark, sf_dir):
    c = F.when(F.lit(False), "")
    for a, b, name in RANGES:
        c = c.when(F.col("s_nationkey").between(a, b), name)
    return table(spark, sf_dir, "supplier").select("s_suppkey", c.otherwise("Other").alias("industry"))


@query("""SELECT p_brand, count(*) AS n, count(*) FILTER (WHERE p_size <= 5) AS small, count(*) FILTER (WHERE p_size > 5 AND p_size <= 25) AS medium, round(100.0 * count(*) FILTER (WHERE p_retailprice > 1000) / count(*), 2) AS pct FROM part GROUP BY 1""")
def coverage_report(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(F.count("*").alias("n"), F.count_if(F.col("p_size") <= 5).alias("small"), F.count_if((F.col("p_size") > 5) & (F.col("p_size") <= 25)).alias("medium"), F.round(100.0 * F.count_if(F.col("p_retailprice") > 1000) / F.count("*"), 2).alias("pct"))


# Identity


@query(f"""WITH {ctes('spans')} SELECT a.tenure_id AS a, b.tenure_id AS b, strftime(greatest(a.start_date, b.start_date), '%Y-%m-%d') AS first FROM spans a JOIN spans b ON a.symbol = b.symbol AND a.tenure_id < b.tenure_id AND a.security_id <> b.security_id
  WHERE a.start_date <= coalesce(b.end_date, DATE '2002-12-31') AND b.start_date <= coalesce(a.end_date, DATE '2002-12-31') AND least(coalesce(a.end_date, DATE '2002-12-31'), coalesce(b.end_date, DATE '2002-12-31')) >= DATE '1998-01-01'""")
def recycled_symbols(spark, sf_dir):
    s = view(spark, sf_dir, "spans")
    o = idn.overlaps(s, "symbol", "tenure_id", "start_date", "end_date", "2002-12-31").where("until >= date'1998-01-01'")
    of = lambda c: s.select(F.col("tenure_id").alias(c), F.col("security_id").alias(f"s_{c}"))
    return o.join(of("a"), "a").join(of("b"), "b").where("s_a <> s_b").select("a", "b", day("first").alias("first"))


_CLOSED = "closed AS (SELECT tenure_id, security_id % 20 AS owner, start_date AS s, end_date AS e FROM spans WHERE end_date IS NOT NULL)"


@query(f"""WITH {ctes('spans')}, {_CLOSED}, d AS (SELECT owner, unnest(generate_series(s, e - 1, INTERVAL 1 DAY))::DATE AS d, tenure_id FROM closed), one AS (SELECT owner, d, min(tenure_id) AS id FROM d GROUP BY 1, 2 HAVING count(*) = 1)
  SELECT id, count(*) AS days FROM one GROUP BY 1""")
def lone_tenures(spark, sf_dir):
    """The days that a tenure has for itself, what overlaps taken off both sides."""
    s = view(spark, sf_dir, "spans").where("end_date is not null").withColumn("owner", F.col("security_id") % 20)
    a = idn.alone(s, "owner", "tenure_id", "start_date", "end_date")
    return a.groupBy("id").agg(F.sum(F.datediff("end", "start")).cast("long").alias("days"))


@query(f"WITH {ctes('securities')} SELECT symbol, array_to_string(list(security_id ORDER BY security_id), ',') AS ids FROM securities GROUP BY 1 HAVING count(DISTINCT security_id) > 1")
def shared_symbols(spark, sf_dir):
    return idn.shared(view(spark, sf_dir, "securities"), "symbol", "security_id").select("symbol", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


@query(f"WITH {ctes('securities')} SELECT symbol, count(*) AS n, min(security_id) AS lowest FROM securities WHERE is_active GROUP BY 1 HAVING count(*) > 1")
def active_collisions(spark, sf_dir):
    return view(spark, sf_dir, "securities").where("is_active").groupBy("symbol").agg(F.count("*").alias("n"), F.min("security_id").alias("lowest")).where("n > 1")


@query("""WITH p AS (SELECT DISTINCT c_custkey // 2 AS a, CASE WHEN c_custkey % 4 < 2 THEN c_custkey // 2 ELSE c_custkey END AS b FROM customer) SELECT a, b FROM p QUALIFY count(*) OVER (PARTITION BY a) = 1 AND count(*) OVER (PARTITION BY b) = 1""")
def one_to_one(spark, sf_dir):
    k = F.col("c_custkey")
    half = F.floor(k / 2)
    return idn.one_to_one(table(spark, sf_dir, "customer").select(half.alias("a"), F.when(k % 4 < 2, half).otherwise(k).alias("b")), "a", "b")


_INCOMING = "incoming AS (SELECT c_custkey AS row_id, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey % 40 END AS figi, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_nationkey END AS cik FROM customer), known AS (SELECT s_suppkey AS security_id, s_suppkey % 37 AS figi, s_nationkey AS cik FROM supplier)"


@query(f"""WITH {_INCOMING}, f AS (SELECT figi, min(security_id) AS x FROM known GROUP BY 1 HAVING count(DISTINCT security_id) = 1), c AS (SELECT cik, min(security_id) AS y FROM known GROUP BY 1 HAVING count(DISTINCT security_id) = 1)
  SELECT row_id, CASE WHEN x <> y THEN 'conflict' WHEN x IS NOT NULL THEN 'figi' WHEN y IS NOT NULL THEN 'cik' ELSE 'new' END AS resolution, CASE WHEN x <> y THEN NULL ELSE coalesce(x, y) END AS security_id FROM incoming LEFT JOIN f USING (figi) LEFT JOIN c USING (cik)""")
def identity_resolution(spark, sf_dir):
    i = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("row_id"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey") % 40).alias("figi"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_nationkey")).alias("cik"))
    k = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("security_id"), (F.col("s_suppkey") % 37).alias("figi"), F.col("s_nationkey").alias("cik"))
    return idn.resolved(i, k, "security_id", ["figi", "cik"], "row_id")


@query(f"""WITH {ctes('securities')} SELECT cik, min(security_id) AS seed, count(*) AS members, CASE WHEN count(*) FILTER (WHERE is_active) > 1 THEN 'dual' WHEN count(*) FILTER (WHERE is_active) = 0 THEN 'inactive' ELSE 'single' END AS kind, coalesce(min(security_id) FILTER (WHERE is_active), min(security_id)) AS anchor FROM securities GROUP BY 1""")
def company_groups(spark, sf_dir):
    """Securities of one filer: the lowest active id is the anchor, else the lowest."""
    active = F.count_if("is_active")
    return view(spark, sf_dir, "securities").groupBy("cik").agg(F.min("security_id").alias("seed"), F.count("*").alias("members"), F.when(active > 1, "dual").when(active == 0, "inactive").otherwise("single").alias("kind"), F.coalesce(F.min(F.when(F.col("is_active"), F.col("security_id"))), F.min("security_id")).alias("anchor"))


# Limits, samples, sets


@query(f"WITH {ctes('daily')} SELECT security_id, strftime(date, '%Y-%m-%d') AS date, round(high / low, 6) AS spread FROM daily ORDER BY high / low DESC, security_id, date LIMIT 20")
def widest_bars(spark, sf_dir):
    return view(spark, sf_dir, "daily").orderBy(F.desc(F.col("high") / F.col("low")), "security_id", "date").limit(20).select("security_id", day("date").alias("date"), r6(F.col("high") / F.col("low")).alias("spread"))


@query("""SELECT o_orderpriority, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5(o_orderkey::VARCHAR || '|7'), o_orderkey) <= 10""")
def stratified_sample(spark, sf_dir):
    """A quota of every stratum, drawn by a seeded hash and so the same on every run."""
    w = Window.partitionBy("o_orderpriority").orderBy(F.md5(F.concat_ws("|", F.col("o_orderkey").cast("string"), F.lit("7"))), "o_orderkey")
    return table(spark, sf_dir, "orders").withColumn("r", F.row_number().over(w)).where("r <= 10").select("o_orderpriority", "o_orderkey")


@query(f"""WITH {ctes('daily')}, m AS (SELECT security_id, date_trunc('month', date)::DATE AS m, sum(volume) AS v FROM daily GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY m ORDER BY v DESC, security_id) AS r FROM m), h AS (SELECT m, security_id, r, lag(r) OVER (PARTITION BY security_id ORDER BY m) <= 3 AS before FROM r)
  SELECT strftime(m, '%Y-%m') AS month, security_id, coalesce(before, false) AS kept FROM h WHERE r <= 3""")
def monthly_leaders(spark, sf_dir):
    """The leaders of each month, and whether they led in their month before."""
    m = view(spark, sf_dir, "daily").groupBy("security_id", F.trunc("date", "month").alias("m")).agg(F.sum("volume").alias("v"))
    r = m.withColumn("r", F.row_number().over(Window.partitionBy("m").orderBy(F.desc("v"), "security_id")))
    kept = F.coalesce(F.lag("r").over(Window.partitionBy("security_id").orderBy("m")) <= 3, F.lit(False))
    return r.withColumn("kept", kept).where("r <= 3").select(F.date_format("m", "yyyy-MM").alias("month"), "security_id", "kept")


# Writes


@query("""SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS bal, CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_mktsegment END AS seg FROM customer""")
def presence_upsert(spark, sf_dir):
    """A batch whose rows name what they give: a column that isn't given stays, one given as null is erased."""
    c = table(spark, sf_dir, "customer")
    old = c.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("seg"))
    batch = c.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("id"), (F.col("c_acctbal") + 1).alias("bal"), F.lit(None).cast("string").alias("seg"), F.when(F.col("c_custkey") % 3 == 0, F.array(F.lit("bal"), F.lit("seg"))).otherwise(F.array(F.lit("bal"))).alias("given"))
    return writes.by_presence(old, batch, ["id"], "given")


@query("""SELECT c_custkey AS id, coalesce(CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END, 'filled') AS seg FROM customer""")
def fill_upsert(spark, sf_dir):
    """Links that are known are never erased: the old value unless it is null."""
    c = table(spark, sf_dir, "customer")
    old = c.select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")).alias("seg"))
    return writes.upsert(old, c.select(F.col("c_custkey").alias("id"), F.lit("filled").alias("seg")), ["id"], fill=["seg"])


@query("""SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS newest FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def replaced(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("version", F.struct("o_orderdate", "o_orderkey"))
    return writes.replaced(o, ["o_custkey"], "version").select("o_custkey", "o_orderkey", day("o_orderdate").alias("newest"))


@query("""WITH s AS (SELECT o_orderkey AS k, o_totalprice AS v, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS close, o_custkey AS c FROM orders WHERE o_orderkey % 3 <> 0), j AS (SELECT CASE WHEN o.o_orderkey IS NULL THEN 'missing' WHEN s.close <> o.o_totalprice THEN 'mismatch' WHEN o.o_orderstatus = 'F' THEN 'known' ELSE 'updated' END AS bucket FROM s LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 2 = 0) o ON s.k = o.o_orderkey) SELECT bucket, count(*) AS n FROM j GROUP BY 1""")
def staged_update(spark, sf_dir):
    """Where staged rows end up: without a target, with another close, known already, or updated."""
    o = table(spark, sf_dir, "orders")
    s = o.where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("k"), F.when(F.col("o_orderkey") % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("close"))
    t = o.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("k"), "o_totalprice", "o_orderstatus")
    bucket = F.when(F.col("o_totalprice").isNull(), "missing").when(F.col("close") != F.col("o_totalprice"), "mismatch").when(F.col("o_orderstatus") == "F", "known").otherwise("updated")
    return s.join(t, "k", "left").groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


# Texts


_ENTITY_SQL = "x"
for _entity, _plain in tx.ENTITIES.items():
    _ENTITY_SQL = f"replace({_ENTITY_SQL}, '{_entity}', '{_plain.replace(chr(39), chr(39) * 2)}')"


@query(rf"""WITH tagless AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '<!--.*?-->', ' ', 'gs'), '<(script|style)\b.*?</(script|style)\s*>', ' ', 'gis'), '<[^>]*>', ' ', 'gs') AS x FROM pages),
  decoded AS (SELECT page_id, regexp_replace(replace({_ENTITY_SQL}, '&amp;', chr(1)), '&#?[A-Za-z0-9]+;', ' ', 'g') AS x FROM tagless)
  SELECT page_id, length(replace(trim(regexp_replace(regexp_replace(x, '[\s ]+', ' ', 'g'), ' ([,.;:)])', '\1', 'g')), chr(1), '&'))::INT AS n FROM decoded""")
def stripped_pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.length(tx.strip_html(F.col("html"))).alias("n"))


@query("""SELECT o_orderkey, len(list_filter(string_split('2.02, ' || (o_orderkey % 9)::VARCHAR || '.01,5.02', ','), lambda x: trim(x) = '2.01')) > 0 AS has FROM orders""")
def filing_items(spark, sf_dir):
    items = F.concat(F.lit("2.02, "), (F.col("o_orderkey") % 9).cast("string"), F.lit(".01,5.02"))
    return table(spark, sf_dir, "orders").select("o_orderkey", tx.has_item(items, "2.01").alias("has"))


@query("""SELECT p_partkey, NOT regexp_matches(lower(concat(p_name, CASE p_partkey % 4 WHEN 0 THEN ' 5% Notes' WHEN 1 THEN ' due 2031' ELSE '' END)), '\\b(note|notes|preferred|unit|units|warrant|warrants|right|rights|debenture|debentures)\\b|\\bdue 20[0-9]{2}\\b|%') AS common FROM part""")
def common_equity(spark, sf_dir):
    name = F.concat("p_name", F.when(F.col("p_partkey") % 4 == 0, " 5% Notes").when(F.col("p_partkey") % 4 == 1, " due 2031").otherwise(""))
    return table(spark, sf_dir, "part").select("p_partkey", tx.common_equity(name).alias("common"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 8 < 5 THEN floor(o_totalprice) / 4 END AS amount, CASE WHEN o_orderkey % 8 = 1 THEN 2 WHEN o_orderkey % 8 < 5 THEN 1 ELSE 0 END AS mentions FROM orders WHERE o_totalprice < 40000""")
def cash_amounts(spark, sf_dir):
    """Cash per share in sentences of eight kinds, three of which only name totals, dividends or other sums."""
    o = table(spark, sf_dir, "orders").where("o_totalprice < 40000").withColumn("a", F.format_number(F.floor("o_totalprice") / 4, 2))
    kinds = [
        "each share became the right to receive $%s in cash, without interest, of $12,345,678.00 in all", "the right to receive $%1$s in cash. Again, $%1$s per share in cash", "a per share consideration of $%s in cash",
        "cash in an amount equal to $%s per share, for $3 billion", "a tender offer to purchase all outstanding shares at a price of $%s per share", "the aggregate consideration of $%s in cash",
        "a cash dividend of $%s per share", "the company repaid $%s of debt; holders have the right to receive $25.00 plus accrued and unpaid dividends per share",
    ]
    text = F.format_string(kinds[0], "a")
    for i, k in enumerate(kinds[1:], 1):
        text = F.when(F.col("o_orderkey") % 8 == i, F.format_string(k, "a")).otherwise(text)
    found = tx.per_share_cash(text)
    return o.select("o_orderkey", F.get(found, F.lit(0)).alias("amount"), F.size(found).alias("mentions"))


@query("""SELECT o_orderkey, (o_custkey % 10)::VARCHAR AS acquirer FROM orders""")
def evidence_tokens(spark, sf_dir):
    evidence = F.concat(F.lit("form=8-K|acquirer="), (F.col("o_custkey") % 10).cast("string"), F.lit("|note"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.element_at(tx.tokens(evidence), "acquirer").alias("acquirer"))
