"""Queries on archives: days of bars and their load, prices by volume, splits, dividends and changes of tickers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.writes import upsert
from tidemark.registry import query
from tidemark.sources import archives
from tidemark.sources.market import ctes, view
from tidemark.sources.views import table

_DAY = "%Y-%m-%d"


def day(x):
    return F.date_format(x, "yyyy-MM-dd")


# A file holds a day of at most a thousand suppliers; tickers are of three suppliers each, tenures those of customers.

_LINES = f"""{ctes('daily', 'spans')}, l AS (SELECT date, security_id // 1000 AS block, 'S' || (security_id // 3)::VARCHAR || CASE WHEN security_id % 17 = 0 THEN 'p' ELSE '' END AS ticker, security_id + day(date) AS k, floor(close) AS close, volume::BIGINT AS volume,
    row_number() OVER (PARTITION BY date, security_id // 1000 ORDER BY security_id) AS n FROM daily),
  asked AS (SELECT DISTINCT ticker, date FROM l), hits AS (SELECT ticker, date, min(security_id) AS lo, max(security_id) AS hi FROM asked JOIN spans ON symbol = ticker AND date >= start_date AND (end_date IS NULL OR date < end_date) GROUP BY 1, 2),
  r AS (SELECT l.*, CASE WHEN k % 29 = 0 THEN 'width' WHEN k % 31 = 0 THEN 'price' WHEN ticker LIKE '%p' THEN 'class' WHEN ticker NOT IN (SELECT symbol FROM spans) THEN 'symbol' WHEN lo IS NULL THEN 'tenure' WHEN lo <> hi THEN 'ambiguous' END AS reason, lo FROM l LEFT JOIN hits USING (ticker, date) WHERE day(date) <> 13),
  load AS (SELECT lo AS security_id, date, close, CASE WHEN volume >= 10 THEN volume END AS trade_count FROM r WHERE reason IS NULL QUALIFY row_number() OVER (PARTITION BY lo, date ORDER BY block::VARCHAR DESC, n DESC) = 1)"""


def _files(spark, sf_dir):
    """(archive, member, day, text) as the readers of files give it."""
    d = view(spark, sf_dir, "daily")
    block, k = F.floor(F.col("security_id") / 1000), F.col("security_id") + F.day("date")
    ticker = F.concat(F.lit("S"), F.floor(F.col("security_id") / 3).cast("string"), F.when(F.col("security_id") % 17 == 0, "p").otherwise(""))
    close, volume = F.floor("close").cast("string"), F.col("volume").cast("bigint")
    low = F.when(k % 31 == 0, "0").otherwise(close)
    line = F.concat_ws(",", ticker, volume.cast("string"), close, close, close, low, F.lit("0"), F.when(volume >= 10, volume.cast("string")).otherwise(""), F.when(k % 29 == 0, "more"))
    files = d.groupBy("date", block.alias("block")).agg(F.array_sort(F.collect_list(F.struct("security_id", line.alias("line")))).alias("lines"))  # a thousand lines at most
    header = F.when(F.day("date") == 13, "ticker,open").otherwise(",".join(archives.HEADER))
    member = F.concat(F.col("block").cast("string"), F.lit("/"), day("date"), F.lit(".csv.gz"))
    return files.select(F.lit(None).cast("string").alias("archive"), member.alias("member"), F.col("date").alias("day"), F.array_join(F.concat(F.array(header), F.col("lines.line")), "\n").alias("text"))


def _tenures(spark, sf_dir):
    return view(spark, sf_dir, "spans").select("security_id", "symbol", F.col("start_date").alias("start"), F.col("end_date").alias("end"))


def _load(spark, sf_dir):
    return archives.loaded(archives.day_bars(_files(spark, sf_dir), _tenures(spark, sf_dir)))


@query(f"""WITH {_LINES} SELECT strftime(date, '{_DAY}') AS day, block, n, ticker, CASE WHEN reason IS NULL THEN lo END AS security_id, CASE WHEN reason IS DISTINCT FROM 'width' THEN close END AS close, reason FROM r
  UNION ALL SELECT DISTINCT strftime(date, '{_DAY}'), block, 0, NULL, NULL::BIGINT, NULL::DOUBLE, 'header' FROM l WHERE day(date) = 13""")
def day_archive(spark, sf_dir):
    """Every line of the files with the security it is of, or why it isn't loaded."""
    r = archives.day_bars(_files(spark, sf_dir), _tenures(spark, sf_dir))
    read = F.col("reason").isNull() | ~F.col("reason").isin("header", "width")
    return r.select(
        day("day").alias("day"), F.split_part("member", F.lit("/"), F.lit(1)).cast("bigint").alias("block"), F.col("n").cast("bigint").alias("n"), F.when(~F.col("reason").eqNullSafe("header"), F.col("ticker")).alias("ticker"),
        F.col("security_id").cast("bigint").alias("security_id"), F.when(read, F.col("close").cast("double")).alias("close"), "reason",
    )


_STORED = "stored AS (SELECT o_custkey AS security_id, o_orderdate::DATE AS date, floor(max(o_totalprice)) AS close, CASE WHEN max(o_orderkey) % 2 = 0 THEN 1 END AS trade_count, CASE WHEN max(o_orderkey) % 3 = 0 THEN floor(max(o_totalprice)) + 1 END AS vwap FROM orders GROUP BY 1, 2)"


def _stored(spark, sf_dir):
    close, last = F.floor(F.max("o_totalprice")), F.max("o_orderkey")
    s = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("security_id"), F.col("o_orderdate").cast("date").alias("date")).agg(close.alias("c"), last.alias("k"))
    price = F.col("c").cast("decimal(18,6)")
    return s.select("security_id", "date", *[price.alias(x) for x in ("open", "high", "low", "close")], F.lit(1).cast("bigint").alias("volume"), F.when(F.col("k") % 2 == 0, 1).cast("bigint").alias("trade_count"), F.when(F.col("k") % 3 == 0, (F.col("c") + 1).cast("double")).alias("vwap"))


@query(f"""WITH {_LINES}, {_STORED}, b AS (SELECT coalesce(s.security_id, p.security_id) AS security_id, coalesce(s.date, p.date) AS date, CASE WHEN p.date IS NULL THEN s.close ELSE p.close END AS close, CASE WHEN p.date IS NULL THEN s.trade_count ELSE p.trade_count END AS trade_count, s.vwap, p.date IS NOT NULL AS own
    FROM stored s FULL JOIN load p ON s.security_id = p.security_id AND s.date = p.date)
  SELECT security_id, strftime(date, '{_DAY}') AS date, close, trade_count, vwap FROM b WHERE own OR vwap IS NOT NULL OR trade_count IS NOT NULL OR security_id NOT IN (SELECT security_id FROM load) OR date NOT BETWEEN (SELECT min(date) FROM load) AND (SELECT max(date) FROM load)""")
def archive_reload(spark, sf_dir):
    """Stored bars after the load of all files: replaced, added, and rid of ghosts."""
    return archives.reloaded(_stored(spark, sf_dir), _load(spark, sf_dir)).select("security_id", day("date").alias("date"), F.col("close").cast("double").alias("close"), "trade_count", "vwap")


_STAGED = f"""{_LINES}, {_STORED}, tree AS (SELECT ticker AS symbol, date, CASE WHEN k % 5 = 0 THEN close + 1 ELSE close END AS close, CASE WHEN k % 7 = 0 THEN 0 ELSE close + k % 3 END AS vw, k % 2 AS place FROM l WHERE date < DATE '1998-01-01' AND ticker NOT LIKE '%p'),
  staged AS (SELECT lo AS security_id, tree.* FROM tree JOIN hits h ON h.ticker = symbol AND h.date = tree.date WHERE lo = hi AND vw > 0),
  prices AS (SELECT security_id, date, close, trade_count, NULL::DOUBLE AS vwap FROM load UNION ALL SELECT security_id, date, close, trade_count, vwap FROM stored s WHERE NOT EXISTS (FROM load p WHERE p.security_id = s.security_id AND p.date = s.date))"""


def _priced(spark, sf_dir):
    """(staged, prices): what a tree of prices by volume holds, and the bars it may fill."""
    load, d = _load(spark, sf_dir).withColumn("vwap", F.lit(None).cast("double")), view(spark, sf_dir, "daily")
    stored = _stored(spark, sf_dir)
    prices = upsert(stored, load, ["security_id", "date"], overwrite=[c for c in stored.columns if c not in ("security_id", "date")])
    k, close = F.col("security_id") + F.day("date"), F.floor("close")
    ticker = F.concat(F.lit("S"), F.floor(F.col("security_id") / 3).cast("string"), F.when(F.col("security_id") % 17 == 0, "p").otherwise(""))
    tree = d.select(ticker.alias("symbol"), "date", F.when(k % 7 == 0, 0).otherwise(close + k % 3).cast("double").alias("vw"), F.when(k % 5 == 0, close + 1).otherwise(close).cast("decimal(18,6)").alias("close"), (k % 2).cast("int").alias("place"))
    return archives.vwap_rows(tree, _tenures(spark, sf_dir), before="1998-01-01").where("reason is null"), prices


@query(f"""WITH {_STAGED} SELECT s.security_id, strftime(s.date, '{_DAY}') AS date, s.vw::DOUBLE AS vw, s.close, s.place::INT AS place, CASE WHEN p.date IS NULL THEN 'missing' WHEN p.vwap IS NOT NULL THEN 'known' WHEN p.trade_count IS NULL THEN 'bare' WHEN p.close = s.close THEN 'update' ELSE 'mismatch' END AS bucket
  FROM staged s LEFT JOIN prices p ON p.security_id = s.security_id AND p.date = s.date""")
def vwap_buckets(spark, sf_dir):
    """Every attributed price by volume with what becomes of it."""
    return archives.vwap_buckets(*_priced(spark, sf_dir)).select("security_id", day("date").alias("date"), "vw", F.col("close").cast("double").alias("close"), "place", "bucket")


@query(f"""WITH {_STAGED}, s AS (SELECT security_id, date, close, arg_min(vw, {{'p': place, 'v': vw}}) AS vw FROM staged GROUP BY 1, 2, 3)
  SELECT p.security_id, strftime(p.date, '{_DAY}') AS date, p.close, p.trade_count, CASE WHEN p.vwap IS NULL AND p.trade_count IS NOT NULL THEN s.vw ELSE p.vwap END::DOUBLE AS vwap FROM prices p LEFT JOIN s ON p.security_id = s.security_id AND p.date = s.date AND p.close = s.close""")
def vwap_filled(spark, sf_dir):
    """The bars after the guarded update from the tree."""
    staged, prices = _priced(spark, sf_dir)
    return archives.with_vwap(prices, staged).select("security_id", day("date").alias("date"), F.col("close").cast("double").alias("close"), "trade_count", "vwap")


# Corporate actions: orders are events, customers dealt on tickers meet on a day.


def _key():
    return F.col("o_orderkey")


def _ticker():
    return F.concat(F.lit("S"), (F.col("o_custkey") % 20).cast("string"))


def _known(spark, sf_dir, prefix):
    return table(spark, sf_dir, "orders").where(_key() % 3 == 0).select(F.concat(prefix, _key().cast("string")).alias("id"))


@query(f"""WITH e AS (SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'P' ELSE 'E' END || o_orderkey::VARCHAR AS id, o_orderkey AS k, 'S' || (o_custkey % 20)::VARCHAR AS ticker, o_orderdate::DATE AS ex_date, CASE WHEN o_orderkey % 41 = 0 THEN 0 ELSE 1 END AS f, CASE WHEN o_orderkey % 35 = 0 THEN 2 WHEN o_orderkey % 37 = 0 THEN 2000 ELSE 2 + o_orderkey % 2 END AS t FROM orders),
  b AS (SELECT *, CASE WHEN f = 0 THEN 'row' WHEN k % 7 = 0 AND k % 35 <> 0 THEN 'spinoff' END AS early FROM e), g AS (SELECT ticker, ex_date, min(t) <> max(t) AS torn FROM b WHERE early IS NULL GROUP BY 1, 2),
  c AS (SELECT b.*, torn, CASE WHEN early IS NULL AND (NOT torn OR k % 35 = 0) THEN row_number() OVER (PARTITION BY ticker, ex_date, early IS NULL AND (NOT torn OR k % 35 = 0) ORDER BY k % 3 <> 0, id) END AS r FROM b LEFT JOIN g USING (ticker, ex_date))
  SELECT id, ticker, strftime(ex_date, '{_DAY}') AS ex_date, CASE WHEN k % 35 = 0 THEN 'spinoff_pseudo_split' ELSE 'forward_split' END AS adjustment_type, coalesce(early, CASE WHEN r = 1 THEN NULL WHEN torn THEN 'conflict' ELSE 'duplicate' END) AS reason, t = 2000 AND early IS NULL AND r IS NOT NULL AS extreme FROM c""")
def split_archive(spark, sf_dir):
    """Splits with what is wrong with them; every fifth spin-off is allowed and marked."""
    prefix = F.when(_key() % 7 == 0, "P").otherwise("E")
    ids = F.concat(prefix, _key().cast("string"))
    legs = F.when(_key() % 35 == 0, 2).when(_key() % 37 == 0, 2000).otherwise(2 + _key() % 2)
    o = table(spark, sf_dir, "orders")
    e = o.select(ids.alias("id"), _ticker().alias("ticker"), F.col("o_orderdate").alias("ex_date"), F.when(_key() % 41 == 0, 0).otherwise(1).alias("split_from"), legs.alias("split_to"), F.lit("forward_split").alias("adjustment_type"))
    allowed = o.where(_key() % 35 == 0).select(ids.alias("id"), F.lit("spinoff_pseudo_split").alias("override"))
    return archives.splits(e, _known(spark, sf_dir, prefix), allowed).select("id", "ticker", day("ex_date").alias("ex_date"), "adjustment_type", "reason", "extreme")


@query(f"""WITH e AS (SELECT 'D' || o_orderkey::VARCHAR AS id, o_orderkey AS k, 'S' || (o_custkey % 20)::VARCHAR AS ticker, o_orderdate::DATE AS ex_date, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderdate::DATE + 10 END AS pay_date, CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE 1 + o_orderkey % 2 END AS cash, CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 5 <> 0 THEN 'USD' ELSE 'CAD' END AS currency FROM orders)
  SELECT id, ticker, strftime(ex_date, '{_DAY}') AS ex_date, cash::DOUBLE AS cash, currency, CASE WHEN cash = 0 THEN 'row' WHEN row_number() OVER (PARTITION BY ticker, ex_date, pay_date, cash, currency ORDER BY k % 3 <> 0, id) > 1 THEN 'duplicate' END AS reason FROM e""")
def dividend_archive(spark, sf_dir):
    """Dividends with what is wrong with them; of equal ones those that are stored already stay."""
    currency = F.when(_key() % 3 != 0, F.when(_key() % 5 != 0, "usd").otherwise("CAD"))
    pay = F.when(_key() % 4 != 0, F.date_add(F.col("o_orderdate").cast("date"), 10))
    e = table(spark, sf_dir, "orders").select(F.concat(F.lit("D"), _key().cast("string")).alias("id"), _ticker().alias("ticker"), F.col("o_orderdate").alias("ex_date"), pay.alias("pay_date"), F.when(_key() % 11 == 0, 0).otherwise(1 + _key() % 2).alias("cash"), currency.alias("currency"))
    return archives.dividends(e, _known(spark, sf_dir, F.lit("D"))).select("id", "ticker", day("ex_date").alias("ex_date"), F.col("cash").cast("double").alias("cash"), "currency", "reason")


@query(f"""SELECT o_orderkey AS k, 's' || (o_custkey % 20)::VARCHAR AS queried, nullif(ltrim((o_custkey % 50)::VARCHAR, '0'), '') AS cik, CASE WHEN o_orderkey % 5 = 0 THEN '1969-12-31' ELSE strftime(o_orderdate, '{_DAY}') END AS date, CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 2 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 't' ELSE 'n' || o_custkey::VARCHAR END AS ticker,
  CASE WHEN o_orderkey % 7 = 0 THEN 'kind' WHEN o_orderkey % 3 = 0 AND o_orderkey % 2 = 0 THEN 'row' WHEN o_orderkey % 5 = 0 THEN 'epoch' END AS reason FROM orders""")
def ticker_events(spark, sf_dir):
    """Changes of tickers with what is wrong with them; some tickers are in the payload only."""
    o = table(spark, sf_dir, "orders")
    e = o.select(
        _key().alias("k"), _ticker().alias("queried_ticker"), F.lpad((F.col("o_custkey") % 50).cast("string"), 10, "0").alias("cik"), F.lit(None).cast("string").alias("composite_figi"), F.when(_key() % 5 == 0, "1969-12-31").otherwise(day("o_orderdate")).alias("event_date"),
        F.when(_key() % 7 == 0, "delisted").otherwise("ticker_change").alias("event_type"), F.when(_key() % 3 != 0, F.concat(F.lit("N"), F.col("o_custkey").cast("string"))).otherwise(" ").alias("ticker_at_event"),
        F.when(_key() % 2 == 0, "{broken").otherwise('{"ticker_change": {"ticker": "T"}}').alias("event_payload"),
    )
    return archives.ticker_changes(e, keep=["k"]).select("k", "queried", "cik", day("date").alias("date"), "ticker", "reason")
