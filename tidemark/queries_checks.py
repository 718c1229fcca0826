"""Queries on whole histories: violations of bars against known ones, symbols that other securities have now."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import checks
from tidemark.registry import query
from tidemark.sources.market import ctes, view
from tidemark.sources.views import table

# Bars of days, some of them spoiled; the violations before 1996 are the known ones.

_KINDS = {"high<low": "high < low", "high<open": "high < open", "high<close": "high < close", "low>open": "low > open", "low>close": "low > close", "not positive": "least(open, high, low, close) <= 0", "negative volume": "volume < 0"}
_FLAT = f"""{ctes('daily')}, b AS (SELECT date, high, CASE WHEN k % 23 = 0 THEN high + 1 ELSE low END AS low, open, CASE WHEN k % 41 = 0 THEN 0 ELSE close END AS close, CASE WHEN k % 37 = 0 THEN -volume ELSE volume END AS volume,
    CASE WHEN k % 3 = 0 THEN 'files' WHEN k % 2 = 0 THEN 'live' ELSE 'old' END AS source FROM (SELECT *, security_id + day(date) AS k FROM daily) d),
  v AS ({' UNION ALL '.join(f"SELECT date, source, '{k}' AS kind FROM b WHERE {x} AND open IS NOT NULL" for k, x in _KINDS.items())} UNION ALL SELECT date, source, 'any' FROM b WHERE open IS NOT NULL AND ({' OR '.join(_KINDS.values())})),
  a AS (SELECT * FROM v UNION ALL SELECT date, 'all', kind FROM v), g AS (SELECT source, kind, count(*) AS n, count(*) FILTER (WHERE date < DATE '1996-01-01') AS allowed FROM a GROUP BY 1, 2)"""


@query(f"WITH {_FLAT} SELECT *, greatest(n - allowed, 0) AS beyond, CASE WHEN n > allowed THEN 'new' ELSE 'known' END AS state FROM g")
def bar_ratchet(spark, sf_dir):
    """Violations by source and kind, and how many there are beyond those known."""
    k = F.col("security_id") + F.day("date")
    d = view(spark, sf_dir, "daily").select(
        "date", "open", "high", F.when(k % 23 == 0, F.col("high") + 1).otherwise(F.col("low")).alias("low"), F.when(k % 41 == 0, 0).otherwise(F.col("close")).alias("close"), F.when(k % 37 == 0, -F.col("volume")).otherwise(F.col("volume")).alias("volume"),
        F.when(k % 3 == 0, 1).alias("trade_count"), F.when(k % 2 == 0, 1.0).alias("vwap"),
    )
    of = lambda bars: checks.bar_violations(bars, checks.source_of_bar())
    return checks.ratchet(of(d), of(d.where("date < date'1996-01-01'")), ["source", "kind"])


@query(f"""WITH {ctes('spans')}, now AS (SELECT c_custkey AS active_id, 's' || ((c_custkey + 1) // 3)::VARCHAR AS active_symbol FROM customer WHERE c_acctbal > 0)
  SELECT DISTINCT security_id, symbol, active_id, active_symbol FROM spans JOIN now ON lower(symbol) = lower(active_symbol) AND security_id <> active_id""")
def symbol_reconnects(spark, sf_dir):
    """Symbols that a security had and another, active one has now."""
    c = table(spark, sf_dir, "customer")
    now = c.select(F.col("c_custkey").alias("security_id"), F.concat(F.lit("s"), F.floor((F.col("c_custkey") + 1) / 3).cast("string")).alias("symbol"), (F.col("c_acctbal") > 0).alias("is_active"))
    return checks.reconnectable(view(spark, sf_dir, "spans"), now)
