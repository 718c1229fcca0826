"""Market tables derived from the star schema, in SQL that Spark and DuckDB read alike.

A security is a supplier; filings, actions and trades are orders and line items with dates of their own.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.views import table

_QUARTER = "last_day(CAST(date_trunc('quarter', {0}) + INTERVAL 2 MONTH AS DATE))"
#: Orders with the supplier of their first line item: the security that a filing, an action or a share count is of.
_ORDERS = "(SELECT l_orderkey, min(l_suppkey) AS security_id FROM lineitem GROUP BY l_orderkey) li JOIN orders ON l_orderkey = o_orderkey"

VIEWS = {
    "securities": "SELECT s_suppkey AS security_id, concat('SYM', CAST(s_suppkey % 7 AS VARCHAR(9))) AS symbol, s_name AS name, s_nationkey AS cik, CASE WHEN s_acctbal > 0 THEN TRUE ELSE FALSE END AS is_active, DATE '1996-01-01' + CAST(s_suppkey % 5 * 100 AS INT) AS list_date, CASE WHEN s_suppkey % 3 = 0 THEN DATE '2000-06-30' + CAST(s_suppkey % 11 AS INT) END AS delist_date FROM supplier",
    "actions": f"SELECT security_id, CAST(o_orderdate AS DATE) AS ex_date, CASE WHEN o_orderpriority = '1-URGENT' THEN 'split' ELSE 'dividend' END AS kind, CAST(o_totalprice AS DOUBLE) / 100000 AS cash, CAST(1 + o_orderkey % 3 AS DOUBLE) AS split_from, CAST(1 + o_orderkey % 4 AS DOUBLE) AS split_to, CASE WHEN o_orderkey % 5 = 0 THEN 'legacy' ELSE 'trusted' END AS source, o_orderkey AS event_id FROM {_ORDERS}",
    "facts": f"SELECT security_id, CASE o_orderpriority WHEN '1-URGENT' THEN 'assets' WHEN '2-HIGH' THEN 'net_income' WHEN '3-MEDIUM' THEN 'operating_income' WHEN '4-NOT SPECIFIED' THEN 'revenue' ELSE 'cash_flow' END AS concept, {_QUARTER.format('o_orderdate')} AS period_end, {_QUARTER.format('o_orderdate')} + CAST(o_orderkey % 60 AS INT) AS filed, round(o_totalprice / 1000, 0) AS value, o_orderkey AS accession FROM {_ORDERS}",
    "shares": f"SELECT security_id, CAST(o_orderdate AS DATE) AS period_end, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INT) AS visible, CAST(floor(o_totalprice) * 1000 AS BIGINT) AS total_shares, o_orderkey AS id FROM {_ORDERS}",
    "holdings": f"SELECT l_partkey % 50 AS filer, l_suppkey AS security_id, {_QUARTER.format('l_shipdate')} AS period, l_orderkey AS accession, {_QUARTER.format('l_shipdate')} + CAST(l_orderkey % 90 AS INT) AS filed, CASE WHEN l_linenumber = 1 THEN '13F-HR/A' ELSE '13F-HR' END AS form, CASE WHEN l_linenumber = 7 THEN 'PRN' ELSE 'SH' END AS kind, CASE WHEN l_linenumber = 6 THEN 'Put' END AS put_call, l_extendedprice AS value, l_quantity AS shares FROM lineitem",
    "insider": "SELECT l_orderkey * 8 + l_linenumber AS id, l_suppkey AS security_id, l_partkey % 40 AS owner, CAST(l_shipdate AS DATE) AS trade_date, CAST(l_shipdate AS DATE) + CAST(l_orderkey % 10 AS INT) AS filed, CASE l_returnflag WHEN 'A' THEN 'P' WHEN 'R' THEN 'S' ELSE 'G' END AS code, l_quantity AS shares, l_extendedprice / l_quantity AS price FROM lineitem",
    "short": "SELECT l_suppkey AS security_id, CAST(l_shipdate AS DATE) AS trade_date, sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS short_volume, sum(l_quantity) AS total_volume FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)",
    "spans": "SELECT o_orderkey AS tenure_id, o_custkey AS security_id, concat('S', CAST(CAST((o_custkey - o_custkey % 3) / 3 AS BIGINT) AS VARCHAR(20))) AS symbol, CAST(o_orderdate AS DATE) AS start_date, CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(30 + o_orderkey % 50 AS INT) END AS end_date FROM orders",
    "daily": "SELECT l_suppkey AS security_id, CAST(l_shipdate AS DATE) AS date, max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low, min(CASE WHEN l_linenumber = 1 THEN l_extendedprice / l_quantity END) AS open, max(l_extendedprice / l_quantity) AS close, sum(l_quantity) AS volume FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)",
    "companies": "SELECT s_suppkey AS security_id, CAST((s_suppkey + s_suppkey % 2) / 2 AS BIGINT) AS company_id FROM supplier WHERE s_suppkey % 7 <> 0",
    "reports": f"""SELECT security_id, concept, CASE WHEN concept IN ('Assets', 'SharesOutstanding') THEN period_end ELSE make_date(y, 1, 1) END AS period_start, period_end,
      period_end + CAST(30 + (security_id * 7 + q * 11 + y) % 40 + 120 * again AS INT) AS filed, value + again * (value % 97) AS value, security_id * 10000000 + y * 1000 + q * 100 + place * 2 + again AS accession
      FROM (SELECT security_id, y, q, last_day(make_date(y, q * 3, 1)) AS period_end, concept, place, again, CASE concept WHEN 'Revenues' THEN revenue WHEN 'SalesRevenueNet' THEN revenue - 1 WHEN 'GrossProfit' THEN revenue - cost WHEN 'CostOfRevenue' THEN cost
          WHEN 'OperatingIncomeLoss' THEN operating WHEN 'NetIncomeLoss' THEN income WHEN 'OperatingCashFlow' THEN cash WHEN 'Assets' THEN assets ELSE shares END AS value
        FROM (SELECT security_id, y, q, assets, shares, {", ".join(f"CAST(sum({c}) OVER (PARTITION BY security_id, y ORDER BY q) AS BIGINT) AS {c}" for c in ("revenue", "cost", "operating", "income", "cash"))}
          FROM (SELECT l_suppkey AS security_id, y, q, CAST(sum(p * 100) AS BIGINT) AS revenue, CAST(sum(p * (100 - d)) AS BIGINT) AS cost, CAST(sum(p * (2 * d - t)) AS BIGINT) AS operating, CAST(sum(p * (d - t)) AS BIGINT) AS income,
            CAST(sum(CASE WHEN l_linenumber % 2 = 0 THEN p * d ELSE -p * t END) AS BIGINT) AS cash, CAST(sum(p * 250) AS BIGINT) AS assets, CAST(sum(p + l_linenumber) AS BIGINT) AS shares
            FROM (SELECT l_suppkey, l_linenumber, CAST(year(l_shipdate) AS INT) AS y, CAST(quarter(l_shipdate) AS INT) AS q, CAST(round(l_extendedprice) AS BIGINT) AS p, CAST(round(l_discount * 100) AS BIGINT) AS d, CAST(round(l_tax * 100) AS BIGINT) AS t FROM lineitem) x
            GROUP BY l_suppkey, y, q) sums) ytd
        CROSS JOIN (VALUES ('Revenues', 1), ('SalesRevenueNet', 2), ('GrossProfit', 3), ('CostOfRevenue', 4), ('OperatingIncomeLoss', 5), ('NetIncomeLoss', 6), ('OperatingCashFlow', 7), ('Assets', 8), ('SharesOutstanding', 9)) AS c(concept, place)
        CROSS JOIN (VALUES (0), (1)) AS r(again)) rows_
      WHERE (security_id % 2 = 1 OR security_id % 14 = 0) AND (again = 0 OR (security_id + q + y) % 5 = 0) AND (concept <> 'GrossProfit' OR security_id % 3 = 0) AND (concept <> 'Revenues' OR security_id % 4 = 1)""",
}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages")


def view(spark: SparkSession, sf_dir: str, name: str, deal: Callable[[DataFrame], DataFrame] = lambda t: t) -> DataFrame:
    """A view of VIEWS over the tables in sf_dir, each dealt to tasks by deal before the view reads it."""
    used = [t for t in TABLES if re.search(rf"\b{t}\b", VIEWS[name])]
    text = VIEWS[name]
    for t in used:
        text = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", text)
    return spark.sql(text, **{t: deal(table(spark, sf_dir, t)) for t in used})


def ctes(*names: str) -> str:
    """The views as common table expressions, for SQL that reads them by name."""
    return ", ".join(f"{n} AS ({VIEWS[n]})" for n in names)
