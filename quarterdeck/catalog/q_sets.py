"""Queries of sorting, limits and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterdeck.catalog import bindings as B
from quarterdeck.catalog.registry import query
from quarterdeck.operators import sets as S


@query(
    "O1_sort_by_key",
    'SELECT symbol, CAST("asOfDate" AS VARCHAR) AS "asOfDate", "sharesOutstanding" FROM shares ORDER BY symbol, shares."asOfDate"',
    "shares",
)
def o1(spark, sf):
    return S.sort_by_key(B.shares(spark, sf).select("symbol", "asOfDate", "sharesOutstanding"), ["symbol", "asOfDate"])


@query("O2_top_k", "SELECT symbol, CAST(date AS VARCHAR) AS date, volume FROM prices ORDER BY volume DESC, symbol, prices.date LIMIT 20", "prices")
def o2(spark, sf):
    return S.top_k(B.prices(spark, sf).select("symbol", "date", "volume"), [F.col("volume").desc(), F.col("symbol"), F.col("date")], 20)


@query(
    "O3_union_all",
    """
SELECT symbol, CAST("asOfDate" AS VARCHAR) AS "asOfDate", "sharesOutstanding", NULL::DOUBLE AS "targetPrice" FROM shares
UNION ALL SELECT symbol, CAST("asOfDate" AS VARCHAR), NULL, "targetPrice" FROM targets""",
    "shares targets",
)
def o3(spark, sf):
    return S.union_all([B.shares(spark, sf).drop("sharesFloat"), B.targets(spark, sf)])


@query("O4_intersect", "SELECT symbol FROM uni INTERSECT SELECT symbol FROM divs WHERE dividend > 0.08", "uni divs")
def o4(spark, sf):
    return S.intersect_keys(B.universe(spark, sf), B.dividends(spark, sf).filter("dividend > 0.08"), "symbol")


@query("O5_distinct", "SELECT DISTINCT symbol, l_returnflag AS flag FROM li", "li")
def o5(spark, sf):
    return B.lines(spark, sf).select("symbol", F.col("l_returnflag").alias("flag")).distinct()


@query(
    "O5_distinct_keep_order",
    """
SELECT o_orderkey, CASE WHEN o_orderstatus = p THEN o_orderstatus || '|' || q WHEN p = q OR o_orderstatus = q THEN o_orderstatus || '|' || p ELSE o_orderstatus || '|' || p || '|' || q END AS kept
FROM (SELECT *, CASE WHEN o_totalprice > 200000 THEN 'F' ELSE 'O' END AS p, 'x' AS q FROM orders)""",
)
def o5_order(spark, sf):
    o = B.table(spark, sf, "orders")
    p = F.when(F.col("o_totalprice") > 200000, F.lit("F")).otherwise(F.lit("O"))
    return o.select("o_orderkey", F.array_join(S.distinct_keep_order(F.array("o_orderstatus", p, F.lit("x"))), "|").alias("kept"))
