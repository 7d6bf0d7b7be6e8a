"""Queries of the aggregate operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterdeck.catalog import bindings as B
from quarterdeck.catalog.q_joins import daily_returns, facts, picked, probes
from quarterdeck.catalog.registry import query
from quarterdeck.functions.scalars import norm_symbol
from quarterdeck.operators import aggregates as A
from quarterdeck.session import scratch_path

_T = ["period"]


@query("A1_latest_date", "SELECT symbol, CAST(max(date) AS VARCHAR) AS date FROM li GROUP BY symbol", "li")
def a1(spark, sf):
    return A.latest_date(B.lines(spark, sf))


_LATEST = ["revenue", "totalDebt", "longTermDebt", "operatingCashFlow", "sharesOutstanding"]


@query(
    "A2_latest_composite_row",
    'SELECT symbol, CAST(max("fiscalDate") AS VARCHAR) AS "fiscalDate", '
    + ", ".join(f'round(arg_max("{c}", ROW("fiscalDate", period)) FILTER (WHERE "{c}" IS NOT NULL), 6) AS "{c}"' for c in _LATEST)
    + " FROM fin GROUP BY symbol",
    "fin",
)
def a2(spark, sf):
    return A.latest_composite_row(B.financials(spark, sf), "symbol", "fiscalDate", _LATEST, _T)


@query(
    "A3_nth_row",
    'SELECT symbol, CAST("fiscalDate" AS VARCHAR) AS "fiscalDate", round("totalDebt", 6) AS "totalDebt", round("sharesOutstanding", 6) AS "sharesOutstanding" FROM finr WHERE rn = 2',
    "finr",
)
def a3(spark, sf):
    return A.nth_row(B.financials(spark, sf), "symbol", "fiscalDate", 2, _T).select("symbol", "fiscalDate", "totalDebt", "sharesOutstanding")


_TTM = [*A.FLOW_SUMS, "weightedAverageSharesDiluted", "sharesOutstanding"]


@query("A4_ttm_block", "SELECT symbol, " + ", ".join(f'round("{c}", 6) AS "{c}"' for c in _TTM) + " FROM ttm", "ttm")
def a4(spark, sf):
    return A.ttm_block(B.financials(spark, sf), ties=_T)


def _yoy(value: str, name: str, test: str) -> str:
    return f"""
SELECT symbol, round(s1 / s2 - 1, 6) AS {name} FROM (
  SELECT symbol, sum(CASE WHEN rn <= 4 THEN "{value}" END) AS s1, sum(CASE WHEN rn > 4 THEN "{value}" END) AS s2, count("{value}") AS n
  FROM finr WHERE rn <= 8 GROUP BY symbol) WHERE n = 8 AND s2 {test} 0"""


@query("A5_ttm_yoy_revenue", _yoy("revenue", "revenue_yoy", ">"), "finr")
def a5(spark, sf):
    return A.ttm_yoy(B.financials(spark, sf), "revenue", "revenue_yoy", ties=_T)


@query("A6_ttm_yoy_ocf", _yoy("operatingCashFlow", "ocf_yoy", "<>"), "finr")
def a6(spark, sf):
    return A.ttm_yoy(B.financials(spark, sf), "operatingCashFlow", "ocf_yoy", positive_base=False, ties=_T)


@query(
    "A7_ttm_ratio_ocf_ni",
    """
SELECT symbol, round(sum("operatingCashFlow") / sum("netIncome"), 6) AS ocf_ni FROM finr WHERE rn <= 4 GROUP BY symbol
HAVING count("operatingCashFlow") = 4 AND count("netIncome") = 4 AND sum("netIncome") <> 0""",
    "finr",
)
def a7(spark, sf):
    return A.ttm_ratio(B.financials(spark, sf), "operatingCashFlow", "netIncome", "ocf_ni", ties=_T)


EPS_YOY = """
SELECT l.symbol, l.eps_ttm / a.eps_ttm - 1 AS eps_yoy
FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY "fiscalDate" DESC) AS k FROM eps WHERE eps_ttm IS NOT NULL) l
JOIN (SELECT x.symbol, x.eps_ttm, row_number() OVER (PARTITION BY x.symbol ORDER BY abs(date_diff('day', x."fiscalDate", m.d - 365)), x."fiscalDate") AS k
      FROM eps x JOIN (SELECT symbol, max("fiscalDate") AS d FROM eps WHERE eps_ttm IS NOT NULL GROUP BY symbol) m USING (symbol)
      WHERE x.eps_ttm IS NOT NULL AND abs(date_diff('day', x."fiscalDate", m.d - 365)) <= 180) a ON a.symbol = l.symbol AND a.k = 1
WHERE l.k = 1 AND a.eps_ttm <> 0"""


@query("A8_eps_yoy", f"SELECT symbol, round(eps_yoy, 6) AS eps_yoy FROM ({EPS_YOY})", "eps")
def a8(spark, sf):
    return A.eps_yoy(B.financials(spark, sf), ties=_T)


@query(
    "A9_interest_coverage",
    """
SELECT symbol, round(oi / abs(oi - ibt), 6) AS interest_coverage FROM (
  SELECT symbol, sum("operatingIncome") AS oi, sum("incomeBeforeTax") AS ibt FROM finr WHERE rn <= 4 GROUP BY symbol HAVING count(*) = 4)
WHERE abs(oi - ibt) >= 1e-12""",
    "finr",
)
def a9(spark, sf):
    return A.interest_coverage(B.financials(spark, sf), ties=_T)


@query(
    "A10_margin_volatility",
    """
SELECT symbol, round(stddev_samp("operatingIncome" / revenue), 6) AS margin_volatility FROM finr WHERE rn <= 8 AND revenue <> 0
GROUP BY symbol HAVING count("operatingIncome" / revenue) >= 4""",
    "finr",
)
def a10(spark, sf):
    return A.margin_volatility(B.financials(spark, sf), ties=_T)


DILUTION = """
SELECT p.symbol, n."sharesOutstanding" / a."sharesOutstanding" - 1 AS share_dilution
FROM (SELECT *, t - 365 AS t1 FROM probe) p ASOF JOIN shares n ON n.symbol = p.symbol AND p.t >= n."asOfDate"
ASOF JOIN shares a ON a.symbol = p.symbol AND p.t1 >= a."asOfDate"
WHERE date_diff('day', a."asOfDate", p.t1) <= 120 AND a."sharesOutstanding" <> 0"""


@query("A11_share_dilution", f"SELECT symbol, round(share_dilution, 6) AS share_dilution FROM ({DILUTION})", "probe shares")
def a11(spark, sf):
    return A.share_dilution_features(probes(spark, sf), B.shares(spark, sf), "symbol", "t", "asOfDate", "sharesOutstanding")


@query("A12_dedupe_max_then_sum", 'SELECT symbol, CAST("asOfDate" AS VARCHAR) AS "asOfDate", "securitiesOwned" FROM held', "held")
def a12(spark, sf):
    return A.dedupe_max_then_sum(B.holdings(spark, sf), ["symbol", "asOfDate"], "reportingName", "securitiesOwned")


@query(
    "A13_beta",
    """
SELECT symbol, round(CASE WHEN count(*) >= 24 AND var_samp(m.ret) <> 0 THEN greatest(-10, least(10, regr_slope(i.ret, m.ret))) END, 6) AS beta
FROM ind i JOIN (SELECT date, close / lag(close) OVER (ORDER BY date) - 1 AS ret FROM market) m USING (date) WHERE i.ret IS NOT NULL AND m.ret IS NOT NULL GROUP BY symbol""",
    "ind market",
)
def a13(spark, sf):
    return A.beta_from_returns(daily_returns(spark, sf), "symbol", "stock_ret", "mkt_ret")


@query("A14_latest_membership", 'SELECT "memberSymbol", "isMember" FROM members WHERE "asOfDate" = (SELECT max("asOfDate") FROM members)', "members")
def a14(spark, sf):
    return A.latest_membership(B.membership(spark, sf))


@query("A15_choose_anchor", "SELECT cik, anchor, n_ends FROM anchors", "anchors")
def a15(spark, sf):
    return A.choose_anchor(facts(spark, sf))


@query(
    "A16_build_slots",
    'SELECT cik, slot, CAST("end" AS VARCHAR) AS "end", accn, form, CAST(filed AS VARCHAR) AS filed, fp, fy FROM slots',
    "slots",
)
def a16(spark, sf):
    return A.build_slots(facts(spark, sf))


@query(
    "A17_chosen_tag",
    """
SELECT cik, metric, tag, n FROM (
  SELECT cik, metric, tag, count(*) AS n, row_number() OVER (PARTITION BY cik, metric ORDER BY count(*) DESC, tag) AS k FROM picked GROUP BY cik, metric, tag) WHERE k = 1""",
    "picked",
)
def a17(spark, sf):
    return A.chosen_tag(picked(spark, sf))


@query(
    "A18_missing_rate",
    """
SELECT round(avg(CASE WHEN "adjClose" IS NULL THEN 1 ELSE 0 END), 6) AS missing_rate,
  round(avg(CASE WHEN "adjClose" IS NULL THEN 1 ELSE 0 END) FILTER (WHERE date = (SELECT max(date) FROM prices)), 6) AS missing_rate_latest,
  CAST(max(date) AS VARCHAR) AS latest FROM prices""",
    "prices",
)
def a18(spark, sf):
    return A.missing_rate(B.prices(spark, sf), "adjClose")


@query(
    "A18_missing_by_symbol",
    """
SELECT symbol, round(avg(CASE WHEN "adjClose" IS NULL THEN 1 ELSE 0 END), 6) AS missing_rate FROM prices
WHERE (SELECT avg(CASE WHEN "adjClose" IS NULL THEN 1 ELSE 0 END) FROM prices) > 0.2 GROUP BY symbol ORDER BY avg(CASE WHEN "adjClose" IS NULL THEN 1 ELSE 0 END) DESC, symbol LIMIT 20""",
    "prices",
)
def a18_by(spark, sf):
    return A.missing_by_key(B.prices(spark, sf), "adjClose")


@query(
    "A19_freshness",
    """
SELECT CAST(min(date) AS VARCHAR) AS min_date, CAST(max(date) AS VARCHAR) AS max_date, count(*) AS n_rows,
  count(*) FILTER (WHERE date = (SELECT max(date) FROM prices)) AS n_latest, date_diff('day', max(date), DATE '2001-11-12') AS lag_days,
  date_diff('day', max(date), DATE '2001-11-12') > 6 AS stale FROM prices""",
    "prices",
)
def a19(spark, sf):
    return A.freshness(B.prices(spark, sf), "date", F.lit("2001-11-12").cast("date"))


@query(
    "A20_table_counts",
    """
SELECT 'prices_eod' AS table_name, count(*) AS n_rows FROM prices UNION ALL SELECT 'financials_quarterly', count(*) FROM fin
UNION ALL SELECT 'dividends_events', count(*) FROM divs UNION ALL SELECT 'earnings_events', 0""",
    "prices fin divs",
)
def a20(spark, sf):
    return A.table_counts(
        {
            "prices_eod": B.prices(spark, sf),
            "financials_quarterly": B.financials(spark, sf),
            "dividends_events": B.dividends(spark, sf),
            "earnings_events": None,
        }
    )


@query(
    "A20_stored_counts",
    "SELECT 'prices_eod' AS table_name, count(*) AS n_rows FROM prices UNION ALL SELECT 'dividends_events', -1 UNION ALL SELECT 'earnings_events', 0",
    "prices",
)
def a20_stored(spark, sf):
    """A stored table, one whose files are no Parquet, and one that is absent."""
    folder = scratch_path(spark, "counted")
    B.prices(spark, sf).write.parquet(f"{folder}/prices_eod.parquet")
    B.dividends(spark, sf).select("symbol").write.text(f"{folder}/dividends_events.parquet")
    return A.stored_counts(spark, folder, ["prices_eod", "dividends_events", "earnings_events"])


@query(
    "A21_coverage_profile",
    "SELECT count(*) AS n_rows, count(DISTINCT symbol) AS n_keys, " + ", ".join(f'count("{c}") AS "{c}"' for c in _LATEST) + " FROM fin",
    "fin",
)
def a21(spark, sf):
    return A.coverage_profile(B.financials(spark, sf), _LATEST, ["symbol"])


@query(
    "A22_value_counts",
    'SELECT "transactionType" AS reason, count(*) AS n FROM itx GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10',
    "itx",
)
def a22(spark, sf):
    return A.value_counts(B.transactions(spark, sf).withColumnRenamed("transactionType", "reason"), "reason")


@query(
    "A23_consistency_profile",
    """
SELECT count(*) FILTER (WHERE "grossProfit" = 0) AS revenue_zero, count(*) FILTER (WHERE "grossProfit" IS NULL) AS revenue_missing,
  count(*) FILTER (WHERE "operatingCashFlow" > "grossProfit") AS gross_profit_above_revenue FROM fin""",
    "fin",
)
def a23(spark, sf):
    return A.consistency_profile(B.financials(spark, sf), "grossProfit", "operatingCashFlow")


@query(
    "A23_consistency_examples",
    """
SELECT symbol, CAST("fiscalDate" AS VARCHAR) AS "fiscalDate", round("grossProfit", 6) AS "grossProfit", round("operatingCashFlow", 6) AS "operatingCashFlow"
FROM fin WHERE "operatingCashFlow" > "grossProfit" ORDER BY symbol, fin."fiscalDate" LIMIT 5""",
    "fin",
)
def a23_examples(spark, sf):
    return A.consistency_examples(B.financials(spark, sf), "grossProfit", "operatingCashFlow", ["symbol", "fiscalDate"])


@query(
    "A24_tag_candidate_profile",
    """
SELECT cik, tag, CAST("end" AS VARCHAR) AS "end", round(val, 6) AS val, accn, rn FROM (
  SELECT *, row_number() OVER (PARTITION BY cik ORDER BY CASE tag WHEN 'InterestExpense' THEN 1 ELSE 7 END, rn) AS a FROM (
    SELECT *, row_number() OVER (PARTITION BY cik, tag ORDER BY "end" DESC, doc_pos, src_pos) AS rn FROM facts WHERE lower(tag) LIKE '%interest%' AND unit = 'USD') WHERE rn <= 8) WHERE a <= 40""",
    "facts",
)
def a24(spark, sf):
    return A.tag_candidate_profile(facts(spark, sf)).select("cik", "tag", "end", "val", "accn", "rn")


@query(
    "A24_tag_units",
    "SELECT cik, tag, string_agg(DISTINCT unit, '|' ORDER BY unit) AS units FROM facts WHERE lower(tag) LIKE '%interest%' GROUP BY cik, tag",
    "facts",
)
def a24_units(spark, sf):
    return A.tag_units(facts(spark, sf)).select("cik", "tag", F.array_join("units", "|").alias("units"))


@query("A25_distinct_symbols", "SELECT DISTINCT upper(trim(c_name)) AS symbol FROM customer JOIN orders ON o_custkey = c_custkey")
def a25(spark, sf):
    j = B.table(spark, sf, "customer").join(B.table(spark, sf, "orders"), F.col("o_custkey") == F.col("c_custkey"))
    return A.distinct_symbols(j.withColumn("raw", F.concat(F.lit(" "), F.lower("c_name"), F.lit(" "))), norm_symbol("raw"))
