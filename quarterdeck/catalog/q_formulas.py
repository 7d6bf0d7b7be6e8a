"""Queries of the row formulas."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterdeck.catalog import bindings as B
from quarterdeck.catalog.q_joins import facts, probes
from quarterdeck.catalog.registry import query
from quarterdeck.operators import aggregates as A
from quarterdeck.operators import formulas as R
from quarterdeck.operators import joins as J
from quarterdeck.operators.fundamentals import fundamental_features
from quarterdeck.plans import company_facts as C
from quarterdeck.schemas import q

# Row formulas over: latest l, trailing block t, previous quarter p, price x, snapshot shares s.
INDICATOR_SQL = {
    "Shs Outstand": "sh",
    "Book/sh": 'l."totalStockholdersEquity" / nullif(sh, 0)',
    "Cash/sh": 'l."cashAndCashEquivalents" / nullif(sh, 0)',
    "Income (Net)": 'coalesce(t."netIncome", l."netIncome")',
    "Sales (Rev)": "coalesce(t.revenue, l.revenue)",
    "Payout": 'abs(t."dividendsPaid") / nullif(abs(t."netIncome"), 0)',
    "EPS (ttm)": "eps",
    "P/E": "px / nullif(eps, 0)",
    "P/S": "px / nullif(t.revenue / nullif(sh, 0), 0)",
    "P/B": 'px / nullif(l."totalStockholdersEquity" / nullif(sh, 0), 0)',
    "P/C": 'px / nullif(l."cashAndCashEquivalents" / nullif(sh, 0), 0)',
    "P/FCF": 'px / nullif(t."freeCashFlow" / nullif(sh, 0), 0)',
    "Market Cap": "px * nullif(sh, 0)",
    "Enterprise Value(EV)": "ev",
    "EV/EBITDA": 'ev / nullif(t."EBITDA", 0)',
    "EV/Sales": "ev / nullif(t.revenue, 0)",
    "Quick Ratio": '(l."cashAndCashEquivalents" + l.receivables) / nullif(l."currentLiabilities", 0)',
    "Current Ratio": 'l."currentAssets" / nullif(l."currentLiabilities", 0)',
    "Debt/Eq": 'l."totalDebt" / nullif(l."totalStockholdersEquity", 0)',
    "LT Debt/Eq": 'l."longTermDebt" / nullif(l."totalStockholdersEquity", 0)',
    "ROA": 't."netIncome" / nullif(l."totalAssets", 0)',
    "ROE": 't."netIncome" / nullif(l."totalStockholdersEquity", 0)',
    "ROIC": """t."operatingIncome" * (1 - tax) / nullif(CASE WHEN p_ic IS NULL THEN ic ELSE (ic + p_ic) / 2 END, 0)""",
    "Gross Margin": 'CASE WHEN t.symbol IS NOT NULL THEN t."grossProfit" / nullif(t.revenue, 0) ELSE l."grossProfit" / nullif(l.revenue, 0) END',
    "Oper. Margin": 'CASE WHEN t.symbol IS NOT NULL THEN t."operatingIncome" / nullif(t.revenue, 0) ELSE l."operatingIncome" / nullif(l.revenue, 0) END',
    "Profit Margin": 'CASE WHEN t.symbol IS NOT NULL THEN t."netIncome" / nullif(t.revenue, 0) ELSE l."netIncome" / nullif(l.revenue, 0) END',
}


PLACES = {"Market Cap": 2, "Enterprise Value(EV)": 2, "SMA200": 8}


def _latest_sql() -> str:
    picks = ", ".join(f'arg_max("{c}", ROW("fiscalDate", period)) FILTER (WHERE "{c}" IS NOT NULL) AS "{c}"' for c in R.LATEST)
    return f'SELECT symbol, max("fiscalDate") AS fd, {picks} FROM fin GROUP BY symbol'


INDICATORS = f"""
SELECT x.symbol, l.fd, x.close AS price, {", ".join(f'{e} AS "{n}"' for n, e in INDICATOR_SQL.items())}
FROM (SELECT symbol, close FROM ind WHERE rn = n) x
LEFT JOIN ({_latest_sql()}) l USING (symbol)
LEFT JOIN ttm t USING (symbol) LEFT JOIN (SELECT * FROM finr WHERE rn = 2) p USING (symbol)
LEFT JOIN (SELECT symbol, arg_max("sharesOutstanding", "asOfDate") AS so FROM shares GROUP BY symbol) s USING (symbol)
CROSS JOIN LATERAL (SELECT x.close AS px, coalesce(s.so, l."sharesOutstanding") AS sh) a
CROSS JOIN LATERAL (SELECT CASE WHEN t.symbol IS NOT NULL THEN t."netIncome" / nullif(coalesce(t."weightedAverageSharesDiluted", nullif(s.so, 0), l."sharesOutstanding"), 0) END AS eps,
  px * nullif(sh, 0) + l."totalDebt" - l."cashAndCashEquivalents" AS ev,
  CASE WHEN t.revenue <> 0 AND abs(t."incomeBeforeTax") >= t.revenue * 0.01 AND t."incomeBeforeTax" <> 0 AND t."incomeTaxExpense" IS NOT NULL
    THEN greatest(0.05, least(0.35, abs(t."incomeTaxExpense") / abs(t."incomeBeforeTax"))) ELSE 0.21 END AS tax,
  l."totalDebt" + l."totalStockholdersEquity" - coalesce(l."cashAndCashEquivalents", 0) AS ic,
  p."totalDebt" + p."totalStockholdersEquity" - coalesce(p."cashAndCashEquivalents", 0) AS p_ic) b"""


@query(
    "F1_financial_indicators",
    "SELECT symbol, " + ", ".join(f'round("{n}", {PLACES.get(n, 6)}) AS "{n}"' for n in R.INDICATORS) + f" FROM ({INDICATORS})",
    "ind fin finr ttm shares",
    places=PLACES,
)
def f1(spark, sf):
    px = B.adjusted(spark, sf).groupBy("symbol").agg(F.max_by("close", "date").alias("Price"))
    sh = A.latest_composite_row(B.shares(spark, sf), "symbol", "asOfDate", ["sharesOutstanding"]).select("symbol", F.col("sharesOutstanding").alias("snap"))
    rows = J.feature_assembly(px, [fundamental_features(B.financials(spark, sf)), sh], "symbol")
    rows = rows.withColumn("shares_out", R.resolved_shares("snap", "l_sharesOutstanding"))
    return R.financial_indicators(rows).select("symbol", *[q(c) for c in R.INDICATORS])


DIVIDEND_SUMS = """
SELECT p.symbol, sum(CASE WHEN "exDate" BETWEEN t - 365 AND t THEN dividend END) AS ttm,
  sum(CASE WHEN "exDate" BETWEEN CAST(t - INTERVAL 3 YEAR AS DATE) - 365 AND CAST(t - INTERVAL 3 YEAR AS DATE) THEN dividend END) AS ago_3y,
  sum(CASE WHEN "exDate" BETWEEN CAST(t - INTERVAL 5 YEAR AS DATE) - 365 AND CAST(t - INTERVAL 5 YEAR AS DATE) THEN dividend END) AS ago_5y
FROM probe p LEFT JOIN divs d USING (symbol) GROUP BY p.symbol"""


def growth_sql(ago: str, n: int) -> str:
    return f"CASE WHEN ttm > 0 AND {ago} > 0 THEN greatest(-50, least(100, (power(ttm / {ago}, 1.0 / {n}) - 1) * 100)) END"


@query(
    "F2_dividend_growth",
    f"SELECT symbol, round({growth_sql('ago_3y', 3)}, 6) AS gr3, round({growth_sql('ago_5y', 5)}, 6) AS gr5 FROM ({DIVIDEND_SUMS})",
    "probe divs",
)
def f2(spark, sf):
    d = J.range_sum(probes(spark, sf), B.dividends(spark, sf), "symbol", "t", "exDate", "dividend", J.dividend_windows("t"))
    return d.select("symbol", R.dividend_growth("ttm", "ago_3y", 3).alias("gr3"), R.dividend_growth("ttm", "ago_5y", 5).alias("gr5"))


def _near(offset: str) -> str:
    target = "m.d" if not offset else f"CAST(m.d - INTERVAL {offset} AS DATE)"
    return f"""(SELECT e.eps_ttm FROM eps e WHERE e.symbol = m.symbol AND e.eps_ttm IS NOT NULL AND abs(date_diff('day', e."fiscalDate", {target})) <= 180
      ORDER BY abs(date_diff('day', e."fiscalDate", {target})), e."fiscalDate" LIMIT 1)"""


GROWTH = f"""
SELECT symbol, this_y, next_y, CASE WHEN g IS NOT NULL THEN greatest(-50, least(100, g * 100)) END AS growth FROM (
  SELECT *, CASE WHEN f IS NOT NULL AND h IS NOT NULL THEN 0.6 * f + 0.4 * h ELSE coalesce(f, h) END AS g FROM (
    SELECT *, CASE WHEN this_y > 0 AND next_y > 0 THEN next_y / this_y - 1 END AS f,
      coalesce(CASE WHEN e0 > 0 AND e5 > 0 THEN power(e0 / e5, 1.0 / 5) - 1 END, CASE WHEN e0 > 0 AND e3 > 0 THEN power(e0 / e3, 1.0 / 3) - 1 END) AS h
    FROM (SELECT m.symbol, {_near("")} AS e0, {_near("3 YEAR")} AS e3, {_near("5 YEAR")} AS e5, x.this_y, x.next_y
      FROM (SELECT symbol, max("fiscalDate") AS d FROM fin GROUP BY symbol) m
      LEFT JOIN (SELECT symbol, arg_max("epsThisY", "asOfDate") FILTER (WHERE "epsThisY" IS NOT NULL) AS this_y,
          arg_max("epsNextY", "asOfDate") FILTER (WHERE "epsNextY" IS NOT NULL) AS next_y FROM est GROUP BY symbol) x ON x.symbol = m.symbol)))"""


def growth_rows(spark, sf):
    est = A.latest_composite_row(B.estimates(spark, sf), "symbol", "asOfDate", ["epsThisY", "epsNextY"]).drop("asOfDate")
    g = fundamental_features(B.financials(spark, sf)).join(est, "symbol", "left")
    return g.withColumn("growth", R.growth_blend("epsThisY", "epsNextY", "eps_now", "eps_5y", "eps_3y"))


@query("F3_growth_blend", f"SELECT symbol, round(growth, 6) AS growth FROM ({GROWTH})", "eps fin est")
def f3(spark, sf):
    return growth_rows(spark, sf).select("symbol", "growth")


@query(
    "F4_forward_pe_peg",
    f"""
SELECT i.symbol, round(i.close / nullif(g.next_y, 0), 6) AS forward_pe, round(CASE WHEN g.growth > 0 THEN i.close / 10 / g.growth END, 6) AS peg
FROM (SELECT symbol, close FROM ind WHERE rn = n) i JOIN ({GROWTH}) g USING (symbol)""",
    "ind eps fin est",
)
def f4(spark, sf):
    px = B.adjusted(spark, sf).groupBy("symbol").agg(F.max_by("close", "date").alias("price"))
    g = px.join(growth_rows(spark, sf), "symbol")
    return g.select("symbol", R.forward_pe("price", "epsNextY").alias("forward_pe"), R.peg(F.col("price") / 10, "growth").alias("peg"))


@query(
    "F5_shares_resolution",
    """
SELECT f.symbol, coalesce(s.v, f.v) AS shares_out, coalesce(CASE WHEN c.v > 0 THEN c.v END, CASE WHEN coalesce(s.v, f.v) > 0 THEN coalesce(s.v, f.v) END) AS insider_base
FROM (SELECT symbol, arg_max("sharesOutstanding", "fiscalDate") FILTER (WHERE "sharesOutstanding" IS NOT NULL) AS v FROM fin GROUP BY symbol) f
LEFT JOIN (SELECT symbol, arg_max("sharesFloat", "asOfDate") FILTER (WHERE "sharesFloat" IS NOT NULL) AS v FROM shares GROUP BY symbol) s USING (symbol)
LEFT JOIN (SELECT symbol, arg_max("sharesOutstanding_shares", "asOfDate") AS v FROM cfacts GROUP BY symbol) c USING (symbol)""",
    "fin shares cfacts",
)
def f5(spark, sf):
    f = A.latest_composite_row(B.financials(spark, sf), "symbol", "fiscalDate", ["sharesOutstanding"]).select("symbol", F.col("sharesOutstanding").alias("f"))
    s = A.latest_composite_row(B.shares(spark, sf), "symbol", "asOfDate", ["sharesFloat"]).select("symbol", F.col("sharesFloat").alias("s"))
    late = B.company_facts(spark, sf)
    c = late.groupBy("symbol").agg(F.expr("max_by(sharesOutstanding_shares, asOfDate) filter (where sharesOutstanding_shares is not null)").alias("c"))
    j = f.join(s, "symbol", "left").join(c, "symbol", "left").withColumn("shares_out", R.resolved_shares("s", "f"))
    return j.select("symbol", "shares_out", R.insider_base("c", "shares_out").alias("insider_base"))


WIDE = """
SELECT cik, slot, max(CASE WHEN metric = 'Revenue' THEN val END) AS rev, max(CASE WHEN metric = 'Revenue' THEN qv END) AS rev_q,
  max(CASE WHEN metric = 'CostOfRevenue' THEN val END) AS cost, max(CASE WHEN metric = 'CostOfRevenue' THEN qv END) AS cost_q,
  max(CASE WHEN metric = 'SGnA' THEN val END) AS sga, max(CASE WHEN metric = 'SGnA' THEN qv END) AS sga_q,
  max(CASE WHEN metric = 'NetIncome' THEN val END) AS ni, max(CASE WHEN metric = 'NetIncome' THEN qv END) AS ni_q,
  max(CASE WHEN metric = 'InterestExpense' THEN val END) AS ie, max(CASE WHEN metric = 'InterestExpense' THEN qv END) AS ie_q,
  max(CASE WHEN metric = 'Assets' THEN val END) AS a, max(CASE WHEN metric = 'Liabilities' THEN val END) AS l, max(CASE WHEN metric = 'Equity' THEN val END) AS e,
  max(CASE WHEN metric = 'SharesOutstanding' THEN val END) AS so
FROM quarterised WHERE slot <= 8 GROUP BY cik, slot"""


@query(
    "F6_derived_metrics",
    f"""
SELECT cik, slot, CASE WHEN abs(rev) >= 1e-12 THEN round(rev - cost, 6) END AS "GrossProfit", CASE WHEN abs(rev_q) >= 1e-12 THEN round(rev_q - cost_q, 6) END AS "GrossProfit_Quarter",
  round(sga, 6) AS "OperatingExpenses", round(sga_q, 6) AS "OperatingExpenses_Quarter", false AS contaminated FROM ({WIDE})""",
    "quarterised",
)
def f6(spark, sf):
    from quarterdeck.operators import xbrl as X

    f = facts(spark, sf)
    slots = A.build_slots(f)
    wide = X.pivot_quarters(X.quarter_values(X.select_fact_for_slot(f, slots, X.metrics_config(spark))), slots)
    return R.derived_metrics(wide).select(
        "cik", "slot", "GrossProfit", "GrossProfit_Quarter", "OperatingExpenses", "OperatingExpenses_Quarter", "contaminated"
    )


@query(
    "F7_balance_check",
    f"""
SELECT cik, slot, round(CASE WHEN abs(a) >= 1e-12 THEN abs(a - (l + e)) / abs(a) END, 6) AS bs_diff_pct,
  CASE WHEN abs(a) >= 1e-12 THEN abs(a - (l + e)) / abs(a) <= 0.01 END AS balance_sheet_ok FROM ({WIDE})""",
    "quarterised",
)
def f7(spark, sf):
    return C.quarters(spark, facts(spark, sf)).select("cik", "slot", "bs_diff_pct", "balance_sheet_ok")


@query(
    "F8_placeholder_columns",
    """
SELECT symbol, NULL::VARCHAR AS "Earnings (Date)", NULL::DOUBLE AS "Inst Own/Trans", NULL::DOUBLE AS "Short Float", NULL::DOUBLE AS "Short Interest",
  NULL::DOUBLE AS "Short Ratio", NULL::DOUBLE AS "Recom" FROM probe""",
    "probe",
)
def f8(spark, sf):
    return R.placeholder_columns(probes(spark, sf).select("symbol"))


