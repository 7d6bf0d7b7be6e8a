"""Row formulas over the assembled features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.functions import fixed
from quarterdeck.functions.scalars import clamp, col, safe_div

LATEST = [
    "revenue", "netIncome", "grossProfit", "operatingIncome", "cashAndCashEquivalents", "receivables", "currentAssets",
    "currentLiabilities", "totalAssets", "totalStockholdersEquity", "totalDebt", "longTermDebt", "freeCashFlow",
    "sharesOutstanding",
]
PREVIOUS = ["totalDebt", "totalStockholdersEquity", "cashAndCashEquivalents"]


def financial_indicators(df: DataFrame, price: str = "Price", shares: str = "shares_out") -> DataFrame:
    """Valuation, margin, return and leverage ratios.

    `df` holds the newest composite quarter as `l_*`, the trailing block as `t_*` with flag `has_ttm`, the
    previous quarter as `p_*` and the flag `has_latest`.
    """
    lat, ttm, prv = (lambda c: F.col(f"l_{c}")), (lambda c: F.col(f"t_{c}")), (lambda c: F.col(f"p_{c}"))
    has, px = F.col("has_ttm"), F.col(price)
    step = df.select(
        "*",
        F.when(F.col("has_latest"), F.coalesce(F.col(shares), lat("sharesOutstanding"))).alias("Shs Outstand"),
        F.when(has, F.coalesce(ttm("weightedAverageSharesDiluted"), F.nullif(F.col(shares), F.lit(0.0)), lat("sharesOutstanding"))).alias("_wad"),
    )
    sh = F.col("Shs Outstand")
    step = step.select(
        "*",
        safe_div(ttm("netIncome"), "_wad").alias("EPS (ttm)"),
        F.when(sh != 0, px * sh).alias("Market Cap"),
    )
    step = step.withColumn("Enterprise Value(EV)", F.col("Market Cap") + lat("totalDebt") - lat("cashAndCashEquivalents"))
    ev = F.col("Enterprise Value(EV)")
    eq = lat("totalStockholdersEquity")

    ibt, rev = F.abs(ttm("incomeBeforeTax")), ttm("revenue")
    tax = F.when(
        (rev != 0) & (ibt >= rev * 0.01) & (ibt != 0) & ttm("incomeTaxExpense").isNotNull(),
        F.greatest(F.lit(0.05), F.least(F.lit(0.35), safe_div(F.abs(ttm("incomeTaxExpense")), ibt))),
    ).otherwise(F.lit(0.21))
    ic = lat("totalDebt") + eq - F.coalesce(lat("cashAndCashEquivalents"), F.lit(0.0))
    ic_prev = prv("totalDebt") + prv("totalStockholdersEquity") - F.coalesce(prv("cashAndCashEquivalents"), F.lit(0.0))
    capital = F.coalesce((ic + ic_prev) / 2.0, ic)

    def margin(c: str) -> Column:
        return F.when(has, safe_div(ttm(c), ttm("revenue"))).otherwise(safe_div(lat(c), lat("revenue")))

    return step.select(
        "*",
        safe_div(eq, sh).alias("Book/sh"),
        safe_div(lat("cashAndCashEquivalents"), sh).alias("Cash/sh"),
        F.coalesce(ttm("netIncome"), lat("netIncome")).alias("Income (Net)"),
        F.coalesce(ttm("revenue"), lat("revenue")).alias("Sales (Rev)"),
        safe_div(F.abs(ttm("dividendsPaid")), F.abs(ttm("netIncome"))).alias("Payout"),
        safe_div(px, "EPS (ttm)").alias("P/E"),
        safe_div(px, safe_div(ttm("revenue"), sh)).alias("P/S"),
        safe_div(px, safe_div(eq, sh)).alias("P/B"),
        safe_div(px, safe_div(lat("cashAndCashEquivalents"), sh)).alias("P/C"),
        safe_div(px, safe_div(ttm("freeCashFlow"), sh)).alias("P/FCF"),
        safe_div(ev, ttm("EBITDA")).alias("EV/EBITDA"),
        safe_div(ev, ttm("revenue")).alias("EV/Sales"),
        safe_div(lat("cashAndCashEquivalents") + lat("receivables"), lat("currentLiabilities")).alias("Quick Ratio"),
        safe_div(lat("currentAssets"), lat("currentLiabilities")).alias("Current Ratio"),
        safe_div(lat("totalDebt"), eq).alias("Debt/Eq"),
        safe_div(lat("longTermDebt"), eq).alias("LT Debt/Eq"),
        safe_div(ttm("netIncome"), lat("totalAssets")).alias("ROA"),
        safe_div(ttm("netIncome"), eq).alias("ROE"),
        F.when(has, safe_div(ttm("operatingIncome") * (1.0 - tax), capital)).alias("ROIC"),
        margin("grossProfit").alias("Gross Margin"),
        margin("operatingIncome").alias("Oper. Margin"),
        margin("netIncome").alias("Profit Margin"),
    ).drop("_wad")


INDICATORS = [
    "Income (Net)", "Sales (Rev)", "Book/sh", "Cash/sh", "Payout", "EPS (ttm)", "P/E", "P/S", "P/B", "P/C", "P/FCF",
    "Market Cap", "Enterprise Value(EV)", "EV/EBITDA", "EV/Sales", "Quick Ratio", "Current Ratio", "Debt/Eq",
    "LT Debt/Eq", "ROA", "ROE", "ROIC", "Gross Margin", "Oper. Margin", "Profit Margin", "Shs Outstand",
]


def cagr(now: Column, ago: Column, years: int) -> Column:
    """Yearly growth between two positive values."""
    return F.when((now > 0) & (ago > 0), F.pow(now / ago, F.lit(1.0 / years)) - 1.0)


def dividend_growth(now: Column | str, ago: Column | str, years: int) -> Column:
    return clamp(cagr(col(now), col(ago), years) * 100.0, -50.0, 100.0)


def growth_blend(this_y: Column | str, next_y: Column | str, eps_now: Column | str, eps_5y: Column | str, eps_3y: Column | str) -> Column:
    """Percent growth: 60% forward and 40% historical when both exist, else whichever does; limited to [-50, 100]."""
    a, b = col(this_y), col(next_y)
    fwd = F.when((a > 0) & (b > 0), b / a - 1.0)
    hist = F.coalesce(cagr(col(eps_now), col(eps_5y), 5), cagr(col(eps_now), col(eps_3y), 3))
    return clamp(F.coalesce(0.6 * fwd + 0.4 * hist, fwd, hist) * 100.0, -50.0, 100.0)


def forward_pe(price: Column | str, eps_next: Column | str) -> Column:
    return safe_div(price, eps_next)


def peg(pe: Column | str, growth_pct: Column | str) -> Column:
    g = col(growth_pct)
    return F.when(g > 0, safe_div(pe, g))


def resolved_shares(snapshot: Column | str, financials: Column | str) -> Column:
    return F.coalesce(col(snapshot), col(financials))


def insider_base(facts_shares: Column | str, shares: Column | str) -> Column:
    f, s = col(facts_shares), col(shares)
    return F.coalesce(F.when(f > 0, f), F.when(s > 0, s))


def facts_shares(reported: Column | str, profile: Column | str) -> Column:
    r = col(reported)
    return F.when(r > 0, r).otherwise(col(profile))


def derived_metrics(df: DataFrame) -> DataFrame:
    """Gross profit and operating expenses from their parts where missing, plus two checks."""
    rev = F.when(F.abs("Revenue") >= 1e-12, F.col("Revenue"))
    gp, gp_q = F.col("GrossProfit"), F.col("GrossProfit_Quarter")
    rev_q = F.when(F.abs("Revenue_Quarter") >= 1e-12, F.col("Revenue_Quarter"))

    def parts(s: str) -> Column:
        a, b = F.col(f"SGnA{s}"), F.col(f"RD{s}")
        return F.when(a.isNotNull() | b.isNotNull(), F.coalesce(a, F.lit(0.0)) + F.coalesce(b, F.lit(0.0)))

    out = df.withColumns(
        {
            "contaminated": F.coalesce(rev.isNull() & (gp > 0), F.lit(False)),
            "GrossProfit": F.coalesce(gp, rev - F.col("CostOfRevenue")),
            "GrossProfit_Quarter": F.coalesce(gp_q, rev_q - F.col("CostOfRevenue_Quarter")),
            "OperatingExpenses": F.coalesce(F.col("OperatingExpenses"), parts("")),
            "OperatingExpenses_Quarter": F.coalesce(F.col("OperatingExpenses_Quarter"), parts("_Quarter")),
        }
    )
    gap = F.col("GrossProfit") - F.col("OperatingExpenses") - F.col("OperatingIncome")
    return out.withColumn("operating_income_gap", F.when(F.abs(gap) > 1e-3, gap))


def balance_check(df: DataFrame, assets: str = "Assets", liabilities: str = "Liabilities", equity: str = "Equity", tol: float = 0.01) -> DataFrame:
    """Relative gap of the balance sheet identity and whether it is within tolerance."""
    a = F.col(assets)
    gap = F.when(F.abs(a) >= 1e-12, F.abs(a - (F.col(liabilities) + F.col(equity))) / F.abs(a))
    return df.withColumn("bs_diff_pct", gap).withColumn("balance_sheet_ok", F.col("bs_diff_pct") <= tol)


def placeholder_columns(df: DataFrame) -> DataFrame:
    """Columns of the layout that no source feeds."""
    types = {"Earnings (Date)": "date"}
    return df.withColumns({c: F.lit(None).cast(types.get(c, "double")) for c in fixed.FACTOR_PLACEHOLDERS})
