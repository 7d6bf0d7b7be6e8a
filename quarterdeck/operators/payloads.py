"""Payload rows to declared tables.

Input is the output of `payload_rows`: identifying columns, `pos` and the field map `r` of strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.functions import fixed
from quarterdeck.functions.scalars import (
    norm_item_key,
    norm_period,
    norm_symbol,
    pick_date,
    pick_num,
    pick_text,
    stable_person_id,
    to_number,
)
from quarterdeck.operators.series import top_n_per_key
from quarterdeck.schemas import TABLES, conform
from quarterdeck.sinks.upsert import last_per_key
from quarterdeck.sources.payloads import field, fields, row_symbol


def num(*names: str) -> Column:
    return pick_num(*fields(*names))


def day(*names: str) -> Column:
    return pick_date(*fields(*names))


def words(*names: str) -> Column:
    return pick_text(*fields(*names))


# ---- prices -------------------------------------------------------------------------------------------------


def build_prices(rows: DataFrame, keep: list[str] | None = None) -> DataFrame:
    return rows.select(
        norm_symbol("symbol").alias("symbol"),
        day("date").alias("date"),
        num("open", "Open").alias("open"),
        num("high", "High").alias("high"),
        num("low", "Low").alias("low"),
        num("close", "Close").alias("close"),
        num("adjClose", "adjustedClose", "adj_close").alias("adjClose"),
        num("volume", "Volume").alias("volume"),
        *(keep or []),
    ).filter(F.col("date").isNotNull())


def build_adjclose(rows: DataFrame, cutoff: str, to_date: str, order: list[str] | None = None) -> DataFrame:
    """Adjusted closes of the feed, with the columns of `order` if they are asked for."""
    out = rows.select(
        norm_symbol("symbol").alias("symbol"), day("date").alias("date"), num("adjClose", "adjustedClose", "adj_close").alias("adjClose"), *(order or [])
    )
    return out.filter(F.col("date").between(F.lit(cutoff).cast("date"), F.lit(to_date).cast("date")) & F.col("adjClose").isNotNull())


def close_fill(prices: DataFrame) -> DataFrame:
    """Missing adjusted closes take the close (daily and index loads)."""
    return prices.withColumn("adjClose", F.coalesce("adjClose", "close"))


# ---- fundamentals -------------------------------------------------------------------------------------------

_STATEMENT_KEY = ["symbol", "fiscalDate", "period"]


def _statement(rows: DataFrame, cutoff: str, values: dict[str, Column], order: list[str]) -> DataFrame:
    s = rows.select(
        norm_symbol("symbol").alias("symbol"),
        day("date", "fiscalDateEnding", "fillingDate").alias("fiscalDate"),
        F.coalesce(words("period"), F.lit("")).alias("period"),
        *[v.alias(n) for n, v in values.items()],
        *order,
    )
    s = s.filter(F.col("fiscalDate") >= F.lit(cutoff).cast("date"))
    return last_per_key(s, _STATEMENT_KEY, order).drop(*order)


def build_financials(
    income: DataFrame, balance: DataFrame, cashflow: DataFrame, cutoff: str = fixed.HISTORY_CUTOFF, order: list[str] | None = None
) -> DataFrame:
    """Three statements merged on (symbol, date, period); a later duplicate row of one statement replaces the earlier.

    Both full joins run on the same three keys, so the second reuses the partitioning of the first.
    """
    order = order or ["pos"]
    inc = _statement(income, cutoff, {
        "revenue": num("revenue", "Revenue"),
        "netIncome": num("netIncome", "NetIncome"),
        "grossProfit": num("grossProfit", "GrossProfit"),
        "operatingIncome": num("operatingIncome", "OperatingIncome"),
        "EBITDA": num("ebitda", "EBITDA"),
        "incomeBeforeTax": num("incomeBeforeTax"),
        "incomeTaxExpense": num("incomeTaxExpense"),
        "weightedAverageSharesDiluted": num("weightedAverageShsOutDil", "weightedAverageShsOutDiluted", "weightedAverageSharesDiluted"),
    }, order)
    bal = _statement(balance, cutoff, {
        "cashAndCashEquivalents": num("cashAndCashEquivalents"),
        "receivables": num("netReceivables", "receivables"),
        "shortTermInvestments": num("shortTermInvestments"),
        "currentAssets": num("totalCurrentAssets", "currentAssets"),
        "currentLiabilities": num("totalCurrentLiabilities", "currentLiabilities"),
        "totalAssets": num("totalAssets", "TotalAssets"),
        "totalStockholdersEquity": num("totalStockholdersEquity", "totalEquity", "stockholdersEquity"),
        "totalDebt": num("totalDebt"),
        "longTermDebt": num("longTermDebt"),
        "sharesOutstanding": num("commonStockSharesOutstanding", "commonStockSharesIssued", "sharesOutstanding", "ordinarySharesNumber"),
    }, order)
    cash = _statement(cashflow, cutoff, {
        "freeCashFlow": num("freeCashFlow"),
        "operatingCashFlow": num(
            "operatingCashFlow", "cashFromOperations", "netCashProvidedByOperatingActivities",
            "netCashProvidedByOperatingActivitiesContinuingOperations",
        ),
        "dividendsPaid": num("dividendsPaid", "cashDividendsPaid", "dividendsPaidCommonStock", "dividendPaid", "paymentsOfDividends"),
        "_wad": num("weightedAverageShsOutDil", "weightedAverageSharesDiluted"),
    }, order)
    m = inc.join(bal, _STATEMENT_KEY, "full").join(cash, _STATEMENT_KEY, "full")
    m = m.withColumn("weightedAverageSharesDiluted", F.coalesce("weightedAverageSharesDiluted", "_wad"))
    m = m.withColumn("period", F.nullif("period", F.lit("")))
    return conform(m, TABLES["financials_quarterly"].schema)


def flatten_line_items(rows: DataFrame, keep: list[str]) -> DataFrame:
    """As-reported `data` to (name, value): a map of items or a list of item objects.

    Columns: kept ones, `i_pos`, `name`, `value` and `is_map`.
    """
    data = F.trim(field("data"))
    as_map = F.map_entries(F.from_json(F.when(data.startswith("{"), data), "map<string,string>"))
    item = "map<string,string>"
    as_list = F.from_json(F.when(data.startswith("["), data), f"array<{item}>")

    def named(it: Column) -> Column:
        return pick_text(*[F.try_element_at(it, F.lit(k)) for k in fixed.ITEM_NAME_FIELDS])

    def valued(it: Column) -> Column:
        # A nested {"raw": ...} or {"value": ...}; a raw 0 falls through to value.
        plain = [to_number(F.try_element_at(it, F.lit(k))) for k in fixed.ITEM_VALUE_FIELDS]
        nested = F.from_json(F.try_element_at(it, F.lit("value")), item)
        raw = to_number(F.try_element_at(nested, F.lit("raw")))
        return F.coalesce(*plain, F.nullif(raw, F.lit(0.0)), to_number(F.try_element_at(nested, F.lit("value"))))

    from_map = F.transform(as_map, lambda e: F.struct(F.trim(e["key"]).alias("name"), to_number(e["value"]).alias("value"), F.lit(True).alias("is_map")))
    from_list = F.transform(as_list, lambda it: F.struct(named(it).alias("name"), valued(it).alias("value"), F.lit(False).alias("is_map")))
    ex = rows.select(*keep, F.posexplode_outer(F.coalesce(from_map, from_list)).alias("i_pos", "i"))
    out = ex.select(*keep, "i_pos", "i.name", "i.value", "i.is_map")
    return out.filter(F.col("name").isNotNull() & (F.col("name") != "") & F.col("value").isNotNull())


def _as_reported(rows: DataFrame, order: list[str]) -> DataFrame:
    keyed = rows.select(
        norm_symbol("symbol").alias("symbol"),
        day("date", "fiscalDateEnding", "fillingDate", "filingDate").alias("fiscalDate"),
        norm_period(words("period")).alias("period"),
        F.struct(*order).alias("at"),
        "r",
    ).filter(F.col("fiscalDate").isNotNull())
    return flatten_line_items(keyed, ["symbol", "fiscalDate", "period", "at"])


def _paid_place() -> Column:
    """Exact key first; else items named dividend + paid/payment: negatives first, then the largest magnitude."""
    low, v = F.lower("name"), F.col("value")
    rank = F.when(F.col("is_map") & (F.col("name") == fixed.DIVIDENDS_PAID_KEY), 0).when(
        low.contains("dividend") & (low.contains("paid") | low.contains("payment")), 1
    )
    return F.when(rank.isNotNull(), F.struct(rank, (v >= 0).alias("pos_sign"), (-F.abs(v)).alias("size"), "i_pos"))


def _shares_place() -> Column:
    """Exact key first; else the largest positive item named like shares outstanding."""
    k, v = F.col("item_key"), F.col("value")
    like = k.contains(fixed.SHARES_OUTSTANDING_KEY) | (k.contains("shares") & k.contains("outstanding"))
    rank = F.when(F.col("is_map") & (F.col("name") == fixed.SHARES_OUTSTANDING_KEY) & (v > 0), 0).when(like & (v > 0), 1)
    return F.when(rank.isNotNull(), F.struct(rank, (-v).alias("size"), "i_pos"))


def _cash_flow_place() -> Column:
    """Exact normalised keys by priority; else a matching name with the largest magnitude.

    Two spellings of one exact key in a map: the later entry counts.
    """
    k, v = F.col("item_key"), F.col("value")
    keys = fixed.OPERATING_CASH_FLOW_KEYS
    exact = F.lit(None).cast("int")
    for i, name in reversed(list(enumerate(keys))):
        exact = F.when(F.col("is_map") & (k == name), i).otherwise(exact)
    like = F.lit(False)
    for name in keys:
        like = like | k.contains(name)
    rank = F.coalesce(exact, F.when(like, len(keys)))
    size = F.when(exact.isNull(), -F.abs(v)).otherwise(-F.col("i_pos").cast("double"))
    return F.when(rank.isNotNull(), F.struct(rank, size.alias("size"), "i_pos"))


#: Place of an item among the candidates of a metric, smallest first; NULL for items that do not qualify.
AS_REPORTED = {"dividendsPaid": _paid_place, "operatingCashFlow": _cash_flow_place, "sharesOutstanding": _shares_place}


def as_reported_metrics(rows: DataFrame, order: list[str], metrics: list[str] | None = None) -> DataFrame:
    """(symbol, fiscalDate, period) and the metrics of as-reported payload rows, all from one parse.

    Best item per payload row and metric, then the last payload row per (symbol, date, period) that has one. The
    extra rows with an empty period hold the last row of a date that has any period, so a lookup without period
    finds it. Both steps are one grouped aggregate each; what a row lacks of one metric does not hide another.
    """
    names = metrics or list(AS_REPORTED)
    key = ["symbol", "fiscalDate", "period"]
    items = _as_reported(rows, order).withColumn("item_key", norm_item_key("name"))
    best = items.groupBy(*key, "at").agg(*[F.min_by("value", AS_REPORTED[m]()).alias(m) for m in names])
    # One pass: a row with a period also counts for the empty period.
    both = best.withColumn("period", F.explode(F.array_distinct(F.array("period", F.lit("")))))
    out = both.groupBy(*key).agg(*[F.max_by(m, F.when(F.col(m).isNotNull(), F.col("at"))).alias(m) for m in names])
    return out.filter(F.coalesce(*names).isNotNull())


def _extract(rows: DataFrame, order: list[str], metric: str) -> DataFrame:
    return as_reported_metrics(rows, order, [metric]).withColumnRenamed(metric, "value")


def extract_dividends_paid(rows: DataFrame, order: list[str]) -> DataFrame:
    return _extract(rows, order, "dividendsPaid")


def extract_shares_outstanding(rows: DataFrame, order: list[str]) -> DataFrame:
    return _extract(rows, order, "sharesOutstanding")


def extract_operating_cash_flow(rows: DataFrame, order: list[str]) -> DataFrame:
    return _extract(rows, order, "operatingCashFlow")


def enrich_nulls(fin: DataFrame, *extracted: DataFrame) -> DataFrame:
    """Fill NULLs of the metrics in `extracted` (as_reported_metrics) by (date, period), then by date alone.

    The periods of a date (a handful) become one map, so each extract is one join and needs no second look-up by date.
    """
    out = fin.withColumn("_p", norm_period("period"))
    for i, e in enumerate(extracted):
        names = [m for m in AS_REPORTED if m in e.columns]
        by = F.map_from_entries(F.collect_list(F.struct("period", F.struct(*names)))).alias(f"_m{i}")
        out = out.join(e.groupBy("symbol", "fiscalDate").agg(by), ["symbol", "fiscalDate"], "left")
        at = lambda p: F.try_element_at(f"_m{i}", p)  # noqa: B023, E731
        out = out.withColumns({m: F.coalesce(m, at(F.col("_p"))[m], at(F.lit(""))[m]) for m in names})
    return out.select(*fin.columns)


# ---- events -------------------------------------------------------------------------------------------------


def _dividend_values() -> list[Column]:
    return [
        num("dividend").alias("dividend"),
        num("adjDividend", "adjustedDividend").alias("adjDividend"),
        day("recordDate").alias("recordDate"),
        day("paymentDate").alias("paymentDate"),
        day("declarationDate").alias("declarationDate"),
        words("frequency").alias("frequency"),
        num("yield", "dividendYield").alias("yield"),
    ]


def build_dividends(rows: DataFrame, cutoff: str = fixed.HISTORY_CUTOFF, keep: list[str] | None = None) -> DataFrame:
    ex_date = day("date", "exDividendDate", "exDate")
    out = rows.select(norm_symbol("symbol").alias("symbol"), ex_date.alias("exDate"), *_dividend_values(), *(keep or []))
    return out.filter(F.col("exDate") >= F.lit(cutoff).cast("date"))


def build_dividends_from_calendar(rows: DataFrame, universe: DataFrame, keep: list[str] | None = None) -> DataFrame:
    out = rows.select(row_symbol().alias("symbol"), day("date", "exDate", "exDividendDate").alias("exDate"), *_dividend_values(), *(keep or []))
    return out.filter(F.col("exDate").isNotNull()).join(universe.select("symbol").distinct(), "symbol", "left_semi")


def _earnings_values() -> list[Column]:
    return [
        num("epsActual", "eps", "reportedEps").alias("epsActual"),
        num("epsEstimated", "estimatedEps").alias("epsEstimated"),
        num("revenue", "revenueActual").alias("revenueActual"),
        num("revenueEstimated", "estimatedRevenue").alias("revenueEstimated"),
        day("fiscalDateEnding", "fiscalDate").alias("fiscalDate"),
    ]


def build_earnings(rows: DataFrame, cutoff: str = fixed.HISTORY_CUTOFF, keep: list[str] | None = None) -> DataFrame:
    out = rows.select(norm_symbol("symbol").alias("symbol"), day("date", "fiscalDateEnding", "earningsDate").alias("earningsDate"), *_earnings_values(), *(keep or []))
    return out.filter(F.col("earningsDate") >= F.lit(cutoff).cast("date"))


def build_earnings_from_calendar(rows: DataFrame, universe: DataFrame, last_updated: bool = False, keep: list[str] | None = None) -> DataFrame:
    stamp = [F.substring(F.trim(F.coalesce(F.nullif(field("updated"), F.lit("")), field("lastUpdated"))), 1, 28).alias("lastUpdated")] if last_updated else []
    out = rows.select(row_symbol().alias("symbol"), day("date", "earningsDate", "fiscalDateEnding").alias("earningsDate"), *_earnings_values(), *stamp, *(keep or []))
    return out.filter(F.col("earningsDate").isNotNull()).join(universe.select("symbol").distinct(), "symbol", "left_semi")


# ---- estimates, targets, facts --------------------------------------------------------------------------------


def _forecasts(rows: DataFrame, as_of: Column, n: int, order: list[str]) -> DataFrame:
    f = rows.select(
        norm_symbol("symbol").alias("symbol"),
        day("date", "fiscalDateEnding", "fillingDate").alias("_d"),
        num("epsAvg", "estimatedEpsAvg", "eps", "epsMean").alias("_eps"),
        *order,
    ).filter(F.col("_d") > as_of)
    return top_n_per_key(f, "symbol", [F.col("_d"), *[F.col(o) for o in order]], n, "_rn")


def estimates_annual(rows: DataFrame, universe: DataFrame, as_of: Column, order: list[str] | None = None) -> DataFrame:
    """First and second forecast after `as_of`, and growth to the fifth; one row for every universe symbol."""

    def at(k: int) -> Column:
        return F.max(F.when(F.col("_rn") == k, F.col("_eps")))

    g = _forecasts(rows, as_of, 5, order or ["pos"]).groupBy("symbol").agg(at(1).alias("epsThisY"), at(2).alias("epsNextY"), at(5).alias("_fifth"))
    growth = F.when((F.col("epsThisY") > 0) & (F.col("_fifth") >= 0), F.pow(F.col("_fifth") / F.col("epsThisY"), F.lit(0.2)) - 1.0)
    out = universe.select("symbol").distinct().join(g, "symbol", "left").withColumn("epsNext5Y", growth).withColumn("asOfDate", as_of)
    return conform(out, TABLES["estimates_snapshot"].schema)


def estimates_quarter(rows: DataFrame, universe: DataFrame, as_of: Column, order: list[str] | None = None) -> DataFrame:
    """Nearest forecast after `as_of`; one row for every universe symbol."""
    g = _forecasts(rows, as_of, 1, order or ["pos"]).select("symbol", F.col("_eps").alias("epsNextQ"))
    out = universe.select("symbol").distinct().join(g, "symbol", "left").withColumn("asOfDate", as_of)
    return conform(out, TABLES["estimates_quarterly_snapshot"].schema)


def target_snapshot(rows: DataFrame, universe: DataFrame, as_of: Column, order: list[str] | None = None) -> DataFrame:
    """Consensus target of the first object; one row for every universe symbol."""
    target = num("targetConsensus", "consensus", "priceTarget", "targetPrice", "median")
    g = rows.select(norm_symbol("symbol").alias("symbol"), F.struct(target.alias("t")).alias("_t"), F.struct(*(order or ["pos"])).alias("_o"))
    first = g.groupBy("symbol").agg(F.min_by("_t", "_o").alias("_t")).select("symbol", F.col("_t.t").alias("targetPrice"))
    out = universe.select("symbol").distinct().join(first, "symbol", "left").withColumn("asOfDate", as_of)
    return conform(out, TABLES["targets_snapshot"].schema)


def company_facts_merge(profile: DataFrame, shares: DataFrame, universe: DataFrame, as_of: Column, order: list[str] | None = None) -> DataFrame:
    """Profile facts full outer share facts, each the last payload of its symbol in `order`; a value of the profile comes first."""
    order = order or ["pos"]
    u = universe.select("symbol").distinct()
    p = profile.select(
        row_symbol().alias("symbol"),
        words("sector").alias("sector"),
        words("industry").alias("industry"),
        num("fullTimeEmployees", "employees", "employeeCount").alias("employees"),
        day("ipoDate", "date").alias("ipoDate"),
        num("sharesOutstanding", "outstandingShares", "commonStockSharesOutstanding").alias("sharesOutstanding_profile"),
        *order,
    ).join(u, "symbol", "left_semi")
    s = shares.select(
        row_symbol().alias("symbol"),
        num("outstandingShares", "sharesOutstanding", "commonStockSharesOutstanding").alias("sharesOutstanding_shares"),
        num("floatShares", "sharesFloat", "float").alias("sharesFloat"),
        *order,
    ).join(u, "symbol", "left_semi")
    p, s = (last_per_key(d, ["symbol"], order).drop(*order) for d in (p, s))
    return conform(p.join(s, "symbol", "full").withColumn("asOfDate", as_of), TABLES["company_facts_snapshot"].schema)


# ---- insiders, membership ---------------------------------------------------------------------------------------


def insider_transactions(rows: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Insider trades of the feed; the columns of `order` stay, so that the last of a key can be told."""
    qty, price = num("securitiesTransacted", "shares", "quantity"), num("price")
    name, link = words("reportingName"), words("link", "url", "filingUrl")
    out = rows.select(
        norm_symbol("symbol").alias("symbol"),
        day("transactionDate", "date").alias("transactionDate"),
        stable_person_id(words("reportingCik", "cik"), name, link).alias("reportingCik"),
        name.alias("reportingName"),
        words("transactionType", "type").alias("transactionType"),
        qty.alias("securitiesTransacted"),
        price.alias("price"),
        F.coalesce(num("value"), price * qty).alias("value"),
        num("securitiesOwned").alias("securitiesOwned"),
        words("securityName").alias("securityName"),
        words("formType", "form").alias("formType"),
        words("acquisitionOrDisposition").alias("acquisitionOrDisposition"),
        link.alias("link"),
        *(order or []),
    )
    return out.filter(F.col("transactionDate").isNotNull())


def insider_holdings_snapshot(tx: DataFrame, as_of: Column, common_stock_only: bool = True, order: list[str] | None = None) -> DataFrame:
    """Newest holding per (symbol, person, security), stamped with `as_of`; of one date the first in `order`."""
    d = tx.filter(F.col("securitiesOwned").isNotNull())
    if common_stock_only:
        d = d.filter(F.upper("securityName").contains("COMMON STOCK"))
    newest = [F.col("transactionDate").desc(), *[F.col(o) for o in order or []]]
    top = top_n_per_key(d, ["symbol", "reportingCik", "securityName"], newest, 1, "_rn")
    return top.select(
        "symbol", as_of.alias("asOfDate"), "reportingCik", "reportingName", "securitiesOwned", "securityName",
        F.col("transactionDate").alias("lastTransactionDate"),
    )


def index_membership(universe: DataFrame, index_symbol: str, members: DataFrame, as_of: Column) -> DataFrame:
    """Every universe symbol with a flag whether the index holds it."""
    m = members.select(F.col("symbol").alias("memberSymbol")).distinct().withColumn("_in", F.lit(True))
    u = universe.select(F.col("symbol").alias("memberSymbol")).distinct().join(m, "memberSymbol", "left")
    return u.select(
        F.lit(index_symbol.upper()).alias("indexSymbol"), as_of.alias("asOfDate"), "memberSymbol", F.col("_in").isNotNull().alias("isMember")
    )
