"""Domain tables made from the driver's tables, so that every operator runs on them.

Suppliers stand for symbols, ship dates for trading days, ship quarters for fiscal quarters and line numbers
for event kinds. Everything is an aggregate or a projection of whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarterdeck.plans.factors import FactorInputs
from quarterdeck.session import materialise
from quarterdeck.sources.payloads import payload_rows, write_payload_bundles

ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_returnflag", "l_discount"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def lines(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.withColumns({"symbol": F.concat(F.lit("S"), F.col("l_suppkey").cast("string")), "date": F.col("l_shipdate").cast("date")})


def orders(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.withColumns({"symbol": F.concat(F.lit("C"), F.col("o_custkey").cast("string")), "date": F.col("o_orderdate").cast("date")})


def ticks(spark: SparkSession, sf: str) -> DataFrame:
    """Raw price records, several per (symbol, date)."""
    return lines(spark, sf).select("symbol", "date", F.col("l_extendedprice").alias("close"), F.col("l_quantity").alias("volume"), *ORDER)


def prices(spark: SparkSession, sf: str) -> DataFrame:
    at, px = F.struct(*ORDER), F.col("l_extendedprice")
    g = lines(spark, sf).groupBy("symbol", "date").agg(
        F.min_by(px, at).alias("open"),
        F.max(px).alias("high"),
        F.min(px).alias("low"),
        F.max_by(F.struct("l_extendedprice", "l_returnflag", "l_discount"), at).alias("_last"),
        F.sum("l_quantity").alias("volume"),
    )
    last = F.col("_last")
    adj = F.when(last["l_returnflag"] != "R", last["l_extendedprice"] * (1 - last["l_discount"]))
    return g.select("symbol", "date", "open", "high", "low", last["l_extendedprice"].alias("close"), adj.alias("adjClose"), "volume")


def adjusted(spark: SparkSession, sf: str) -> DataFrame:
    return prices(spark, sf).withColumn("close", F.coalesce("adjClose", "close"))


def stored_prices(spark: SparkSession, sf: str) -> DataFrame:
    """The price table as jobs find it: written once below the shared folder."""
    return materialise(prices(spark, sf), "prices")


def market_of(px: DataFrame) -> DataFrame:
    """Mean adjusted close of all symbols per day."""
    daily = px.groupBy("date").agg(F.avg(F.coalesce("adjClose", "close")).alias("close"))
    return daily.select(F.lit("^GSPC").alias("symbol"), "date", "close")


def market(spark: SparkSession, sf: str) -> DataFrame:
    return market_of(prices(spark, sf))


def quarter_end(d: str = "date") -> Column:
    return F.last_day(F.add_months(F.trunc(d, "quarter"), 2))


def financials(spark: SparkSession, sf: str) -> DataFrame:
    li = lines(spark, sf).withColumn("fiscalDate", quarter_end())
    p, d, t, qty = (F.col(c) for c in ("l_extendedprice", "l_discount", "l_tax", "l_quantity"))
    few = F.col("l_linenumber") <= 2
    is_r, is_a, is_n = (F.col("l_returnflag") == x for x in "RAN")
    return li.groupBy("symbol", "fiscalDate").agg(
        F.concat(F.lit("Q"), F.max(F.quarter("date")).cast("string")).alias("period"),
        F.sum(p * (1 - d)).alias("revenue"),
        F.sum(p * (d - t / 2)).alias("netIncome"),
        F.sum(F.when(few, p * d)).alias("grossProfit"),
        F.sum(p * d).alias("operatingIncome"),
        F.sum(p * (d + 0.02)).alias("EBITDA"),
        F.sum(p * (d - t / 4)).alias("incomeBeforeTax"),
        F.sum(p * (t / 4)).alias("incomeTaxExpense"),
        F.sum(p * t).alias("cashAndCashEquivalents"),
        F.sum(qty * 10).alias("receivables"),
        F.sum(qty).alias("shortTermInvestments"),
        (F.sum(p) / 2).alias("currentAssets"),
        F.sum(F.when(F.col("l_linestatus") == "F", p)).alias("currentLiabilities"),
        (F.sum(p) * 2).alias("totalAssets"),
        (F.sum(p * t) + F.sum(p)).alias("totalStockholdersEquity"),
        F.sum(F.when(few & is_r, p)).alias("totalDebt"),
        F.sum(F.when(few & is_a, p)).alias("longTermDebt"),
        F.sum(F.when(is_n, p * d).otherwise(-p * t)).alias("freeCashFlow"),
        F.sum(F.when((F.col("l_linestatus") == "F") & (F.col("l_linenumber") <= 4), p * d)).alias("operatingCashFlow"),
        (-F.sum(F.when(is_n, p * 0.01))).alias("dividendsPaid"),
        F.sum(qty).alias("weightedAverageSharesDiluted"),
        F.sum(F.when((F.col("l_linenumber") == 1) & is_r, qty * 100)).alias("sharesOutstanding"),
    )


def dividends(spark: SparkSession, sf: str) -> DataFrame:
    li = lines(spark, sf).filter("l_linenumber = 1")
    return li.select(
        "symbol",
        F.col("date").alias("exDate"),
        (F.col("l_tax") + 0.01).alias("dividend"),
        (F.col("l_tax") / 2).alias("adjDividend"),
        F.date_add("date", 1).alias("recordDate"),
        F.when(F.col("l_returnflag") != "N", F.date_add("date", 14)).alias("paymentDate"),
        F.date_sub("date", 14).alias("declarationDate"),
        F.lit("Quarterly").alias("frequency"),
        F.col("l_discount").alias("yield"),
        *ORDER,
    )


def _snapshot(spark: SparkSession, sf: str, line: int, *aggs: Column) -> DataFrame:
    li = lines(spark, sf).filter(F.col("l_linenumber") == line)
    return li.groupBy("symbol", F.col("date").alias("asOfDate")).agg(*aggs)


def shares(spark: SparkSession, sf: str) -> DataFrame:
    qty = F.col("l_quantity")
    return _snapshot(
        spark, sf, 2, F.sum(qty * 1000).alias("sharesOutstanding"), F.sum(F.when(F.col("l_returnflag") != "R", qty * 800)).alias("sharesFloat")
    )


def targets(spark: SparkSession, sf: str) -> DataFrame:
    return _snapshot(spark, sf, 3, F.max(F.when(F.col("l_returnflag") != "A", F.col("l_extendedprice"))).alias("targetPrice"))


def estimates(spark: SparkSession, sf: str) -> DataFrame:
    e = _snapshot(spark, sf, 4, F.sum(F.col("l_discount") * 10).alias("epsThisY"), F.sum(F.when(F.col("l_returnflag") != "N", F.col("l_tax") * 20)).alias("epsNextY"))
    return e.select("symbol", "asOfDate", "epsNextY", F.lit(None).cast("double").alias("epsNextQ"), "epsThisY", F.lit(None).cast("double").alias("epsNext5Y"))


def estimates_quarterly(spark: SparkSession, sf: str) -> DataFrame:
    return _snapshot(spark, sf, 5, F.sum(F.when(F.col("l_returnflag") != "N", F.col("l_tax"))).alias("epsNextQ"))


def company_facts(spark: SparkSession, sf: str) -> DataFrame:
    qty, flag = F.col("l_quantity"), F.col("l_returnflag")
    c = _snapshot(
        spark, sf, 6,
        F.sum(F.when(flag == "A", qty)).alias("employees"),
        F.sum(qty * 1000).alias("sharesOutstanding_profile"),
        F.sum(F.when(flag != "A", qty * 900)).alias("sharesOutstanding_shares"),
        F.sum(qty * 700).alias("sharesFloat"),
    )
    return c.withColumns({"ipoDate": F.date_sub("asOfDate", 3650), "sector": F.lit("Sector"), "industry": F.lit(None).cast("string")})


def holdings(spark: SparkSession, sf: str) -> DataFrame:
    li = lines(spark, sf).filter("l_linenumber = 7")
    person = F.when(F.col("l_returnflag") != "N", F.concat(F.lit("P"), F.floor(F.col("l_partkey") / 100).cast("string")))
    return li.select(
        "symbol",
        F.last_day("date").alias("asOfDate"),
        person.alias("reportingCik"),
        person.alias("reportingName"),
        (F.col("l_quantity") * 50).alias("securitiesOwned"),
        F.lit("Common Stock").alias("securityName"),
        F.col("date").alias("lastTransactionDate"),
    )


def transactions(spark: SparkSession, sf: str) -> DataFrame:
    li = lines(spark, sf)
    flag, n = F.col("l_returnflag"), F.col("l_linenumber")
    kind = F.when(n <= 2, F.lit("S-Sale")).when(n <= 4, F.lit("P-Purchase")).when(n == 5, F.lit("Acquired by gift")).otherwise(F.lit("Award"))
    return li.select(
        "symbol",
        F.col("date").alias("transactionDate"),
        F.concat(F.lit("P"), F.floor(F.col("l_partkey") / 100).cast("string")).alias("reportingCik"),
        F.concat(F.lit("Person "), F.floor(F.col("l_partkey") / 100).cast("string")).alias("reportingName"),
        kind.alias("transactionType"),
        F.col("l_quantity").alias("securitiesTransacted"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") * F.col("l_quantity")).alias("value"),
        F.when(flag != "R", F.col("l_quantity") * 100).alias("securitiesOwned"),
        F.when(n <= 3, F.lit("Common Stock")).otherwise(F.lit("Option")).alias("securityName"),
        F.lit("4").alias("formType"),
        F.when(flag == "A", F.lit("A")).when(flag == "R", F.lit("D")).alias("acquisitionOrDisposition"),
        F.lit(None).cast("string").alias("link"),
        *ORDER,
    )


def suppliers(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier")
    return s.withColumn("symbol", F.concat(F.lit("S"), F.col("s_suppkey").cast("string")))


def universe(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers with a positive balance."""
    return suppliers(spark, sf).filter("s_acctbal > 0").select("symbol")


def membership(spark: SparkSession, sf: str) -> DataFrame:
    s = suppliers(spark, sf)
    days = F.array(F.lit("2001-06-30").cast("date"), F.lit("2001-12-31").cast("date"))
    d = s.select("symbol", "s_acctbal", F.explode(days).alias("asOfDate"))
    limit = F.when(F.col("asOfDate") == F.lit("2001-12-31").cast("date"), 2000.0).otherwise(5000.0)
    return d.select(
        F.lit("SP500").alias("indexSymbol"), "asOfDate", F.col("symbol").alias("memberSymbol"), (F.col("s_acctbal") > limit).alias("isMember")
    )


def factor_inputs(spark: SparkSession, sf: str) -> FactorInputs:
    px = stored_prices(spark, sf)
    return FactorInputs(
        prices=px, market=market_of(px), financials=financials(spark, sf), dividends=dividends(spark, sf),
        shares=shares(spark, sf), membership=membership(spark, sf), targets=targets(spark, sf), company_facts=company_facts(spark, sf),
        holdings=holdings(spark, sf), transactions=transactions(spark, sf), estimates=estimates(spark, sf),
        estimates_quarterly=estimates_quarterly(spark, sf),
    )


# ---- landed payloads ---------------------------------------------------------------------------------------


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt evenly: the driver's files are one row group each, which a scan cannot split.

    Lines are dealt by their key: dealing in turn makes Spark sort the rows of each task first.
    """
    n, keys = df.sparkSession.sparkContext.defaultParallelism, ["l_orderkey", "l_linenumber"]
    return df.repartition(n, *keys) if set(keys) <= set(df.columns) else df.repartition(n)


def landed(df: DataFrame, keep: list[str], **fields: Column) -> DataFrame:
    """One JSON payload (a list of one object) per input row, parsed back to payload rows."""
    df = spread(df)
    body = F.to_json(F.array(F.struct(*[c.alias(n) for n, c in fields.items()])))
    return payload_rows(df.select(*keep, body.alias("body")), "body", keep)


def land(df: DataFrame, path: str, row: Column, symbol: str = "symbol", order: list[str] | None = None) -> None:
    """Bundles as a loader leaves them (see `sources.payloads.read_payload_bundles`): one response per symbol, a list of the JSON
    rows in feed order."""
    keyed = df.withColumn("_of", F.col(symbol)).repartition("_of")  # columns travel, not their longer JSON
    # Flat: for a struct inside the sorted one Spark makes an ordering anew at every comparison.
    placed = F.struct(*(order or ORDER), row.alias("_row"))
    rows = keyed.groupBy(F.col("_of").alias("symbol")).agg(F.sort_array(F.collect_list(placed)).alias("rows"))
    body = F.concat(F.lit("["), F.array_join(F.transform("rows", lambda x: x["_row"]), ","), F.lit("]"))
    write_payload_bundles(rows.select("symbol", body.alias("body")), path)


# ---- company documents -----------------------------------------------------------------------------------------


def filings(spark: SparkSession, sf: str) -> DataFrame:
    """One filing per (symbol, quarter): quarter and year-to-date figures and last year's balance."""
    f = financials(spark, sf).withColumns({"y": F.year("fiscalDate"), "qn": F.quarter("fiscalDate")})
    ytd = Window.partitionBy("symbol", "y").orderBy("fiscalDate").rowsBetween(Window.unboundedPreceding, 0)
    back = Window.partitionBy("symbol").orderBy("fiscalDate")
    key = F.substring("symbol", 2, 20)
    return f.select(
        "symbol", "y", "qn", "fiscalDate",
        key.alias("cik"),
        F.trunc("fiscalDate", "quarter").alias("q_start"),
        F.trunc("fiscalDate", "year").alias("y_start"),
        F.concat_ws("-", F.lit("A"), key, F.col("y").cast("string"), F.col("qn").cast("string")).alias("accn"),
        F.date_add("fiscalDate", 40).alias("filed"),
        F.when(F.col("qn") == 4, F.lit("FY")).otherwise(F.concat(F.lit("Q"), F.col("qn").cast("string"))).alias("fp"),
        F.when(F.col("qn") == 4, F.lit("10-K")).otherwise(F.lit("10-Q")).alias("form"),
        (F.col("y") * 10 + F.col("qn")).cast("long").alias("doc_pos"),
        F.col("revenue").alias("rev"), F.sum("revenue").over(ytd).alias("rev_ytd"),
        F.sum("netIncome").over(ytd).alias("ni_ytd"),
        F.col("totalAssets").alias("assets"), F.lag("totalAssets", 4).over(back).alias("assets_ago"), F.lag("fiscalDate", 4).over(back).alias("end_ago"),
        (F.col("totalAssets") - F.col("totalStockholdersEquity") + F.col("totalDebt") * 0.2).alias("liabilities"),
        F.col("totalStockholdersEquity").alias("equity"),
        F.sum("operatingIncome").over(ytd).alias("cost_ytd"), F.sum("incomeTaxExpense").over(ytd).alias("sga_ytd"),
        F.col("cashAndCashEquivalents").alias("interest"),
        F.col("weightedAverageSharesDiluted").alias("shares"),
        F.col("totalDebt").isNull().alias("no_debt"),
    )


def _fact(end: Column | str, val: Column | str, start: str | None = None, when: Column | None = None) -> Column:
    e = F.col(end) if isinstance(end, str) else end
    v = F.col(val) if isinstance(val, str) else val
    f = F.struct(
        *([F.col(start).cast("string").alias("start")] if start else [F.lit(None).cast("string").alias("start")]),
        e.cast("string").alias("end"), v.alias("val"), F.col("accn").alias("accn"), F.col("y").alias("fy"), F.col("fp").alias("fp"),
        F.col("form").alias("form"), F.col("filed").cast("string").alias("filed"),
    )
    return F.when(when, f) if when is not None else f


def _usd(*facts: Column, unit: str = "USD") -> Column:
    return F.struct(F.struct(F.array_compact(F.array(*facts)).alias(unit)).alias("units"))


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """Company-facts JSON, one document per filing."""
    qn, end = F.col("qn"), F.col("fiscalDate")
    tags = {
        "Revenues": _usd(_fact(end, "rev", "q_start", qn <= 2), _fact(end, "rev_ytd", "y_start", qn >= 2)),
        "NetIncomeLoss": _usd(_fact(end, "ni_ytd", "y_start")),
        "Assets": _usd(_fact("end_ago", "assets_ago", None, F.col("end_ago").isNotNull()), _fact(end, "assets")),
        "Liabilities": _usd(_fact(end, "liabilities", None, F.col("liabilities").isNotNull())),
        "StockholdersEquity": _usd(_fact(end, "equity")),
        "CostOfRevenue": _usd(_fact(end, "cost_ytd", "y_start", F.col("no_debt"))),
        "CostOfGoodsAndServicesSold": _usd(_fact(end, F.col("cost_ytd") * 2, "y_start")),
        "SellingGeneralAndAdministrativeExpense": _usd(_fact(end, "sga_ytd", "y_start", qn != 3)),
        "InterestExpense": _usd(_fact(end, "interest", "q_start", qn == 1), _fact(F.date_sub(end, 2), "interest", "q_start", qn == 4)),
        "InterestPaidNet": _usd(_fact(end, "interest", "q_start", qn == 2)),
    }
    dei = F.struct(_usd(_fact(end, "shares"), unit="shares").alias("EntityCommonStockSharesOutstanding"))
    gaap = F.struct(*[c.alias(t) for t, c in tags.items()])
    doc = F.struct(F.col("cik").cast("long").alias("cik"), F.struct(gaap.alias("us-gaap"), dei.alias("dei")).alias("facts"))
    return filings(spark, sf).select("symbol", "doc_pos", F.to_json(doc).alias("body"))


def concept_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Single-concept JSON of interest paid, one document per filing; ends differ from the slot by 0 to 9 days."""
    shift = F.when(F.col("no_debt"), 5).otherwise(9)
    doc = F.struct(
        F.col("cik").cast("long").alias("cik"),
        F.when(F.col("qn") == 3, F.lit("InterestPaid")).otherwise(F.lit("InterestExpenseDebt")).alias("tag"),
        F.struct(F.array(_fact(F.date_sub("fiscalDate", shift), F.col("interest") / 2, "q_start")).alias("USD")).alias("units"),
    )
    return filings(spark, sf).filter("qn >= 3").select("symbol", "doc_pos", F.to_json(doc).alias("body"))
