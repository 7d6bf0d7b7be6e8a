"""Queries of the payload jobs: JSON made from whole tables, normalised to declared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterdeck.catalog import bindings as B
from quarterdeck.catalog.registry import query
from quarterdeck.operators import payloads as N
from quarterdeck.sources.payloads import payload_rows

_AT = [*B.ORDER, "pos"]
_KEEP = ["symbol", *B.ORDER]


def _is(flag):
    return F.col("l_returnflag") == flag


def _t(c):
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _day(c="date"):
    return F.concat(_t(c), F.lit("T00:00:00"))


def _lines(spark, sf, where=None):
    li = B.lines(spark, sf)
    return li.filter(where) if where else li


@query(
    "N1_build_prices",
    """
SELECT symbol, CAST(date AS VARCHAR) AS date, l_extendedprice AS open, CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS high, NULL::DOUBLE AS low,
  round(l_extendedprice * (1 - l_discount), 6) AS close, CASE l_returnflag WHEN 'A' THEN l_tax WHEN 'N' THEN l_discount END AS "adjClose", l_quantity AS volume
FROM li WHERE l_linenumber <> 7""",
    "li",
)
def n1(spark, sf):
    rows = B.landed(
        _lines(spark, sf), _KEEP,
        date=F.when(F.col("l_linenumber") != 7, _day()),
        open=F.when(_is("A"), _t("l_extendedprice")).otherwise(F.lit(" ")), Open=F.col("l_extendedprice"),
        high=F.when(_is("R"), F.lit("high")).otherwise(_t("l_extendedprice")), High=F.lit(1),
        Close=F.col("l_extendedprice") * (1 - F.col("l_discount")),
        adjClose=F.when(_is("A"), F.col("l_tax")), adj_close=F.when(_is("N"), _t("l_discount")),
        Volume=_t("l_quantity"),
    )
    return N.build_prices(rows)


@query(
    "N2_build_adjclose",
    """
SELECT symbol, CAST(date AS VARCHAR) AS date, l_extendedprice AS "adjClose" FROM li
WHERE l_returnflag <> 'R' AND date BETWEEN DATE '1996-01-01' AND DATE '2000-06-30'""",
    "li",
)
def n2(spark, sf):
    rows = B.landed(_lines(spark, sf), _KEEP, date=_day(), adjustedClose=F.when(~_is("R"), F.col("l_extendedprice")))
    return N.build_adjclose(rows, "1996-01-01", "2000-06-30")


def statement_lines(spark, sf):
    """Lines and payload fields of the three statements."""
    n = F.col("l_quantity")
    values = {
        "income": (1, {
            "revenue": F.when(_is("A"), _t("l_extendedprice")), "Revenue": n, "netIncome": F.col("l_tax"), "weightedAverageShsOutDil": F.when(n > 25, n),
        }),
        "balance": (2, {
            "totalAssets": F.col("l_extendedprice"), "netReceivables": F.lit(""), "receivables": n, "commonStockSharesOutstanding": F.when(_is("A"), n * 50),
        }),
        "cash": (3, {
            "operatingCashFlow": F.when(_is("A"), F.col("l_extendedprice")), "cashFromOperations": F.when(_is("R"), F.col("l_tax")),
            "weightedAverageSharesDiluted": F.col("l_linenumber") * 1000, "cashDividendsPaid": F.when(~_is("R"), -n),
        }),
    }
    period = F.when(~_is("N"), F.concat(F.lit("Q"), F.quarter("q")))
    for feed, (line, fields) in values.items():
        li = _lines(spark, sf, f"l_linenumber = {line}").withColumn("q", B.quarter_end())
        yield feed, li, {"date": _day("q"), "period": period} | fields


def statements(spark, sf):
    return [B.landed(li, _KEEP, **fields) for _, li, fields in statement_lines(spark, sf)]


def _stmt_sql(line: int, cols: str) -> str:
    return f"""(SELECT symbol, fd, per, {cols} FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, fd, per ORDER BY o DESC, l_quantity DESC, l_tax DESC) AS k FROM (
    SELECT *, CAST(date_trunc('quarter', date) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS fd, CASE WHEN l_returnflag = 'N' THEN '' ELSE 'Q' || quarter(date) END AS per FROM li WHERE l_linenumber = {line})
  WHERE fd >= DATE '1996-01-01') WHERE k = 1)"""


FINANCIALS_SQL = f"""
SELECT symbol, fd, per, revenue, ni, dil, ta, rec, so, ocf, dp, coalesce(dil, dil2) AS wad FROM
  {_stmt_sql(1, "CASE WHEN l_returnflag = 'A' THEN l_extendedprice ELSE l_quantity END AS revenue, l_tax AS ni, CASE WHEN l_quantity > 25 THEN l_quantity END AS dil")} i
  FULL JOIN {_stmt_sql(2, "l_extendedprice AS ta, l_quantity AS rec, CASE WHEN l_returnflag = 'A' THEN l_quantity * 50 END AS so")} b USING (symbol, fd, per)
  FULL JOIN {_stmt_sql(3, "CASE l_returnflag WHEN 'A' THEN l_extendedprice WHEN 'R' THEN l_tax END AS ocf, CASE WHEN l_returnflag <> 'R' THEN -l_quantity END AS dp, l_linenumber * 1000.0::DOUBLE AS dil2")} c USING (symbol, fd, per)"""

_ORD = [*_AT]


def merged_financials(spark, sf):
    return N.build_financials(*statements(spark, sf), cutoff="1996-01-01", order=_ORD)


@query(
    "N3_build_financials",
    f"""
SELECT symbol, CAST(fd AS VARCHAR) AS "fiscalDate", nullif(per, '') AS period, revenue, ni AS "netIncome", wad AS "weightedAverageSharesDiluted",
  ta AS "totalAssets", rec AS receivables, ocf AS "operatingCashFlow", dp AS "dividendsPaid" FROM ({FINANCIALS_SQL})""",
    "li",
)
def n3(spark, sf):
    return merged_financials(spark, sf).select(
        "symbol", "fiscalDate", "period", "revenue", "netIncome", "weightedAverageSharesDiluted", "totalAssets", "receivables", "operatingCashFlow", "dividendsPaid"
    )


def as_reported_row():
    """As-reported object of a line with its quarter end `q`: a map of items for flag A, a list of item objects otherwise."""
    px, qty = F.col("l_extendedprice"), F.col("l_quantity")
    n = F.col("l_linenumber")
    as_map = F.to_json(
        F.struct(
            F.when(n == 1, F.format_number(-px, 2)).alias("paymentsofdividends"),
            F.when(n <= 2, qty * 7).alias("commonstocksharesoutstanding"),
            F.when(n == 3, px).alias("Net_Cash Provided_By Operating Activities"),
            F.when(n >= 3, px / 4).alias("OperatingCashFlow"),
            F.lit("text").alias("note"),
        )
    )
    as_list = F.to_json(
        F.array(
            F.struct(F.lit(" Dividends paid ").alias("label"), (-qty).alias("amount"), F.lit(None).cast("string").alias("tag")),
            F.struct(F.lit("Payments of dividends").alias("label"), (qty * n).alias("amount"), F.lit("x").alias("tag")),
            F.struct(F.lit("Total shares outstanding").alias("label"), qty.alias("amount"), F.lit("y").alias("tag")),
            F.struct(F.lit("Cash from operations, other").alias("label"), (-px).alias("amount"), F.lit("z").alias("tag")),
            F.struct(F.lit("").alias("label"), px.alias("amount"), F.lit(None).cast("string").alias("tag")),
        )
    )
    # The nested document goes in as JSON, not as quoted text.
    return F.concat(
        F.lit('{"date":"'), _t("q"), F.lit('","period":'),
        F.when(~_is("N"), F.concat(F.lit('"Q'), F.quarter("q"), F.lit('"'))).otherwise(F.lit("null")),
        F.lit(',"data":'), F.when(_is("A"), as_map).otherwise(as_list), F.lit("}"),
    )


def _items(spark, sf):
    li = B.spread(_lines(spark, sf).withColumn("q", B.quarter_end()))
    return payload_rows(li.select(*_KEEP, F.concat(F.lit("["), as_reported_row(), F.lit("]")).alias("body")), "body", _KEEP)


ITEMS = """
(SELECT symbol, CAST(date_trunc('quarter', date) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS fd, CASE WHEN l_returnflag = 'N' THEN '' ELSE 'Q' || quarter(date) END AS per, o, l_orderkey, i.*
 FROM li CROSS JOIN LATERAL (
  SELECT 0 AS i_pos, 'paymentsofdividends' AS name, -round(l_extendedprice, 2) AS v, true AS m WHERE l_returnflag = 'A' AND l_linenumber = 1
  UNION ALL SELECT 1, 'commonstocksharesoutstanding', l_quantity * 7, true WHERE l_returnflag = 'A' AND l_linenumber <= 2
  UNION ALL SELECT 2, 'Net_Cash Provided_By Operating Activities', l_extendedprice, true WHERE l_returnflag = 'A' AND l_linenumber = 3
  UNION ALL SELECT 3, 'OperatingCashFlow', l_extendedprice / 4, true WHERE l_returnflag = 'A' AND l_linenumber >= 3
  UNION ALL SELECT 0, 'Dividends paid', -l_quantity, false WHERE l_returnflag <> 'A'
  UNION ALL SELECT 1, 'Payments of dividends', l_quantity * l_linenumber, false WHERE l_returnflag <> 'A'
  UNION ALL SELECT 2, 'Total shares outstanding', l_quantity, false WHERE l_returnflag <> 'A'
  UNION ALL SELECT 3, 'Cash from operations, other', -l_extendedprice, false WHERE l_returnflag <> 'A') i)"""


@query("N4_flatten_line_items", f"SELECT symbol, l_orderkey, name, round(v, 6) AS value, m AS is_map FROM {ITEMS}", "li")
def n4(spark, sf):
    return N.flatten_line_items(_items(spark, sf), ["symbol", "l_orderkey"]).drop("i_pos")


def _extract_sql(rank: str, prefer: str) -> str:
    return f"""
SELECT symbol, fd, per, arg_max(v, o) AS v FROM (
  SELECT symbol, fd, per, o, v FROM best UNION ALL SELECT symbol, fd, '', o, v FROM best WHERE per <> '') GROUP BY symbol, fd, per""".replace(
        "best",
        f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, fd, per, o ORDER BY rk, {prefer}, i_pos) AS k
  FROM (SELECT *, {rank} AS rk FROM {ITEMS}) WHERE rk IS NOT NULL) WHERE k = 1)""",
    )


DIVIDENDS_PAID = _extract_sql(
    "CASE WHEN m AND name = 'paymentsofdividends' THEN 0 WHEN lower(name) LIKE '%dividend%' AND (lower(name) LIKE '%paid%' OR lower(name) LIKE '%payment%') THEN 1 END",
    "v >= 0, -abs(v)",
)
SHARES_OUT = _extract_sql("CASE WHEN v > 0 AND m AND name = 'commonstocksharesoutstanding' THEN 0 WHEN v > 0 AND lower(name) LIKE '%shares%' AND lower(name) LIKE '%outstanding%' THEN 1 END", "-v")
CASH_FLOW = _extract_sql(
    "CASE WHEN name LIKE 'Net_Cash%' THEN 1 WHEN name = 'OperatingCashFlow' THEN 3 WHEN name LIKE 'Cash from op%' THEN 4 END", "CASE WHEN m THEN 0 ELSE -abs(v) END"
)
_OUT = 'symbol, CAST(fd AS VARCHAR) AS "fiscalDate", per AS period, round(v, 6) AS value'


@query("N5_extract_dividends_paid", f"SELECT {_OUT} FROM ({DIVIDENDS_PAID})", "li")
def n5(spark, sf):
    return N.extract_dividends_paid(_items(spark, sf), _AT)


@query("N6_extract_shares_outstanding", f"SELECT {_OUT} FROM ({SHARES_OUT})", "li")
def n6(spark, sf):
    return N.extract_shares_outstanding(_items(spark, sf), _AT)


@query("N7_extract_operating_cash_flow", f"SELECT {_OUT} FROM ({CASH_FLOW})", "li")
def n7(spark, sf):
    return N.extract_operating_cash_flow(_items(spark, sf), _AT)


def _filled(column: str, extract: str, i: int) -> tuple[str, str]:
    """Value and joins of one metric filled by period, then by date."""
    joins = " ".join(f"LEFT JOIN ({extract}) x{i}{k} ON x{i}{k}.symbol = f.symbol AND x{i}{k}.fd = f.fd AND x{i}{k}.per = {per}" for k, per in enumerate(["f.per", "''"]))
    return f"coalesce({column}, x{i}0.v, x{i}1.v)", joins


_FILLED = [_filled("f.dp", DIVIDENDS_PAID, 0), _filled("f.ocf", CASH_FLOW, 1), _filled("f.so", SHARES_OUT, 2)]


@query(
    "N8_enrich_nulls",
    f"""
SELECT f.symbol, CAST(f.fd AS VARCHAR) AS "fiscalDate", nullif(f.per, '') AS period, round({_FILLED[0][0]}, 6) AS "dividendsPaid", round({_FILLED[1][0]}, 6) AS "operatingCashFlow", round({_FILLED[2][0]}, 6) AS "sharesOutstanding"
FROM ({FINANCIALS_SQL}) f {" ".join(x[1] for x in _FILLED)}""",
    "li",
)
def n8(spark, sf):
    f = N.enrich_nulls(merged_financials(spark, sf), N.as_reported_metrics(_items(spark, sf), _AT))
    return f.select("symbol", "fiscalDate", "period", "dividendsPaid", "operatingCashFlow", "sharesOutstanding")


_DIV_SQL = """l_tax AS dividend, l_discount AS "adjDividend", CAST(date + 1 AS VARCHAR) AS "recordDate", CASE WHEN l_returnflag <> 'N' THEN CAST(date + 14 AS VARCHAR) END AS "paymentDate",
  NULL::VARCHAR AS "declarationDate", CASE WHEN l_returnflag = 'R' THEN 'Monthly' END AS frequency, l_quantity AS yield"""


def _dividend_fields():
    return {
        "dividend": _t("l_tax"),
        "adjustedDividend": F.col("l_discount"),
        "recordDate": _day(F.date_add("date", 1)),
        "paymentDate": F.when(_is("N"), F.lit("")).otherwise(_day(F.date_add("date", 14))),
        "declarationDate": F.lit("unknown"),
        "frequency": F.when(_is("R"), F.lit(" Monthly ")),
        "dividendYield": F.col("l_quantity"),
    }


@query("N9_build_dividends", f"SELECT symbol, CAST(date AS VARCHAR) AS \"exDate\", {_DIV_SQL} FROM li WHERE date >= DATE '1998-01-01'", "li")
def n9(spark, sf):
    rows = B.landed(_lines(spark, sf), _KEEP, date=F.when(_is("A"), _day()), exDividendDate=F.when(_is("N"), _day()), exDate=_day(), **_dividend_fields())
    return N.build_dividends(rows, "1998-01-01")


def _ticker_fields():
    return {"symbol": F.when(_is("A"), F.lit(" ")), "ticker": F.lower(F.concat(F.lit(" "), F.col("symbol")))}


@query(
    "N10_build_dividends_from_calendar",
    f'SELECT symbol, CAST(date AS VARCHAR) AS "exDate", {_DIV_SQL} FROM li WHERE symbol IN (SELECT symbol FROM uni)',
    "li uni",
)
def n10(spark, sf):
    li = _lines(spark, sf)
    rows = B.landed(li, B.ORDER, **_ticker_fields(), date=F.when(_is("A"), _day()), exDate=_day(), **_dividend_fields())
    return N.build_dividends_from_calendar(rows, B.universe(spark, sf))


_EARN_SQL = """CASE WHEN l_returnflag = 'A' THEN l_tax ELSE l_discount END AS "epsActual", l_quantity AS "epsEstimated", l_extendedprice AS "revenueActual", NULL::DOUBLE AS "revenueEstimated",
  CAST(date - 30 AS VARCHAR) AS "fiscalDate\""""


def _earning_fields():
    return {
        "epsActual": F.when(_is("A"), _t("l_tax")),
        "eps": F.col("l_discount"),
        "estimatedEps": F.col("l_quantity"),
        "revenueActual": F.col("l_extendedprice"),
        "fiscalDate": _day(F.date_sub("date", 30)),
    }


@query("N11_build_earnings", f"SELECT symbol, CAST(date AS VARCHAR) AS \"earningsDate\", {_EARN_SQL} FROM li WHERE date >= DATE '1997-01-01'", "li")
def n11(spark, sf):
    rows = B.landed(_lines(spark, sf), _KEEP, date=F.when(_is("A"), _day()), earningsDate=_day(), **_earning_fields())
    return N.build_earnings(rows, "1997-01-01")


def calendar_rows(spark, sf):
    li = _lines(spark, sf)
    stamp = F.concat(_t(F.date_add("date", 1)), F.lit(" 10:00:00.000000000 and more"))
    return B.landed(li, B.ORDER, **_ticker_fields(), date=_day(), **_earning_fields(), updated=F.when(_is("A"), stamp), lastUpdated=F.when(_is("N"), stamp))


@query(
    "N12_build_earnings_from_calendar",
    f"""
SELECT symbol, CAST(date AS VARCHAR) AS "earningsDate", {_EARN_SQL}, CASE WHEN l_returnflag <> 'R' THEN left(CAST(date + 1 AS VARCHAR) || ' 10:00:00.000000000 and more', 28) END AS "lastUpdated"
FROM li WHERE symbol IN (SELECT symbol FROM uni)""",
    "li uni",
)
def n12(spark, sf):
    return N.build_earnings_from_calendar(calendar_rows(spark, sf), B.universe(spark, sf), last_updated=True)


_AS_OF = "2001-06-30"


def as_of():
    return F.lit(_AS_OF).cast("date")


def _forecast_rows(spark, sf):
    return B.landed(_lines(spark, sf), _KEEP, fillingDate=_day(), epsAvg=F.when(_is("A"), _t("l_quantity")), estimatedEpsAvg=F.when(_is("N"), F.col("l_tax")), eps=F.lit("n/a"))


_FORECAST = f"""(SELECT symbol, CASE l_returnflag WHEN 'A' THEN l_quantity WHEN 'N' THEN l_tax END AS eps, row_number() OVER (PARTITION BY symbol ORDER BY date, o) AS k FROM li WHERE date > DATE '{_AS_OF}')"""


@query(
    "N13_estimates_annual",
    f"""
SELECT u.symbol, '{_AS_OF}' AS "asOfDate", max(CASE WHEN k = 2 THEN eps END) AS "epsNextY", NULL::DOUBLE AS "epsNextQ", max(CASE WHEN k = 1 THEN eps END) AS "epsThisY",
  round(CASE WHEN max(CASE WHEN k = 1 THEN eps END) > 0 THEN power(max(CASE WHEN k = 5 THEN eps END) / max(CASE WHEN k = 1 THEN eps END), 0.2) - 1 END, 6) AS "epsNext5Y"
FROM uni u LEFT JOIN {_FORECAST} f USING (symbol) GROUP BY u.symbol""",
    "uni li",
)
def n13(spark, sf):
    return N.estimates_annual(_forecast_rows(spark, sf), B.universe(spark, sf), as_of(), _AT)


@query(
    "N14_estimates_quarter",
    f"SELECT u.symbol, '{_AS_OF}' AS \"asOfDate\", eps AS \"epsNextQ\" FROM uni u LEFT JOIN {_FORECAST} f ON f.symbol = u.symbol AND k = 1",
    "uni li",
)
def n14(spark, sf):
    return N.estimates_quarter(_forecast_rows(spark, sf), B.universe(spark, sf), as_of(), _AT)


@query(
    "N15_target_snapshot",
    f"""
SELECT u.symbol, '{_AS_OF}' AS "asOfDate", t.v AS "targetPrice" FROM uni u LEFT JOIN (
  SELECT symbol, CASE l_returnflag WHEN 'A' THEN l_quantity WHEN 'N' THEN l_tax END AS v, row_number() OVER (PARTITION BY symbol ORDER BY o) AS k FROM li) t ON t.symbol = u.symbol AND k = 1""",
    "uni li",
)
def n15(spark, sf):
    rows = B.landed(_lines(spark, sf), _KEEP, targetConsensus=F.when(_is("A"), F.col("l_quantity")), median=F.when(_is("N"), _t("l_tax")))
    return N.target_snapshot(rows, B.universe(spark, sf), as_of(), _AT)


@query(
    "N16_company_facts_merge",
    f"""
SELECT symbol, '{_AS_OF}' AS "asOfDate", sector, NULL::VARCHAR AS industry, employees, ipo AS "ipoDate", sp AS "sharesOutstanding_profile", ss AS "sharesOutstanding_shares", fl AS "sharesFloat" FROM
 (SELECT symbol, 'N' || s_nationkey AS sector, CASE WHEN s_nationkey > 5 THEN s_suppkey::DOUBLE END AS employees, '1990-01-0' || (1 + s_nationkey % 9) AS ipo, s_acctbal AS sp FROM sup WHERE s_acctbal > 0 AND s_nationkey < 18) p
FULL JOIN (SELECT symbol, s_acctbal * 2 AS ss, s_acctbal / 2 AS fl FROM sup WHERE s_acctbal > 0 AND s_nationkey > 8) s USING (symbol)""",
    "sup",
)
def n16(spark, sf):
    # Every symbol comes twice in either feed; the later payload counts.
    s, k = B.suppliers(spark, sf).withColumn("turn", F.explode(F.array(F.lit(0), F.lit(1)))), F.col("s_nationkey")
    s = s.withColumn("s_acctbal", F.when(F.col("turn") == 1, F.col("s_acctbal")).otherwise(1.0))
    profile = B.landed(
        s.filter("s_nationkey < 18"), ["s_suppkey", "turn"], symbol=F.lower("symbol"), sector=F.concat(F.lit(" N"), k), employees=F.when(k > 5, F.col("s_suppkey")),
        ipoDate=F.concat(F.lit("1990-01-0"), 1 + k % 9), outstandingShares=_t("s_acctbal"),
    )
    shares = B.landed(s.filter("s_nationkey > 8"), ["s_suppkey", "turn"], ticker=F.col("symbol"), sharesOutstanding=F.col("s_acctbal") * 2, float=F.col("s_acctbal") / 2)
    return N.company_facts_merge(profile, shares, B.universe(spark, sf), as_of(), ["turn", "pos"])


def insider_fields():
    return {
        "transactionDate": F.when(F.col("l_linenumber") != 6, _day()),
        "shares": _t("l_quantity"), "price": F.when(~_is("R"), F.col("l_extendedprice")), "value": F.when(_is("A"), F.lit(1)),
        "cik": F.when(_is("A"), _t("l_partkey")), "reportingName": F.concat(F.lit("Person "), F.floor(F.col("l_partkey") / 100)),
        "url": F.when(_is("N"), F.lit("http://x/y")), "type": F.lit("S-Sale"), "securitiesOwned": F.when(~_is("N"), F.col("l_quantity") * 10),
        "securityName": F.when(F.col("l_linenumber") <= 3, F.lit("Class A common stock")).otherwise(F.lit("Option")),
        "form": F.lit("4"), "acquisitionOrDisposition": F.col("l_returnflag"),
    }


def insider_rows(spark, sf):
    return B.landed(_lines(spark, sf), _KEEP, **insider_fields())


TRANSACTIONS_SQL = """
SELECT symbol, date, CASE WHEN l_returnflag = 'A' THEN CAST(l_partkey AS VARCHAR) ELSE 'H_' || left(sha1(nm || '|' || coalesce(lk, '')), 16) END AS person, nm, l_quantity AS qty,
  CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS price, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN l_extendedprice * l_quantity END AS value,
  CASE WHEN l_returnflag <> 'N' THEN l_quantity * 10 END AS owned, CASE WHEN l_linenumber <= 3 THEN 'Class A common stock' ELSE 'Option' END AS sec, l_returnflag AS ad, lk, o
FROM (SELECT *, 'Person ' || CAST(floor(l_partkey / 100) AS BIGINT) AS nm, CASE WHEN l_returnflag = 'N' THEN 'http://x/y' END AS lk FROM li WHERE l_linenumber <> 6)"""


@query(
    "N17_insider_transactions",
    f"""
SELECT symbol, CAST(date AS VARCHAR) AS "transactionDate", person AS "reportingCik", nm AS "reportingName", 'S-Sale' AS "transactionType", qty AS "securitiesTransacted", price,
  round(value, 6) AS value, owned AS "securitiesOwned", sec AS "securityName", '4' AS "formType", ad AS "acquisitionOrDisposition", lk AS link FROM ({TRANSACTIONS_SQL})""",
    "li",
)
def n17(spark, sf):
    return N.insider_transactions(insider_rows(spark, sf))


@query(
    "N18_insider_holdings_snapshot",
    f"""
SELECT symbol, '{_AS_OF}' AS "asOfDate", "reportingCik", "reportingName", "securitiesOwned", "securityName", CAST("transactionDate" AS VARCHAR) AS "lastTransactionDate" FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, "reportingCik", "securityName" ORDER BY "transactionDate" DESC, o, "securitiesOwned") AS k
  FROM itx WHERE "securitiesOwned" IS NOT NULL AND upper("securityName") LIKE '%COMMON STOCK%') WHERE k = 1""",
    "itx",
)
def n18(spark, sf):
    return N.insider_holdings_snapshot(B.transactions(spark, sf), as_of(), order=[*B.ORDER, "securitiesOwned"])


@query(
    "N19_index_membership",
    f"SELECT 'SP500' AS \"indexSymbol\", '{_AS_OF}' AS \"asOfDate\", u.symbol AS \"memberSymbol\", d.symbol IS NOT NULL AS \"isMember\" FROM uni u LEFT JOIN (SELECT DISTINCT symbol FROM divs WHERE dividend > 0.08 AND \"exDate\" > DATE '2000-06-01') d USING (symbol)",
    "uni divs",
)
def n19(spark, sf):
    members = B.dividends(spark, sf).filter((F.col("dividend") > 0.08) & (F.col("exDate") > F.lit("2000-06-01").cast("date")))
    return N.index_membership(B.universe(spark, sf), "sp500", members, as_of())


@query("N20_close_fill", 'SELECT symbol, CAST(date AS VARCHAR) AS date, round(coalesce("adjClose", close), 6) AS "adjClose" FROM prices', "prices")
def n20(spark, sf):
    return N.close_fill(B.prices(spark, sf)).select("symbol", "date", "adjClose")
