"""Queries of the scalar expressions, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterdeck.catalog import bindings as B
from quarterdeck.catalog.registry import query
from quarterdeck.functions import fixed
from quarterdeck.functions import scalars as P
from quarterdeck.schemas import conform
from quarterdeck.sources.tables import first_present_column, universe_filter

_ID = ["l_orderkey", "l_linenumber"]
_KEYS = "l_orderkey, l_linenumber"


def _lines(spark, sf):
    return B.lines(spark, sf)


def _vary(a, b, c):
    """A value that depends on the return flag."""
    return F.when(F.col("l_returnflag") == "A", a).when(F.col("l_returnflag") == "N", b).otherwise(c)


def _s(c: str):
    return F.col(c).cast("string")


@query(
    "P1_pick_num",
    f"""
SELECT {_KEYS}, CASE l_returnflag WHEN 'A' THEN l_quantity WHEN 'N' THEN l_tax ELSE NULL END AS v FROM lineitem""",
)
def p1(spark, sf):
    d = _lines(spark, sf).select(*_ID, _vary(F.lit(None), F.lit("  "), F.lit("n/a")).alias("a"), _vary(_s("l_quantity"), _s("l_tax"), _s("l_tax")).alias("b"))
    return d.select(*_ID, P.pick_num("a", "b").alias("v"))


@query("P2_pick_date", f"SELECT {_KEYS}, CASE l_returnflag WHEN 'R' THEN NULL ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS d FROM lineitem")
def p2(spark, sf):
    stamp = F.concat(F.col("date").cast("string"), F.lit("T00:00:00"))
    d = _lines(spark, sf).select(*_ID, _vary(stamp, F.lit(" "), F.lit("soon")).alias("a"), stamp.alias("b"))
    return d.select(*_ID, P.pick_date("a", "b").alias("d"))


@query("P3_pick_text", f"SELECT {_KEYS}, CASE l_returnflag WHEN 'A' THEN l_linestatus WHEN 'N' THEN 'N' ELSE NULL END AS v FROM lineitem")
def p3(spark, sf):
    d = _lines(spark, sf)
    a = _vary(F.concat(F.lit("\t "), F.col("l_linestatus"), F.lit(" ")), F.lit("   "), F.lit(None))
    b = _vary(F.lit("x"), F.col("l_returnflag"), F.lit(""))
    return d.select(*_ID, a.alias("a"), b.alias("b")).select(*_ID, P.pick_text("a", "b").alias("v"))


@query("P4_to_number", f"SELECT {_KEYS}, CASE l_returnflag WHEN 'A' THEN round(l_extendedprice, 2) WHEN 'N' THEN l_quantity END AS v FROM lineitem")
def p4(spark, sf):
    d = _lines(spark, sf)
    t = _vary(F.format_number("l_extendedprice", 2), F.concat(F.lit(" "), _s("l_quantity")), F.lit("nan"))
    return d.select(*_ID, P.to_number(t).alias("v"))


@query("P5_norm_period", f"SELECT {_KEYS}, CASE l_returnflag WHEN 'A' THEN 'Q' || l_linenumber ELSE '' END AS p FROM lineitem")
def p5(spark, sf):
    t = _vary(F.concat(F.lit(" Q"), _s("l_linenumber")), F.lit("<NA>"), F.lit(None).cast("string"))
    return _lines(spark, sf).select(*_ID, P.norm_period(t).alias("p"))


@query(
    "P6_stable_person_id",
    """
SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN CAST(c_custkey AS VARCHAR) ELSE 'H_' || left(sha1(c_name || '|' || CASE WHEN c_nationkey > 10 THEN c_mktsegment ELSE '' END), 16) END AS person
FROM customer""",
)
def p6(spark, sf):
    c = B.table(spark, sf, "customer")
    cik = F.when(F.col("c_acctbal") > 5000, F.concat(F.lit(" "), _s("c_custkey")))
    link = F.when(F.col("c_nationkey") > 10, F.col("c_mktsegment"))
    return c.select("c_custkey", P.stable_person_id(cik, "c_name", link).alias("person"))


@query(
    "P7_norm_key",
    "SELECT p_partkey, regexp_replace(upper(p_name || '-' || p_brand), '[^A-Z0-9]', '', 'g') AS k, replace(replace(lower(p_name || '_' || p_type), ' ', ''), '_', '') AS item FROM part",
)
def p7(spark, sf):
    p = B.table(spark, sf, "part")
    return p.select(
        "p_partkey",
        P.norm_key(F.concat_ws("-", "p_name", "p_brand")).alias("k"),
        P.norm_item_key(F.concat_ws("_", "p_name", "p_type")).alias("item"),
    )


@query(
    "P8_reject_non_equity",
    """
SELECT p_partkey, CASE WHEN ac IN ('cash', 'currency') THEN true WHEN ac = 'equity' AND listed THEN false
  ELSE (nm LIKE '%ETF%' OR nm LIKE '%TRUST%' OR nm LIKE '%FX%') AND NOT (listed AND ac LIKE '%equity%') END AS rejected
FROM (SELECT p_partkey, CASE WHEN p_size < 5 THEN 'cash' WHEN p_size < 8 THEN 'currency' WHEN p_size < 30 THEN 'equity' WHEN p_size < 40 THEN 'private equity' ELSE 'bond' END AS ac,
        upper(CASE p_type WHEN 'ECONOMY' THEN 'netflix ' WHEN 'SMALL' THEN 'fxcm ' WHEN 'STANDARD' THEN 'bluetfrust ' ELSE 'trustco ' END || p_name) AS nm, p_retailprice > 930 AS listed FROM part)""",
)
def p8(spark, sf):
    p = B.table(spark, sf, "part")
    size, kind = F.col("p_size"), F.col("p_type")
    ac = F.when(size < 5, "Cash").when(size < 8, "CURRENCY").when(size < 30, " Equity").when(size < 40, "Private Equity").otherwise("Bond")
    head = F.when(kind == "ECONOMY", "Netflix ").when(kind == "SMALL", "fxcm ").when(kind == "STANDARD", "bluetfrust ").otherwise("Trustco ")
    rejected = P.reject_non_equity(F.concat(head, F.col("p_name")), ac, F.lit("T"), F.col("p_retailprice") > 930)
    return p.select("p_partkey", rejected.alias("rejected"))


@query(
    "P9_exclude_non_company",
    """
SELECT c_custkey, CASE WHEN c_nationkey IN (0, 1) THEN 'excluded_cvr' WHEN c_nationkey IN (2, 3) THEN 'excluded_currency_ticker'
  WHEN c_mktsegment = 'FURNITURE' THEN 'excluded_non_company_sector' WHEN c_nationkey IN (4, 5) THEN 'excluded_non_company_name' END AS reason FROM customer""",
)
def p9(spark, sf):
    c = B.table(spark, sf, "customer")
    k = F.col("c_nationkey")
    name = (
        F.when(k == 0, F.concat("c_name", F.lit(" CVR")))
        .when(k == 1, F.concat("c_name", F.lit("  -CVR ")))
        .when(k == 4, F.concat("c_name", F.lit(" swaps 12")))
        .when(k == 5, F.concat(F.lit("Cash "), "c_name"))
        .when(k == 6, F.concat("c_name", F.lit(" cashmere futuresque")))
        .otherwise(F.col("c_name"))
    )
    ticker = F.when(k == 2, F.lit(" usd")).when(k == 3, F.lit("SGD")).otherwise(F.lit("T"))
    sector = F.when(F.col("c_mktsegment") == "FURNITURE", F.lit("Cash and/or Derivatives ")).otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", P.exclude_non_company(ticker, name, sector).alias("reason"))


@query("P10_safe_div", f"SELECT {_KEYS}, round(l_extendedprice / nullif(l_tax, 0), 6) AS v FROM lineitem")
def p10(spark, sf):
    return _lines(spark, sf).select(*_ID, P.safe_div("l_extendedprice", "l_tax").alias("v"))


@query(
    "P11_split_factor",
    f"""
SELECT {_KEYS}, round(CASE l_returnflag WHEN 'A' THEN l_quantity / l_linenumber WHEN 'N' THEN l_quantity / nullif(l_linenumber - 1, 0) END, 6) AS f FROM lineitem""",
)
def p11(spark, sf):
    num = _vary(F.col("l_linenumber").cast("double"), F.lit(None), F.lit(1.0))
    den = _vary(F.col("l_quantity"), F.lit(None), F.lit(0.0))
    text = _vary(F.lit("9/9"), F.concat_ws("/", (F.col("l_linenumber") - 1).cast("string"), _s("l_quantity")), F.lit("2:1"))
    return _lines(spark, sf).select(*_ID, P.split_factor(num, den, text).alias("f"))


_SIGN = """CASE WHEN "acquisitionOrDisposition" = 'A' THEN 1 WHEN "acquisitionOrDisposition" = 'D' THEN -1
  WHEN "transactionType" = 'S-Sale' THEN -1 WHEN "transactionType" IN ('P-Purchase', 'Acquired by gift') THEN 1 END"""


@query("P12_txn_sign", f'SELECT symbol, "transactionType" AS kind, coalesce({_SIGN}, 0)::BIGINT AS sign, count(*) AS n FROM itx GROUP BY 1, 2, 3', "itx")
def p12(spark, sf):
    t = B.transactions(spark, sf)
    sign = F.coalesce(P.txn_sign("acquisitionOrDisposition", "transactionType"), F.lit(0)).cast("long")
    return t.groupBy("symbol", F.col("transactionType").alias("kind"), sign.alias("sign")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "P13_pct_clamped",
    f"""
SELECT {_KEYS}, CASE WHEN l_quantity > 1 THEN round(greatest(0, least(100, 100.0 * l_linenumber * 10 / l_quantity)), 2) END AS own,
  CASE WHEN l_quantity > 1 THEN 
    CASE WHEN l_returnflag <> 'R' THEN round(greatest(-99, least(99, 100.0 * (CASE WHEN l_returnflag = 'A' THEN l_linenumber - l_quantity / 2 ELSE l_linenumber END) / l_quantity)), 2) END END AS trans
FROM lineitem""",
)
def p13(spark, sf):
    d = _lines(spark, sf)
    shares = F.when(F.col("l_quantity") > 1, F.col("l_quantity")).otherwise(F.lit(0.0))
    now, prev = F.col("l_linenumber").cast("double"), _vary(F.col("l_quantity") / 2, F.lit(None), F.lit(None))
    net = _vary(F.lit(5.0), F.col("l_linenumber").cast("double"), F.lit(None))
    return d.select(*_ID, P.own_pct(now * 10, shares).alias("own"), P.trans_pct(now, prev, net, shares).alias("trans"))


@query(
    "P14_format_pair",
    f"""
SELECT {_KEYS}, CASE WHEN l_returnflag = 'A' THEN printf('%.2f%%', l_quantity) ELSE 'N/A' END || ' / ' ||
  CASE WHEN l_returnflag = 'R' THEN 'N/A' WHEN l_linenumber >= 4 THEN printf('+%.2f%%', CAST(l_linenumber - 4 AS DOUBLE)) ELSE printf('%.2f%%', CAST(l_linenumber - 4 AS DOUBLE)) END AS pair
FROM lineitem""",
)
def p14(spark, sf):
    own = _vary(F.col("l_quantity"), F.lit(None).cast("double"), F.lit(None).cast("double"))
    trans = F.when(F.col("l_returnflag") != "R", (F.col("l_linenumber") - 4).cast("double"))
    d = _lines(spark, sf).select(*_ID, own.alias("own"), trans.alias("trans"))
    return d.select(*_ID, P.format_pair("own", "trans").alias("pair"))


_DAYS = "CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(l_quantity * 8 AS INT) END"


@query(
    "P15_period_type",
    f"""
SELECT {_KEYS}, CASE WHEN d IS NULL THEN 'INSTANT' WHEN d >= 330 THEN 'FY' WHEN d BETWEEN 150 AND 320 THEN 'YTD' WHEN d BETWEEN 70 AND 110 THEN 'QUARTER' ELSE 'UNKNOWN' END AS kind
FROM (SELECT *, {_DAYS} AS d FROM lineitem)""",
)
def p15(spark, sf):
    start = F.when(F.col("l_returnflag") != "R", F.date_sub("date", (F.col("l_quantity") * 8).cast("int")))
    return _lines(spark, sf).select(*_ID, P.period_type(start, "date").alias("kind"))


@query("P16_flow_period_ok", f"SELECT {_KEYS}, coalesce(d BETWEEN 60 AND 400, true) AS ok FROM (SELECT *, {_DAYS.replace('* 8', '* 10')} AS d FROM lineitem)")
def p16(spark, sf):
    start = F.when(F.col("l_returnflag") != "R", F.date_sub("date", (F.col("l_quantity") * 10).cast("int")))
    return _lines(spark, sf).select(*_ID, P.flow_period_ok(start, "date").alias("ok"))


@query("P17_unit_matches", f"SELECT {_KEYS}, l_returnflag = 'A' AS usd, l_returnflag <> 'A' AS share_unit FROM lineitem")
def p17(spark, sf):
    u = _vary(F.lit(" usd"), F.lit("Shares "), F.lit("usd/shares"))
    return _lines(spark, sf).select(
        *_ID, P.unit_matches(u, ["USD", "USD/shares"], ["shares"]).alias("usd"), P.unit_matches(u, ["shares", "USD/shares"]).alias("share_unit")
    )


@query(
    "P18_prev_trade_date",
    """
SELECT DISTINCT CAST(date AS VARCHAR) AS date,
  CAST(date - CASE isodow(date) WHEN 6 THEN 1 WHEN 7 THEN 2 WHEN 1 THEN 3 ELSE 1 END AS VARCHAR) AS prev FROM li""",
    "li",
)
def p18(spark, sf):
    return _lines(spark, sf).select("date", P.prev_trade_date("date").alias("prev")).distinct()


# CRC-32 by its definition: xor each byte in, then eight shifts (operations below 0) with the fixed polynomial.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length(symbol) + 1),
    lambda i: list_prepend(ascii(substr(symbol, i, 1))::BIGINT, [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))),
    lambda c, op: CASE WHEN op >= 0 THEN xor(c, op) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"""


@query("P19_shard_filter", f"SELECT symbol, {_CRC} % 4 = 1 AS in_shard, true AS in_one FROM (SELECT DISTINCT symbol FROM li)", "li")
def p19(spark, sf):
    s = _lines(spark, sf).select("symbol").distinct()
    return s.select("symbol", P.shard_filter("symbol", 4, 1).alias("in_shard"), P.shard_filter("symbol", 1, 0).alias("in_one"))


@query(
    "P20_universe_filter",
    "SELECT symbol, CAST(date AS VARCHAR) AS date, round(close, 6) AS close FROM prices WHERE symbol IN (SELECT symbol FROM uni) AND date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'",
    "prices uni",
)
def p20(spark, sf):
    low, high = F.lit("1996-01-01").cast("date"), F.lit("1999-12-31").cast("date")
    return universe_filter(B.prices(spark, sf), B.universe(spark, sf), "symbol", "date", low, high).select("symbol", "date", "close")


@query(
    "P21_conform",
    'SELECT symbol, CAST("asOfDate" AS VARCHAR) AS "asOfDate", NULL::DOUBLE AS "epsNextY", "sharesOutstanding" AS "epsNextQ", NULL::DOUBLE AS "epsThisY", NULL::DOUBLE AS "epsNext5Y" FROM shares',
    "shares",
)
def p21(spark, sf):
    from quarterdeck.schemas import TABLES

    s = B.shares(spark, sf).withColumnsRenamed({"sharesOutstanding": "EPSNEXTQ"}).withColumn("epsThisY", F.lit(float("nan")))
    return conform(s, TABLES["estimates_snapshot"].schema)


@query("P22_zero_repair", f"SELECT {_KEYS}, CASE WHEN l_tax = 0 AND l_discount > 0 THEN NULL ELSE l_tax END AS revenue FROM lineitem")
def p22(spark, sf):
    return _lines(spark, sf).select(*_ID, P.zero_repair("l_tax", "l_discount").alias("revenue"))


@query("P23_pad_cik", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'X' || o_custkey ELSE lpad(CAST(o_custkey AS VARCHAR), 10, '0') END AS cik FROM orders")
def p23(spark, sf):
    raw = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("X"), F.col("o_custkey"))).otherwise(F.concat(F.lit(" "), F.col("o_custkey")))
    return B.table(spark, sf, "orders").select("o_orderkey", P.pad_cik(raw).alias("cik"))


_QUARTER = """CASE l_returnflag WHEN 'A' THEN year(l_shipdate) || 'Q' || quarter(l_shipdate)
  WHEN 'N' THEN CASE WHEN quarter(l_shipdate) < 4 THEN year(l_shipdate) || 'Q' || quarter(l_shipdate) END END"""


def _quarter_keys(spark, sf):
    y, qn = F.year("date"), F.quarter("date")
    frame = _vary(F.concat(F.lit("cy"), y, F.lit("Q"), qn), F.concat(F.lit("CY"), y), F.lit(None))
    fp = _vary(F.lit(None), F.when(qn == 4, F.lit("FY")).otherwise(F.concat(F.lit("q"), qn)), F.lit("FY"))
    return _lines(spark, sf).withColumn("quarter_key", P.quarter_key(frame, y, fp))


@query("P24_quarter_key", f"SELECT {_KEYS}, {_QUARTER} AS quarter_key FROM lineitem")
def p24(spark, sf):
    return _quarter_keys(spark, sf).select(*_ID, "quarter_key")


@query(
    "P24_quarter_key_order",
    f"""
SELECT symbol, max(k) AS newest, min(k) AS oldest, CAST(left(max(k), 4) AS BIGINT) AS year, CAST(right(max(k), 1) AS BIGINT) AS quarter
FROM (SELECT 'S' || l_suppkey AS symbol, {_QUARTER} AS k FROM lineitem) WHERE k IS NOT NULL GROUP BY symbol""",
)
def p24_order(spark, sf):
    """Newest and oldest quarter of each symbol by the sort key."""
    d = _quarter_keys(spark, sf).filter("quarter_key IS NOT NULL").withColumn("at", P.quarter_key_order("quarter_key"))
    g = d.groupBy("symbol").agg(F.max_by("quarter_key", "at").alias("newest"), F.min_by("quarter_key", "at").alias("oldest"), F.max("at").alias("at"))
    return g.select("symbol", "newest", "oldest", "at.year", "at.quarter")


@query("P25_first_present_column", "SELECT symbol, round(sum(l_tax), 6) AS interest FROM li GROUP BY symbol", "li")
def p25(spark, sf):
    d = _lines(spark, sf).withColumnsRenamed({"l_tax": "netInterestExpense", "l_discount": "interestExpenseTotal"})
    return d.groupBy("symbol").agg(F.sum(first_present_column(d, fixed.INTEREST_EXPENSE_COLUMNS)).alias("interest"))


@query(
    "P26_ticker_variants",
    """
SELECT c_custkey, CASE WHEN c_nationkey = 0 THEN 'BRK-B|BRK.B|BRKB|BRKB-B'
  WHEN c_nationkey = 1 THEN 'HEI-A|HEI.A|HEIA' WHEN c_nationkey = 2 THEN 'BF.-B|BF..B|BF.B|BF-B|BF.B-B' WHEN c_nationkey = 3 THEN 'GOOGL' WHEN c_nationkey = 4 THEN '' ELSE 'C' || c_custkey END AS variants FROM customer""",
)
def p26(spark, sf):
    c, k = B.table(spark, sf, "customer"), F.col("c_nationkey")
    t = F.when(k == 0, "brkb").when(k == 1, "HEIA").when(k == 2, "BF.B").when(k == 3, "GOOGL").when(k == 4, " ").otherwise(F.concat(F.lit("C"), F.col("c_custkey")))
    n = F.when(k == 0, "Some Series B class b").when(k == 1, "HEICO CORP CLASS A").when(k == 2, "Brown class B").when(k == 3, "Alphabet Class A").otherwise("x")
    return c.select("c_custkey", F.array_join(P.ticker_variants(t, n), "|").alias("variants"))
