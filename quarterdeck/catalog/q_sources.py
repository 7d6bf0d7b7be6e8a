"""Queries of the sources: files and documents made from whole tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterdeck.catalog import bindings as B
from quarterdeck.catalog.registry import query
from quarterdeck.schemas import TABLES, q
from quarterdeck.session import scratch_path
from quarterdeck.sources import holdings as H
from quarterdeck.sources import tables as S
from quarterdeck.sources import xbrl as X
from quarterdeck.sources.payloads import cik_map, payload_rows, symbol_keys, symbol_names


@query(
    "S1_read_table",
    """
SELECT symbol, CAST(date AS VARCHAR) AS date, l_tax AS open, NULL::DOUBLE AS high, NULL::DOUBLE AS low, l_extendedprice AS close,
  CASE WHEN l_returnflag <> 'A' THEN l_discount END AS "adjClose", l_quantity AS volume FROM li WHERE l_linenumber <> 7""",
    "li",
)
def s1(spark, sf):
    li = B.lines(spark, sf)
    raw = li.select(
        F.lower(F.concat(F.lit(" "), "symbol", F.lit(" "))).alias("symbol"),
        F.when(F.col("l_linenumber") == 7, F.lit("soon")).otherwise(F.col("date").cast("string")).alias("date"),
        F.col("l_tax").cast("string").alias("open"),
        F.col("l_extendedprice").alias("close"),
        F.when(F.col("l_returnflag") == "A", F.lit(float("nan"))).otherwise(F.col("l_discount")).alias("adjClose"),
        F.col("l_quantity").alias("volume"),
        F.lit(1).alias("undeclared"),
    )
    path = scratch_path(spark, "prices_eod")
    raw.write.parquet(path)
    return S.read_table(spark, path, TABLES["prices_eod"])


@query(
    "S1_read_table_csv_twin",
    'SELECT symbol, CAST("asOfDate" AS VARCHAR) AS "asOfDate", "targetPrice" FROM targets',
    "targets",
)
def s1_csv(spark, sf):
    path = scratch_path(spark, "targets")
    B.targets(spark, sf).write.option("header", True).csv(f"{path}.csv")
    return S.read_table(spark, f"{path}.parquet", TABLES["targets_snapshot"], f"{path}.csv")


@query("S2_adjusted_close", "SELECT symbol, CAST(date AS VARCHAR) AS date, round(open, 6) AS open, round(close, 6) AS close FROM px", "px")
def s2(spark, sf):
    return S.adjusted_close(B.prices(spark, sf)).select("symbol", "date", "open", "close")


@query("S3_resolve_market_series", "SELECT symbol, CAST(date AS VARCHAR) AS date, round(close, 6) AS close FROM (SELECT 'GSPC' AS symbol, date, max(high) AS close FROM prices GROUP BY date)", "prices")
def s3(spark, sf):
    p = B.prices(spark, sf)
    raw = [
        p.groupBy("date").agg(F.max("close").alias("close")).select(F.lit("SPX").alias("symbol"), "date", "close"),
        p.groupBy("date").agg(F.max("high").alias("close")).select(F.lit(" gspc").alias("symbol"), "date", "close"),
        p.select("symbol", "date", "close"),
    ]
    out = S.resolve_market_series(raw[0].union(raw[1]).union(raw[2]))
    return out.select(F.upper(F.trim("symbol")).alias("symbol"), "date", "close")


def holdings_files(spark, sf):
    """Physical lines of one holdings file per part brand: preamble, header, rows, malformed rows."""
    p = B.table(spark, sf, "part")
    file = F.concat(F.lit("fund-"), F.regexp_replace("p_brand", "#", "-"))
    semi = F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3")
    tab = F.col("p_brand").isin("Brand#4")
    sep = F.when(semi, F.lit(";")).when(tab, F.lit("\t")).otherwise(F.lit(","))
    head = p.select(file.alias("file"), sep.alias("sep")).distinct()
    top = head.select(
        "file",
        F.posexplode(
            F.array(
                F.lit("﻿Fund holdings"),
                F.lit(""),
                F.concat(F.lit("Ticker"), "sep", F.lit("Security Name"), "sep", F.lit("Asset Class"), "sep", F.lit("Weight (%)\r")),
            )
        ).alias("pos", "line"),
    )
    quoted = F.concat(F.lit('"'), F.replace("p_name", F.lit(" "), F.lit(", ")), F.lit('"'))
    cells = [F.concat(F.lit("P"), F.col("p_partkey")), quoted, F.lit("Equity"), F.col("p_size").cast("string")]
    # Every part above 1000 in price carries a cell too many.
    row = F.concat(cells[0], sep, cells[1], sep, cells[2], sep, cells[3], F.when(F.col("p_retailprice") > 1000, F.concat(sep, F.lit("x"))).otherwise(F.lit("")))
    body = p.select(file.alias("file"), (F.col("p_partkey") + 10).cast("int").alias("pos"), row.alias("line"))
    return top.unionByName(body)


@query(
    "S4_read_preamble_csv",
    """
SELECT 'fund-' || replace(p_brand, '#', '-') AS file, 'P' || p_partkey AS ticker, replace(p_name, ' ', ', ') AS name, 'Equity' AS asset_class, CAST(p_size AS VARCHAR) AS weight
FROM part WHERE p_retailprice <= 1000""",
)
def s4(spark, sf):
    from quarterdeck.functions import fixed

    rows = H.holdings_rows(holdings_files(spark, sf))
    return rows.select(
        "file",
        H.cell(fixed.TICKER_COLUMNS).alias("ticker"),
        H.cell(fixed.NAME_COLUMNS).alias("name"),
        H.cell(fixed.ASSET_CLASS_COLUMNS).alias("asset_class"),
        H.cell(fixed.WEIGHT_COLUMNS).alias("weight"),
    )


@query("S5_read_universe", "SELECT DISTINCT 'C' || (c_custkey // 3) AS symbol FROM customer WHERE c_nationkey > 3")
def s5(spark, sf):
    c = B.table(spark, sf, "customer")
    keep = F.col("c_nationkey") > 3
    code = F.concat(F.lit(" c"), F.floor(F.col("c_custkey") / 3).cast("string"))
    raw = c.select(F.when(keep, code).alias("﻿Ticker_Fixed"), F.when(keep, F.col("c_name")).alias(" Name"))
    path = scratch_path(spark, "universe")
    raw.write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(path)
    return S.universe_symbols(S.read_universe(spark, path))


@query("S6_pick_col", "SELECT p_partkey, p_name AS name, p_brand AS ticker FROM part")
def s6(spark, sf):
    p = B.table(spark, sf, "part").withColumnsRenamed({"p_name": "security NAME", "p_brand": "TICKER"})
    name, ticker = S.pick_col(p, ["Name", "Security Name"]), S.pick_col(p, ["Symbol", "ticker"])
    return p.select("p_partkey", F.col(q(name)).alias("name"), F.col(q(ticker)).alias("ticker"))


@query(
    "S7_read_payload_json",
    """
SELECT event_id, i::BIGINT AS pos, CASE WHEN i = 0 THEN props->>'k' ELSE CAST(user_id AS VARCHAR) END AS k
FROM events, (VALUES (0), (1)) v(i) WHERE event_type NOT IN ('view', 'error') AND (i = 0 OR event_type = 'click')""",
)
def s7(spark, sf):
    e = B.table(spark, sf, "events")
    kind = F.col("event_type")
    both = F.concat(F.lit(" ["), "props", F.lit(',{"k":'), F.col("user_id"), F.lit("}]"))
    body = F.when(kind == "view", F.lit('"none"')).when(kind == "error", F.lit('[{"k":1}')).when(kind == "click", both).otherwise(F.col("props"))
    rows = payload_rows(e.select("event_id", body.alias("body")), "body", ["event_id"])
    return rows.select("event_id", "pos", F.try_element_at("r", F.lit("k")).alias("k"))


@query("S7_read_payload_files", "SELECT symbol, CAST(date AS VARCHAR) AS date, round(close, 6) AS close FROM px", "px")
def s7_files(spark, sf):
    """The landed-folder reader: one line of JSON per payload object, stored as text and parsed back."""
    px = B.adjusted(spark, sf)
    path = scratch_path(spark, "landed")
    px.select(F.to_json(F.struct("symbol", "date", "close")).alias("value")).write.text(path)
    rows = payload_rows(spark.read.text(path), "value")
    get = lambda n: F.try_element_at("r", F.lit(n))
    return rows.select(get("symbol").alias("symbol"), get("date").alias("date"), get("close").cast("double").alias("close"))


_FACT = 'CAST("start" AS VARCHAR) AS "start", CAST("end" AS VARCHAR) AS "end", round(val, 6) AS val, accn, fy, fp, form, CAST(filed AS VARCHAR) AS filed'


@query("S8_explode_xbrl_facts", f"SELECT cik, ns, tag, unit, doc_pos, src_pos, {_FACT}, NULL::VARCHAR AS frame FROM facts", "facts")
def s8(spark, sf):
    return X.explode_xbrl_facts(B.documents(spark, sf), "body", "doc_pos")


@query("S9_read_concept_records", f"SELECT cik, tag, tag_rank, src_pos, {_FACT} FROM concepts", "concepts")
def s9(spark, sf):
    return X.read_concept_records(B.concept_documents(spark, sf)).drop("frame")


@query(
    "S10_read_cik_map",
    """
SELECT ticker, arg_max(cik, seq) AS cik FROM (
  SELECT 'T' || s_nationkey AS ticker, lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS cik, s_suppkey * 2 AS seq FROM supplier
  UNION ALL SELECT 'U' || s_nationkey, lpad(CAST(s_suppkey + 7 AS VARCHAR), 10, '0'), s_suppkey * 2 + 1 FROM supplier) GROUP BY ticker""",
)
def s10(spark, sf):
    s = B.suppliers(spark, sf)
    a = F.concat(F.lit('{"ticker":" t'), "s_nationkey", F.lit('","cik_str":'), "s_suppkey", F.lit("}"))
    b = F.concat(F.lit('{"ticker":"U'), "s_nationkey", F.lit('","cik":"'), F.col("s_suppkey") + 7, F.lit('"}'))
    as_map = F.concat(F.lit('{"0":'), a, F.lit(',"1":'), b, F.lit("}"))
    body = F.when(F.col("s_acctbal") > 4000, as_map).otherwise(F.concat(F.lit("["), a, F.lit(","), b, F.lit(',{"ticker":"","cik":1}]')))
    return cik_map(s.select("s_suppkey", body.alias("body")), "body", "s_suppkey")


def symbol_documents(spark, sf):
    p = B.table(spark, sf, "part")
    mark = F.when(F.col("p_retailprice") > 950, F.lit(".")).when(F.col("p_retailprice") > 930, F.lit("-")).otherwise(F.lit(""))
    sym = F.concat(F.lower(F.substring("p_type", 1, 2)), "p_size", mark, F.substring("p_brand", 7, 1))
    return p.select("p_partkey", F.to_json(F.array(F.struct(sym.alias("Symbol"), F.col("p_name").alias("companyName")))).alias("body"))


SYMBOLS = """
SELECT symbol, arg_max(p_name, p_partkey) AS name FROM (
  SELECT upper(left(p_type, 2)) || p_size || CASE WHEN p_retailprice > 950 THEN '.' WHEN p_retailprice > 930 THEN '-' ELSE '' END || substr(p_brand, 7, 1) AS symbol, p_name, p_partkey FROM part)
GROUP BY symbol"""


@query("S11_symbol_master", SYMBOLS)
def s11(spark, sf):
    return symbol_names(symbol_documents(spark, sf), "body", "p_partkey")


@query(
    "S11_symbol_keys",
    f"SELECT regexp_replace(symbol, '[^A-Z0-9]', '', 'g') AS norm_key, string_agg(symbol, '|' ORDER BY symbol) AS symbols FROM ({SYMBOLS}) GROUP BY 1",
)
def s11_keys(spark, sf):
    k = symbol_keys(symbol_names(symbol_documents(spark, sf), "body", "p_partkey"))
    return k.select("norm_key", F.array_join("symbols", "|").alias("symbols"))
