"""Queries of the sinks: each writes below the shared folder and reads the result back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterdeck.catalog import bindings as B
from quarterdeck.catalog.registry import query
from quarterdeck.schemas import TABLES, Table
from quarterdeck.session import materialise, scratch_path
from quarterdeck.sinks import upsert as K
from quarterdeck.sinks import writers as W
from quarterdeck.sinks.catalog_upsert import locations, upsert_table
from quarterdeck.streaming.upserts import stream_upsert

_TARGETS = TABLES["targets_snapshot"]


def _batches(spark, sf):
    """Two batches of target rows from orders: cheap orders are stored first, dear ones arrive later; keys repeat."""
    o = B.orders(spark, sf)
    rows = o.select(
        F.when(F.col("o_orderstatus") != "P", F.col("symbol")).alias("symbol"),
        F.trunc("date", "quarter").alias("asOfDate"),
        F.col("o_totalprice").alias("targetPrice"),
        "o_orderkey",
        (F.col("o_totalprice") > 250000).alias("dear"),
    )
    return rows.filter("not dear").drop("dear"), rows.filter("dear").drop("dear")


UPSERT = """
SELECT symbol, "asOfDate", "targetPrice" FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, "asOfDate" ORDER BY o_totalprice > 250000 DESC, o_orderkey DESC) AS k FROM (
    SELECT CASE WHEN o_orderstatus <> 'P' THEN symbol END AS symbol, CAST(date_trunc('quarter', date) AS DATE) AS "asOfDate", o_totalprice AS "targetPrice", o_totalprice, o_orderkey FROM od)) WHERE k = 1"""
_UP = f'SELECT symbol, CAST("asOfDate" AS VARCHAR) AS "asOfDate", "targetPrice" FROM ({UPSERT})'


@query("K1_upsert", _UP, "od")
def k1(spark, sf):
    first, second = _batches(spark, sf)
    path = scratch_path(spark, "targets_snapshot")
    K.upsert(spark, path, first, _TARGETS, pos=["o_orderkey"])
    K.upsert(spark, path, second, _TARGETS, pos=["o_orderkey"])
    return spark.read.parquet(path)


@query("K1_upsert_partitioned", _UP, "od")
def k1_partitioned(spark, sf):
    first, second = _batches(spark, sf)
    path = scratch_path(spark, "targets_by_year")
    by = {"year": F.year("asOfDate")}
    K.upsert(spark, path, first, _TARGETS, pos=["o_orderkey"], partition_by=by)
    K.upsert(spark, path, second, _TARGETS, pos=["o_orderkey"], partition_by=by)
    return spark.read.parquet(path).drop("year")


@query("K1_upsert_catalog_table", _UP, "od")
def k1_catalog_table(spark, sf):
    """The same rows through a catalog table, whose partitions are switched and never moved."""
    name = f"targets_{uuid.uuid4().hex[:12]}"
    root = scratch_path(spark, "targets_versions")
    by = {"year": F.year("asOfDate").cast("string")}
    for batch in _batches(spark, sf):
        upsert_table(spark, name, root, batch, _TARGETS, pos=["o_orderkey"], partition_by=by)
    rows = spark.table(name).drop("year")
    rows = spark.read.schema(rows.schema).parquet(*locations(spark, name))
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    return rows


@query("K1_upsert_null_partition", _UP, "od")
def k1_null_partition(spark, sf):
    """Partitions by a letter of the symbol, NULL for orders without one."""
    first, second = _batches(spark, sf)
    path = scratch_path(spark, "targets_by_letter")
    by = {"letter": F.substring("symbol", 2, 1)}
    K.upsert(spark, path, first, _TARGETS, pos=["o_orderkey"], partition_by=by)
    K.upsert(spark, path, second, _TARGETS, pos=["o_orderkey"], partition_by=by)
    return spark.read.parquet(path).drop("letter")


@query("K1_upsert_recovery", _UP, "od")
def k1_recovery(spark, sf):
    """The second run stopped after staging and after removing the table; the third call finishes it."""
    first, second = _batches(spark, sf)
    path = scratch_path(spark, "targets_recovered")
    K.upsert(spark, path, first, _TARGETS, pos=["o_orderkey"])
    K.merge_last_wins(spark.read.parquet(path), second, _TARGETS.key, _TARGETS.schema, ["o_orderkey"]).write.parquet(K.staging(path))
    K.remove_table(spark, path)
    K.upsert(spark, path, second.limit(0), _TARGETS, pos=["o_orderkey"])
    return spark.read.parquet(path)


@query("K1_upsert_batch_order", _UP, "od")
def k1_batch_order(spark, sf):
    """Both batches as one: the order of the rows decides."""
    first, second = (b.withColumn("turn", F.lit(i)) for i, b in enumerate(_batches(spark, sf)))
    path = scratch_path(spark, "targets_ordered")
    K.upsert(spark, path, second.unionByName(first), _TARGETS, pos=["turn", "o_orderkey"])
    return spark.read.parquet(path)


@query(
    "K2_upsert_keep_on_empty",
    'SELECT symbol, CAST("asOfDate" AS VARCHAR) AS "asOfDate", "sharesOutstanding", "sharesFloat" FROM shares',
    "shares",
)
def k2(spark, sf):
    s, path = B.shares(spark, sf), scratch_path(spark, "shares_snapshot")
    K.upsert(spark, path, s, TABLES["shares_snapshot"], pos=[], keep_on_empty=True)
    K.upsert(spark, path, s.filter("sharesOutstanding < 0"), TABLES["shares_snapshot"], pos=[], keep_on_empty=True)
    return spark.read.parquet(path)


@query(
    "K3_accumulate_snapshot",
    """
SELECT CAST(t AS VARCHAR) AS "asOfDate", symbol, round(close, 6) AS "Price", NULL::DOUBLE AS "Beta" FROM (
  SELECT date AS t, symbol, close FROM px WHERE date < DATE '2001-01-01' UNION ALL SELECT date, symbol, close * 2 FROM px WHERE date >= DATE '2001-01-01')""",
    "px",
)
def k3(spark, sf):
    from quarterdeck.plans.factors import accumulate

    px = B.adjusted(spark, sf).select(F.col("date").alias("asOfDate"), "symbol", F.col("close").alias("Price"))
    new = px.filter("asOfDate >= date '2001-01-01'").withColumn("Price", F.col("Price") * 2)
    return accumulate(px, new).select("asOfDate", "symbol", "Price", "Beta")


@query(
    "K3_snapshots_by_date",
    """
SELECT kind, CAST(t AS VARCHAR) AS "asOfDate", symbol, round(CASE WHEN t >= DATE '2001-01-01' THEN close * 2 ELSE close END, 6) AS "Price"
FROM (SELECT last_day(date) AS t, symbol, arg_max(close, date) AS close FROM px GROUP BY symbol, last_day(date)), (VALUES ('csv'), ('parquet')) k(kind)""",
    "px",
)
def k3_by_date(spark, sf):
    """Month-end snapshots stored twice, those since 2001 with new prices; both files are read back."""
    from quarterdeck.plans import factors

    ends = B.adjusted(spark, sf).groupBy(F.last_day("date").alias("asOfDate"), "symbol").agg(F.max_by("close", "date").alias("Price"))
    ends, out = materialise(ends, "ends"), scratch_path(spark, "factors")
    factors.store_snapshots(spark, ends, out)
    factors.store_snapshots(spark, ends.filter("asOfDate >= date '2001-01-01'").withColumn("Price", F.col("Price") * 2), out)
    cols = ["kind", "asOfDate", "symbol", "Price"]
    a = factors.read_snapshots(spark, out).withColumn("kind", F.lit("parquet")).select(*cols)
    b = spark.read.csv(f"{out}.csv", header=True).select(F.lit("csv").alias("kind"), F.col("asOfDate").cast("date"), "symbol", F.col("Price").cast("double"))
    return a.unionByName(b)


@query(
    "K4_write_pair",
    'SELECT kind, symbol, round(v, 6) AS "Oper. Margin", round(w, 6) AS "P/E" FROM (SELECT symbol, sum(l_tax) AS v, sum(l_discount) AS w FROM li GROUP BY symbol), (VALUES (\'csv\'), (\'parquet\')) t(kind)',
    "li",
)
def k4(spark, sf):
    d = B.lines(spark, sf).groupBy("symbol").agg(F.round(F.sum("l_tax"), 6).alias("Oper. Margin"), F.round(F.sum("l_discount"), 6).alias("P/E"))
    path = scratch_path(spark, "pair")
    W.write_pair(d, path)
    a = spark.read.parquet(f"{path}.parquet").withColumn("kind", F.lit("parquet"))
    b = spark.read.schema(d.schema).csv(f"{path}.csv", header=True).withColumn("kind", F.lit("csv"))
    return a.unionByName(b)


@query(
    "K5_write_csv_null_blank",
    """
SELECT l_orderkey, l_linenumber, CASE WHEN l_tax = 0 AND l_discount > 0 THEN '' ELSE CAST(l_tax AS VARCHAR) END AS "Revenue", CAST(l_discount AS VARCHAR) AS "GrossProfit", '' AS absent FROM lineitem""",
)
def k5(spark, sf):
    d = B.table(spark, sf, "lineitem").withColumnsRenamed({"l_tax": "Revenue", "l_discount": "GrossProfit"})
    path = scratch_path(spark, "guarded")
    W.write_csv_null_blank(d, path, ["l_orderkey", "l_linenumber", "Revenue", "GrossProfit", "absent"])
    raw = spark.read.option("header", True).option("nullValue", "\u0000").option("emptyValue", "").csv(path)
    blank = [F.coalesce(c, F.lit("")).alias(c) for c in ("Revenue", "GrossProfit", "absent")]
    return raw.select(F.col("l_orderkey").cast("long").alias("l_orderkey"), F.col("l_linenumber").cast("long").alias("l_linenumber"), *blank)


_CLASSES = """SELECT p_partkey, p_name, CASE WHEN p_size < 10 THEN 'REJECT' WHEN p_size < 20 THEN 'AMBIGUOUS' WHEN p_size < 40 THEN 'EXACT' ELSE 'NORMALIZED' END AS match_type FROM part"""


def _classes(spark, sf):
    p, n = B.table(spark, sf, "part"), F.col("p_size")
    kind = F.when(n < 10, "REJECT").when(n < 20, "AMBIGUOUS").when(n < 40, "EXACT").otherwise("NORMALIZED")
    return p.select("p_partkey", "p_name", kind.alias("match_type"))


@query(
    "K6_split_sink",
    f"SELECT *, CASE match_type WHEN 'REJECT' THEN 'universe_rejects' WHEN 'AMBIGUOUS' THEN 'universe_ambiguous' ELSE 'universe_list' END AS output FROM ({_CLASSES})",
)
def k6(spark, sf):
    path = scratch_path(spark, "split")
    W.split_sink(_classes(spark, sf), path)
    return spark.read.parquet(path).withColumnRenamed("_out", "output")


@query(
    "K7_write_lookup_json",
    f"SELECT p_name AS ticker, arg_max(match_type, p_partkey) AS match_type, arg_max(p_partkey, p_partkey) AS at FROM ({_CLASSES}) GROUP BY p_name",
)
def k7(spark, sf):
    path = scratch_path(spark, "lookup")
    W.write_lookup_json(_classes(spark, sf), path, "p_name", ["match_type", "p_partkey"], "p_partkey")
    m = spark.read.text(path).select(F.explode(F.from_json("value", "map<string,struct<match_type:string,p_partkey:bigint>>")).alias("ticker", "v"))
    return m.select("ticker", "v.match_type", F.col("v.p_partkey").alias("at"))


@query(
    "K8_high_watermark",
    "SELECT symbol, CAST(max(date) AS VARCHAR) AS watermark FROM px GROUP BY symbol UNION ALL SELECT '*', CAST(max(date) AS VARCHAR) FROM px",
    "px",
)
def k8(spark, sf):
    px = B.adjusted(spark, sf)
    all_keys = K.high_watermark(px, None, "date").select(F.lit("*").alias("symbol"), "watermark")
    return K.high_watermark(px, "symbol", "date").union(all_keys)


_STORED = "(SELECT symbol, max(date) AS w FROM prices WHERE volume > 140 GROUP BY symbol)"


@query(
    "K9_incremental_slice",
    f"""
SELECT 'next_day' AS rule, p.symbol, CAST(p.date AS VARCHAR) AS date, p.volume FROM prices p LEFT JOIN {_STORED} s USING (symbol)
WHERE p.date BETWEEN greatest(coalesce(s.w + 1, DATE '1998-01-01'), DATE '1998-01-01') AND DATE '2001-10-01'
UNION ALL SELECT 'reread', p.symbol, CAST(p.date AS VARCHAR), p.volume FROM prices p LEFT JOIN {_STORED} s USING (symbol)
WHERE p.date BETWEEN greatest(coalesce(s.w - 7, DATE '1998-01-01'), DATE '1998-01-01') AND DATE '2001-10-01'""",
    "prices",
)
def k9(spark, sf):
    p = B.prices(spark, sf).select("symbol", "date", "volume")
    mark = K.high_watermark(p.filter("volume > 140"), "symbol", "date")
    a = K.incremental_slice(p, mark, "symbol", "date", "1998-01-01", "2001-10-01")
    b = K.incremental_slice(p, mark, "symbol", "date", "1998-01-01", "2001-10-01", 7)
    cols = ["symbol", "date", "volume"]
    return a.select(F.lit("next_day").alias("rule"), *cols).union(b.select(F.lit("reread").alias("rule"), *cols))


@query(
    "K10_newer_than_stored",
    """
SELECT o_orderkey, lu AS "lastUpdated" FROM (SELECT *, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(date AS VARCHAR) END AS lu,
   CASE WHEN o_totalprice < 100000 THEN NULL WHEN o_totalprice < 120000 THEN ' ' ELSE CAST(date + CASE WHEN o_totalprice < 300000 THEN 1 WHEN o_totalprice < 400000 THEN 0 ELSE -1 END AS VARCHAR) END AS old, o_totalprice >= 60000 AS has FROM od)
WHERE NOT has OR old IS NULL OR trim(old) = '' OR lu IS NULL OR lu > old""",
    "od",
)
def k10(spark, sf):
    o, price = B.orders(spark, sf), F.col("o_totalprice")
    new = o.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("date").cast("string")).alias("lastUpdated"))
    shift = F.when(price < 300000, 1).when(price < 400000, 0).otherwise(-1)
    old = F.when(price < 100000, F.lit(None)).when(price < 120000, F.lit(" ")).otherwise(F.date_add("date", shift).cast("string"))
    stored = o.filter(price >= 60000).select("o_orderkey", old.alias("lastUpdated"))
    return K.newer_than_stored(new, stored, ["o_orderkey"])


@query(
    "K11_hit_driven_refresh",
    """
SELECT 'hits' AS run, symbol FROM (SELECT symbol FROM uni INTERSECT SELECT symbol FROM li WHERE date > DATE '2001-10-20') UNION ALL SELECT 'all', symbol FROM uni""",
    "uni li",
)
def k11(spark, sf):
    cal = B.lines(spark, sf).filter("date > date '2001-10-20'")
    u = B.universe(spark, sf)
    days = {"hits": "2001-11-06", "all": "2001-11-05"}
    parts = [K.hit_driven_keys(cal, u, F.lit(d).cast("date")).select(F.lit(n).alias("run"), "symbol") for n, d in days.items()]
    return parts[0].union(parts[1])


EVENTS = Table(
    "events",
    T.StructType([T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())]),
    ["user_id", "event_type"],
)


@query("K12_stream_upsert", "SELECT user_id, event_type, arg_max(value, event_id) AS value FROM events GROUP BY user_id, event_type")
def k12(spark, sf):
    path = scratch_path(spark, "events")
    schema = B.table(spark, sf, "events").schema
    run = stream_upsert(spark, f"{sf}/events*.parquet", schema, EVENTS, path, scratch_path(spark, "events-checkpoint"), pos=["event_id"])
    run.awaitTermination()
    return spark.read.parquet(path)


@query(
    "K13_chunk_concat_dedupe",
    """
SELECT symbol, CAST(date AS VARCHAR) AS date, v AS volume FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY chunk DESC) AS k FROM (
    SELECT symbol, date, 1 AS chunk, volume AS v FROM prices WHERE date <= DATE '1999-01-31' UNION ALL SELECT symbol, date, 2, -volume FROM prices WHERE date >= DATE '1999-01-01')) WHERE k = 1""",
    "prices",
)
def k13(spark, sf):
    p = B.prices(spark, sf).select("symbol", "date", "volume")
    a = p.filter("date <= date '1999-01-31'").withColumn("chunk", F.lit(1))
    b = p.filter("date >= date '1999-01-01'").withColumn("volume", -F.col("volume")).withColumn("chunk", F.lit(2))
    return K.chunk_concat_dedupe(a.union(b))


@query(
    "K14_event_dedupe_nulls",
    """
SELECT symbol, CAST("exDate" AS VARCHAR) AS "exDate", CAST("paymentDate" AS VARCHAR) AS "paymentDate", round(dividend, 6) AS dividend, yield FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, "exDate", "paymentDate", dividend ORDER BY o DESC) AS k FROM (
    SELECT symbol, CAST(date_trunc('month', "exDate") AS DATE) AS "exDate", CAST(date_trunc('month', "paymentDate") AS DATE) AS "paymentDate", dividend, yield, o FROM divs)) WHERE k = 1""",
    "divs",
)
def k14(spark, sf):
    d = B.dividends(spark, sf).withColumns({"exDate": F.trunc("exDate", "month"), "paymentDate": F.trunc("paymentDate", "month")})
    return K.event_dedupe(d, pos=B.ORDER).select("symbol", "exDate", "paymentDate", "dividend", "yield")
