"""Landed JSON: vendor payloads, registry maps and symbol lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.functions.scalars import col, norm_key, norm_symbol, pad_cik, pick_text, text
from quarterdeck.sources.tables import path_exists

_ROW = "map<string,string>"
#: Responses in a row group of a bundle. Spark decodes up to 4,096 rows of a group at once, which of whole responses is a gigabyte a task.
GROUP_ROWS = 32


def payload_array(body: Column | str) -> Column:
    """Objects of a payload as an array of string maps.

    A list gives its objects, a lone object one row, everything else (also broken JSON) none. Numbers and
    nested objects arrive as their JSON text.
    """
    b = F.trim(col(body))
    return (
        F.when(b.startswith("["), F.coalesce(F.from_json(b, f"array<{_ROW}>"), F.array().cast(f"array<{_ROW}>")))
        .when(b.startswith("{"), F.array(F.from_json(b, _ROW)))
        .otherwise(F.array().cast(f"array<{_ROW}>"))
    )


def payload_rows(df: DataFrame, body: str = "body", keep: list[str] | None = None) -> DataFrame:
    """One row per payload object: kept columns, `pos` in the payload and the field map `r`."""
    # The outer form: for a plain explode Spark infers a size filter that would parse the body again.
    exploded = df.select(*(keep or []), F.posexplode_outer(payload_array(body)).alias("pos", "r"))
    return exploded.filter(F.col("r").isNotNull())


def read_payload_json(spark: SparkSession, path: str, symbols: list[str] | None = None) -> DataFrame:
    """Landed payload files below `path`: symbol, pos, r, and `at`, the place of the row in the feed (file, then position).

    One response per file, in `SYMBOL.json` or in a folder `symbol=SYMBOL`; folders above it, such as chunks of one
    series, only give the order. A response is bounded by the vendor's page size, so one file per row is safe; the rows spread over tasks
    by file. `symbols` is a test on the file names alone, so Spark drops other files before it opens them. A folder
    that is absent has no rows.
    """
    if not path_exists(spark, path):
        files = spark.createDataFrame([], "symbol string, file string, body string")
    else:
        raw = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
        file = F.col("_metadata.file_path")
        name = F.coalesce(*[F.nullif(F.regexp_extract(file, p, 1), F.lit("")) for p in (r"/symbol=([^/]+)/", r"([^/]+?)\.json[^/]*$")])
        symbol = norm_symbol(F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))))
        if symbols is not None:
            raw = raw.filter(symbol.isin(symbols))
        files = raw.select(symbol.alias("symbol"), file.alias("file"), F.col("value").alias("body"))
    rows = payload_rows(files, "body", ["symbol", "file"])
    return rows.withColumn("at", F.struct("file", "pos")).drop("file")


def read_payload_bundles(spark: SparkSession, path: str, symbols: DataFrame | None = None) -> DataFrame:
    """Landed responses kept many to a file: the columns of `read_payload_json`.

    A bundle is a Parquet file of (symbol, body), one row per response, in small row groups (`write_payload_bundles`), so that a feed has as many files as its size asks for and
    not one per symbol. Folders inside the feed, such as chunks of one series, give the order of the responses of a symbol. Rows of symbols that
    are not in `symbols` are dropped before a body is parsed. A folder that is absent has no rows.
    """
    if not path_exists(spark, path):
        raw = spark.createDataFrame([], "symbol string, file string, body string")
    else:
        stored = spark.read.option("recursiveFileLookup", True).schema("symbol string, body string").parquet(path)
        folder = F.regexp_extract(F.col("_metadata.file_path"), "^(.*/)", 1)
        raw = stored.select(norm_symbol("symbol").alias("symbol"), F.concat(folder, "symbol").alias("file"), "body")
    if symbols is not None:
        raw = raw.join(symbols.select("symbol").distinct(), "symbol", "left_semi")
    rows = payload_rows(raw, "body", ["symbol", "file"])
    return rows.withColumn("at", F.struct("file", "pos")).drop("file")


def write_payload_bundles(responses: DataFrame, path: str) -> None:
    """Land responses (symbol, body) as bundles in row groups of `GROUP_ROWS`, so that neither writing nor reading holds many bodies."""
    out = responses.select("symbol", "body").write.option("compression", "zstd")
    out.option("parquet.block.row.count.limit", GROUP_ROWS).parquet(path)


def field(name: str, rows: str = "r") -> Column:
    return F.try_element_at(F.col(rows), F.lit(name))


def fields(*names: str) -> list[Column]:
    return [field(n) for n in names]


def row_symbol() -> Column:
    """Symbol of a calendar or list row: `symbol`, else `ticker`."""
    return norm_symbol(F.coalesce(text(field("symbol")), text(field("ticker"))))


def cik_map(df: DataFrame, body: str = "body", order: str | None = None) -> DataFrame:
    """Ticker to ten-digit company id; map of objects or list of objects; the last duplicate wins."""
    b = F.trim(col(body))
    listed = F.transform(payload_array(b), lambda r: r)
    mapped = F.map_values(F.from_json(b, f"map<string,{_ROW}>"))
    rows = F.when(b.startswith("{"), F.coalesce(mapped, listed)).otherwise(listed)
    ex = df.select(*([order] if order else []), F.posexplode_outer(rows).alias("pos", "r"))
    cik = F.coalesce(field("cik_str"), field("cik"))
    picked = ex.select(
        norm_symbol(field("ticker")).alias("ticker"),
        F.when(text(cik).rlike(r"^\d+$"), pad_cik(cik)).alias("cik"),
        F.struct(*([order] if order else []), "pos").alias("_at"),
    ).filter((F.col("ticker") != "") & F.col("cik").isNotNull())
    return picked.groupBy("ticker").agg(F.max_by("cik", "_at").alias("cik"))


def symbol_names(df: DataFrame, body: str = "body", order: str | None = None) -> DataFrame:
    """Listed symbols with their name; the last duplicate wins."""
    rows = payload_rows(df, body, [order] if order else None)
    listed = rows.select(
        norm_symbol(pick_text(*fields("symbol", "Symbol"))).alias("symbol"),
        F.coalesce(pick_text(*fields("name", "Name", "companyName")), F.lit("")).alias("name"),
        F.struct(*([order] if order else []), "pos").alias("_at"),
    ).filter(F.col("symbol").isNotNull())
    return listed.groupBy("symbol").agg(F.max_by("name", "_at").alias("name"))


def symbol_keys(master: DataFrame) -> DataFrame:
    """Normalised key to its sorted distinct symbols (spelling variants of one listing, so a short array)."""
    return (
        master.select(norm_key("symbol").alias("norm_key"), "symbol")
        .distinct()
        .groupBy("norm_key")
        .agg(F.sort_array(F.collect_set("symbol")).alias("symbols"))
    )
