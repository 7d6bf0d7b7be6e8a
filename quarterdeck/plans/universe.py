"""Universe of resolved tickers from fund holdings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterdeck.functions import fixed
from quarterdeck.functions.scalars import norm_symbol, reject_non_equity, text
from quarterdeck.operators.aggregates import value_counts
from quarterdeck.operators.matching import resolve_tickers
from quarterdeck.sinks.writers import split_sink, write_lookup_json
from quarterdeck.sources.holdings import cell, read_holdings
from quarterdeck.sources.payloads import symbol_names

OUTPUT = ["ticker_raw", "name_raw", "ticker_fixed", "match_type", "match_score", "candidate_count", "reason", "weight"]


def holdings_lines(rows: DataFrame) -> DataFrame:
    """(file, pos, names, cells) rows to typed holdings lines."""
    return rows.select(
        "file",
        "pos",
        F.coalesce(norm_symbol(cell(fixed.TICKER_COLUMNS)), F.lit("")).alias("ticker_raw"),
        F.coalesce(text(cell(fixed.NAME_COLUMNS)), F.lit("")).alias("name_raw"),
        F.coalesce(text(cell(fixed.ASSET_CLASS_COLUMNS)), F.lit("")).alias("asset_class"),
        cell(fixed.WEIGHT_COLUMNS).alias("weight"),
    )


def classify(lines: DataFrame, master: DataFrame) -> DataFrame:
    """Every line with its resolution. Rejection rules come first, then the ticker match."""
    listed = master.select(F.col("symbol").alias("ticker_raw"), F.lit(True).alias("_listed"))
    flagged = lines.join(listed, "ticker_raw", "left")
    flagged = flagged.withColumn(
        "_bad",
        reject_non_equity("name_raw", "asset_class", "ticker_raw", F.coalesce("_listed", F.lit(False))) & (F.col("ticker_raw") != ""),
    ).drop("_listed")
    resolved = resolve_tickers(flagged.filter(~F.col("_bad")), master, "ticker_raw", "name_raw")
    keys = ["ticker_raw", "name_raw"]
    good = flagged.filter(~F.col("_bad")).join(resolved, keys)
    bad = flagged.filter("_bad").withColumns(
        {
            "ticker_fixed": F.lit(""),
            "match_type": F.lit("REJECT"),
            "match_score": F.lit(None).cast(T.DoubleType()),
            "candidate_count": F.lit(0),
            "reason": F.lit("non_equity"),
        }
    )
    return good.unionByName(bad).select("file", "pos", *OUTPUT)


def reject_reasons(classified: DataFrame) -> DataFrame:
    return value_counts(classified.filter("match_type = 'REJECT'"), "reason", 10)


def run(spark: SparkSession, holdings_path: str, symbol_list: DataFrame, out: str) -> None:
    """Holdings folder and landed symbol list to the three outputs and the lookup file."""
    rows = classify(holdings_lines(read_holdings(spark, holdings_path)), symbol_names(symbol_list))
    split_sink(rows, f"{out}/universe")
    stored = spark.read.parquet(f"{out}/universe").filter("reason is null or reason not in ('empty_ticker', 'non_equity')")
    write_lookup_json(
        stored.withColumns({"_at": F.struct("file", "pos"), "score": F.col("match_score")}),
        f"{out}/ticker_map",
        "ticker_raw",
        ["ticker_fixed", "match_type", "score", "candidate_count", "reason"],
        "_at",
    )
