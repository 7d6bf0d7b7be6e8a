"""Declared tables and universe lists from files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterdeck.functions import fixed
from quarterdeck.functions.scalars import norm_symbol, text
from quarterdeck.schemas import Table, conform, q


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when the Hadoop path holds anything; works for every file system Spark can read."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def normalise_table(df: DataFrame, table: Table, required_dates: tuple[str, ...] | None = None) -> DataFrame:
    """Conform, trim and upper-case the symbol, drop rows without a required date."""
    out = conform(df, table.schema).withColumn(table.symbol, norm_symbol(table.symbol))
    need = table.required_dates if required_dates is None else required_dates
    return out.dropna(subset=list(need)) if need else out


def read_table(spark: SparkSession, path: str, table: Table, csv_path: str | None = None) -> DataFrame:
    """Load a declared table from Parquet, else from its CSV twin, else an empty typed frame."""
    if path_exists(spark, path):
        return normalise_table(spark.read.parquet(path), table)
    if csv_path and path_exists(spark, csv_path):
        return normalise_table(spark.read.csv(csv_path, header=True), table)
    return spark.createDataFrame([], table.schema)


def adjusted_close(prices: DataFrame, close: str = "close", adjusted: str = "adjClose") -> DataFrame:
    """Replace the close by the adjusted close where there is one; open, high and low stay raw."""
    return prices.withColumn(close, F.coalesce(F.col(adjusted), F.col(close)))


def resolve_market_series(raw: DataFrame, symbol: str = "symbol", candidates: list[str] | None = None) -> DataFrame:
    """Rows of the first candidate symbol that occurs; without a symbol column the whole table.

    The winning rank is a one-row aggregate with map-side partials, so its join side is bounded.
    """
    if symbol not in raw.columns:
        return raw
    names = candidates or fixed.MARKET_SYMBOL_CANDIDATES
    rank = F.array_position(F.array(*[F.lit(n) for n in names]), norm_symbol(symbol))
    ranked = raw.filter(norm_symbol(symbol).isin(*names)).withColumn("_rank", rank)
    best = ranked.agg(F.min("_rank").alias("_rank"))
    return ranked.join(F.broadcast(best), "_rank").drop("_rank")


def pick_col(df: DataFrame, candidates: list[str]) -> str | None:
    """First candidate that the frame has, ignoring case; decided from the schema alone."""
    have = {c.lower(): c for c in df.columns}
    return next((have[c.lower()] for c in candidates if c.lower() in have), None)


def first_present_column(df: DataFrame, candidates: list[str] | None = None) -> str | None:
    """First of the known interest-expense columns, matched exactly."""
    return next((c for c in candidates or fixed.INTEREST_EXPENSE_COLUMNS if c in df.columns), None)


def clean_headers(df: DataFrame) -> DataFrame:
    """Strip byte-order marks and blanks from the header names."""
    return df.toDF(*[c.replace("﻿", "").strip() for c in df.columns])


def universe_rows(df: DataFrame) -> DataFrame:
    """Trimmed cells, short rows padded with '', all-blank rows dropped."""
    df = clean_headers(df)
    cells = [F.coalesce(text(q(c)), F.lit("")).alias(c) for c in df.columns]
    blank = F.lit(True)
    for c in df.columns:
        blank = blank & (F.col(q(c)) == "")
    return df.select(*cells).filter(~blank)


def universe_symbols(df: DataFrame) -> DataFrame:
    """Distinct normalised symbols of a universe list."""
    df = clean_headers(df)
    name = pick_col(df, fixed.UNIVERSE_SYMBOL_COLUMNS)
    if name is None:
        raise ValueError(f"a universe list needs one of {fixed.UNIVERSE_SYMBOL_COLUMNS}")
    return df.select(norm_symbol(q(name)).alias("symbol")).filter(F.col("symbol") != "").distinct()


def read_universe(spark: SparkSession, path: str) -> DataFrame:
    """Universe CSV as all-string rows."""
    return universe_rows(spark.read.csv(path, header=True, mode="PERMISSIVE"))


def universe_filter(
    df: DataFrame,
    universe: DataFrame,
    key: str = "symbol",
    date: str | None = None,
    low: Column | str | None = None,
    high: Column | str | None = None,
    only: list[str] | None = None,
) -> DataFrame:
    """Keep universe symbols inside a date range; range and symbol list reach the scan."""
    if date and low is not None:
        df = df.filter(F.col(date) >= low)
    if date and high is not None:
        df = df.filter(F.col(date) <= high)
    if only:
        df = df.filter(F.col(key).isin([s.strip().upper() for s in only]))
    return df.join(universe.select(key).distinct(), key, "left_semi")
