"""Ticker resolution: exact symbol, normalised key, then names scored inside the key block."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quarterdeck.functions.scalars import norm_key, norm_symbol


def _common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, one bit per character of `a`."""
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & masks.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - bin(row).count("1")


def _ratio(a: str, b: str) -> float:
    n = len(a) + len(b)
    return 100.0 if n == 0 else 200.0 * _common_length(a, b) / n


def token_set_score(a: str, b: str) -> float:
    """Similarity of two names as word sets, 0 to 100; word order and repetition do not count."""
    if not a or not b:
        return 0.0
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = x & y
    if both and (not (x - y) or not (y - x)):
        return 100.0
    shared = " ".join(sorted(both))
    rest_a, rest_b = " ".join(sorted(x - y)), " ".join(sorted(y - x))
    full_a = f"{shared} {rest_a}".strip()
    full_b = f"{shared} {rest_b}".strip()
    best = _ratio(full_a, full_b)
    if both:
        best = max(best, _ratio(shared, full_a), _ratio(shared, full_b))
    return best


@F.pandas_udf(T.DoubleType())
def token_set_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_set_score(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype="float64")


def resolve_tickers(lines: DataFrame, master: DataFrame, ticker: str, name: str, accept: float = 90.0, lead: float = 5.0) -> DataFrame:
    """Resolution per distinct (ticker, name): match type, symbol, score, candidate count and reason.

    `master` is (symbol, name), unique on symbol. Every join is an equi-join: exact on the symbol, then on the
    normalised key. A key block holds the spellings of one listing code, and lines are distinct before they
    meet it, so repeated holdings lines cost nothing. Names are scored by the one pandas UDF, and only for
    blocks with more than one symbol.
    """
    d = lines.select(ticker, name).distinct().withColumn("_t", norm_symbol(ticker)).withColumn("_k", norm_key(ticker))
    syms = master.select(F.col("symbol").alias("_sym"), F.col("name").alias("_cand"))
    exact = syms.select(F.col("_sym").alias("_exact"))
    blocks = syms.withColumn("_k", norm_key("_sym"))
    sizes = blocks.groupBy("_k").agg(F.count(F.lit(1)).alias("_n"), F.min("_sym").alias("_one"))

    d = d.join(exact, F.col("_t") == F.col("_exact"), "left").join(sizes, "_k", "left")
    # A score depends on the two names alone, so copies collapse before names meet: one row per distinct line
    # name and one per distinct candidate name of a block, with the number of symbols that carry it.
    unclear = d.filter(F.col("_exact").isNull() & (F.col("_n") > 1)).select("_k", F.trim(F.coalesce(F.col(name), F.lit(""))).alias("_line"))
    cands = blocks.groupBy("_k", F.trim(F.coalesce("_cand", F.lit(""))).alias("_cand")).agg(F.min("_sym").alias("_sym"), F.count(F.lit(1)).alias("_c"))
    scored = unclear.distinct().join(cands, "_k").withColumn("_score", token_set_ratio("_line", "_cand"))
    w = Window.partitionBy("_k", "_line").orderBy(F.col("_score").desc(), "_sym")
    ranked = scored.withColumn("_rn", F.row_number().over(w)).filter("_rn <= 2")
    first = F.col("_rn") == 1
    best = ranked.groupBy("_k", "_line").agg(
        F.max(F.when(first, F.col("_sym"))).alias("_best"),
        F.max(F.when(first, F.col("_score"))).alias("_top"),
        # Two symbols with the best name tie with each other.
        F.max(F.when(~first | (F.col("_c") > 1), F.col("_score"))).alias("_second"),
    )
    lined = d.withColumn("_line", F.trim(F.coalesce(F.col(name), F.lit(""))))
    j = lined.join(best, ["_k", "_line"], "left")
    sure = (F.col("_top") >= accept) & (F.col("_top") - F.col("_second") >= lead)
    kind = (
        F.when(F.coalesce(F.col("_t"), F.lit("")) == "", F.lit("REJECT"))
        .when(F.col("_exact").isNotNull(), F.lit("EXACT"))
        .when(F.col("_n").isNull(), F.lit("REJECT"))
        .when(F.col("_n") == 1, F.lit("NORMALIZED"))
        .when(sure, F.lit("NAME_FUZZY"))
        .otherwise(F.lit("AMBIGUOUS"))
    )
    return _resolution(j.withColumn("match_type", kind), ticker, name)


def _resolution(j: DataFrame, ticker: str, name: str) -> DataFrame:
    m = F.col("match_type")
    fixed_symbol: Column = (
        F.when(m == "EXACT", F.col("_t")).when(m == "NORMALIZED", F.col("_one")).when(m == "NAME_FUZZY", F.col("_best")).otherwise(F.lit(""))
    )
    reason = (
        F.when((m == "REJECT") & (F.coalesce(F.col("_t"), F.lit("")) == ""), F.lit("empty_ticker"))
        .when(m == "REJECT", F.lit("no_symbol_match"))
        .when(m == "AMBIGUOUS", F.lit("fuzzy_tie_or_low_score"))
    )
    count = F.when(m == "EXACT", F.lit(1)).when(m == "REJECT", F.lit(0)).otherwise(F.col("_n")).cast("int")
    return j.select(
        ticker, name, fixed_symbol.alias("ticker_fixed"), "match_type",
        F.when(m.isin("NAME_FUZZY", "AMBIGUOUS"), F.col("_top")).alias("match_score"),
        count.alias("candidate_count"), reason.alias("reason"),
    )
