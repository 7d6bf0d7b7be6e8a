"""Quality report over the stored tables.

Each table is read once and reduced to one row, or one row per day, of mergeable counts; every check comes from these. The
day counts of the prices can be stored, so that a daily report reads the new days and the counts of the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterdeck.functions import fixed
from quarterdeck.operators import aggregates as A
from quarterdeck.operators.joins import calendar_consistency
from quarterdeck.schemas import Table
from quarterdeck.sinks.upsert import upsert

PRICE_DAYS = Table(
    "price_days",
    T.StructType([T.StructField("day", T.DateType()), T.StructField("n_rows", T.LongType()), T.StructField("missing", T.LongType())]),
    ["day"],
)


def price_days(prices: DataFrame) -> DataFrame:
    """Rows and missing adjusted closes of each day."""
    return A.day_profile(prices, "date", {"missing": F.col("adjClose").isNull()})


def store_price_days(spark: SparkSession, path: str, prices: DataFrame) -> None:
    """Merge the counts of whole days of `prices` into the stored ones; a day that comes again is replaced."""
    upsert(spark, path, price_days(prices), PRICE_DAYS, pos=[])


def _long(row: DataFrame, *checks: tuple[str, str, str]) -> DataFrame:
    """(section, check_name, value) rows from one row of figures; `checks` holds section, check and column."""
    return row.select(F.inline(F.array(*[F.struct(F.lit(s).alias("section"), F.lit(n).alias("check_name"), F.col(c).cast("double").alias("value")) for s, n, c in checks])))


def price_report(days: DataFrame, today: Column, stale_days: int = fixed.STALE_DAYS) -> DataFrame:
    """Row count, freshness and missing adjusted closes from the counts of the days.

    An empty table has no rows, no lag and no rates. Rows without a date count as rows and are of no day.
    """
    g = days.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), F.max("day").alias("newest"), F.sum("missing").alias("missing"),
        F.max_by("n_rows", "day").alias("n_latest"), F.max_by("missing", "day").alias("missing_latest"),
    )
    lag = F.datediff(today, "newest")
    g = g.withColumns(
        {
            "lag_days": lag,
            "stale": (lag > stale_days).cast("int"),
            "missing_rate": F.try_divide("missing", "n_rows"),
            "missing_rate_latest": F.try_divide("missing_latest", "n_latest"),
        }
    )
    names = ["n_rows", "n_latest", "lag_days", "stale", "missing_rate", "missing_rate_latest"]
    return _long(g, ("rows", "prices_eod", "n_rows"), *[("prices", n, n) for n in names])


def financials_report(financials: DataFrame) -> DataFrame:
    """Row count and consistency of revenue and gross profit, from one aggregate."""
    r, g = F.col("revenue"), F.col("grossProfit")
    checks = {"revenue_zero": r == 0, "revenue_missing": r.isNull(), "gross_profit_above_revenue": g > r}
    row = financials.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()])
    return _long(row, ("rows", "financials_quarterly", "n_rows"), *[("financials", n, n) for n in checks])


def report(
    days: DataFrame, financials: DataFrame, calendar: DataFrame, events: DataFrame, today: Column, others: dict[str, DataFrame | None] | None = None
) -> DataFrame:
    """All checks in one long table (section, check_name, value).

    `days` are the counts of the prices (`price_days`, or stored ones); of the `others` only rows are counted, None stands for
    an absent table.
    """
    match = calendar_consistency(calendar, events, "symbol", "exDate", "exDate", "pos").groupBy("status").agg(
        F.count(F.lit(1)).cast("double").alias("value")
    )
    out = price_report(days, today).union(financials_report(financials))
    out = out.union(match.select(F.lit("calendar"), "status", "value"))
    for name, df in (others or {}).items():
        n = df.agg(F.count(F.lit(1)).alias("n")) if df is not None else days.sparkSession.range(1).select(F.lit(0).alias("n"))
        out = out.union(_long(n, ("rows", name, "n")))
    return out
