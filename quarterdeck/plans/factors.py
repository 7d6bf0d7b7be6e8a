"""Factor snapshot: one row of factors per symbol at its newest price date."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.functions.scalars import format_pair, own_pct, safe_div, trans_pct
from quarterdeck.operators import aggregates as A
from quarterdeck.operators import formulas as R
from quarterdeck.operators import joins as J
from quarterdeck.operators import series as W
from quarterdeck.operators.fundamentals import fundamental_features
from quarterdeck.schemas import FACTORS, TABLES, conform
from quarterdeck.session import materialise
from quarterdeck.sinks.upsert import merge_last_wins, recover, remove_table, upsert
from quarterdeck.sources.tables import adjusted_close, first_present_column, path_exists, read_table, resolve_market_series

_KEY = "symbol"
#: Folder of a stored snapshot: its date.
_PART = "snapshot"


@dataclass
class FactorInputs:
    prices: DataFrame
    market: DataFrame
    financials: DataFrame
    dividends: DataFrame
    shares: DataFrame
    membership: DataFrame
    targets: DataFrame
    company_facts: DataFrame
    holdings: DataFrame
    transactions: DataFrame
    estimates: DataFrame
    estimates_quarterly: DataFrame


def read_inputs(spark: SparkSession, folder: str, index_symbol: str = "SP500") -> FactorInputs:
    def table(name: str) -> DataFrame:
        return read_table(spark, f"{folder}/{name}.parquet", TABLES[name], f"{folder}/{name}.csv")

    return FactorInputs(
        prices=table("prices_eod"),
        market=table("sp500_prices"),
        financials=table("financials_quarterly"),
        dividends=table("dividends_events"),
        shares=table("shares_snapshot"),
        membership=table("index_membership").filter(F.upper("indexSymbol") == index_symbol.upper()),
        targets=table("targets_snapshot"),
        company_facts=table("company_facts_snapshot"),
        holdings=table("insider_holdings_snapshot"),
        transactions=table("insider_transactions"),
        estimates=table("estimates_snapshot"),
        estimates_quarterly=table("estimates_quarterly_snapshot"),
    )


def _event_features(probe: DataFrame, dividends: DataFrame) -> DataFrame:
    """Dividend sums and the next or previous ex-date: one join, one aggregate."""
    hit = dividends.select(_KEY, "exDate", "dividend").join(probe, _KEY)
    ex, t = F.col("exDate"), F.col("price_date")
    sums = [F.sum(F.when(ex.between(lo, hi), F.col("dividend"))).alias(n) for n, (lo, hi) in J.dividend_windows("price_date").items()]
    return hit.groupBy(_KEY).agg(*sums, F.coalesce(F.min(F.when(ex > t, ex)), F.max(F.when(ex <= t, ex))).alias("Dividend Ex-Date"))


def _share_features(probe: DataFrame, shares: DataFrame) -> DataFrame:
    """Newest shares, and shares now against about a year ago: one join, one aggregate."""
    hit = shares.select(_KEY, "asOfDate", "sharesOutstanding", "sharesFloat").join(probe, _KEY)
    day, t = F.col("asOfDate"), F.col("price_date")
    # The row itself counts, NULL value or not, so the value is boxed.
    value = F.struct(F.col("sharesOutstanding").alias("v"))
    year_ago = day <= F.date_sub(t, 365)
    g = hit.groupBy(_KEY).agg(
        F.expr("max_by(sharesOutstanding, asOfDate) filter (where sharesOutstanding is not null)").alias("_snap_shares"),
        F.expr("max_by(sharesFloat, asOfDate) filter (where sharesFloat is not null)").alias("Shs Float"),
        F.max_by(value, F.when(day <= t, day)).alias("_now"),
        F.max_by(value, F.when(year_ago, day)).alias("_ago"),
        F.max(F.when(year_ago, F.datediff(F.date_sub(t, 365), day) * -1)).alias("_age"),
    )
    ago = F.when(F.col("_age") >= -120, F.col("_ago.v"))
    return g.select(_KEY, "_snap_shares", "Shs Float", (safe_div("_now.v", ago) - 1.0).alias("Share Dilution"))


def _holding_features(probe: DataFrame, holdings: DataFrame) -> DataFrame:
    """Insider holdings at the price date and ninety days before."""
    held = A.dedupe_max_then_sum(holdings, [_KEY, "asOfDate"], "reportingName", "securitiesOwned").join(probe, _KEY)
    day, t = F.col("asOfDate"), F.col("price_date")
    return held.groupBy(_KEY).agg(
        F.max_by("securitiesOwned", F.when(day <= t, day)).alias("_held_now"),
        F.max_by("securitiesOwned", F.when(day <= F.date_sub(t, 90), day)).alias("_held_prev"),
    )


def _one_row_a_day(prices: DataFrame) -> DataFrame:
    """Prices with one row per symbol and day: the last in `seq`, and without that column the largest row.

    The rows are dealt by symbol first, which the windows after it need anyway.
    """
    order = ["seq"] if "seq" in prices.columns else [c for c in prices.columns if c not in (_KEY, "date")]
    return W.price_series(prices.repartition(_KEY), order)


def factor_rows(inp: FactorInputs) -> DataFrame:
    """The factor table of this run.

    Prices are first reduced to one row per symbol and day (the later in `seq`, if the table has it). Each input table is read once and shuffled once by symbol; after its aggregate it has one row per symbol,
    so the left joins of the assembly only carry small sides. The probe (newest price date per symbol) is a
    partial aggregate over two columns of the prices.
    """
    px = adjusted_close(_one_row_a_day(inp.prices))
    probe = inp.prices.groupBy(_KEY).agg(F.max("date").alias("price_date"))
    indicators = W.latest_price_indicators(px).filter(F.col("Price").isNotNull())
    beta = W.beta(px, resolve_market_series(_one_row_a_day(inp.market))).withColumnRenamed("beta", "Beta")
    fin = inp.financials.filter(F.col("fiscalDate").isNotNull())

    targets = A.latest_composite_row(inp.targets, _KEY, "asOfDate", ["targetPrice"]).select(_KEY, F.col("targetPrice").alias("Target Price"))
    member = A.latest_membership(inp.membership).select(F.col("memberSymbol").alias(_KEY), F.col("isMember").alias("Index"))
    est = A.latest_composite_row(inp.estimates, _KEY, "asOfDate", ["epsThisY", "epsNextY"])
    est = est.select(_KEY, F.col("epsThisY").alias("EPS This Y"), F.col("epsNextY").alias("EPS Next Y"))
    est_q = A.latest_composite_row(inp.estimates_quarterly, _KEY, "asOfDate", ["epsNextQ"]).select(_KEY, F.col("epsNextQ").alias("EPS Next Q"))
    facts = J.asof_step_back(
        probe, inp.company_facts, _KEY, "price_date", "asOfDate",
        ["ipoDate", "sharesOutstanding_shares", "sharesOutstanding_profile"], "employees", F.col("employees") >= 0,
    ).select(
        _KEY, F.col("employees").alias("Employees"), F.col("ipoDate").alias("IPO (Date)"),
        R.facts_shares("sharesOutstanding_shares", "sharesOutstanding_profile").alias("_facts_shares"),
    )
    net = J.range_signed_sum(
        probe, inp.transactions, _KEY, "price_date", "transactionDate", "securitiesTransacted", "acquisitionOrDisposition", "transactionType"
    ).select(_KEY, F.col("net_shares").alias("_net"))

    features = [
        beta,
        fundamental_features(fin, first_present_column(fin)),
        _share_features(probe, inp.shares),
        _event_features(probe, inp.dividends),
        _holding_features(probe, inp.holdings),
        targets, member, est, est_q, facts, net,
    ]
    rows = J.feature_assembly(indicators, features, _KEY)
    rows = rows.withColumns(
        {
            "has_latest": F.coalesce("has_latest", F.lit(False)),
            "has_ttm": F.coalesce("has_ttm", F.lit(False)),
            "shares_out": R.resolved_shares("_snap_shares", "l_sharesOutstanding"),
        }
    )
    rows = R.financial_indicators(rows)
    base = R.insider_base("_facts_shares", "shares_out")
    rows = rows.withColumns(
        {
            "asOfDate": F.col("price_date"),
            "Dividend TTM": F.col("ttm"),
            "Dividend Est": F.col("ttm"),
            "Dividend Gr. 3Y": R.dividend_growth("ttm", "ago_3y", 3),
            "Dividend Gr. 5Y": R.dividend_growth("ttm", "ago_5y", 5),
            "EPS Next 5Y": R.growth_blend("EPS This Y", "EPS Next Y", "eps_now", "eps_5y", "eps_3y"),
            "Forward P/E": R.forward_pe("Price", "EPS Next Y"),
            "_own": own_pct("_held_now", base),
            "_trans": trans_pct("_held_now", "_held_prev", "_net", base),
        }
    )
    rows = rows.withColumn("PEG", R.peg("P/E", "EPS Next 5Y")).withColumn("Insider Own/Trans", format_pair("_own", "_trans"))
    return conform(R.placeholder_columns(rows), FACTORS.schema)


def accumulate(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Snapshot history with this run merged in: (asOfDate, symbol) is unique and the new row wins."""
    return merge_last_wins(existing, new, FACTORS.key, FACTORS.schema)


def store_snapshots(spark: SparkSession, rows: DataFrame, out: str) -> None:
    """Merge `rows` into the stored snapshots: Parquet and CSV, one folder per date (column `snapshot`).

    Only the dates of `rows` are read and rewritten. The CSV twin is made from the same folders of the Parquet table; the dates
    that it still lacks are kept beside the table until it is complete, so a run that stopped between the two
    is made good by the next. A history that exists as CSV only, or in one piece, is rewritten once, and so is a CSV
    in one piece or without its success marker.
    """
    table, twin, todo = f"{out}.parquet", f"{out}.csv", f"{out}__csv_todo"
    recover(spark, table)
    if not path_exists(spark, table):
        rows = accumulate(read_table(spark, table, FACTORS, twin), rows)
    new = materialise(conform(rows, FACTORS.schema), "snapshots")
    new.select(F.col("asOfDate").alias(_PART)).distinct().write.mode("append").parquet(todo)
    upsert(spark, table, new, FACTORS, pos=[], partition_by={_PART: F.col("asOfDate")})
    stored = spark.read.parquet(table)
    by_day = path_exists(spark, f"{twin}/_SUCCESS") and _PART in spark.read.csv(twin, header=True).columns
    if by_day:
        days = spark.read.parquet(todo).distinct().withColumnRenamed(_PART, "_day")
        stored = stored.join(days, F.col(_PART).eqNullSafe(F.col("_day")), "left_semi")
    mode = "dynamic" if by_day else "static"
    rows_of_csv = stored.repartition(_PART).sortWithinPartitions(_PART, *FACTORS.key)
    rows_of_csv.write.mode("overwrite").option("partitionOverwriteMode", mode).option("header", True).partitionBy(_PART).csv(twin)
    remove_table(spark, todo)


def read_snapshots(spark: SparkSession, out: str) -> DataFrame:
    """The stored snapshots with the declared columns; a filter on asOfDate alone does not prune, one on `snapshot` before does."""
    return conform(spark.read.parquet(f"{out}.parquet"), FACTORS.schema)


def run(spark: SparkSession, folder: str, out: str, index_symbol: str = "SP500") -> None:
    """Read the tables, compute the factors, merge them into the stored snapshots, write Parquet and CSV."""
    store_snapshots(spark, factor_rows(read_inputs(spark, folder, index_symbol)), out)


def coverage(rows: DataFrame) -> DataFrame:
    """Non-NULL count per factor of a run."""
    return A.coverage_profile(rows, [c for c in rows.columns if c not in FACTORS.key], FACTORS.key)

