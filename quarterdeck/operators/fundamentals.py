"""All trailing fundamentals of a symbol in one pass.

The operators of `aggregates` answer one question each and read the statements once each. The factor job needs
all of them, so this module ranks the rows once (one exchange, one sort by symbol and date) and takes every
feature as a conditional aggregate of that ranking. The aggregate is partitioned like the window, so nothing
is exchanged again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarterdeck.functions.scalars import safe_div
from quarterdeck.operators.aggregates import FLOW_SUMS
from quarterdeck.operators.formulas import LATEST, PREVIOUS
from quarterdeck.schemas import q

_NEAR_DAYS = 180


def _ranked(fin: DataFrame, key: str, date: str, tie: str) -> DataFrame:
    rows = Window.partitionBy(key).orderBy(date, tie)
    whole = rows.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    four = rows.rowsBetween(-3, 0)
    ni, shares = "netIncome", "weightedAverageSharesDiluted"
    full = (F.count(ni).over(four) == 4) & (F.count(shares).over(four) == 4)
    d = fin.select(
        "*",
        (F.count(F.lit(1)).over(whole) - F.row_number().over(rows) + 1).alias("_rn"),
        F.when(full, safe_div(F.sum(ni).over(four), F.avg(shares).over(four))).alias("_eps"),
        F.max(date).over(whole).alias("_fd"),
    )
    return d.withColumn("_eps_fd", F.max(F.when(F.col("_eps").isNotNull(), F.col(date))).over(whole))


def _near(date: str, target: Column) -> Column:
    """Trailing EPS at the date nearest to `target`, equal distances to the earlier date."""
    gap = F.abs(F.datediff(date, target))
    ok = (gap <= _NEAR_DAYS) & F.col("_eps").isNotNull()
    return F.min_by(F.when(ok, F.col("_eps")), F.when(ok, F.struct(gap, F.col(date))))


def fundamental_features(fin: DataFrame, interest: str | None = None, key: str = "symbol", date: str = "fiscalDate", tie: str = "period") -> DataFrame:
    """Newest composite quarter `l_*`, previous quarter `p_*`, trailing block `t_*`, growth and quality ratios."""
    rn = F.col("_rn")

    def rows(c: str, low: int, high: int) -> Column:
        return F.when(rn.between(low, high), F.col(c))

    def both(c: str) -> list[Column]:
        return [
            F.count(rows(c, 1, 4)).alias(f"_n1_{c}"), F.count(rows(c, 5, 8)).alias(f"_n2_{c}"),
            F.sum(rows(c, 1, 4)).alias(f"_s1_{c}"), F.sum(rows(c, 5, 8)).alias(f"_s2_{c}"),
        ]

    margin = F.when((rn <= 8) & (F.col("revenue") != 0), safe_div("operatingIncome", "revenue"))
    cost = interest or "incomeBeforeTax"
    g = _ranked(fin, key, date, tie).groupBy(key).agg(
        F.max(date).alias("financials_date"),
        F.count(F.lit(1)).alias("_rows"),
        *[F.expr(f"min_by({q(c)}, _rn) filter (where {q(c)} is not null)").alias(f"l_{c}") for c in LATEST],
        *[F.max(rows(c, 2, 2)).alias(f"p_{c}") for c in PREVIOUS],
        *[F.sum(rows(c, 1, 4)).alias(f"_t_{c}") for c in FLOW_SUMS],
        F.avg(rows("weightedAverageSharesDiluted", 1, 4)).alias("_t_weightedAverageSharesDiluted"),
        F.max(rows("sharesOutstanding", 1, 1)).alias("_t_sharesOutstanding"),
        *both("revenue"), *both("operatingCashFlow"), F.count(rows("netIncome", 1, 4)).alias("_n1_netIncome"),
        F.sum(rows(cost, 1, 4)).alias("_cost"),
        F.count(margin).alias("_margins"), F.stddev_samp(margin).alias("_margin_dev"),
        F.max_by(F.when(F.col("_eps").isNotNull(), F.col("_eps")), F.when(F.col("_eps").isNotNull(), F.struct(date, -rn))).alias("_eps_last"),
        _near(date, F.date_sub("_eps_fd", 365)).alias("_eps_ago"),
        _near(date, F.col("_fd")).alias("eps_now"),
        _near(date, F.add_months("_fd", -36)).alias("eps_3y"),
        _near(date, F.add_months("_fd", -60)).alias("eps_5y"),
    )
    has = F.col("_rows") >= 4
    block = [*FLOW_SUMS, "weightedAverageSharesDiluted", "sharesOutstanding"]

    def yoy(c: str, positive: bool) -> Column:
        base = F.col(f"_s2_{c}")
        ok = (F.col(f"_n1_{c}") == 4) & (F.col(f"_n2_{c}") == 4) & ((base > 0) if positive else (base != 0))
        return F.when(ok, F.col(f"_s1_{c}") / base - 1.0)

    oi = F.col("_t_operatingIncome")
    paid = F.abs(F.col("_cost") if interest else oi - F.col("_cost"))
    complete = (F.col("_n1_operatingCashFlow") == 4) & (F.col("_n1_netIncome") == 4)
    return g.select(
        key, "financials_date", F.lit(True).alias("has_latest"), has.alias("has_ttm"),
        *[f"l_{c}" for c in LATEST], *[f"p_{c}" for c in PREVIOUS],
        *[F.when(has, F.col(f"_t_{c}")).alias(f"t_{c}") for c in block],
        yoy("revenue", True).alias("Revenue YoY"),
        yoy("operatingCashFlow", False).alias("OCF YoY"),
        F.when(complete, safe_div("_t_operatingCashFlow", "_t_netIncome")).alias("OCF/NI"),
        (safe_div("_eps_last", "_eps_ago") - 1.0).alias("EPS YoY"),
        F.when(has & (paid >= 1e-12), oi / paid).alias("Interest Coverage"),
        F.when(F.col("_margins") >= 4, F.col("_margin_dev")).alias("OPM volatility"),
        "eps_now", "eps_3y", "eps_5y",
    )
