"""Queries of the window and time-series operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterdeck.catalog import bindings as B
from quarterdeck.catalog.registry import query
from quarterdeck.operators import series as W
from quarterdeck.operators.xbrl import quarter_values
from quarterdeck.sources.tables import adjusted_close


@query(
    "W1_price_series",
    """
SELECT symbol, CAST(date AS VARCHAR) AS date, close, volume FROM (
  SELECT symbol, date, l_extendedprice AS close, l_quantity AS volume, row_number() OVER (PARTITION BY symbol, date ORDER BY o DESC, l_quantity DESC) AS k FROM li)
WHERE k = 1""",
    "li",
)
def w1(spark, sf):
    return W.price_series(B.ticks(spark, sf), [*B.ORDER, "volume"]).select("symbol", "date", "close", "volume")


@query("W2_prev_close_change", "SELECT symbol, CAST(date AS VARCHAR) AS date, round(close, 6) AS close, round(prev, 6) AS prev_close, round((close - prev) / nullif(prev, 0), 6) AS change FROM ind", "ind")
def w2(spark, sf):
    return W.prev_close_change(B.adjusted(spark, sf), W.by_key()).select("symbol", "date", "close", "prev_close", "change")


@query(
    "W3_avg_volume",
    """
SELECT symbol, CAST(date AS VARCHAR) AS date, round(av, 6) AS avg_volume, round(volume / nullif(av, 0), 6) AS rel_volume FROM (
  SELECT *, CASE WHEN rn >= 63 THEN avg(volume) OVER (PARTITION BY symbol ORDER BY date ROWS 62 PRECEDING) END AS av FROM ind)""",
    "ind",
)
def w3(spark, sf):
    return W.volume_ratio(B.adjusted(spark, sf), W.by_key()).select("symbol", "date", "avg_volume", "rel_volume")


@query(
    "W4_sma",
    "SELECT symbol, CAST(date AS VARCHAR) AS date, "
    + ", ".join(
        f"round(CASE WHEN rn >= {n} THEN avg(close) OVER (PARTITION BY symbol ORDER BY date ROWS {n - 1} PRECEDING) END, 8) AS sma{n}" for n in (20, 50, 200)
    )
    + " FROM ind",
    "ind",
    digits=8,
)
def w4(spark, sf):
    return W.sma(B.adjusted(spark, sf)).select("symbol", "date", "sma20", "sma50", "sma200")


@query(
    "W5_high_low_52w",
    """
SELECT symbol, CAST(date AS VARCHAR) AS date,
  CASE WHEN rn >= 250 THEN round(max(close) OVER w, 6) END AS high_n, CASE WHEN rn >= 250 THEN round(min(close) OVER w, 6) END AS low_n
FROM ind WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS 249 PRECEDING)""",
    "ind",
)
def w5(spark, sf):
    return W.high_low(B.adjusted(spark, sf)).select("symbol", "date", "high_n", "low_n")


@query(
    "W6_volatility",
    """
SELECT symbol, CAST(date AS VARCHAR) AS date, CASE WHEN count(ret) OVER w = 63 THEN round(stddev_samp(ret) OVER w, 6) END AS volatility
FROM ind WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS 62 PRECEDING)""",
    "ind",
)
def w6(spark, sf):
    return W.volatility(B.adjusted(spark, sf), W.by_key()).select("symbol", "date", "volatility")


@query(
    "W7_atr",
    """
SELECT symbol, CAST(date AS VARCHAR) AS date,
  CASE WHEN rn >= 15 THEN round((sum(t) OVER (PARTITION BY symbol ORDER BY date ROWS 13 PRECEDING) + lag(own, 14) OVER (PARTITION BY symbol ORDER BY date)) / 15, 6) END AS atr
FROM (SELECT *, CASE WHEN prev IS NOT NULL THEN greatest(high - low, abs(high - prev), abs(low - prev)) END AS t,
        greatest(high - low, abs(high - close), abs(low - close)) AS own FROM ind)""",
    "ind",
)
def w7(spark, sf):
    return W.atr(B.adjusted(spark, sf), W.by_key()).select("symbol", "date", "atr")


@query(
    "W8_rsi_wilder",
    """
SELECT symbol, CAST(max(date) AS VARCHAR) AS date, round(CASE WHEN max(n) >= 15 THEN CASE WHEN sum(l * wt) = 0 THEN CASE WHEN sum(g * wt) > 0 THEN 100.0 END
  ELSE 100.0 - 100.0 / (1 + sum(g * wt) / sum(l * wt)) END END, 6) AS rsi
FROM (SELECT symbol, date, n, greatest(close - prev, 0) AS g, greatest(prev - close, 0) AS l,
        CASE WHEN rn <= 15 THEN power(13.0 / 14.0, n - 15) ELSE power(13.0 / 14.0, n - rn) END / 14.0 AS wt FROM ind WHERE rn > 1)
GROUP BY symbol""",
    "ind",
)
def w8(spark, sf):
    return W.rsi_latest(B.adjusted(spark, sf)).select("symbol", "date", "rsi")


@query(
    "W9_perf",
    "SELECT symbol, CAST(date AS VARCHAR) AS date, "
    + ", ".join(f"round(close / nullif(lag(close, {n}) OVER w, 0) - 1, 6) AS perf_{k}" for k, n in W.PERF_ROWS.items())
    + " FROM ind WINDOW w AS (PARTITION BY symbol ORDER BY date)",
    "ind",
)
def w9(spark, sf):
    return W.perf(B.adjusted(spark, sf), W.by_key()).select("symbol", "date", *[f"perf_{k}" for k in W.PERF_ROWS])


@query(
    "W10_perf_ytd",
    """
SELECT symbol, CAST(date AS VARCHAR) AS date, round(close / nullif(first_value(close) OVER (PARTITION BY symbol, year(date) ORDER BY date), 0) - 1, 6) AS perf_ytd
FROM ind""",
    "ind",
)
def w10(spark, sf):
    return W.perf_ytd(B.adjusted(spark, sf)).select("symbol", "date", "perf_ytd")


@query(
    "W11_month_end_close",
    "SELECT symbol, CAST(date_trunc('month', date)::DATE AS VARCHAR) AS month, round(arg_max(close, date), 6) AS close FROM px GROUP BY symbol, date_trunc('month', date)",
    "px",
)
def w11(spark, sf):
    return W.month_end_close(B.adjusted(spark, sf))


@query(
    "W12_beta_monthly_or_daily",
    "SELECT symbol, round(beta, 2) AS beta FROM betas",
    "betas",
)
def w12(spark, sf):
    px = B.stored_prices(spark, sf)
    return W.beta(adjusted_close(px), B.market_of(px))


@query("W13_rolling_ttm_ratio", 'SELECT symbol, CAST("fiscalDate" AS VARCHAR) AS "fiscalDate", round(eps_ttm, 6) AS eps_ttm FROM eps', "eps")
def w13(spark, sf):
    return W.rolling_ttm_ratio(B.financials(spark, sf), order=["period"]).select("symbol", "fiscalDate", "eps_ttm")


@query(
    "W14_decumulate",
    """
SELECT cik, slot, metric, CAST("end" AS VARCHAR) AS "end", ptype AS period_type, round(val, 6) AS val, round(qv, 6) AS quarter_value FROM quarterised""",
    "quarterised",
)
def w14(spark, sf):
    from quarterdeck.catalog.q_joins import picked

    return quarter_values(picked(spark, sf)).select("cik", "slot", "metric", "end", "period_type", "val", "quarter_value")


@query(
    "W15_back_adjust",
    """
SELECT symbol, CAST(date AS VARCHAR) AS date, round(close * coalesce(product(f) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 1), 6) AS adj_close
FROM (SELECT p.symbol, p.date, p.close,
    coalesce(s.factor, 1) * coalesce(CASE WHEN d.dividend IS NOT NULL THEN (coalesce(p.prev, p.close) - d.dividend) / coalesce(p.prev, p.close) END, 1) AS f
  FROM ind p
  LEFT JOIN (SELECT symbol, "exDate" AS date, dividend FROM (SELECT *, row_number() OVER (PARTITION BY symbol, "exDate" ORDER BY o DESC, dividend DESC) AS k FROM divs) WHERE k = 1) d USING (symbol, date)
  LEFT JOIN (SELECT symbol, date, 1.0 / (1 + max(l_discount)) AS factor FROM li WHERE l_linenumber = 2 AND l_returnflag = 'R' AND l_discount > 0.09 GROUP BY symbol, date) s USING (symbol, date))""",
    "ind divs",
)
def w15(spark, sf):
    from quarterdeck.plans.ingest import dividends_by_date

    splits = (
        B.lines(spark, sf)
        .filter("l_linenumber = 2 and l_returnflag = 'R' and l_discount > 0.09")
        .groupBy("symbol", "date")
        .agg((1.0 / (1 + F.max("l_discount"))).alias("factor"))
    )
    div = dividends_by_date(B.dividends(spark, sf), [*B.ORDER, "dividend"])
    return W.back_adjust(B.adjusted(spark, sf), div, splits).select("symbol", "date", "adj_close")


@query(
    "W16_top_n_per_key",
    """
SELECT symbol, CAST(date AS VARCHAR) AS date, round(close, 6) AS close, rn FROM (
  SELECT symbol, date, close, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS rn FROM px) WHERE rn <= 8""",
    "px",
)
def w16(spark, sf):
    return W.top_n_per_key(B.adjusted(spark, sf), "symbol", [F.col("date").desc()], 8).select("symbol", "date", "close", "rn")
