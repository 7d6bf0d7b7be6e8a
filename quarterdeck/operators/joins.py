"""As-of, range and lookup joins.

Two shapes of as-of join exist. With one probe per key the snapshots join the probe and aggregate (map-side
partials, so hot keys are safe). With many probes per key the two sides are stacked and the newest snapshot is
carried forward inside (key, calendar bucket); one row per bucket carries the value across buckets. No task
ever holds more than one bucket of one key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarterdeck.functions.scalars import col, safe_div, txn_sign
from quarterdeck.sinks.upsert import last_per_key


def asof_backward(
    probes: DataFrame,
    snaps: DataFrame,
    key: str,
    at: str,
    snap_at: str,
    values: list[str],
    lag_days: int = 0,
    tolerance_days: int | None = None,
) -> DataFrame:
    """One probe per key: newest snapshot on or before `at - lag_days`, at most `tolerance_days` older than that."""
    bound = F.date_sub(F.col("_t"), lag_days)
    side = snaps.select(key, F.col(snap_at).alias("_s"), *values)
    hit = side.join(probes.select(key, F.col(at).alias("_t")), key).filter(F.col("_s") <= bound)
    best = hit.groupBy(key).agg(
        F.max("_s").alias(f"{snap_at}_found"), F.max("_t").alias("_t"), F.max_by(F.struct(*values), "_s").alias("_v")
    )
    if tolerance_days is not None:
        best = best.filter(F.datediff(F.date_sub("_t", lag_days), f"{snap_at}_found") <= tolerance_days)
    return probes.join(best.select(key, f"{snap_at}_found", *[F.col(f"_v.{v}").alias(v) for v in values]), key, "left")


def asof_backward_many(
    probes: DataFrame, snaps: DataFrame, key: str, at: str, snap_at: str, values: list[str], bucket: str = "month"
) -> DataFrame:
    """Any number of probes per key: newest snapshot on or before each probe (unique snapshot dates per key)."""
    names = [c for c in probes.columns if c not in (key, at)]
    payload = F.struct(F.col(snap_at).alias("_s"), *values)
    left = probes.select(key, F.col(at).alias("_t"), F.lit(1).alias("_kind"), F.struct(F.lit(1).alias("_"), *names).alias("_p"))
    right = snaps.filter(F.col(snap_at).isNotNull()).select(
        key, F.col(snap_at).alias("_t"), F.lit(0).alias("_kind"), payload.alias("_v")
    )
    stacked = left.unionByName(right, allowMissingColumns=True).withColumn("_b", F.trunc("_t", bucket))
    inside = Window.partitionBy(key, "_b").orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    local = stacked.withColumn("_local", F.last("_v", ignorenulls=True).over(inside)).filter("_kind = 1")
    before = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    ends = stacked.groupBy(key, "_b").agg(F.expr("max_by(_v, _t) filter (where _kind = 0)").alias("_end"))
    carried = ends.withColumn("_carry", F.last("_end", ignorenulls=True).over(before)).select(key, "_b", "_carry")
    found = local.join(carried, [key, "_b"], "left").withColumn("_f", F.coalesce("_local", "_carry"))
    return found.select(
        key,
        F.col("_t").alias(at),
        *[F.col(f"_p.`{c}`").alias(c) for c in names],
        F.col("_f._s").alias(f"{snap_at}_found"),
        *[F.col(f"_f.`{v}`").alias(v) for v in values],
    )


def asof_step_back(
    probes: DataFrame,
    snaps: DataFrame,
    key: str,
    at: str,
    snap_at: str,
    values: list[str],
    stepped: str,
    valid: Column,
    steps: int = 2,
) -> DataFrame:
    """As `asof_backward`, but `stepped` is the first valid value among the newest `steps + 1` eligible rows."""
    side = snaps.select(key, F.col(snap_at).alias("_s"), *values, stepped)
    hit = side.join(probes.select(key, F.col(at).alias("_t")), key).filter(F.col("_s") <= F.col("_t"))
    w = Window.partitionBy(key).orderBy(F.col("_s").desc())
    near = hit.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= steps + 1)
    best = near.withColumn("_ok", valid).groupBy(key).agg(
        F.max("_s").alias(f"{snap_at}_found"),
        *[F.min_by(v, "_rn").alias(v) for v in values],
        F.expr(f"min_by(`{stepped}`, _rn) filter (where _ok)").alias(stepped),
    )
    return probes.join(best, key, "left")


def asof_nearest(
    probes: DataFrame, series: DataFrame, key: str, at: Column, series_at: str, value: str, tolerance_days: int = 180, name: str | None = None
) -> DataFrame:
    """Value at the date nearest to `at` on either side; equal distances take the earlier date."""
    t = probes.withColumn("_t", at)
    side = series.select(key, F.col(series_at).alias("_d"), F.col(value).alias("_v")).filter(F.col("_v").isNotNull())
    hit = side.join(t.select(key, "_t"), key).withColumn("_gap", F.abs(F.datediff("_d", "_t")))
    best = hit.filter(F.col("_gap") <= tolerance_days).groupBy(key).agg(F.min_by("_v", F.struct("_gap", "_d")).alias(name or value))
    return t.drop("_t").join(best, key, "left")


def range_sum(
    probes: DataFrame, events: DataFrame, key: str, at: str, event_at: str, value: str, windows: dict[str, tuple[Column, Column]]
) -> DataFrame:
    """Sum of events per probe and closed date window; NULL where the window holds none.

    All windows share one join and one aggregate; events outside the widest window never shuffle twice.
    """
    side = events.select(key, F.col(event_at).alias("_e"), F.col(value).alias("_v")).filter(F.col("_v").isNotNull())
    hit = side.join(probes.select(key, F.col(at).alias(at)), key)
    sums = [F.sum(F.when(F.col("_e").between(lo, hi), F.col("_v"))).alias(n) for n, (lo, hi) in windows.items()]
    return probes.join(hit.groupBy(key).agg(*sums), key, "left")


def dividend_windows(at: str) -> dict[str, tuple[Column, Column]]:
    """The trailing year before `at`, and the year that ended three and five years earlier."""
    t = F.col(at)
    ends = {"ttm": t, "ago_3y": F.add_months(t, -36), "ago_5y": F.add_months(t, -60)}
    return {n: (F.date_sub(e, 365), e) for n, e in ends.items()}


def range_signed_sum(
    probes: DataFrame,
    txns: DataFrame,
    key: str,
    at: str,
    txn_at: str,
    quantity: str,
    acq_disp: str,
    kind: str,
    days: int = 90,
    name: str = "net_shares",
) -> DataFrame:
    """Net signed quantity in (at - days, at]; rows without any sign give 0, no rows give NULL."""
    side = txns.select(key, F.col(txn_at).alias("_e"), (txn_sign(acq_disp, kind) * F.col(quantity)).alias("_q"))
    hit = side.join(probes.select(key, at), key).filter((F.col("_e") > F.date_sub(at, days)) & (F.col("_e") <= F.col(at)))
    net = hit.groupBy(key).agg(F.coalesce(F.sum("_q"), F.lit(0.0)).alias(name))
    return probes.join(net, key, "left")


def next_or_previous_event(probes: DataFrame, events: DataFrame, key: str, at: str, event_at: str, name: str = "event_date") -> DataFrame:
    """Earliest event after `at`, else the latest on or before it."""
    hit = events.select(key, F.col(event_at).alias("_e")).join(probes.select(key, at), key)
    best = hit.groupBy(key).agg(
        F.coalesce(F.min(F.when(F.col("_e") > F.col(at), F.col("_e"))), F.max(F.when(F.col("_e") <= F.col(at), F.col("_e")))).alias(name)
    )
    return probes.join(best, key, "left")


def fill_from_side_table(
    rows: DataFrame, side: DataFrame, key: str, on: list[str], value: str, threshold: float, side_order: list[str]
) -> DataFrame:
    """Fill NULLs of `value` from a side table, for keys whose missing share reaches the threshold.

    Of several side rows for one place the last in `side_order` counts. The gate is one row per key from a partial
    aggregate.
    """
    gate = rows.groupBy(key).agg((F.avg(F.col(value).isNull().cast("int")) >= threshold).alias("_gate"))
    fill = last_per_key(side, on, side_order).select(*on, F.col(value).alias("_fill"))
    return (
        rows.join(gate, key, "left")
        .join(fill, on, "left")
        .withColumn(value, F.coalesce(F.col(value), F.when(F.col("_gate"), F.col("_fill"))))
        .drop("_gate", "_fill")
    )


def priority_lookup(rows: DataFrame, variants: Column, lookup: DataFrame, lookup_key: str, value: str, row_id: list[str]) -> DataFrame:
    """First variant of each row that the lookup knows; rows without a match keep NULL.

    The variants explode to at most six short rows per input row and meet the lookup in one equi-join.
    """
    ex = rows.select(*row_id, F.posexplode(variants).alias("_pos", "_variant"))
    hit = ex.join(lookup.select(F.col(lookup_key).alias("_variant"), value), "_variant")
    best = hit.groupBy(*row_id).agg(F.min_by(value, "_pos").alias(value))
    return rows.join(best, row_id, "left")


def replicate_shared_key(names: DataFrame, per_key: DataFrame, key: str, order: str, strategy: str = "copy") -> DataFrame:
    """Results computed once per shared key, given to every name on it (`copy`, `allow`) or to the first (`skip`)."""
    if strategy == "skip":
        w = Window.partitionBy(key).orderBy(order)
        names = names.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    return names.join(per_key, key)


def aligned_returns(stock: DataFrame, market: DataFrame, on: str, s: str = "ret", m: str = "ret") -> DataFrame:
    """Stock and market returns on common dates. The market side is one row per date; Spark checks its size."""
    mk = market.select(on, F.col(m).alias("mkt_ret"))
    return stock.withColumnRenamed(s, "stock_ret").join(mk, on).filter(F.col("stock_ret").isNotNull() & F.col("mkt_ret").isNotNull())


def calendar_consistency(calendar: DataFrame, events: DataFrame, key: str, cal_date: str, event_date: str, pos: str) -> DataFrame:
    """Per key: first calendar date against first event date."""
    c = calendar.groupBy(key).agg(F.min_by(cal_date, pos).alias("calendar_date"))
    e = events.filter(F.col(event_date).isNotNull()).groupBy(key).agg(F.min_by(event_date, pos).alias("ex_date"))
    status = (
        F.when(F.col("calendar_date").isNull(), F.lit("MISSING_CALENDAR"))
        .when(F.col("ex_date").isNull(), F.lit("MISSING_EXDATE"))
        .when(F.col("calendar_date") == F.col("ex_date"), F.lit("MATCH"))
        .otherwise(F.lit("MISMATCH"))
    )
    return c.join(e, key, "full").withColumn("status", status)


def feature_assembly(base: DataFrame, features: list[DataFrame], key: str) -> DataFrame:
    """Left join of keyed feature sets to the base rows; every side is unique on the key."""
    out = base
    for f in features:
        out = out.join(f, key, "left")
    return out


__all__ = [n for n in dir() if not n.startswith("_") and n not in ("annotations", "col")]
