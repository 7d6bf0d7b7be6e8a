"""Choice of one fact per (company, slot, metric) and the quarterly pivot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarterdeck.functions import fixed
from quarterdeck.functions.scalars import flow_period_ok, unit_matches
from quarterdeck.operators.series import decumulate

_FAR = 9999


def metrics_config(spark: SparkSession, metrics: dict[str, list[list[str]]] | None = None) -> DataFrame:
    """Tag table (metric, group_no, tag_rank, tag, unit, is_flow): about 120 rows, fixed in code."""
    rows = []
    for metric, groups in (metrics or fixed.METRIC_TAGS).items():
        units = sorted({u.strip().lower() for u in fixed.METRIC_UNITS.get(metric, ["USD"])})
        for g, tags in enumerate(groups):
            for r, tag in enumerate(tags):
                rows += [(metric, g, r, tag, u, metric not in fixed.STOCK_METRICS) for u in units]
    return spark.createDataFrame(rows, "metric string, group_no int, tag_rank int, tag string, _unit string, is_flow boolean")


def _filed_order(filed: Column, slot_filed: Column) -> tuple[Column, Column]:
    known = filed.isNotNull() & slot_filed.isNotNull()
    later = F.when(known & (filed > slot_filed), 1).otherwise(0)
    gap = F.when(known, F.abs(F.datediff(filed, slot_filed))).otherwise(_FAR)
    return later, gap


def _slot_side(slots: DataFrame) -> DataFrame:
    return slots.select("cik", "slot", F.col("end").alias("s_end"), *[F.col(c).alias(f"s_{c}") for c in ("accn", "fy", "fp", "filed")])


def _mismatch(a: Column, b: Column) -> Column:
    return F.when(F.coalesce(a == b, F.lit(False)), 0).otherwise(1)


def select_fact_for_slot(facts: DataFrame, slots: DataFrame, config: DataFrame) -> DataFrame:
    """One fact per (company, slot, metric), with how it was matched.

    Inside a tag group the slot's own filing comes first (`ACCN`), then any filing with the same period end
    (`END`); a later group counts only when both fail. The config has a fixed size and is broadcast. Facts
    meet slots on (company, end); every candidate then competes by one ordering, of which a window group limit
    keeps one row per task and group before the shuffle.
    """
    f = facts.withColumn("_unit", F.lower(F.trim("unit"))).join(F.broadcast(config), ["tag", "_unit"])
    s = _slot_side(slots)
    c = f.join(s, (f["cik"] == s["cik"]) & (f["end"] == s["s_end"])).drop(s["cik"])
    own = F.coalesce(F.trim("accn") == F.trim("s_accn"), F.lit(False)) & (~F.col("is_flow") | flow_period_ok("start", "end"))
    later, gap = _filed_order(F.col("filed"), F.col("s_filed"))
    c = c.withColumn("_own", own)

    def when_own(x: Column) -> Column:
        return F.when(F.col("_own"), x)

    order = [
        F.col("group_no"),
        (~F.col("_own")).cast("int"),
        when_own(F.col("tag_rank")),
        when_own(_mismatch(F.col("fy"), F.col("s_fy"))),
        when_own(_mismatch(F.upper("fp"), F.upper("s_fp"))),
        when_own(later),
        when_own(gap),
        F.col("accn").desc_nulls_last(),
        F.col("tag_rank"),
        F.col("doc_pos"),
        F.col("src_pos"),
    ]
    w = Window.partitionBy("cik", "slot", "metric").orderBy(*order)
    best = c.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
    return best.select(
        "cik", "slot", "metric", "end", "start", "val", "tag", "unit", "accn", "fy", "fp", "form", "filed", "frame",
        F.when(F.col("_own"), F.lit("ACCN")).otherwise(F.lit("END")).alias("match_basis"),
    )


def _interest_candidates(facts: DataFrame, slots: DataFrame) -> DataFrame:
    """Candidates of steps 1 to 6: own filing, same end, end within three days; P&L tags before cash-flow tags."""
    pnl, cash = fixed.INTEREST_PNL_TAGS, fixed.INTEREST_CASH_TAGS
    f = facts.filter(F.col("tag").isin(pnl + cash) & unit_matches("unit", ["USD"], ["shares"]))
    is_cash = F.col("tag").isin(cash)
    rank = F.when(is_cash, F.array_position(F.array(*[F.lit(t) for t in cash]), F.col("tag"))).otherwise(
        F.array_position(F.array(*[F.lit(t) for t in pnl]), F.col("tag"))
    )
    f = f.withColumn("_cash", is_cash.cast("int")).withColumn("_rank", rank)
    tol = fixed.INTEREST_TOLERANCE_DAYS
    s = _slot_side(slots)
    # Each slot lists the seven days around its end, so the tolerance join stays an equi-join.
    days = s.withColumn("end", F.explode(F.sequence(F.date_sub("s_end", tol), F.date_add("s_end", tol))))
    c = f.join(days, ["cik", "end"])
    dist = F.abs(F.datediff("end", "s_end"))
    own = (dist == 0) & F.coalesce(F.trim("accn") == F.trim("s_accn"), F.lit(False)) & flow_period_ok("start", "end")
    step = F.when(own, 0).when(dist == 0, 2).otherwise(4) + F.col("_cash")
    later, gap = _filed_order(F.col("filed"), F.col("s_filed"))
    o = own
    return c.select(
        "cik", "slot", "end", "start", "val", "tag", "accn", "fy", "fp", "form", "filed", "src_pos", "doc_pos",
        step.alias("step"),
        dist.alias("o1"),
        F.when(step >= 4, -F.length(F.coalesce("accn", F.lit("")))).otherwise(0).alias("o2"),
        F.when(o, F.col("_rank")).otherwise(0).alias("o3"),
        F.when(o, _mismatch(F.col("fy"), F.col("s_fy"))).otherwise(0).alias("o4"),
        F.when(o, _mismatch(F.upper("fp"), F.upper("s_fp"))).otherwise(0).alias("o5"),
        F.when(o, later).otherwise(0).alias("o6"),
        F.when(o, gap).otherwise(0).alias("o7"),
        F.when(step.isin(2, 3), F.col("accn")).alias("o_accn"),
        F.col("_rank").alias("o8"),
        F.when(F.col("_cash") == 1, F.lit("CFS")).otherwise(F.lit("PNL")).alias("interest_source"),
        F.when(step <= 1, F.lit("ACCN")).otherwise(F.lit("END")).alias("match_basis"),
    )


def select_concept_for_slot(
    records: DataFrame,
    slots: DataFrame,
    tolerance: int = fixed.CONCEPT_TOLERANCE_DAYS,
    max_age: int = fixed.CONCEPT_MAX_AGE_DAYS,
) -> DataFrame:
    """Concept record of each slot: nearest end within the tolerance, then filing and tag preferences."""
    reach = min(tolerance, max_age)
    s = _slot_side(slots)
    days = s.withColumn("end", F.explode(F.sequence(F.date_sub("s_end", reach), F.date_add("s_end", reach))))
    c = records.join(days, ["cik", "end"])
    known = F.col("filed").isNotNull() & F.col("s_filed").isNotNull()
    pnl = F.col("tag").isin(fixed.INTEREST_PNL_TAGS)
    order = [
        F.abs(F.datediff("end", "s_end")),
        _mismatch(F.trim("accn"), F.trim("s_accn")),
        F.when(known & (F.col("filed") <= F.col("s_filed")), 0).otherwise(1),
        F.when(known, F.abs(F.datediff("filed", "s_filed"))).otherwise(_FAR),
        F.when(F.upper("form").isin("10-Q", "10-K"), 0).otherwise(1),
        F.when(pnl, 0).otherwise(1),
        F.col("end").desc(),
        F.col("filed").desc_nulls_last(),
        F.col("accn").desc_nulls_last(),
        F.col("tag_rank"),
        F.col("src_pos"),
    ]
    w = Window.partitionBy("cik", "slot").orderBy(*order)
    best = c.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
    return best.select(
        "cik", "slot", "end", "start", "val", "tag", "accn", "fy", "fp", "form", "filed",
        F.when(pnl, F.lit("CONCEPT_PNL")).otherwise(F.lit("CONCEPT_CFO")).alias("interest_source"),
        F.lit("CONCEPT").alias("match_basis"),
    )


def select_interest_for_slot(facts: DataFrame, slots: DataFrame, concepts: DataFrame | None = None) -> DataFrame:
    """Interest expense per slot by cascade; slots that nothing fills stay with NULLs."""
    c = _interest_candidates(facts, slots)
    order = ["step", "o1", "o2", "o3", "o4", "o5", "o6", "o7", F.col("o_accn").desc_nulls_last(), "o8", "doc_pos", "src_pos"]
    w = Window.partitionBy("cik", "slot").orderBy(*order)
    best = c.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
    cols = ["cik", "slot", "end", "start", "val", "tag", "accn", "fy", "fp", "form", "filed", "interest_source", "match_basis"]
    found = best.select(*cols)
    if concepts is not None:
        rest = slots.join(found.select("cik", "slot"), ["cik", "slot"], "left_anti")
        found = found.unionByName(select_concept_for_slot(concepts, rest).select(*cols))
    return slots.select("cik", "slot", F.col("end").alias("slot_end")).join(found, ["cik", "slot"], "left")


def with_interest(selected: DataFrame, interest: DataFrame) -> DataFrame:
    """Selected facts with interest expense from its own cascade, and `interest_source` beside `match_basis`."""
    others = selected.filter(F.col("metric") != "InterestExpense").withColumn("interest_source", F.lit(None).cast("string"))
    found = interest.filter(F.col("match_basis").isNotNull()).drop("slot_end").withColumn("metric", F.lit("InterestExpense"))
    return others.unionByName(found, allowMissingColumns=True)


def quarter_values(selected: DataFrame, metrics: list[str] | None = None, slots: DataFrame | None = None) -> DataFrame:
    """Selected facts with the quarter value of the flow metrics.

    Facts of the interest cascade may end some days off their slot, and two slots may hold the same one; with `slots`
    a chain follows the slots' own ends.
    """
    flows = metrics or fixed.QUARTERISED_METRICS
    if slots is None:
        d = decumulate(selected, ["cik", "metric"])
    else:
        dated = selected.join(slots.select("cik", "slot", F.col("end").alias("slot_end")), ["cik", "slot"])
        d = decumulate(dated, ["cik", "metric"], order="slot_end").drop("slot_end")
    return d.withColumn("quarter_value", F.when(F.col("metric").isin(flows), F.col("quarter_value")))


#: What a value tells about its fact.
ORIGIN = ["tag", "accn", "match_basis", "interest_source"]


def pivot_quarters(
    values: DataFrame, slots: DataFrame, metrics: list[str] | None = None, n_out: int = fixed.SLOTS_OUT, origin: bool = False
) -> DataFrame:
    """One row per (company, slot) with every metric and its quarter value.

    The pivot is a plain aggregate over a fixed list of names: no extra job looks the names up. With `origin` the same
    aggregate also carries where each metric comes from: a map from its name to the `ORIGIN` fields, which has as
    many entries as there are metrics at most.
    """
    names = metrics or fixed.METRICS
    cells = []
    for m in names:
        here = F.col("metric") == m
        cells += [F.max(F.when(here, F.col("val"))).alias(m), F.max(F.when(here, F.col("quarter_value"))).alias(f"{m}_Quarter")]
    if origin:
        fields = F.struct(*[F.col(c) if c in values.columns else F.lit(None).cast("string").alias(c) for c in ORIGIN])
        cells.append(F.map_from_entries(F.collect_list(F.struct("metric", fields.alias("origin")))).alias("origin"))
    wide = values.filter(F.col("slot") <= n_out).groupBy("cik", "slot").agg(*cells)
    return slots.filter(F.col("slot") <= n_out).join(wide, ["cik", "slot"], "left")


def unpivot_origin(derived: DataFrame, keep: list[str], metrics: list[str] | None = None) -> DataFrame:
    """One row per (company, slot, metric) with its values and where they come from; `derived` has the columns of
    `pivot_quarters` with `origin` after `formulas.derived_metrics`.

    A value that its parts gave has a `derived_source` and no tag. Gross profit beside a missing or zero revenue has a
    `contamination_flag`. Metrics without any value are left out.
    """
    names = metrics or fixed.METRICS
    cells = []
    for m in names:
        at = F.col("origin")[m]
        made = F.lit(fixed.DERIVED_SOURCES[m]) if m in fixed.DERIVED_SOURCES else F.lit(None).cast("string")
        flag = F.when(F.col("contaminated"), F.lit(fixed.CONTAMINATION_FLAG)) if m == "GrossProfit" else F.lit(None).cast("string")
        cells.append(
            F.struct(
                F.lit(m).alias("metric"), F.col(m).alias("val"), F.col(f"{m}_Quarter").alias("quarter_value"), *[at[c].alias(c) for c in ORIGIN],
                F.when(at.isNull() & F.col(m).isNotNull(), made).alias("derived_source"), flag.alias("contamination_flag"),
            )
        )
    rows = derived.select(*keep, F.explode(F.array(*cells)).alias("m")).select(*keep, "m.*")
    return rows.filter(F.col("val").isNotNull() | F.col("quarter_value").isNotNull())
