"""Grouped aggregates over fundamentals, snapshots and data quality.

Trailing blocks count rows, not quarters: two periods on one fiscal date count twice.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarterdeck.functions import fixed
from quarterdeck.functions.scalars import safe_div
from quarterdeck.operators.joins import asof_backward, asof_nearest
from quarterdeck.operators.series import beta_of, rolling_ttm_ratio, top_n_per_key
from quarterdeck.schemas import q
from quarterdeck.sources.tables import path_exists

FLOW_SUMS = [
    "netIncome", "revenue", "EBITDA", "freeCashFlow", "operatingCashFlow", "dividendsPaid",
    "operatingIncome", "incomeBeforeTax", "incomeTaxExpense", "grossProfit",
]


def latest_date(df: DataFrame, key: str = "symbol", date: str = "date") -> DataFrame:
    return df.groupBy(key).agg(F.max(date).alias(date))


def latest_composite_row(df: DataFrame, key: str, date: str, values: list[str], ties: list[str] | None = None) -> DataFrame:
    """Newest non-NULL value of each column per key, so one output row may mix several input rows."""
    order = "struct({})".format(", ".join(q(c) for c in [date, *(ties or [])])) if ties else q(date)
    picks = [F.expr(f"max_by({q(v)}, {order}) filter (where {q(v)} is not null)").alias(v) for v in values]
    return df.groupBy(key).agg(F.max(date).alias(date), *picks)


def newest(df: DataFrame, key: str, date: str, n: int, ties: list[str] | None = None) -> DataFrame:
    """Newest `n` rows per key with their rank `rn`."""
    return top_n_per_key(df, key, [F.col(c).desc() for c in [date, *(ties or [])]], n)


def nth_row(df: DataFrame, key: str, date: str, n: int = 2, ties: list[str] | None = None) -> DataFrame:
    """The n-th newest row as it stands, NULLs included."""
    return newest(df, key, date, n, ties).filter(F.col("rn") == n).drop("rn")


def _block(c: Column | str, low: int, high: int) -> Column:
    return F.when(F.col("rn").between(low, high), F.col(c) if isinstance(c, str) else c)


def ttm_block(fin: DataFrame, key: str = "symbol", date: str = "fiscalDate", ties: list[str] | None = None) -> DataFrame:
    """Newest four rows: flows summed, diluted shares averaged, shares from the newest row; none below four rows."""
    g = newest(fin, key, date, 4, ties).groupBy(key)
    out = g.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(c).alias(c) for c in FLOW_SUMS],
        F.avg("weightedAverageSharesDiluted").alias("weightedAverageSharesDiluted"),
        F.max(F.when(F.col("rn") == 1, F.col("sharesOutstanding"))).alias("sharesOutstanding"),
    )
    return out.filter("_n = 4").drop("_n")


def ttm_yoy(
    fin: DataFrame, value: str, name: str, key: str = "symbol", date: str = "fiscalDate", positive_base: bool = True, ties: list[str] | None = None
) -> DataFrame:
    """Sum of rows 1-4 over rows 5-8, minus 1; all eight must exist; the base must be > 0 (or only != 0)."""
    g = newest(fin, key, date, 8, ties).groupBy(key).agg(
        F.count(_block(value, 1, 4)).alias("_c1"),
        F.count(_block(value, 5, 8)).alias("_c2"),
        F.sum(_block(value, 1, 4)).alias("_s1"),
        F.sum(_block(value, 5, 8)).alias("_s2"),
    )
    ok = F.col("_s2") > 0 if positive_base else F.col("_s2") != 0
    return g.filter((F.col("_c1") == 4) & (F.col("_c2") == 4) & ok).select(key, (F.col("_s1") / F.col("_s2") - 1.0).alias(name))


def ttm_ratio(
    fin: DataFrame, num: str, den: str, name: str, key: str = "symbol", date: str = "fiscalDate", ties: list[str] | None = None
) -> DataFrame:
    """Sum over four rows of `num` / the same of `den`; four values each, divisor not 0."""
    g = newest(fin, key, date, 4, ties).groupBy(key).agg(
        F.count(num).alias("_c1"), F.count(den).alias("_c2"), F.sum(num).alias("_s1"), F.sum(den).alias("_s2")
    )
    return g.filter("_c1 = 4 and _c2 = 4 and _s2 != 0").select(key, (F.col("_s1") / F.col("_s2")).alias(name))


def eps_yoy(fin: DataFrame, name: str = "eps_yoy", key: str = "symbol", date: str = "fiscalDate", ties: list[str] | None = None) -> DataFrame:
    """Newest trailing EPS against the one nearest to a year earlier."""
    series = rolling_ttm_ratio(fin, key, date, ties).filter(F.col("eps_ttm").isNotNull()).select(key, date, *(ties or []), "eps_ttm")
    order = F.struct(date, *(ties or []))
    last = series.groupBy(key).agg(F.max(date).alias("_last"), F.max_by("eps_ttm", order).alias("_now"))
    both = asof_nearest(last, series, key, F.date_sub("_last", 365), date, "eps_ttm", 180, "_ago")
    return both.filter("_ago != 0").select(key, (F.col("_now") / F.col("_ago") - 1.0).alias(name))


def interest_coverage(
    fin: DataFrame, interest: str | None = None, name: str = "interest_coverage", key: str = "symbol", date: str = "fiscalDate", ties: list[str] | None = None
) -> DataFrame:
    """Operating income / |interest| over four rows; without an interest column, operating minus pretax income."""
    g = newest(fin, key, date, 4, ties).groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("operatingIncome").alias("_oi"),
        F.sum(interest or "incomeBeforeTax").alias("_x"),
    )
    cost = F.col("_x") if interest else F.col("_oi") - F.col("_x")
    return g.filter("_n = 4").withColumn("_i", F.abs(cost)).filter("_i >= 1e-12").select(key, (F.col("_oi") / F.col("_i")).alias(name)).dropna()


def margin_volatility(
    fin: DataFrame,
    name: str = "margin_volatility",
    rows: int = 8,
    least: int = 4,
    key: str = "symbol",
    date: str = "fiscalDate",
    ties: list[str] | None = None,
) -> DataFrame:
    """Sample deviation of operating margin over the newest rows; at least four margins."""
    m = newest(fin, key, date, rows, ties).filter("revenue != 0").select(key, safe_div("operatingIncome", "revenue").alias("_m"))
    return m.groupBy(key).agg(F.count("_m").alias("_n"), F.stddev_samp("_m").alias(name)).filter(F.col("_n") >= least).drop("_n")


def share_dilution_features(probes: DataFrame, shares: DataFrame, key: str, at: str, snap_at: str, value: str, name: str = "share_dilution") -> DataFrame:
    """Shares now over shares about a year ago (at most 120 days off), minus 1."""
    now = asof_backward(probes.select(key, at), shares, key, at, snap_at, [value]).select(key, F.col(value).alias("_now"))
    ago = asof_backward(probes.select(key, at), shares, key, at, snap_at, [value], 365, 120).select(key, F.col(value).alias("_ago"))
    return now.join(ago, key).filter("_ago != 0 and _now is not null").select(key, (F.col("_now") / F.col("_ago") - 1.0).alias(name))


def dedupe_max_then_sum(df: DataFrame, group: list[str], person: str, value: str) -> DataFrame:
    """Largest value per person, then the sum per group; rows without a person are left out."""
    top = df.filter(F.col(person).isNotNull() & F.col(value).isNotNull()).groupBy(*group, person).agg(F.max(value).alias(value))
    return top.groupBy(*group).agg(F.sum(value).alias(value))


def beta_from_returns(pairs: DataFrame, key: str, stock: str, market: str, least: int = 24, name: str = "beta") -> DataFrame:
    return pairs.groupBy(key).agg(beta_of(stock, market, least).alias(name))


def latest_membership(members: DataFrame, date: str = "asOfDate", key: str = "memberSymbol", flag: str = "isMember") -> DataFrame:
    """Members of the newest snapshot of all; the newest date is one row."""
    top = members.agg(F.max(date).alias(date))
    return members.join(F.broadcast(top), date).select(key, flag)


# ---- company facts --------------------------------------------------------------------------------------


def choose_anchor(facts: DataFrame, tags: list[str] | None = None) -> DataFrame:
    """Per company the anchor tag with the most distinct period ends; equal counts take the earlier tag."""
    tags = tags or fixed.ANCHOR_TAGS
    rank = F.array_position(F.array(*[F.lit(t) for t in tags]), F.col("tag"))
    ends = facts.filter(F.col("tag").isin(tags)).select("cik", "tag", "end").distinct()
    n = ends.groupBy("cik", "tag").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("cik").agg(F.max_by(F.struct("tag", "n"), F.struct("n", -rank)).alias("a")).select(
        "cik", F.col("a.tag").alias("anchor"), F.col("a.n").alias("n_ends")
    )


def build_slots(facts: DataFrame, n: int = fixed.SLOTS_OUT + fixed.SLOTS_BACKFILL, tags: list[str] | None = None) -> DataFrame:
    """Newest `n` period ends of each company's anchor, with the filing data of the first fact of each end."""
    tags = tags or fixed.ANCHOR_TAGS
    cols = ["accn", "form", "filed", "fp", "fy"]
    firsts = (
        facts.filter(F.col("tag").isin(tags))
        .groupBy("cik", "tag", "end")
        .agg(F.min_by(F.struct(*cols), F.struct("doc_pos", "src_pos")).alias("m"))
    )
    # `firsts` has one row per (company, tag, end), so the anchor choice reuses it and facts are scanned once.
    anchor = choose_anchor(firsts, tags)
    ends = firsts.join(anchor.select("cik", F.col("anchor").alias("tag")), ["cik", "tag"])
    w = Window.partitionBy("cik").orderBy(F.col("end").desc())
    ranked = ends.withColumn("slot", F.row_number().over(w)).filter(F.col("slot") <= n)
    return ranked.select("cik", "slot", "end", *[F.col(f"m.{c}").alias(c) for c in cols])


def chosen_tag(selected: DataFrame) -> DataFrame:
    """Most frequent tag per company and metric; equal counts take the alphabetically first tag."""
    n = selected.filter(F.col("tag").isNotNull()).groupBy("cik", "metric", "tag").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("cik", "metric").orderBy(F.col("n").desc(), "tag")
    return n.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


# ---- data quality ------------------------------------------------------------------------------------------


def missing_rate(df: DataFrame, value: str, key: str = "symbol", date: str = "date") -> DataFrame:
    """NULL share overall and at the newest date, one row."""
    miss = F.col(value).isNull().cast("int")
    by_day = df.groupBy(date).agg(F.count(F.lit(1)).alias("n"), F.sum(miss).alias("m"))
    return by_day.agg(
        (F.sum("m") / F.sum("n")).alias("missing_rate"),
        F.max_by(F.col("m") / F.col("n"), date).alias("missing_rate_latest"),
        F.max(date).alias("latest"),
    )


def missing_by_key(df: DataFrame, value: str, key: str = "symbol", top: int = fixed.ADJ_WARN_TOP, warn: float = fixed.ADJ_WARN_MISSING) -> DataFrame:
    """Keys with the highest missing share, only when the overall share passes the limit."""
    by = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(value).isNull().cast("int")).alias("m"))
    rate = by.agg((F.sum("m") / F.sum("n")).alias("_all"))
    return (
        by.join(F.broadcast(rate), F.col("_all") > warn)
        .select(key, (F.col("m") / F.col("n")).alias("missing_rate"))
        .orderBy(F.col("missing_rate").desc(), key)
        .limit(top)
    )


def freshness(df: DataFrame, date: str, today: Column, stale_days: int = fixed.STALE_DAYS) -> DataFrame:
    by_day = df.groupBy(date).agg(F.count(F.lit(1)).alias("n"))
    g = by_day.agg(
        F.min(date).alias("min_date"), F.max(date).alias("max_date"), F.sum("n").alias("n_rows"), F.max_by("n", date).alias("n_latest")
    )
    lag = F.datediff(today, F.col("max_date"))
    return g.withColumn("lag_days", lag).withColumn("stale", lag > stale_days)


def day_profile(df: DataFrame, date: str, checks: dict[str, Column]) -> DataFrame:
    """One row per day: `day`, `n_rows` and how many rows meet each check. Profiles of different days are merged by a union."""
    met = [F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in checks.items()]
    return df.groupBy(F.col(date).alias("day")).agg(F.count(F.lit(1)).alias("n_rows"), *met)


def table_counts(tables: dict[str, DataFrame | None]) -> DataFrame:
    """Rows per table; None stands for an absent table (0)."""
    parts = []
    some = next(d for d in tables.values() if d is not None)
    for name, df in tables.items():
        n = F.count(F.lit(1)) if df is not None else F.lit(0).cast("long")
        src = df if df is not None else some.limit(0)
        parts.append(src.agg((n if df is not None else F.count(F.lit(1))).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def stored_counts(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """Rows per stored table of `folder`: 0 for an absent one, -1 for one that cannot be read.

    A count without columns reads Parquet footers, no data pages. The names are few, so one small job each is enough to
    tell which table is broken.
    """
    counts = []
    for name in names:
        path = f"{folder}/{name}.parquet"
        if not path_exists(spark, path):
            counts.append((name, 0))
            continue
        try:
            counts.append((name, spark.read.parquet(path).count()))
        except (PySparkException, Py4JJavaError):
            counts.append((name, -1))
    return spark.createDataFrame(counts, "table_name string, n_rows long")


def coverage_profile(df: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """Non-NULL count per column, rows and distinct keys, as one row."""
    n_keys = F.count_distinct(F.struct(*[F.col(q(k)) for k in keys])).alias("n_keys")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), n_keys, *[F.count(q(c)).alias(c) for c in columns])


def value_counts(df: DataFrame, value: str, top: int = 10) -> DataFrame:
    return df.groupBy(value).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), value).limit(top)


def consistency_profile(df: DataFrame, revenue: str, gross_profit: str) -> DataFrame:
    r, g = F.col(revenue), F.col(gross_profit)
    return df.agg(
        F.count(F.when(r == 0, 1)).alias("revenue_zero"),
        F.count(F.when(r.isNull(), 1)).alias("revenue_missing"),
        F.count(F.when(g > r, 1)).alias("gross_profit_above_revenue"),
    )


def consistency_examples(df: DataFrame, revenue: str, gross_profit: str, keys: list[str], n: int = 5) -> DataFrame:
    return df.filter(F.col(gross_profit) > F.col(revenue)).select(*keys, revenue, gross_profit).orderBy(*keys).limit(n)


def tag_candidate_profile(facts: DataFrame, per_tag: int = 8, rows: int = 40) -> DataFrame:
    """Newest USD facts of every interest-like tag of a company: eight per tag, forty per company."""
    known = fixed.INTEREST_PNL_TAGS + fixed.INTEREST_CASH_TAGS
    like = F.col("tag").isin(known) | F.lower("tag").contains("interest")
    base = facts.filter((F.col("ns") == fixed.NAMESPACES[0]) & like & (F.lower(F.trim("unit")) == "usd"))
    rank = F.array_position(F.array(*[F.lit(t) for t in known]), F.col("tag"))
    base = base.withColumn("_rank", F.when(rank > 0, rank).otherwise(len(known) + 1))
    w = Window.partitionBy("cik", "tag").orderBy(F.col("end").desc(), "doc_pos", "src_pos")
    top = base.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= per_tag)
    w_all = Window.partitionBy("cik").orderBy("_rank", "tag", "rn")
    return top.withColumn("_all", F.row_number().over(w_all)).filter(F.col("_all") <= rows).drop("_rank", "_all")


def tag_units(facts: DataFrame) -> DataFrame:
    """Units under which each interest-like tag is reported."""
    like = F.lower("tag").contains("interest")
    return facts.filter(like).groupBy("cik", "tag").agg(F.sort_array(F.collect_set("unit")).alias("units"))


def distinct_symbols(df: DataFrame, symbol: Column) -> DataFrame:
    return df.select(symbol.alias("symbol")).filter(F.col("symbol") != "").distinct()
