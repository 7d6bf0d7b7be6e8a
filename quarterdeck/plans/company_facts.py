"""Company facts to slot-aligned quarterly metrics, and the same over a whole universe."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.functions import fixed
from quarterdeck.functions.scalars import exclude_non_company, pad_cik, ticker_variants, zero_repair
from quarterdeck.operators import aggregates as A
from quarterdeck.operators import xbrl as X
from quarterdeck.operators.formulas import balance_check, derived_metrics
from quarterdeck.operators.joins import priority_lookup
from quarterdeck.session import materialise
from quarterdeck.sinks.writers import write_csv_null_blank
from quarterdeck.sources.xbrl import explode_xbrl_facts

BASE = ["ticker", "cik", "name", "sector", "end", "fy", "fp", "form", "filed", "accn"]
CHECKS = ["balance_sheet_ok", "bs_diff_pct"]


def metric_columns() -> list[str]:
    return [*fixed.METRICS, *[f"{m}_Quarter" for m in fixed.METRICS]]


def used_tags() -> list[str]:
    """Tags that slots, metrics and the interest cascade read; the other facts of a document are never stored."""
    metrics = {t for groups in fixed.METRIC_TAGS.values() for g in groups for t in g}
    return sorted(metrics | {*fixed.ANCHOR_TAGS, *fixed.INTEREST_CONCEPT_TAGS})


def quarters(spark: SparkSession, facts: DataFrame, n_out: int = fixed.SLOTS_OUT) -> DataFrame:
    """Quarterly metrics of every company in `facts`: one row per (company, report period)."""
    slots = A.build_slots(facts, n_out + fixed.SLOTS_BACKFILL)
    picked = X.select_fact_for_slot(facts, slots, X.metrics_config(spark))
    wide = X.pivot_quarters(X.quarter_values(picked), slots, n_out=n_out)
    out = balance_check(derived_metrics(wide))
    return out.select("cik", "slot", *[c for c in BASE if c in out.columns and c != "cik"], *metric_columns(), *CHECKS)


def quarters_of_documents(spark: SparkSession, docs: DataFrame, body: str = "body", doc_pos: str | None = None, n_out: int = fixed.SLOTS_OUT) -> DataFrame:
    """As `quarters`, from JSON documents. The parsed facts are written once, since slots and selection both read them."""
    return quarters(spark, materialise(explode_xbrl_facts(docs, body, doc_pos, used_tags()), "facts"), n_out)


def traced_quarters(spark: SparkSession, facts: DataFrame, concepts: DataFrame | None = None, n_out: int = fixed.SLOTS_OUT) -> DataFrame:
    """As `quarters`, but long and with the origin of each value; interest expense comes from its full cascade.

    One row per (company, slot, metric): cik, slot, slot_end, metric, val, quarter_value, tag, accn, match_basis,
    interest_source, derived_source, contamination_flag, balance_sheet_ok, bs_diff_pct. `concepts` are records of single-concept documents,
    the last step of the cascade. The slots feed three consumers and are written once.
    """
    slots = materialise(A.build_slots(facts, n_out + fixed.SLOTS_BACKFILL), "slots")
    picked = X.with_interest(X.select_fact_for_slot(facts, slots, X.metrics_config(spark)), X.select_interest_for_slot(facts, slots, concepts))
    wide = balance_check(derived_metrics(X.pivot_quarters(X.quarter_values(picked, slots=slots), slots, n_out=n_out, origin=True)))
    return X.unpivot_origin(wide.withColumnRenamed("end", "slot_end"), ["cik", "slot", "slot_end", *CHECKS])


def resolve_companies(universe: DataFrame, ciks: DataFrame) -> DataFrame:
    """Universe lines (pos, ticker, name, sector) with exclusion reason and company id."""
    u = universe.withColumn("excluded", exclude_non_company("ticker", "name", "sector"))
    variants = F.when(F.col("excluded").isNull(), ticker_variants("ticker", "name"))
    return priority_lookup(u, variants, ciks.select(F.col("ticker").alias("listed"), "cik"), "listed", "cik", ["pos"])


def extraction_report(resolved: DataFrame, known: DataFrame, broken: DataFrame | None = None, strategy: str = "copy") -> DataFrame:
    """One row per universe line with the outcome. `known` lists companies whose facts parsed, `broken` those that failed.

    The first line of a company is `ok`, the later ones are duplicates; a failed company is never stored, so
    each of its lines reports the failure.
    """
    # Lines without a company id get a key of their own, so they don't meet in one task.
    r = resolved.withColumnRenamed("cik", "_cik").withColumn("cik", F.coalesce("_cik", F.concat(F.lit("none-"), F.col("pos"))))
    r = r.join(known.select("cik", F.lit(True).alias("_known")).distinct(), "cik", "left")
    if broken is not None:
        r = r.join(broken.select("cik", F.lit(True).alias("_broken")).distinct(), "cik", "left")
    else:
        r = r.withColumn("_broken", F.lit(None).cast("boolean"))
    firsts = r.filter(F.col("excluded").isNull() & F.col("_cik").isNotNull()).groupBy("cik").agg(F.min("pos").alias("_first"))
    r = r.join(firsts, "cik", "left").drop("cik").withColumnRenamed("_cik", "cik")
    again = {"skip": "duplicate_cik_skip", "copy": "duplicate_cik_copy", "allow": "duplicate_cik_allow_reuse"}[strategy]
    reason = (
        F.when(F.col("excluded").isNotNull(), F.col("excluded"))
        .when(F.col("cik").isNull(), F.lit("no_cik"))
        .when(F.col("_broken"), F.lit("parse_error"))
        .when(F.col("_known").isNull(), F.lit("fetch_error"))
        .when(F.col("pos") > F.col("_first"), F.lit(again))
        .otherwise(F.lit("ok"))
    )
    cik = F.when(F.col("excluded").isNull(), F.coalesce("cik", F.lit(""))).otherwise(F.lit(""))
    return r.select("pos", "ticker", "name", "sector", reason.alias("reason"), cik.alias("cik"))


def universe_rows(report: DataFrame, per_company: DataFrame) -> DataFrame:
    """Quarter rows of every line that is `ok` or a kept duplicate."""
    take = report.filter(F.col("reason").isin("ok", "duplicate_cik_copy", "duplicate_cik_allow_reuse"))
    out = take.select("pos", "ticker", "cik", "name", "sector").join(per_company, "cik")
    return out.withColumn("Revenue", zero_repair("Revenue", "GrossProfit"))


def outcome_counts(report: DataFrame) -> DataFrame:
    return report.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def document_ids(docs: DataFrame) -> DataFrame:
    """(cik, bad) of landed documents: whether the JSON is broken, and the company id.

    The id is the one in the document; a broken document takes it from the landed key (column `key`, such as a file
    name), since it cannot be read from the body: the digits after `CIK`, and in a key without these the first digits.
    """
    marked = F.nullif(F.regexp_extract(F.col("key"), r"(?i)CIK[^0-9]?(\d+)", 1), F.lit(""))
    key = F.coalesce(marked, F.regexp_extract(F.col("key"), r"(\d+)", 1)) if "key" in docs.columns else F.lit(None).cast("string")
    cik = F.coalesce(F.get_json_object("body", "$.cik"), F.nullif(key, F.lit("")))
    return docs.select(pad_cik(cik).alias("cik"), F.try_parse_json("body").isNull().alias("bad")).filter(F.col("cik").isNotNull())


def run(spark: SparkSession, universe: DataFrame, ciks: DataFrame, docs: DataFrame, out: str, strategy: str = "copy", n_out: int = fixed.SLOTS_OUT, report_only: bool = False) -> None:
    """Universe lines, ticker map and landed documents (body, and key for broken ones) to the report and the quarterly CSV.

    The report needs the ids of the documents and whether they parse; facts are made for the quarterly file alone.
    """
    names = resolve_companies(universe, ciks)
    ids = materialise(document_ids(docs), "documents")
    report = materialise(
        extraction_report(names, ids.filter(~F.col("bad")), ids.filter("bad"), strategy), "report"
    )
    write_csv_null_blank(report.orderBy("pos"), f"{out}/universe_extraction_report", ["ticker", "name", "reason", "cik", "error", "http_status", "last_err", "attempts_used"], sanitise=False)
    if not report_only:
        facts = materialise(explode_xbrl_facts(docs, tags=used_tags()), "facts")
        rows = universe_rows(report, quarters(spark, facts, n_out))
        write_csv_null_blank(rows.orderBy("pos", F.col("slot")), f"{out}/universe_metrics_quarterly", [*BASE, *metric_columns(), *CHECKS])

