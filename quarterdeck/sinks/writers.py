"""File sinks: Parquet with a CSV twin, null-preserving CSV, split outputs and lookup JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.functions.scalars import zero_repair
from quarterdeck.schemas import q


def write_pair(df: DataFrame, path: str) -> None:
    """Parquet and CSV of one frame. The CSV is made from the Parquet files, so the plan runs once."""
    df.write.mode("overwrite").parquet(f"{path}.parquet")
    df.sparkSession.read.parquet(f"{path}.parquet").write.mode("overwrite").option("header", True).csv(f"{path}.csv")


def write_csv_null_blank(
    df: DataFrame, path: str, columns: list[str], *, sanitise: bool = True, revenue: str = "Revenue", gross_profit: str = "GrossProfit"
) -> None:
    """CSV in which missing is blank and never 0; undeclared columns are left out, absent ones are blank."""
    if sanitise and {revenue, gross_profit} <= set(df.columns):
        df = df.withColumn(revenue, zero_repair(revenue, gross_profit))
    out = df.select(*[F.col(q(c)) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])
    out.write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def split_sink(df: DataFrame, path: str, by: str = "match_type") -> None:
    """One pass over the classified rows, one output folder per class."""
    df.withColumn("_out", F.when(F.col(by).isin("REJECT"), F.lit("universe_rejects")).when(
        F.col(by) == "AMBIGUOUS", F.lit("universe_ambiguous")
    ).otherwise(F.lit("universe_list"))).write.mode("overwrite").partitionBy("_out").parquet(path)


def lookup_json(df: DataFrame, key: str, values: list[str], pos: str) -> DataFrame:
    """One JSON line per key with its resolution; the last duplicate wins."""
    last = df.groupBy(key).agg(F.max_by(F.struct(*values), F.col(pos)).alias("v"))
    return last.select(F.to_json(F.map_from_arrays(F.array(key), F.array("v")), {"ignoreNullFields": "false"}).alias("value"))


def write_lookup_json(df: DataFrame, path: str, key: str, values: list[str], pos: str) -> None:
    lookup_json(df, key, values, pos).write.mode("overwrite").text(path)
