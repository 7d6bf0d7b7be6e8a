"""The dealt operators bound to the driver's tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarterdeck.llm import bpe, chat_format, collocations, decontamination, edit_fingerprints, lexical_search, line_dedup, near_dedup, pii, quality_rules, substring_dedup, suffix_dedup, toxicity
from quarterdeck.llm.registry import query, table

#: The public vocabulary files; on a cluster only the driver needs them.
TOKENIZERS = "/opt/tokenizers"


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_quality_rules", quality_rules.oracle_sql())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


@query("op3_pii")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"))


@query("op4_near_dedup", near_dedup.oracle_sql(85))
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.link(table(spark, sf_dir, "documents"), percent=85).drop("n_links")


@query("op5_decontamination")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_line_dedup", line_dedup.ORACLE)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(table(spark, sf_dir, "documents"))


@query("op7_suffix_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove(table(spark, sf_dir, "documents")).drop("kept")


@query("op8_chat_format", chat_format.ORACLE)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = spark.createDataFrame([(-7, 0, "user", chat_format.PLANTED), (-7, 1, "assistant", chat_format.PLANTED)], "conv_id long, turn long, role string, text string")
    return chat_format.digests(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted))


@query("op9_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json")


@query("op10_substring_dedup", substring_dedup.ORACLE)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove(table(spark, sf_dir, "documents")).drop("kept")


@query("op11_edit_fingerprints")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_fingerprints.compare_edits(table(spark, sf_dir, "documents"))


@query("op12_collocations", collocations.ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


@query("op13_lexical_search", lexical_search.ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
