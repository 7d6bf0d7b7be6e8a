"""Training-text pipeline: five stages over `documents`, each written as Parquet and read again by the next.

Toxic documents go; repeated lines are cut out of the texts that are left; of each group of near copies the document
with the smallest id stays; documents that hold a benchmark item go; what stays is encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarterdeck.llm import bpe, decontamination, line_dedup, near_dedup, toxicity
from quarterdeck.llm.queries import TOKENIZERS
from quarterdeck.llm.registry import table
from quarterdeck.session import materialise


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not predict as toxic."""
    return toxicity.reject(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier line resembles; n_chars follows the text."""
    return line_dedup.remove(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return near_dedup.dedupe(docs, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the digests of ids and decoded text."""
    return bpe.encode(docs, f"{TOKENIZERS}/byte_bpe_50k.json").drop("decoded")


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("bpe", bpe_stage),
]

#: The classifier, the Hamming search and the merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
