"""Sorting, limits and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sort_by_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Total order by key: a range exchange, so the sort itself is distributed."""
    return df.orderBy(*keys)


def top_k(df: DataFrame, by: list[Column], k: int) -> DataFrame:
    """Report of the first k rows (take-ordered: each task keeps only k)."""
    return df.orderBy(*by).limit(k)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def intersect_keys(universe: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    return universe.join(wanted.select(key).distinct(), key, "left_semi")


def distinct_keep_order(values: Column | str) -> Column:
    """Array without duplicates, first occurrences in order."""
    return F.array_distinct(values)
