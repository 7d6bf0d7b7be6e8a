"""Lossless prefilter before a join: a bitmap of the wanted keys, broadcast, so that other rows are not shuffled.

The bitmap has about sixteen bits per wanted key and `MOST_BITS` (128 MB) at most; that bounds what is broadcast.
Past it more rows pass and none is lost, as a flag may be set for a key that isn't wanted but never the other way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_BITS = 1 << 30
_BUCKET = 1 << 15


def flagged(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """`rows` with `_flag`: false only if the row's keys are not in `wanted`, which should be stored or cheap to count."""
    size = max(_BUCKET, min(MOST_BITS, 1 << (16 * max(1, wanted.count()) - 1).bit_length()))
    at = F.pmod(F.xxhash64(*keys), F.lit(size))
    bits = wanted.select(at.alias("_at")).groupBy(F.floor(F.col("_at") / _BUCKET).alias("_bucket")).agg(F.bitmap_construct_agg(F.col("_at") % _BUCKET).alias("_bits"))
    marked = rows.withColumns({"_bucket": F.floor(at / _BUCKET), "_bit": (at % _BUCKET).cast("int")}).join(F.broadcast(bits), "_bucket", "left")
    byte = F.expr("cast(conv(hex(substring(_bits, cast(floor(_bit / 8) as int) + 1, 1)), 16, 10) as int)")
    test = byte.bitwiseAND(F.expr("cast(pow(2, _bit % 8) as int)")) != 0
    return marked.withColumn("_flag", F.coalesce(test, F.lit(False))).drop("_bucket", "_bit", "_bits")


def only_flagged(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    return flagged(rows, wanted, keys).where("_flag").drop("_flag")
