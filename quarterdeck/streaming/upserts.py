"""Streaming upsert of newly landed files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from quarterdeck.schemas import Table
from quarterdeck.sinks.upsert import last_per_key, upsert


def stream_upsert(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    table: Table,
    path: str,
    checkpoint: str,
    pos: list[str],
    shape: Callable[[DataFrame], DataFrame] = lambda d: d,
    partition_by: dict[str, Column] | None = None,
    file_format: str = "parquet",
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Consume the files that landed since the last run and merge them by primary key.

    The checkpoint remembers the files; the merge is idempotent, so a batch that is replayed after a failure
    leaves the same table. `available_now` ends when the backlog is done, which replaces a polling loop.
    """

    def merge(batch: DataFrame, _: int) -> None:
        rows = last_per_key(shape(batch), table.key, pos).persist()  # read by the emptiness test, the partitions and the merge
        try:
            upsert(spark, path, rows, table, pos=pos, keep_on_empty=True, partition_by=partition_by)
        finally:
            rows.unpersist()

    source = spark.readStream.schema(schema).format(file_format).option("maxFilesPerTrigger", files_per_batch).load(landing)
    return (
        source.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
