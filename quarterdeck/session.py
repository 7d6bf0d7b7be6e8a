"""Session builder and the shared working folder."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "quarterdeck", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Session with AQE, skew-join splitting and UTC. On a cluster the submit options win."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        # Local mode: the driver is the only executor, so it gets the memory.
        b = b.master(master).config("spark.ui.enabled", "false").config("spark.driver.memory", os.environ.get("LOCAL_MEMORY", "12g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


@functools.cache
def _local_dir() -> str:
    """One folder per process; the setting itself can't be changed in a running session."""
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp" if os.path.isdir("/tmp") else None)


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach: `spark.checkpoint.dir`.

    A local folder is made only where the setting is absent and the master is local, which is the test case; a
    cluster without the setting is an error, because executors do not share a machine's folders.
    """
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        return _local_dir()
    return conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once below the shared folder and read it back.

    Used where several consumers read one costly intermediate. The files outlive lost executors, so a retry
    re-reads them and does not recompute the lineage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
