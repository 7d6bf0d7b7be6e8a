"""Keyed upsert of catalog tables whose readers never find a table or a partition absent.

Data files are written once to a folder of their own and never renamed. A publish points the partition (or, without
partitions, the table) at the new folder by the catalog's own `SET LOCATION`; a query that was planned before
goes on reading the old files, which stay until `remove_unused` is called. The switch is a metastore entry, so it costs
the same on an object store, where a rename would be a copy.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterdeck.schemas import Table, q
from quarterdeck.sinks.upsert import _fs, _remove, merge_last_wins

#: Partition of rows whose partition expression is NULL.
NO_PART = "none"


def _create(spark: SparkSession, name: str, schema: T.StructType, location: str, part: str | None) -> None:
    cols = ", ".join(f"{q(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    by = f"PARTITIONED BY ({q(part)})" if part else ""
    cols += f", {q(part)} string" if part else ""
    spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet {by} LOCATION '{location}'")


def _text(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")


def upsert_table(spark: SparkSession, name: str, root: str, new: DataFrame, table: Table, *, pos: list[str], partition_by: dict[str, Column] | None = None) -> None:
    """Merge `new` by primary key into the external catalog table `name`, whose files lie below `root`.

    `pos` orders the rows of the batch: of one key the last row is stored. With `partition_by` (one name and one text
    expression over key columns) only the partitions that the batch touches are read and rewritten, and each switches on its own; rows with a NULL expression are in partition `none`.
    If a run stops before all have switched, the next call merges the rest again: the batch wins over itself. An empty batch changes nothing.
    """
    fresh = f"{root.rstrip('/')}/v-{uuid.uuid4().hex}"
    (part, expr), = (partition_by or {None: None}).items()
    exists = spark.catalog.tableExists(name)
    if not part:
        stored = spark.table(name) if exists else spark.createDataFrame([], table.schema)
        if new.isEmpty():
            return
        merge_last_wins(stored, new, table.key, table.schema, pos).write.parquet(fresh)
        if exists:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{fresh}'")
        else:
            _create(spark, name, table.schema, fresh, None)
        spark.catalog.refreshTable(name)
        return
    place = F.coalesce(expr, F.lit(NO_PART))
    touched = [r[0] for r in new.select(place.alias("p")).distinct().collect()]  # partitions of one batch
    if not touched:
        return
    if not exists:
        _create(spark, name, table.schema, f"{root.rstrip('/')}/v-first", part)
    base = spark.table(name).filter(F.col(part).isin(touched)).drop(part)
    merged = merge_last_wins(base, new, table.key, table.schema, pos).withColumn(part, place)
    merged.repartition(part, F.col(q(table.key[0]))).write.partitionBy(part).parquet(fresh)
    known = {r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    fs, at = _fs(spark, fresh)
    for f in fs.listStatus(at):
        if not f.isDirectory():
            continue
        value = f.getPath().getName().split("=", 1)[1]
        spec = f"PARTITION ({q(part)} = '{_text(value)}')"
        if value in known:
            spark.sql(f"ALTER TABLE {name} {spec} SET LOCATION '{f.getPath().toString()}'")
        else:
            spark.sql(f"ALTER TABLE {name} ADD {spec} LOCATION '{f.getPath().toString()}'")
    spark.catalog.refreshTable(name)


def locations(spark: SparkSession, name: str) -> list[str]:
    """Folders that the catalog names for the table's data."""
    def first(spec: str) -> str:
        # A partition's own place comes before that of the table.
        return next(r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name} {spec}").collect() if r.col_name == "Location")

    if not any(c.isPartition for c in spark.catalog.listColumns(name)):
        return [first("")]
    out = []
    for r in spark.sql(f"SHOW PARTITIONS {name}").collect():
        key, value = r[0].split("=", 1)
        out.append(first(f"PARTITION ({q(key)} = '{_text(value)}')"))
    return out


def remove_unused(spark: SparkSession, name: str, root: str, older_than_ms: int = 24 * 3600 * 1000) -> int:
    """Remove version folders below `root` (or their partitions) that the catalog no longer names and that are older than
    any query still running; returns how many folders went."""
    fs, at = _fs(spark, root)
    used = {spark._jvm.org.apache.hadoop.fs.Path(x).toUri().getPath() for x in locations(spark, name)}
    limit, gone = time.time() * 1000 - older_than_ms, 0
    for version in fs.listStatus(at):
        here = version.getPath().toUri().getPath()
        if not version.isDirectory() or here in used:
            continue
        parts = [f for f in fs.listStatus(version.getPath()) if f.isDirectory()]
        kept = [f for f in parts if f.getPath().toUri().getPath() in used or f.getModificationTime() > limit]
        if not kept and version.getModificationTime() <= limit:
            _remove(fs, version.getPath())
            gone += 1
            continue
        for f in parts:
            if f not in kept:
                _remove(fs, f.getPath())
                gone += 1
    return gone
