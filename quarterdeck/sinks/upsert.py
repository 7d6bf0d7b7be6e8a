"""Keyed merge and upsert of declared tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quarterdeck.functions.scalars import pick_date
from quarterdeck.schemas import Table, conform, q
from quarterdeck.sources.tables import path_exists


def last_per_key(df: DataFrame, keys: list[str | Column], order: list[str | Column]) -> DataFrame:
    """The last row of each key in `order`; NULL keys are equal to each other.

    `row_number() = 1` lets Spark apply a window group limit before the shuffle: each task sends at most one
    row per key, so a key that holds a third of all rows costs no more than any other.
    """
    w = Window.partitionBy(*keys).orderBy(*[(F.col(o) if isinstance(o, str) else o).desc_nulls_last() for o in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def merge_last_wins(
    existing: DataFrame, new: DataFrame, key: list[str], schema: T.StructType | None = None, pos: list[str] | None = None
) -> DataFrame:
    """existing and new as one table with unique keys: new beats existing, a later row beats an earlier one.

    Columns that only the stored table has are kept (new rows get NULL there).
    """
    order = pos or []
    if schema is not None:
        declared = schema.fieldNames()
        extra = [f for f in existing.schema.fields if f.name not in declared and f.name not in order]
        full = T.StructType(list(schema.fields) + extra)
        e = conform(existing, full).select("*", *[F.lit(None).alias(p) for p in order])
        n = conform(new, full).select("*") if not order else new.select(
            *[c for c in _conformed(new, full)], *[F.col(p) for p in order]
        )
    else:
        e, n = existing, new
    both = e.withColumn("_src", F.lit(0)).unionByName(n.withColumn("_src", F.lit(1)), allowMissingColumns=True)
    return last_per_key(both, [q(k) for k in key], ["_src", *order]).drop("_src", *order)


def _conformed(df: DataFrame, schema: T.StructType) -> list[Column]:
    have = {c.lower(): c for c in df.columns}
    out = []
    for f in schema.fields:
        c = F.col(q(have[f.name.lower()])) if f.name.lower() in have else F.lit(None)
        c = c.try_cast(f.dataType)
        if isinstance(f.dataType, T.DoubleType):
            c = F.nullif(c, F.lit(float("nan")))
        out.append(c.alias(f.name))
    return out


def chunk_concat_dedupe(chunks: DataFrame, chunk: str = "chunk", key: list[str] | None = None, pos: list[str] | None = None) -> DataFrame:
    """Overlapping chunks of one series: a later chunk beats an earlier one on the same key."""
    return last_per_key(chunks, key or ["symbol", "date"], [chunk, *(pos or [])]).drop(chunk, *(pos or []))


def event_dedupe(events: DataFrame, key: list[str] | None = None, pos: list[str] | None = None) -> DataFrame:
    """Dividend events: last row per key, where missing payment dates are equal."""
    return last_per_key(events, key or ["symbol", "exDate", "paymentDate", "dividend"], pos or []).drop(*(pos or []))


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def staging(path: str, parts: bool = False) -> str:
    """Folder beside the table for finished rows: of the whole table, or of some of its partitions."""
    return path.rstrip("/") + ("__staging_parts" if parts else "__staging")


def _remove(fs, p) -> None:
    if fs.exists(p) and not fs.delete(p, True):
        raise OSError(f"could not remove {p}")


def _move(fs, src, dst) -> None:
    if not fs.rename(src, dst):
        raise OSError(f"could not publish {dst}")


def remove_table(spark: SparkSession, path: str) -> None:
    _remove(*_fs(spark, path))


def recover(spark: SparkSession, path: str) -> None:
    """Finish or forget what an interrupted publish of `path` left behind.

    A staging folder with its success marker holds complete merged rows: it is published again from where it
    stopped. One without the marker is a failed write and goes. An older layout kept the previous version beside
    the table during a swap; it is put back if the table is absent.
    """
    fs, dst = _fs(spark, path)
    new = spark._jvm.org.apache.hadoop.fs.Path
    for parts in (False, True):
        if fs.exists(new(staging(path, parts) + "/_SUCCESS")):
            publish_staged(spark, path, parts)
        else:
            _remove(fs, new(staging(path, parts)))
    old = new(path.rstrip("/") + "__old")
    if fs.exists(old):
        if fs.exists(dst):
            _remove(fs, old)
        else:
            _move(fs, old, dst)


def publish_staged(spark: SparkSession, path: str, parts: bool = False) -> None:
    """Put the finished staging folder of `path` into its place.

    Every step can be repeated: the table or partition leaves the staging folder by the same rename that publishes
    it, so until then its rows are complete in one place, and the success marker of the partitions goes last.
    """
    fs, dst = _fs(spark, path)
    new = spark._jvm.org.apache.hadoop.fs.Path
    staged = new(staging(path, parts))
    if not parts:
        _remove(fs, dst)
        _move(fs, staged, dst)
        return
    for f in fs.listStatus(staged):
        if f.isDirectory():
            at = new(dst, f.getPath().getName())
            _remove(fs, at)
            _move(fs, f.getPath(), at)
    _remove(fs, staged)


def upsert(
    spark: SparkSession,
    path: str,
    new: DataFrame,
    table: Table,
    *,
    pos: list[str],
    keep_on_empty: bool = False,
    partition_by: dict[str, Column] | None = None,
) -> None:
    """Merge `new` into the stored table by primary key and publish the result.

    `pos` orders the rows of the batch: of one key the last row is stored. Without partitions the whole table is
    merged; with `partition_by` (one name and one expression over key columns, such as the month of the date) only
    the partitions that the batch touches are read and rewritten, the one of NULL included, so a daily batch against
    a table of many years stays small. A stored table without these partitions is rewritten once. Files of a partition are
    sorted by the key. The merged rows are staged and then moved; `recover` finishes an interrupted
    move at the next call.
    """
    recover(spark, path)
    if keep_on_empty and new.isEmpty():
        return
    exists = path_exists(spark, path)
    stored = spark.read.parquet(path) if exists else spark.createDataFrame([], table.schema)
    if not partition_by:
        merge_last_wins(stored, new, table.key, table.schema, pos).write.parquet(staging(path))
        publish_staged(spark, path)
        return
    (part, expr), = partition_by.items()
    split = exists and part in stored.columns
    base = stored.drop(part) if part in stored.columns else stored
    if split:
        # `part` is the folder name, so the semi join prunes the stored partitions at run time.
        touched = new.select(expr.alias("_touched")).distinct()
        base = stored.join(touched, F.col(part).eqNullSafe(F.col("_touched")), "left_semi").drop(part)
    merged = merge_last_wins(base, new, table.key, table.schema, pos).withColumn(part, expr)
    keys = [F.col(q(k)) for k in table.key]
    merged.repartition(part, keys[0]).sortWithinPartitions(part, *keys).write.partitionBy(part).parquet(staging(path, split))
    publish_staged(spark, path, split)


# ---- incremental loads --------------------------------------------------------------------------------------


def high_watermark(df: DataFrame, key: str | None, date: str) -> DataFrame:
    """Newest stored date per key, or one global row when `key` is None."""
    g = df.filter(F.col(date).isNotNull())
    return (g.groupBy(key) if key else g).agg(F.max(date).alias("watermark"))


def incremental_slice(
    new: DataFrame,
    watermark: DataFrame,
    key: str,
    date: str,
    cutoff: str,
    target: Column | str,
    reread_days: int | None = None,
) -> DataFrame:
    """New rows that a run has to load: from the day after the watermark (or `reread_days` before it) to `target`.

    Keys without a watermark start at the cutoff. The watermark table holds one row per key; Spark broadcasts
    it when its measured size allows and shuffles both sides otherwise.
    """
    low = F.lit(cutoff).cast("date")
    step = F.date_add("watermark", 1) if reread_days is None else F.date_sub("watermark", reread_days)
    high = F.lit(target).cast("date") if isinstance(target, str) else target
    rows = new.filter((F.col(date) >= low) & (F.col(date) <= high))
    start = F.greatest(F.coalesce(step, low), low)
    return rows.join(watermark, key, "left").filter(F.col(date) >= start).drop("watermark")


def newer_than_stored(new: DataFrame, stored: DataFrame, key: list[str], stamp: str = "lastUpdated") -> DataFrame:
    """Rows whose update stamp is newer than the stored one; a blank stamp on either side keeps the row."""
    old = stored.select(*key, F.trim(F.col(stamp)).alias("_old"))
    n, o = F.trim(F.col(stamp)), F.col("_old")
    keep = o.isNull() | (o == "") | n.isNull() | (n > o)
    return new.join(old, key, "left").filter(keep).drop("_old")


def hit_driven_keys(calendar: DataFrame, universe: DataFrame, as_of: Column, key: str = "symbol") -> DataFrame:
    """Keys to refresh: those with a calendar row, and on the first five days of a month all of them."""
    hits = universe.select(key).distinct().join(calendar.select(key).distinct(), key, "left_semi")
    everyone = universe.select(key).distinct().filter(F.dayofmonth(as_of) <= 5)
    return hits.union(everyone).distinct()


def filter_rows_by_date_range(rows: DataFrame, date_fields: list[Column], low: str, high: str) -> DataFrame:
    """Payload rows whose first non-blank date field lies in [low, high]."""
    return rows.filter(pick_date(*date_fields).between(F.lit(low).cast("date"), F.lit(high).cast("date")))
