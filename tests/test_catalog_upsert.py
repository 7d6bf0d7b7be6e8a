"""Upserts of catalog tables: merged rows, readers during a publish, removal of old folders."""

import threading

from pyspark.sql import functions as F

from quarterdeck.schemas import TABLES
from quarterdeck.sinks import catalog_upsert as C



def _part():
    return {"month": F.date_format(F.trunc("date", "month"), "yyyy-MM")}


def _px(rows, *data):
    return rows("symbol string, date date, close double, n int", *data)


def _stored(spark, name):
    return {(r.symbol, str(r.date)): r.close for r in spark.table(name).collect()}


def test_partitions_are_switched(spark, rows, tmp_path):
    name, root = "px_parts", str(tmp_path / "px")
    up = lambda new: C.upsert_table(spark, name, root, new, TABLES["prices_eod"], pos=["n"], partition_by=_part())
    try:
        up(_px(rows, ("A", "2024-01-02", 1.0, 1), ("A", "2024-01-02", 2.0, 2), ("A", "2024-02-01", 3.0, 1), ("B", None, 9.0, 1)))
        assert _stored(spark, name) == {("A", "2024-01-02"): 2.0, ("A", "2024-02-01"): 3.0, ("B", "None"): 9.0}
        before = set(C.locations(spark, name))
        up(_px(rows, ("A", "2024-02-02", 4.0, 1), ("A", "2024-02-01", 5.0, 1), ("B", None, 8.0, 1), ("A", "2024-03-01", 6.0, 1)))
        want = {("A", "2024-01-02"): 2.0, ("A", "2024-02-01"): 5.0, ("A", "2024-02-02"): 4.0, ("B", "None"): 8.0, ("A", "2024-03-01"): 6.0}
        assert _stored(spark, name) == want
        assert len(before & set(C.locations(spark, name))) == 1  # only January stays where it was
        up(_px(rows).limit(0))
        assert C.remove_unused(spark, name, root) == 0  # too young
        assert C.remove_unused(spark, name, root, older_than_ms=-60_000) >= 2
        spark.catalog.refreshTable(name)
        assert _stored(spark, name) == want
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_whole_tables_are_switched(spark, rows, tmp_path):
    name, root = "px_whole", str(tmp_path / "px")
    up = lambda new: C.upsert_table(spark, name, root, new, TABLES["prices_eod"], pos=["n"])
    try:
        up(_px(rows, ("A", "2024-01-02", 1.0, 1)))
        up(_px(rows, ("A", "2024-01-02", 2.0, 1), ("B", "2024-01-02", 3.0, 1)))
        assert _stored(spark, name) == {("A", "2024-01-02"): 2.0, ("B", "2024-01-02"): 3.0}
        assert C.remove_unused(spark, name, root, older_than_ms=-60_000) == 1
        assert _stored(spark, name) == {("A", "2024-01-02"): 2.0, ("B", "2024-01-02"): 3.0}
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_readers_go_on_during_a_publish(spark, rows, tmp_path):
    name, root = "px_read", str(tmp_path / "px")
    up = lambda v: C.upsert_table(spark, name, root, _px(rows, *[("A", f"2024-0{m}-02", v, 1) for m in range(1, 5)]), TABLES["prices_eod"], pos=["n"], partition_by=_part())
    errors, counts, stop = [], [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                counts.append(spark.table(name).count())
            except Exception as e:  # noqa: BLE001
                errors.append(e)

    try:
        up(0.0)
        planned = spark.table(name)
        planned.collect()
        reader = threading.Thread(target=read)
        reader.start()
        for v in range(1, 5):
            up(float(v))
        stop.set()
        reader.join()
        assert not errors and set(counts) == {4} and len(counts) > 3
        assert {r.close for r in planned.collect()} <= {0.0, 4.0}
        assert set(_stored(spark, name).values()) == {4.0}
    finally:
        stop.set()
        spark.sql(f"DROP TABLE IF EXISTS {name}")
