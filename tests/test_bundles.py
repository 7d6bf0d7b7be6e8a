"""Feeds landed in bundles."""

import json

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from quarterdeck.catalog import bindings as B
from quarterdeck.plans import modes
from quarterdeck.sources.payloads import GROUP_ROWS, read_payload_bundles

SMALL = "/root/testdata/sf0.001"


def test_bundles_read_like_single_files(spark, tmp_path):
    """One folder of files for all symbols, chunks in order, other symbols left out before a body is parsed (F1 to F3, F6, F7)."""
    at = tmp_path / "landed"
    lines = B.lines(spark, SMALL)
    for n in (1, 2):
        B.land(lines, f"{at}/targets.bundles/chunk={n}", F.to_json(F.struct((F.col("l_quantity") * n).alias("targetConsensus"))))
    files = [p for p in at.rglob("*.parquet")]
    assert 0 < len(files) <= 2 * 8  # not one for each of the symbols
    (at / "targets").mkdir()
    (at / "targets" / "S1.json").write_text(json.dumps([{"targetConsensus": 7}]), encoding="utf-8")
    u = spark.createDataFrame([("S1",), ("S2",)], "symbol string")
    rows = modes.Load(spark, str(at), str(tmp_path / "t"), u, "2024-02-01").feed("targets").select("symbol", "at", F.col("r")["targetConsensus"].alias("v")).collect()
    assert {r.symbol for r in rows} == {"S1", "S2"} and "7" in {r.v for r in rows}
    want = [r.l_quantity * n for n in (1, 2) for r in lines.filter("symbol = 'S2'").orderBy(*B.ORDER).collect()]
    assert [float(r.v) for r in sorted((r for r in rows if r.symbol == "S2"), key=lambda r: (r["at"].file, r["at"].pos))] == want
    assert read_payload_bundles(spark, str(at / "nothing")).collect() == []


def test_bundles_are_written_in_small_row_groups(spark, tmp_path):
    """A task decodes up to 4,096 rows of a row group at once: of large bodies that was more than an executor has."""
    rows = spark.range(300).select(F.concat(F.lit("S"), F.col("id").cast("string")).alias("symbol"), F.lit("2001-01-01").alias("date"), F.col("id").alias("at"))
    B.land(rows.coalesce(1), f"{tmp_path}/feed.bundles", F.to_json(F.struct("date")), order=["at"])
    groups = [m.row_group(i).num_rows for p in tmp_path.glob("feed.bundles/*.parquet") for m in [pq.ParquetFile(p).metadata] for i in range(m.num_row_groups)]
    assert sum(groups) == 300 and max(groups) <= GROUP_ROWS
    got = read_payload_bundles(spark, f"{tmp_path}/feed.bundles")
    assert got.count() == 300 and got.select("symbol").distinct().count() == 300
