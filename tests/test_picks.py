"""Picks of payload fields: compiled, and right on odd values."""

import re

from quarterdeck.catalog import load
from quarterdeck.functions import scalars as P

QUERIES, _ = load()
SMALL = "/root/testdata/sf0.001"


def test_picks_stay_small_enough_to_be_compiled(spark):
    """The JVM interprets methods of more than 8,000 bytes for ever (F9, F10, F16 to F18, F23)."""
    for name in ("N1_build_prices", "N9_build_dividends", "N10_build_dividends_from_calendar", "N12_build_earnings_from_calendar", "N17_insider_transactions"):
        df = QUERIES[name](spark, SMALL)
        df.collect()  # the final plan
        text = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$").__getattr__("MODULE$").codegenString(df._jdf.queryExecution().executedPlan())
        sizes = [int(s) for s in re.findall(r"maxMethodCodeSize:(\d+)", text)]
        assert sizes and max(sizes) < 8000, (name, sizes)


def test_picks_of_odd_values(spark):
    odd = [" 1.5 ", "\t", "", None, "1.", ".5", "1e3", "NaN", "Infinity", "1d", "1,5", "-", "0x1", "2\n", "١"]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in odd], "v string").select(P.pick_num("v")).collect()]
    assert got == [1.5, None, None, None, 1.0, 0.5, 1000.0, None, None, None, None, None, None, 2.0, None]
    days = [" 2024-02-29T10:00", "2023-02-29", "2024-1-5", "0000-01-01", "unknown", "20240105", "2024-01-0", "", None, "9999-12-31x"]
    got = [str(r[0]) for r in spark.createDataFrame([(v,) for v in days], "v string").select(P.pick_date("v")).collect()]
    assert got == ["2024-02-29"] + ["None"] * 8 + ["9999-12-31"]
    two = spark.createDataFrame([(" ", "x", "y"), (None, None, " y "), ("bad", "2024-01-01", None)], "a string, b string, c string")
    assert [r[0] for r in two.select(P.pick_text("a", "b", "c")).collect()] == ["x", "y", "bad"]
    assert [r[0] for r in two.select(P.pick_date("a", "b")).collect()] == [None, None, None]  # the first that is not blank decides
