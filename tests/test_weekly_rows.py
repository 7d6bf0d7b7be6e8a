"""The weekly mode returns the rows of its tables."""

from quarterdeck.catalog import bindings as B
from quarterdeck.catalog import load

QUERIES, _ = load()
SMALL = "/root/testdata/sf0.001"


def test_weekly_returns_every_row(spark):
    """One row per table and symbol, not three totals (F4)."""
    rows = QUERIES["C5_ingest_weekly"](spark, SMALL).collect()
    n = B.universe(spark, SMALL).count()
    assert len(rows) == 3 * n and len({(r.table_name, r.symbol) for r in rows}) == 3 * n
