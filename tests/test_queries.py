"""Every registered query against its SQL in DuckDB, on the smallest data."""

import pytest
from compare import compare
from conftest import SF

import __spark_entry__ as entry
from quarterdeck.catalog import load

QUERIES, SQL = load()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name):
    result = compare(duck, spark, name, QUERIES[name], SQL.get(name), SF)
    assert result.startswith(("ok", "rows-only")) and "TYPES" not in result, result


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_holds_every_query():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_inventory_is_covered():
    ids = {n.split("_", 1)[0] for n in QUERIES}
    counts = {"S": 11, "K": 14, "P": 26, "N": 20, "J": 17, "A": 25, "W": 16, "O": 5, "F": 8, "C": 6}
    assert ids == {f"{letter}{i}" for letter, n in counts.items() for i in range(1, n + 1)}


def test_entry_has_the_factor_columns(spark):
    from quarterdeck.functions import fixed

    df = entry.entry(spark)
    assert df.columns == fixed.FACTOR_COLUMNS and df.count() > 0
