"""Shared session and DuckDB connection."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from quarterdeck.session import build_session

    s = build_session("tests", "local[8]", 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    from compare import connect

    return connect(SF)


@pytest.fixture
def rows(spark):
    """Literal frames: rows(schema, (..), (..)) with ISO dates for date columns."""

    def make(schema, *data):
        import datetime as dt

        from pyspark.sql import types as T

        st = T._parse_datatype_string(schema)
        conv = [
            tuple(dt.date.fromisoformat(v) if isinstance(f.dataType, T.DateType) and isinstance(v, str) else v for v, f in zip(r, st.fields, strict=True))
            for r in data
        ]
        return spark.createDataFrame(conv, st)

    return make
