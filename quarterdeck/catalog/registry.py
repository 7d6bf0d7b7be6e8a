"""Registry of named queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterdeck.catalog.ctes import CTES
from quarterdeck.schemas import q

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tidy(df: DataFrame, digits: int = 6, places: dict[str, int] | None = None) -> DataFrame:
    """Dates as ISO text and doubles rounded, so two engines can be compared value by value.

    `places` sets other digits per column: fewer for large amounts, where six would pass the precision of a
    double, more where exact results end in a five at the seventh digit.
    """
    out = []
    for f in df.schema.fields:
        c = F.col(q(f.name))
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), (places or {}).get(f.name, digits)) + F.lit(0.0)
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("date").cast("string")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        out.append(c.alias(f.name))
    return df.select(*out)


def _with(names: list[str]) -> str:
    seen: list[str] = []

    def visit(n: str) -> None:
        deps, _ = CTES[n]
        for d in deps.split():
            visit(d)
        if n not in seen:
            seen.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1].strip()})" for n in seen) + "\n" if seen else ""


def sql(text: str, ctes: str = "") -> str:
    """Statement with the named common table expressions and all they need."""
    return _with(ctes.split()) + text.strip()


def query(name: str, text: str | None = None, ctes: str = "", digits: int = 6, places: dict[str, int] | None = None):
    """Register a query under its inventory id, with the SQL that must give the same rows."""

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, sf, _f=fn: tidy(_f(spark, sf), digits, places)
        if text is not None:
            ORACLES[name] = sql(text, ctes)
        return fn

    return add
