"""The extraction job computes what it writes, and days of facts are read as before."""

import datetime as dt

from pyspark.sql import functions as F

from quarterdeck.plans import company_facts as C
from quarterdeck.sources import xbrl


def test_a_report_alone_makes_no_facts(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(C, "explode_xbrl_facts", lambda *a, **k: (_ for _ in ()).throw(AssertionError("facts")))
    lines = rows("pos int, ticker string, name string, sector string", (1, "A", "Alpha", "x"), (2, "B", "Beta", "x"))
    ciks = rows("ticker string, cik string", ("A", "0000000001"), ("B", "0000000002"))
    docs = rows("key string, body string", ("CIK1", '{"cik": 1, "facts": {}}'), ("CIK2", '{"cik": 2, "fac'))
    C.run(spark, lines, ciks, docs, str(tmp_path), report_only=True)
    got = spark.read.csv(f"{tmp_path}/universe_extraction_report", header=True).collect()
    assert {r.ticker: r.reason for r in got} == {"A": "ok", "B": "parse_error"}


def test_days_of_facts(rows):
    texts = ["2024-02-29", " 2024-02-29T10:00", "2023-02-29", "0000-01-01", "2024-2-9", "", None, "20240229", "x2024-02-29"]
    got = [r.d for r in rows("i int, t string", *enumerate(texts)).orderBy("i").select(xbrl._day(F.col("t")).alias("d")).collect()]
    assert got == [dt.date(2024, 2, 29)] * 2 + [None] * 7


def test_landed_documents_are_written_once(spark):
    from conftest import SF

    from quarterdeck.catalog.q_jobs import landed_facts

    plan = landed_facts(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and "Exchange" not in plan
