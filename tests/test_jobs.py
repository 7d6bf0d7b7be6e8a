"""Jobs end to end over files."""

import dataclasses
import json

import pytest
from conftest import SF
from pyspark.sql import functions as F

from quarterdeck.catalog import bindings as B
from quarterdeck.functions import fixed
from quarterdeck.operators import aggregates
from quarterdeck.plans import company_facts, factors, universe
from quarterdeck.sources.holdings import read_holdings
from quarterdeck.sources.payloads import read_payload_json
from quarterdeck.sources.tables import read_universe


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The declared tables of the factor job, as Parquet folders."""
    folder = tmp_path_factory.mktemp("tables")
    names = {"prices": "prices_eod", "market": "sp500_prices", "financials": "financials_quarterly", "dividends": "dividends_events",
             "shares": "shares_snapshot", "membership": "index_membership", "targets": "targets_snapshot", "company_facts": "company_facts_snapshot",
             "holdings": "insider_holdings_snapshot", "transactions": "insider_transactions", "estimates": "estimates_snapshot",
             "estimates_quarterly": "estimates_quarterly_snapshot"}
    inputs = B.factor_inputs(spark, SF)
    for f in dataclasses.fields(inputs):
        getattr(inputs, f.name).write.parquet(f"{folder}/{names[f.name]}.parquet")
    return str(folder)


def test_factor_job_accumulates(spark, tables, tmp_path):
    out = str(tmp_path / "factors_latest")
    factors.run(spark, tables, out)
    first = factors.read_snapshots(spark, out)
    n = first.count()
    assert first.columns == fixed.FACTOR_COLUMNS and n > 0
    factors.run(spark, tables, out)
    again = factors.read_snapshots(spark, out)
    assert again.count() == n
    assert spark.read.csv(f"{out}.csv", header=True).count() == n


def _snapshots(rows, *r):
    return rows("asOfDate date, symbol string, Price double", *r)


def test_snapshots_touch_their_dates_only(spark, rows, tmp_path):
    out = str(tmp_path / "f")
    factors.store_snapshots(spark, _snapshots(rows, ("2024-01-31", "A", 1.0), ("2024-02-29", "B", 3.0), ("2024-02-29", "A", 2.0), (None, "N", 9.0)), out)
    files = lambda kind: {str(p): p.stat().st_mtime_ns for p in (tmp_path / f"f.{kind}").rglob("part-*")}
    before = {k: files(k) for k in ("parquet", "csv")}
    # A run that stopped before its CSV left February on the list.
    spark.createDataFrame([("2024-02-29",)], "d string").selectExpr("date(d) AS snapshot").write.parquet(f"{out}__csv_todo")
    factors.store_snapshots(spark, _snapshots(rows, ("2024-03-31", "A", 4.0), (None, "N", 8.0)), out)
    want = {("2024-01-31", "A", 1.0), ("2024-02-29", "A", 2.0), ("2024-02-29", "B", 3.0), ("2024-03-31", "A", 4.0), ("None", "N", 8.0)}
    assert {(str(r.asOfDate), r.symbol, r.Price) for r in factors.read_snapshots(spark, out).collect()} == want
    csv = spark.read.csv(f"{out}.csv", header=True).collect()
    assert {(str(r.asOfDate), r.symbol, float(r.Price)) for r in csv} == want and len(csv) == len(want)
    same = {k: {p.split("snapshot=")[1][:10] for p in before[k].items() & files(k).items() for p in p[:1]} for k in before}
    assert same == {"parquet": {"2024-01-31", "2024-02-29"}, "csv": {"2024-01-31"}}
    assert not (tmp_path / "f__csv_todo").exists()


def test_snapshots_in_one_piece_are_split_once(spark, rows, tmp_path):
    out = str(tmp_path / "f")
    _snapshots(rows, ("2024-01-31", "A", 1.0), ("2024-02-29", "A", 2.0)).write.option("header", True).csv(f"{out}.csv")
    factors.store_snapshots(spark, _snapshots(rows, ("2024-02-29", "A", 5.0)), out)
    assert {(str(r.asOfDate), r.Price) for r in factors.read_snapshots(spark, out).collect()} == {("2024-01-31", 1.0), ("2024-02-29", 5.0)}
    whole = str(tmp_path / "g")
    _snapshots(rows, ("2024-01-31", "A", 1.0)).write.parquet(f"{whole}.parquet")
    _snapshots(rows, ("2024-01-31", "A", 1.0)).write.option("header", True).csv(f"{whole}.csv")
    factors.store_snapshots(spark, _snapshots(rows, ("2024-02-29", "A", 5.0)), whole)
    assert factors.read_snapshots(spark, whole).count() == spark.read.csv(f"{whole}.csv", header=True).count() == 2


def test_values_tell_their_origin(spark, rows):
    from quarterdeck.operators import formulas, xbrl

    slots = rows("cik string, slot int, end date", ("1", 1, "2024-06-30"), ("1", 2, "2024-03-31"))
    form = "cik string, slot int, metric string, start date, end date, val double, tag string, accn string, match_basis string"
    picked = rows(form, ("1", 1, "Revenue", "2024-01-01", "2024-06-30", 100.0, "Revenues", "a", "ACCN"), ("1", 2, "Revenue", "2024-01-01", "2024-03-31", 40.0, "Revenues", "b", "END"),
                  ("1", 1, "CostOfRevenue", "2024-01-01", "2024-06-30", 30.0, "CostOfRevenue", "a", "ACCN"), ("1", 1, "RD", "2024-01-01", "2024-06-30", 7.0, "RD", "a", "ACCN"),
                  ("1", 2, "InterestExpense", "2024-01-01", "2024-03-31", 1.0, "x", "b", "ACCN"))
    found = "cik string, slot int, slot_end date, start date, end date, val double, tag string, accn string, interest_source string, match_basis string"
    # Records that end some days before their slots: the later one loses the earlier one of its start.
    interest = rows(found, ("1", 1, "2024-06-30", "2024-01-01", "2024-06-27", 5.0, "InterestPaid", "c", "CONCEPT_CFO", "CONCEPT"), ("1", 2, "2024-03-31", "2024-01-01", "2024-03-28", 2.0, "InterestExpense", "b", "PNL", "END"))
    values = xbrl.quarter_values(xbrl.with_interest(picked, interest), slots=slots)
    out = xbrl.unpivot_origin(formulas.derived_metrics(xbrl.pivot_quarters(values, slots, origin=True)), ["slot"])
    got = {(r.slot, r.metric): (r.val, r.quarter_value, r.tag, r.match_basis, r.interest_source, r.derived_source, r.contamination_flag) for r in out.collect()}
    assert got == {
        (1, "Revenue"): (100.0, 60.0, "Revenues", "ACCN", None, None, None),
        (2, "Revenue"): (40.0, 40.0, "Revenues", "END", None, None, None),
        (1, "CostOfRevenue"): (30.0, None, "CostOfRevenue", "ACCN", None, None, None),
        (1, "GrossProfit"): (70.0, None, None, None, None, "REV-COGS", None),
        (1, "RD"): (7.0, None, "RD", "ACCN", None, None, None),
        (1, "OperatingExpenses"): (7.0, None, None, None, None, "SGnA+RD", None),
        (1, "InterestExpense"): (5.0, 3.0, "InterestPaid", "CONCEPT", "CONCEPT_CFO", None, None),
        (2, "InterestExpense"): (2.0, 2.0, "InterestExpense", "END", "PNL", None, None),
    }
    dirty = rows(form, ("1", 1, "Revenue", None, "2024-06-30", 0.0, "Revenues", "a", "ACCN"), ("1", 1, "GrossProfit", None, "2024-06-30", 9.0, "GrossProfit", "a", "ACCN"))
    out = xbrl.unpivot_origin(formulas.derived_metrics(xbrl.pivot_quarters(xbrl.quarter_values(dirty), slots, origin=True)), ["slot"])
    assert {(r.metric, r.val, r.contamination_flag) for r in out.collect()} == {("Revenue", 0.0, None), ("GrossProfit", 9.0, "GP_PRESENT_REV_MISSING_OR_ZERO")}


def test_price_checks_from_day_counts(spark, rows, tmp_path):
    from quarterdeck.plans import quality

    form, today = "symbol string, date date, adjClose double", F.lit("2024-01-12").cast("date")
    first = rows(form, ("A", "2024-01-02", 1.0), ("B", "2024-01-02", None), ("A", "2024-01-03", None))
    again = rows(form, ("A", "2024-01-03", 2.0), ("B", "2024-01-03", None), ("C", None, 1.0))
    figures = lambda days: {r.check_name: r.value for r in quality.price_report(days, today).collect() if r.section == "prices"}
    path = str(tmp_path / "days")
    for batch in (first, again):
        quality.store_price_days(spark, path, batch)
    whole = rows(form, ("A", "2024-01-02", 1.0), ("B", "2024-01-02", None), ("A", "2024-01-03", 2.0), ("B", "2024-01-03", None), ("C", None, 1.0))
    want = {"n_rows": 5.0, "n_latest": 2.0, "lag_days": 9.0, "stale": 1.0, "missing_rate": 0.4, "missing_rate_latest": 0.5}
    assert figures(spark.read.parquet(path)) == figures(quality.price_days(whole)) == want
    empty = figures(quality.price_days(whole.limit(0)))
    assert empty == {"n_rows": 0.0, "n_latest": None, "lag_days": None, "stale": None, "missing_rate": None, "missing_rate_latest": None}


def test_quality_report_reads_each_table_once(spark, rows, tmp_path):
    from quarterdeck.plans import quality

    def stored(name, form, *r):
        rows(form, *r).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    prices = stored("prices", "symbol string, date date, adjClose double", ("A", "2024-01-02", None))
    fin = stored("fin", "symbol string, revenue double, grossProfit double", ("A", 0.0, 1.0), ("B", None, 1.0), ("C", 5.0, 9.0), ("D", 5.0, None))
    form = "symbol string, exDate date, pos int"
    events, calendar = stored("events", form, ("A", "2024-01-02", 1)), stored("calendar", form, ("A", "2024-01-02", 1), ("B", "2024-01-03", 2))
    out = quality.report(quality.price_days(prices), fin, calendar, events, F.lit("2024-01-04").cast("date"), {"earnings_events": None, "more": events})
    got = {(r.section, r.check_name): r.value for r in out.collect()}
    assert got == {
        ("rows", "prices_eod"): 1.0, ("rows", "financials_quarterly"): 4.0, ("rows", "earnings_events"): 0.0, ("rows", "more"): 1.0,
        ("prices", "n_rows"): 1.0, ("prices", "n_latest"): 1.0, ("prices", "lag_days"): 2.0, ("prices", "stale"): 0.0, ("prices", "missing_rate"): 1.0, ("prices", "missing_rate_latest"): 1.0,
        ("financials", "revenue_zero"): 1.0, ("financials", "revenue_missing"): 1.0, ("financials", "gross_profit_above_revenue"): 2.0,
        ("calendar", "MATCH"): 1.0, ("calendar", "MISSING_EXDATE"): 1.0,
    }
    plan = quality.report(quality.price_days(prices), fin, calendar, events, F.lit("2024-01-04").cast("date"))._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan parquet") == 4  # prices, financials, calendar, events


def test_company_id_of_a_landed_name(rows):
    docs = rows("body string, key string", ("{", "2024-05-01/CIK0000000012.json"), ("{", "77.json"), ("{", "none"), ('{"cik": 5}', "CIK0000000009.json"))
    assert {(r.cik, r.bad) for r in company_facts.document_ids(docs).collect()} == {("0000000012", True), ("0000000077", True), ("0000000005", False)}


def test_universe_job(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "fund.csv").write_text(
        "﻿Fund holdings as of today\n\nTicker,Name,Asset Class,Weight (%)\nAAPL,APPLE,Equity,5.1\nBRKB,\"HATHAWAY, BERKSHIRE\",Equity,2\nUSD,US DOLLAR,Cash,1\nBFB,BROWN,Equity,1,extra\nXYZ,NOBODY,Equity\n",
        encoding="utf-8",
    )
    assert read_holdings(spark, str(tmp_path / "in")).count() == 4
    listing = [{"symbol": "AAPL", "name": "APPLE INC"}, {"symbol": "BRK.B", "name": "BERKSHIRE HATHAWAY,"}, {"symbol": "BRK-B", "name": "OTHER"}]
    master = spark.createDataFrame([(json.dumps(listing),)], "body string")
    universe.run(spark, str(tmp_path / "in"), master, str(tmp_path / "out"))
    got = {(r.ticker_raw, r.ticker_fixed, r.match_type, r._out) for r in spark.read.parquet(str(tmp_path / "out" / "universe")).collect()}
    assert got == {
        ("AAPL", "AAPL", "EXACT", "universe_list"),
        ("BRKB", "BRK.B", "NAME_FUZZY", "universe_list"),
        ("USD", "", "REJECT", "universe_rejects"),
        ("XYZ", "", "REJECT", "universe_rejects"),
    }
    keys = {k for r in spark.read.text(str(tmp_path / "out" / "ticker_map")).collect() for k in json.loads(r.value)}
    assert keys == {"AAPL", "BRKB", "XYZ"}


def test_company_facts_job(spark, tmp_path):
    docs = B.documents(spark, SF)
    ciks = B.suppliers(spark, SF).select(F.col("symbol").alias("ticker"), F.lpad(F.col("s_suppkey").cast("string"), 10, "0").alias("cik"))
    names = [(5, "S2", "Two", "x"), (6, "S3", "Three", "x"), (0, "S1", "One", "x"), (1, "S1", "One again", "x"), (2, "USD", "Dollars", "x"), (3, "NONE", "Nobody", "x")]
    lines = spark.createDataFrame(names, "pos int, ticker string, name string, sector string")
    out = str(tmp_path / "out")
    broken = spark.createDataFrame([('{"cik": 2, "facts": {"us-', "CIK0000000002.json")], "body string, key string")
    docs = docs.select("body", F.lit(None).cast("string").alias("key")).filter("get_json_object(body, '$.cik') NOT IN (2, 3)").unionByName(broken)
    company_facts.run(spark, lines, ciks, docs, out)
    report = {r.name: r.reason for r in spark.read.csv(f"{out}/universe_extraction_report", header=True).collect()}
    assert report == {"One": "ok", "One again": "duplicate_cik_copy", "Dollars": "excluded_currency_ticker", "Nobody": "no_cik", "Two": "parse_error", "Three": "fetch_error"}
    rows = spark.read.csv(f"{out}/universe_metrics_quarterly", header=True)
    assert rows.columns == [*company_facts.BASE, *company_facts.metric_columns(), *company_facts.CHECKS]
    assert rows.groupBy("name").count().collect()[0]["count"] == fixed.SLOTS_OUT and rows.count() == 2 * fixed.SLOTS_OUT
    # Quarter values of a complete year add up to the year.
    quarters = {r["end"]: (r.NetIncome, r.NetIncome_Quarter) for r in rows.filter("name = 'One'").collect()}
    year = [float(quarters[e][1]) for e in ("2000-03-31", "2000-06-30", "2000-09-30", "2000-12-31")]
    assert sum(year) == pytest.approx(float(quarters["2000-12-31"][0]))


def test_landed_payload_files(spark, tmp_path):
    (tmp_path / "aapl.json").write_text('[{"date":"2024-01-02","Close":"2.5"},{"date":"2024-01-03","close":3}]')
    (tmp_path / "MSFT.json").write_text('{"date":"2024-01-02","close":null}')
    (tmp_path / "bad.json").write_text('"oops"')
    got = {(r.symbol, r.pos, r.r["date"]) for r in read_payload_json(spark, str(tmp_path)).collect()}
    assert got == {("AAPL", 0, "2024-01-02"), ("AAPL", 1, "2024-01-03"), ("MSFT", 0, "2024-01-02")}


def test_universe_file(spark, tmp_path):
    (tmp_path / "u.csv").write_text("﻿Ticker, Name ,Sector\n AAA ,x,y\n,,\nBBB\n", encoding="utf-8")
    rows = read_universe(spark, str(tmp_path / "u.csv"))
    assert rows.columns == ["Ticker", "Name", "Sector"]
    assert {tuple(r) for r in rows.collect()} == {("AAA", "x", "y"), ("BBB", "", "")}


def test_holdings_records(spark, tmp_path):
    """A line break and a separator inside quotes, a quote as text, and a file in Latin-1."""
    text = 'Fund "A\n\nTicker,Name,Weight (%)\nAAA,"FIRST\nSECOND, THIRD",1\nBBB,2" PIPE CO,2\nCCC,"SAYS ""HI""",3\nDDD,\u00c9TABLISSEMENTS,4\n'
    (tmp_path / "one.csv").write_bytes(text.encode("utf-8-sig"))
    (tmp_path / "two.csv").write_bytes(text.encode("latin1"))
    for name in ("one", "two"):
        rows = read_holdings(spark, str(tmp_path / f"{name}.csv")).orderBy("pos").collect()
        assert [r.cells for r in rows] == [["AAA", "FIRST\nSECOND, THIRD", "1"], ["BBB", '2" PIPE CO', "2"], ["CCC", 'SAYS "HI"', "3"], ["DDD", "\u00c9TABLISSEMENTS", "4"]]


def test_stored_counts(spark, tmp_path):
    spark.range(7).write.parquet(str(tmp_path / "good.parquet"))
    (tmp_path / "broken.parquet").mkdir()
    (tmp_path / "broken.parquet" / "part-0.parquet").write_bytes(b"PAR1 no table")
    counts = {r.table_name: r.n_rows for r in aggregates.stored_counts(spark, str(tmp_path), ["good", "broken", "absent"]).collect()}
    assert counts == {"good": 7, "broken": -1, "absent": 0}
