"""Literal cases: NULLs, ties, window edges, and second formulas."""

import random
import shutil

import pytest
from pyspark.sql import functions as F

from quarterdeck.functions import scalars as P
from quarterdeck.operators import aggregates as A
from quarterdeck.operators import joins as J
from quarterdeck.operators import matching as M
from quarterdeck.operators import series as W
from quarterdeck.operators import xbrl as X
from quarterdeck.schemas import TABLES
from quarterdeck.sinks import upsert as K


def days(n, start="2024-01-01"):
    import datetime as dt

    d = dt.date.fromisoformat(start)
    return [(d + dt.timedelta(days=i)).isoformat() for i in range(n)]


def one(df, column):
    return [r[column] for r in df.collect()]


# ---- series ---------------------------------------------------------------------------------------------------


def test_rows_not_values_open_a_window(rows):
    px = rows("symbol string, date date, close double", *[("A", d, None if i == 3 else float(i)) for i, d in enumerate(days(21))])
    got = one(W.sma(px, (20,)).orderBy("date"), "sma20")
    assert got[18] is None
    assert got[19] == pytest.approx(sum(x for x in range(20) if x != 3) / 19)


def test_block_windows_equal_plain_windows(rows):
    rnd = random.Random(5)
    values = {k: [None if rnd.random() < 0.3 else rnd.uniform(1, 9) for _ in range(m)] for k, m in (("A", 23), ("B", 4), ("C", 12))}
    values["D"] = [None] * 9
    px = rows("symbol string, date date, close double", *[(k, d, x) for k, v in values.items() for d, x in zip(days(len(v)), v, strict=True)])
    for n in (1, 2, 4, 5):
        got = {}
        for r in W.high_low(W.sma(px, (n,)), n).orderBy("symbol", "date").collect():
            got.setdefault(r.symbol, []).append((r[f"sma{n}"], r.high_n, r.low_n))
        for k, v in values.items():
            for i, triple in enumerate(got[k]):
                last = [x for x in v[max(0, i - n + 1) : i + 1] if x is not None]
                if i + 1 < n or not last:
                    assert triple == (None, None, None), (k, n, i)
                else:
                    assert triple == (pytest.approx(sum(last) / len(last)), max(last), min(last)), (k, n, i)


def test_volatility_needs_every_return(rows):
    px = rows("symbol string, date date, close double", *[("A", d, None if i == 2 else 100.0 + i % 3) for i, d in enumerate(days(9))])
    got = one(W.volatility(px, W.by_key(), 4).orderBy("date"), "volatility")
    assert got[6] is None and got[7] is not None


def _rsi_by_recursion(closes, n=14):
    gains = [max(b - a, 0) for a, b in zip(closes, closes[1:], strict=False)]
    losses = [max(a - b, 0) for a, b in zip(closes, closes[1:], strict=False)]
    g, x = sum(gains[:n]) / n, sum(losses[:n]) / n
    for i in range(n, len(gains)):
        g, x = ((n - 1) * g + gains[i]) / n, ((n - 1) * x + losses[i]) / n
    return 100.0 - 100.0 / (1 + g / x) if x else (100.0 if g else None)


def test_rsi_equals_the_recursion(rows):
    rnd = random.Random(1)
    series = {"A": [rnd.uniform(50, 60) for _ in range(60)], "UP": [float(i) for i in range(20)], "FLAT": [5.0] * 20, "SHORT": [1.0, 2.0]}
    data = [(s, d, c) for s, closes in series.items() for d, c in zip(days(len(closes)), closes, strict=True)]
    px = rows("symbol string, date date, close double", *data)
    got = {r.symbol: r.rsi for r in W.rsi_latest(px).collect()}
    assert got["A"] == pytest.approx(_rsi_by_recursion(series["A"]), abs=1e-9)
    assert got["UP"] == 100.0 and got["FLAT"] is None and got["SHORT"] is None


def test_latest_indicators_equal_the_window_operators(rows):
    rnd = random.Random(2)
    data = [("A", d, 60.0 + rnd.random(), 40.0 + rnd.random(), rnd.uniform(41, 59), float(rnd.randint(1, 9))) for d in days(300, "2023-03-01")]
    px = rows("symbol string, date date, high double, low double, close double, volume double", *data)
    w = W.by_key()
    steps = W.atr(W.volatility(W.high_low(W.sma(W.volume_ratio(px, w))), w), w)
    want = W.perf_ytd(W.perf(steps, w)).orderBy(F.col("date").desc()).first()
    got = W.latest_price_indicators(px).first()
    pairs = {"SMA20": "sma20", "SMA200": "sma200", "52W High": "high_n", "52W Low": "low_n", "Volatility": "volatility", "ATR(14)": "atr",
             "Avg Volume": "avg_volume", "Perf Year": "perf_year", "Perf Week": "perf_week", "Perf YTD": "perf_ytd"}
    for a, b in pairs.items():
        assert got[a] == pytest.approx(want[b], abs=1e-9), a
    assert got["Perf 3Y"] is None and got["RSI(14)"] == pytest.approx(W.rsi_latest(px).first().rsi)


def test_back_adjust_equals_a_reverse_loop(rows):
    closes = [10.0, 11.0, 12.0, 13.0, 14.0, 15.0]
    d = days(6)
    px = rows("symbol string, date date, close double", *[("A", x, c) for x, c in zip(d, closes, strict=True)])
    div = rows("symbol string, date date, dividend double", ("A", d[0], 1.0), ("A", d[3], 0.5))
    spl = rows("symbol string, date date, factor double", ("A", d[3], 0.5), ("A", d[5], 0.0))
    got = one(W.back_adjust(px, div, spl).orderBy("date"), "adj_close")
    want, factor = [], 1.0
    for i in range(5, -1, -1):
        want.insert(0, closes[i] * factor)
        if i == 3:
            factor *= 0.5 * (12.0 - 0.5) / 12.0
    assert got == pytest.approx(want) and got[-1] == closes[-1]


def test_decumulate_by_a_loop_per_start(rows):
    rnd = random.Random(3)
    ends = ["2023-03-31", "2023-06-30", "2023-09-30", "2023-12-31", "2024-03-31", "2024-06-30"]
    data = []
    for m in range(60):
        for e in ends:
            start = rnd.choice(["2023-01-01", "2023-04-01", "2023-10-01", "2024-01-01", None])
            if start is None or start < e:
                data.append((f"m{m}", start, e, rnd.choice([None, float(rnd.randint(1, 99))])))
    df = rows("metric string, start date, end date, val double", *data)
    got = {(r.metric, r["end"].isoformat()): (r.period_type, r.quarter_value) for r in W.decumulate(df, ["metric"]).collect()}
    for m in {r[0] for r in data}:
        last = {}
        for _, start, e, val in sorted((r for r in data if r[0] == m), key=lambda r: r[2]):
            kind = got[m, e][0]
            want = None
            if val is not None and start is not None and kind in ("QUARTER", "YTD", "FY"):
                want = val if kind == "QUARTER" else (val - last[start] if start in last else None)
                last[start] = val
            assert got[m, e][1] == want


def test_beta_breaks_on_a_missing_month(rows):
    m = rows("month date, close double", ("2024-01-01", 1.0), ("2024-02-01", 2.0), ("2024-04-01", 3.0), ("2024-05-01", 6.0))
    got = one(W.month_returns(m, None).orderBy("month"), "ret")
    assert got == [None, 1.0, None, 1.0]


# ---- aggregates -------------------------------------------------------------------------------------------------


def _fin(rows, n, null_at=None, base=10.0):
    import datetime as dt

    d0 = dt.date(2020, 3, 31)
    data = [("A", (d0 + dt.timedelta(days=91 * i)).isoformat(), f"Q{i % 4 + 1}", None if i == null_at else base + i) for i in range(n)]
    return rows("symbol string, fiscalDate date, period string, revenue double", *data)


def test_ttm_yoy_needs_eight_values(rows):
    assert A.ttm_yoy(_fin(rows, 7), "revenue", "v").count() == 0
    assert A.ttm_yoy(_fin(rows, 8, null_at=3), "revenue", "v").count() == 0
    assert one(A.ttm_yoy(_fin(rows, 8), "revenue", "v"), "v")[0] == pytest.approx(62 / 46 - 1)
    assert A.ttm_yoy(_fin(rows, 8, base=-5.0), "revenue", "v").count() == 0
    assert A.ttm_yoy(_fin(rows, 8, base=-5.0), "revenue", "v", positive_base=False).count() == 1


def test_composite_row_mixes_rows_but_nth_row_does_not(rows):
    df = rows("k string, d date, a double, b double", ("x", "2024-03-01", None, 1.0), ("x", "2024-02-01", 2.0, None), ("x", "2024-01-01", 3.0, 3.0))
    r = A.latest_composite_row(df, "k", "d", ["a", "b"]).first()
    assert (r.a, r.b) == (2.0, 1.0)
    assert A.nth_row(df, "k", "d").first().b is None


def test_holdings_count_a_person_once(rows):
    df = rows("s string, d date, p string, v double", ("A", "2024-01-01", "x", 5.0), ("A", "2024-01-01", "x", 7.0), ("A", "2024-01-01", "y", 1.0), ("A", "2024-01-01", None, 99.0))
    assert one(A.dedupe_max_then_sum(df, ["s", "d"], "p", "v"), "v") == [8.0]


# ---- joins ------------------------------------------------------------------------------------------------------


def test_asof_edges(rows):
    snaps = rows("k string, s date, v double", ("A", "2023-01-01", 1.0), ("A", "2023-12-31", 2.0), ("A", "2024-01-02", 3.0), ("B", "2025-01-01", 9.0))
    probes = rows("k string, t date", ("A", "2024-01-01"), ("B", "2024-01-01"))
    got = {r.k: r.v for r in J.asof_backward(probes, snaps, "k", "t", "s", ["v"]).collect()}
    assert got == {"A": 2.0, "B": None}
    lag = J.asof_backward(probes, snaps, "k", "t", "s", ["v"], lag_days=365, tolerance_days=0)
    assert {r.k: r.v for r in lag.collect()}["A"] == 1.0
    # 120 days are within, 121 are not
    p = rows("k string, t date", ("A", "2024-01-01"))
    for old, want in (("2022-09-03", 5.0), ("2022-09-02", None)):
        s = rows("k string, s date, v double", ("A", old, 5.0))
        assert one(J.asof_backward(p, s, "k", "t", "s", ["v"], 365, 120), "v") == [want]


def test_asof_many_carries_over_empty_buckets(rows):
    snaps = rows("k string, s date, v double", ("A", "2023-01-15", 1.0), ("A", "2024-06-10", None), ("A", "2024-06-20", 3.0))
    dates = ["2023-01-01", "2023-01-15", "2023-02-01", "2024-05-31", "2024-06-15", "2024-06-20", "2024-12-01"]
    probes = rows("k string, t date, id int", *[("A", d, i) for i, d in enumerate(dates)])
    got = {r.id: (r.s_found.isoformat() if r.s_found else None, r.v) for r in J.asof_backward_many(probes, snaps, "k", "t", "s", ["v"]).collect()}
    assert [got[i] for i in range(7)] == [
        (None, None), ("2023-01-15", 1.0), ("2023-01-15", 1.0), ("2023-01-15", 1.0), ("2024-06-10", None), ("2024-06-20", 3.0), ("2024-06-20", 3.0),
    ]


def test_nearest_takes_the_earlier_of_two_equals(rows):
    series = rows("k string, d date, v double", ("A", "2024-01-01", 1.0), ("A", "2024-01-11", 2.0), ("B", "2024-07-05", 3.0), ("C", "2024-07-04", 4.0))
    probes = rows("k string, t date", ("A", "2024-01-06"), ("B", "2024-01-06"), ("C", "2024-01-06"))
    got = {r.k: r.v for r in J.asof_nearest(probes, series, "k", F.col("t"), "d", "v").collect()}
    assert got == {"A": 1.0, "B": None, "C": 4.0}


def test_signed_sum_window_is_open_at_the_start(rows):
    tx = rows("k string, d date, q double, ad string, kind string", ("A", "2024-01-01", 1.0, "A", None), ("A", "2024-01-02", 10.0, "D", None), ("A", "2024-03-31", 100.0, None, "Purchase"), ("B", "2024-03-31", 5.0, None, "Gift"))
    probes = rows("k string, t date", ("A", "2024-03-31"), ("B", "2024-03-31"), ("C", "2024-03-31"))
    got = {r.k: r.net_shares for r in J.range_signed_sum(probes, tx, "k", "t", "d", "q", "ad", "kind").collect()}
    assert got == {"A": 90.0, "B": 0.0, "C": None}


def test_leap_day_windows(rows):
    ev = rows("k string, d date, v double", ("A", "2021-02-28", 1.0), ("A", "2020-02-29", 2.0), ("A", "2020-02-28", 4.0))
    probes = rows("k string, t date", ("A", "2024-02-29"))
    r = J.range_sum(probes, ev, "k", "t", "d", "v", J.dividend_windows("t")).first()
    assert (r.ttm, r.ago_3y) == (None, 3.0)


# ---- upsert -----------------------------------------------------------------------------------------------------


def test_upsert_is_idempotent_and_nulls_are_one_key(rows, spark, tmp_path):
    t = TABLES["targets_snapshot"]
    a = rows("symbol string, asOfDate date, targetPrice double", ("A", "2024-01-01", 1.0), (None, "2024-01-01", 2.0))
    b = rows("symbol string, asOfDate date, targetPrice double", (None, "2024-01-01", 3.0), ("B", "2024-01-01", 4.0))
    path = str(tmp_path / "t")
    for batch in (a, b, b):
        K.upsert(spark, path, batch, t, pos=[])
    got = {(r.symbol, r.targetPrice) for r in spark.read.parquet(path).collect()}
    assert got == {("A", 1.0), (None, 3.0), ("B", 4.0)}
    K.upsert(spark, str(tmp_path / "none"), a.limit(0), t, pos=[], keep_on_empty=True)
    assert not (tmp_path / "none").exists()


def test_upsert_keeps_null_partitions_and_the_last_row_of_a_batch(rows, spark, tmp_path):
    t, path = TABLES["targets_snapshot"], str(tmp_path / "n")
    by = {"month": F.date_format("asOfDate", "yyyy-MM")}
    batch = lambda *r: rows("symbol string, asOfDate date, targetPrice double, at int", *r)
    K.upsert(spark, path, batch(("A", None, 1.0, 0), ("B", "2020-01-01", 1.0, 0)), t, pos=["at"], partition_by=by)
    K.upsert(spark, path, batch(("C", None, 3.0, 1), ("C", None, 2.0, 0)), t, pos=["at"], partition_by=by)
    assert {(r.symbol, r.targetPrice) for r in spark.read.parquet(path).collect()} == {("A", 1.0), ("B", 1.0), ("C", 3.0)}


@pytest.mark.parametrize("state", ["staged", "table removed", "half of the partitions moved", "old layout", "failed write"])
def test_upsert_resumes_from_every_half_done_state(rows, spark, tmp_path, state):
    t, path = TABLES["targets_snapshot"], tmp_path / "t"
    by = {"month": F.date_format("asOfDate", "yyyy-MM")} if "partitions" in state else None
    batch = lambda *r: rows("symbol string, asOfDate date, targetPrice double", *r)
    K.upsert(spark, str(path), batch(("A", "2024-01-01", 1.0), ("B", "2024-02-01", 1.0)), t, pos=[], partition_by=by)
    want = {("A", 2.0), ("B", 2.0)}
    done = batch(("A", "2024-01-01", 2.0), ("B", "2024-02-01", 2.0))
    if state in ("staged", "table removed"):
        done.write.parquet(K.staging(str(path)))
        if state == "table removed":
            shutil.rmtree(path)
    elif by:
        done.withColumn("month", by["month"]).write.partitionBy("month").parquet(K.staging(str(path), True))
        shutil.rmtree(path / "month=2024-01")
        (tmp_path / "t__staging_parts" / "month=2024-01").rename(path / "month=2024-01")
        shutil.rmtree(path / "month=2024-02")
    elif state == "old layout":
        path.rename(tmp_path / "t__old")
        want = {("A", 1.0), ("B", 1.0)}
    else:
        (tmp_path / "t__staging").mkdir()
        want = {("A", 1.0), ("B", 1.0)}
    K.upsert(spark, str(path), batch(("C", "2024-01-01", 5.0)), t, pos=[], partition_by=by)
    assert {(r.symbol, r.targetPrice) for r in spark.read.parquet(str(path)).collect()} == want | {("C", 5.0)}
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def test_side_tables_with_repeated_rows_multiply_nothing(rows):
    p = rows("symbol string, date date, adjClose double", ("A", "2024-01-01", None), ("A", "2024-01-02", None))
    side = rows("symbol string, date date, adjClose double, at int", ("A", "2024-01-01", 1.0, 0), ("A", "2024-01-01", 2.0, 1))
    got = J.fill_from_side_table(p, side, "symbol", ["symbol", "date"], "adjClose", 0.05, ["at"]).collect()
    assert sorted((r.adjClose for r in got), key=str) == [2.0, None]


def test_partitioned_upsert_leaves_other_partitions_alone(rows, spark, tmp_path):
    t = TABLES["targets_snapshot"]
    path = str(tmp_path / "p")
    by = {"month": F.date_format("asOfDate", "yyyy-MM")}
    K.upsert(spark, path, rows("symbol string, asOfDate date, targetPrice double", ("A", "2024-01-01", 1.0), ("A", "2024-02-01", 2.0)), t, pos=[], partition_by=by)
    before = {f.name for f in (tmp_path / "p" / "month=2024-01").glob("*.parquet")}
    K.upsert(spark, path, rows("symbol string, asOfDate date, targetPrice double", ("A", "2024-02-01", 5.0)), t, pos=[], partition_by=by)
    assert {f.name for f in (tmp_path / "p" / "month=2024-01").glob("*.parquet")} == before
    assert sorted(one(spark.read.parquet(path), "targetPrice")) == [1.0, 5.0]


def test_stored_extra_column_survives(rows):
    old = rows("symbol string, asOfDate date, targetPrice double, note string", ("A", "2024-01-01", 1.0, "x"))
    new = rows("symbol string, asOfDate date, targetPrice double", ("B", "2024-01-01", 2.0))
    got = {r.symbol: r.note for r in K.merge_last_wins(old, new, ["symbol", "asOfDate"], TABLES["targets_snapshot"].schema).collect()}
    assert got == {"A": "x", "B": None}


# ---- names ------------------------------------------------------------------------------------------------------


def _plain_lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_common_length_against_the_table():
    rnd = random.Random(4)
    for _ in range(300):
        a, b = ("".join(rnd.choice("abc ") for _ in range(rnd.randint(0, 90))) for _ in range(2))
        assert M._common_length(a, b) == _plain_lcs(a, b)


def test_token_set_score():
    assert M.token_set_score("ACME CORP", "CORP ACME ACME") == 100.0
    assert M.token_set_score("ACME CORP", "ACME CORP CLASS A") == 100.0
    assert M.token_set_score("", "ACME") == 0.0
    assert M.token_set_score("abc", "abd") == pytest.approx(200 * 2 / 6)


def test_resolution_classes(rows):
    master = rows("symbol string, name string", ("BRK.B", "BERKSHIRE HATHAWAY"), ("BRK-B", "OTHER THING"), ("AAPL", "APPLE"), ("BF-B", "BROWN"))
    lines = rows("t string, n string", ("aapl", "x"), ("BRKB", "HATHAWAY BERKSHIRE"), ("BRK/B", ""), ("BFB", ""), ("ZZZ", ""), (" ", ""))
    got = {r.t: (r.match_type, r.ticker_fixed, r.match_score, r.reason) for r in M.resolve_tickers(lines, master, "t", "n").collect()}
    assert got["aapl"][:2] == ("EXACT", "AAPL") and got["BFB"][:2] == ("NORMALIZED", "BF-B")
    assert got["BRKB"][:3] == ("NAME_FUZZY", "BRK.B", 100.0)
    assert got["BRK/B"] == ("AMBIGUOUS", "", 0.0, "fuzzy_tie_or_low_score")
    assert got["ZZZ"][3] == "no_symbol_match" and got[" "][3] == "empty_ticker"


def test_ticker_variants(rows):
    df = rows("t string, n string", ("HEIA", "HEICO CORP CLASS A"), ("BRKB", "x"), ("GOOGL", "ALPHABET CLASS A"))
    got = {r.t: r.v for r in df.select("t", P.ticker_variants("t", "n").alias("v")).collect()}
    assert got["HEIA"] == ["HEI-A", "HEI.A", "HEIA"] and got["BRKB"][0] == "BRK-B" and got["GOOGL"] == ["GOOGL"]


# ---- facts ------------------------------------------------------------------------------------------------------


def _fact(rows, *facts):
    cols = "cik string, ns string, tag string, unit string, doc_pos bigint, src_pos bigint, start date, end date, val double, accn string, fy int, fp string, form string, filed date, frame string"
    base = dict(cik="1", ns="us-gaap", tag="Revenues", unit="USD", doc_pos=0, src_pos=0, start="2024-01-01", end="2024-03-31", val=1.0, accn="a", fy=2024, fp="Q1", form="10-Q", filed="2024-05-01", frame=None)
    return rows(cols, *[tuple({**base, **f}.values()) for f in facts])


def _slot(rows):
    return rows("cik string, slot int, end date, accn string, form string, filed date, fp string, fy int", ("1", 1, "2024-03-31", "a", "10-Q", "2024-05-01", "Q1", 2024))


@pytest.mark.parametrize(
    "facts, want, basis",
    [
        ([dict(tag="SalesRevenueNet", val=1.0), dict(val=2.0)], 2.0, "ACCN"),
        ([dict(val=1.0, accn="b"), dict(val=2.0, tag="SalesRevenueNet")], 2.0, "ACCN"),
        ([dict(val=1.0, start="2024-02-15"), dict(val=2.0, accn="c"), dict(val=3.0, accn="b")], 2.0, "END"),
        ([dict(val=1.0, start="2024-01-31"), dict(val=2.0, accn="b")], 1.0, "ACCN"),
        ([dict(val=1.0, src_pos=5, start="2023-10-01"), dict(val=2.0, src_pos=6)], 1.0, "ACCN"),
        ([dict(val=1.0, fy=2023), dict(val=2.0, src_pos=9)], 2.0, "ACCN"),
        ([dict(val=7.0, unit=" usd ")], 7.0, "ACCN"),
    ],
)
def test_fact_choice(rows, spark, facts, want, basis):
    r = X.select_fact_for_slot(_fact(rows, *facts), _slot(rows), X.metrics_config(spark)).filter("metric = 'Revenue'").first()
    assert (r.val, r.match_basis) == (want, basis)


def test_interest_cascade(rows):
    s = _slot(rows)
    pnl, cash = dict(tag="InterestExpense"), dict(tag="InterestPaid")
    cases = [
        ([dict(cash, val=1.0), dict(pnl, val=2.0, accn="z")], 1.0, "CFS"),
        ([dict(cash, val=1.0, accn="z"), dict(pnl, val=2.0, end="2024-04-02")], 1.0, "CFS"),
        ([dict(pnl, val=2.0, end="2024-04-03"), dict(cash, val=3.0, end="2024-04-01")], 2.0, "PNL"),
        ([dict(pnl, val=2.0, end="2024-04-04")], None, None),
    ]
    for facts, want, source in cases:
        r = X.select_interest_for_slot(_fact(rows, *facts), s).first()
        assert (r.val, r.interest_source) == (want, source)


def test_anchor_tie_takes_the_earlier_tag(rows):
    f = _fact(rows, dict(tag="Assets"), dict(tag="NetIncomeLoss"), dict(tag="Other"))
    assert A.choose_anchor(f).first().anchor == "NetIncomeLoss"


# ---- plans: the shape that scale depends on -----------------------------------------------------------------------


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_newest_rows_are_limited_before_the_exchange(rows):
    df = rows("k string, d date, v double", ("A", "2024-01-01", 1.0))
    plan = _plan(A.newest(df, "k", "d", 4))
    assert plan.count("WindowGroupLimit") == 2


def test_filters_and_columns_reach_the_scan(spark):
    from conftest import SF

    from quarterdeck.catalog import bindings as B
    from quarterdeck.sources.tables import universe_filter

    li = B.lines(spark, SF)
    out = universe_filter(li, B.universe(spark, SF), only=["s1"]).filter("l_quantity > 10").select("symbol", "l_quantity")
    plan = _plan(out)
    assert "GreaterThan(l_quantity,10.0)" in plan and "l_extendedprice" not in plan


def test_no_python_worker_outside_name_scores(spark):
    from conftest import SF

    import __spark_entry__ as entry

    for name in ("C1_factors_job", "W15_back_adjust", "J1_asof_backward_many", "N3_build_financials"):
        plan = _plan(entry.queries()[name](spark, SF))
        assert "Python" not in plan and "CartesianProduct" not in plan, name
        # The factor job meets one-row tables (newest snapshot date, market rank); nothing else may loop.
        assert "NestedLoop" not in plan or name == "C1_factors_job", name


def test_long_frames_sort_once(rows):
    px = rows("symbol string, date date, close double", ("A", "2024-01-01", 1.0))
    for df in (W.sma(px), W.high_low(px)):
        assert _plan(df).count("Sort [") == 1


def test_long_frames_at_other_lengths(rows):
    rnd = random.Random(6)
    values = [None if rnd.random() < 0.5 else rnd.uniform(1, 9) for _ in range(70)]
    px = rows("symbol string, date date, close double", *[("A", d, x) for d, x in zip(days(70), values, strict=True)])
    lengths = (3, 7, 23, 31, 64)
    got = W.high_low(W.sma(px, lengths), 23).orderBy("date").collect()
    for i, r in enumerate(got):
        for n in lengths:
            last = [x for x in values[max(0, i - n + 1) : i + 1] if x is not None]
            assert r[f"sma{n}"] == (pytest.approx(sum(last) / len(last)) if i + 1 >= n and last else None), (n, i)
        last = [x for x in values[max(0, i - 22) : i + 1] if x is not None]
        assert (r.high_n, r.low_n) == ((max(last), min(last)) if i + 1 >= 23 else (None, None))
