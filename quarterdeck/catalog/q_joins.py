"""Queries of the join operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterdeck.catalog import bindings as B
from quarterdeck.catalog.registry import query
from quarterdeck.functions.scalars import ticker_variants
from quarterdeck.operators import aggregates as A
from quarterdeck.operators import joins as J
from quarterdeck.operators import matching as M
from quarterdeck.operators import series as W
from quarterdeck.operators import xbrl as X
from quarterdeck.operators.formulas import facts_shares
from quarterdeck.session import materialise
from quarterdeck.sources.xbrl import explode_xbrl_facts, read_concept_records


def facts(spark, sf):
    """Facts of the company documents; written once, as several consumers read them."""
    return materialise(explode_xbrl_facts(B.documents(spark, sf), "body", "doc_pos"), "facts")


def picked(spark, sf):
    f = facts(spark, sf)
    return X.select_fact_for_slot(f, A.build_slots(f), X.metrics_config(spark))


def probes(spark, sf):
    """Newest price date of each symbol."""
    return A.latest_date(B.adjusted(spark, sf)).withColumnRenamed("date", "t")


@query(
    "J1_asof_backward",
    """
SELECT p.symbol, CAST(p.t AS VARCHAR) AS t, CAST(s."asOfDate" AS VARCHAR) AS "asOfDate_found", s."sharesOutstanding"
FROM probe p ASOF LEFT JOIN shares s ON p.symbol = s.symbol AND p.t >= s."asOfDate\"""",
    "probe shares",
)
def j1(spark, sf):
    return J.asof_backward(probes(spark, sf), B.shares(spark, sf), "symbol", "t", "asOfDate", ["sharesOutstanding"])


@query(
    "J1_asof_backward_many",
    """
SELECT p.symbol, CAST(p.date AS VARCHAR) AS date, round(p.close, 6) AS close, CAST(s."asOfDate" AS VARCHAR) AS "asOfDate_found", s."sharesOutstanding"
FROM px p ASOF LEFT JOIN shares s ON p.symbol = s.symbol AND p.date >= s."asOfDate\"""",
    "px shares",
)
def j1_many(spark, sf):
    px = B.adjusted(spark, sf).select("symbol", "date", "close")
    return J.asof_backward_many(px, B.shares(spark, sf), "symbol", "date", "asOfDate", ["sharesOutstanding"])


@query(
    "J2_asof_step_back",
    """
SELECT symbol, CAST(max(t) AS VARCHAR) AS t, max(CASE WHEN k = 1 THEN CASE WHEN "sharesOutstanding_shares" > 0 THEN "sharesOutstanding_shares" ELSE "sharesOutstanding_profile" END END) AS shares_out,
  CAST(max(CASE WHEN k = 1 THEN "ipoDate" END) AS VARCHAR) AS "ipoDate", arg_min(employees, k) FILTER (WHERE employees >= 0 AND k <= 3) AS employees
FROM (SELECT p.symbol, p.t, c.*, row_number() OVER (PARTITION BY p.symbol ORDER BY c."asOfDate" DESC) AS k
      FROM probe p LEFT JOIN cfacts c ON c.symbol = p.symbol AND c."asOfDate" <= p.t) GROUP BY symbol""",
    "probe cfacts",
)
def j2(spark, sf):
    values = ["ipoDate", "sharesOutstanding_shares", "sharesOutstanding_profile"]
    j = J.asof_step_back(probes(spark, sf), B.company_facts(spark, sf), "symbol", "t", "asOfDate", values, "employees", F.col("employees") >= 0)
    return j.select("symbol", "t", facts_shares("sharesOutstanding_shares", "sharesOutstanding_profile").alias("shares_out"), "ipoDate", "employees")


@query(
    "J3_asof_offset_tolerance",
    """
SELECT p.symbol, CASE WHEN date_diff('day', s."asOfDate", p.t - 365) <= 120 THEN s."sharesOutstanding" END AS shares_1y, h."securitiesOwned" AS held_90d
FROM (SELECT *, t - 365 AS t1, t - 90 AS t2 FROM probe) p
ASOF LEFT JOIN shares s ON p.symbol = s.symbol AND p.t1 >= s."asOfDate" ASOF LEFT JOIN held h ON p.symbol = h.symbol AND p.t2 >= h."asOfDate\"""",
    "probe shares held",
)
def j3(spark, sf):
    p = probes(spark, sf)
    a = J.asof_backward(p, B.shares(spark, sf), "symbol", "t", "asOfDate", ["sharesOutstanding"], 365, 120)
    held = A.dedupe_max_then_sum(B.holdings(spark, sf), ["symbol", "asOfDate"], "reportingName", "securitiesOwned")
    b = J.asof_backward(p, held, "symbol", "t", "asOfDate", ["securitiesOwned"], 90)
    return a.select("symbol", F.col("sharesOutstanding").alias("shares_1y")).join(
        b.select("symbol", F.col("securitiesOwned").alias("held_90d")), "symbol"
    )


@query(
    "J4_asof_nearest",
    """
SELECT p.symbol, round((SELECT eps_ttm FROM eps e WHERE e.symbol = p.symbol AND eps_ttm IS NOT NULL AND abs(date_diff('day', e."fiscalDate", p.t - 365)) <= 180
  ORDER BY abs(date_diff('day', e."fiscalDate", p.t - 365)), e."fiscalDate" LIMIT 1), 6) AS eps_1y FROM probe p""",
    "probe eps",
)
def j4(spark, sf):
    s = W.rolling_ttm_ratio(B.financials(spark, sf), order=["period"])
    return J.asof_nearest(probes(spark, sf), s, "symbol", F.date_sub("t", 365), "fiscalDate", "eps_ttm", name="eps_1y").select("symbol", "eps_1y")


@query(
    "J5_range_sum",
    """
SELECT p.symbol, round(sum(CASE WHEN "exDate" BETWEEN t - 365 AND t THEN dividend END), 6) AS ttm,
  round(sum(CASE WHEN "exDate" BETWEEN CAST(t - INTERVAL 3 YEAR AS DATE) - 365 AND CAST(t - INTERVAL 3 YEAR AS DATE) THEN dividend END), 6) AS ago_3y,
  round(sum(CASE WHEN "exDate" BETWEEN CAST(t - INTERVAL 5 YEAR AS DATE) - 365 AND CAST(t - INTERVAL 5 YEAR AS DATE) THEN dividend END), 6) AS ago_5y
FROM probe p LEFT JOIN divs d USING (symbol) GROUP BY p.symbol""",
    "probe divs",
)
def j5(spark, sf):
    return J.range_sum(probes(spark, sf), B.dividends(spark, sf), "symbol", "t", "exDate", "dividend", J.dividend_windows("t")).drop("t")


@query(
    "J6_range_signed_sum",
    """
SELECT p.symbol, CASE WHEN count(x."transactionDate") > 0 THEN coalesce(sum(sign * "securitiesTransacted"), 0.0) END AS net_shares
FROM probe p LEFT JOIN (SELECT *, CASE WHEN "acquisitionOrDisposition" = 'A' THEN 1 WHEN "acquisitionOrDisposition" = 'D' THEN -1
   WHEN regexp_matches(lower("transactionType"), 'sale|sell|disposed') THEN -1 WHEN regexp_matches(lower("transactionType"), 'buy|purchase|acquired') THEN 1 END AS sign FROM itx) x
  ON x.symbol = p.symbol AND x."transactionDate" > p.t - 90 AND x."transactionDate" <= p.t GROUP BY p.symbol""",
    "probe itx",
)
def j6(spark, sf):
    return J.range_signed_sum(
        probes(spark, sf), B.transactions(spark, sf), "symbol", "t", "transactionDate", "securitiesTransacted", "acquisitionOrDisposition", "transactionType"
    ).drop("t")


@query(
    "J7_next_or_previous_event",
    """
SELECT p.symbol, CAST(coalesce(min(CASE WHEN "paymentDate" > t THEN "paymentDate" END), max(CASE WHEN "paymentDate" <= t THEN "paymentDate" END)) AS VARCHAR) AS event_date
FROM probe p LEFT JOIN divs d USING (symbol) GROUP BY p.symbol""",
    "probe divs",
)
def j7(spark, sf):
    return J.next_or_previous_event(probes(spark, sf), B.dividends(spark, sf), "symbol", "t", "paymentDate").drop("t")


@query(
    "J8_fill_from_side_table",
    """
SELECT p.symbol, CAST(p.date AS VARCHAR) AS date, round(coalesce(p."adjClose", CASE WHEN g.m >= 0.33 THEN s.adj END), 6) AS "adjClose"
FROM prices p JOIN (SELECT symbol, avg(CASE WHEN "adjClose" IS NULL THEN 1 ELSE 0 END) AS m FROM prices GROUP BY symbol) g USING (symbol)
LEFT JOIN (SELECT symbol, date, open * 0.5 AS adj FROM prices WHERE volume > 20) s USING (symbol, date)""",
    "prices",
)
def j8(spark, sf):
    p = B.prices(spark, sf)
    # Every day comes twice in the feed; the later value counts.
    side = p.filter("volume > 20").select("symbol", "date", F.posexplode(F.array(F.col("open") * 7, F.col("open") * 0.5)).alias("at", "adjClose"))
    return J.fill_from_side_table(p, side, "symbol", ["symbol", "date"], "adjClose", 0.33, ["at"]).select("symbol", "date", "adjClose")


@query(
    "J9_priority_lookup",
    """
SELECT c_custkey, tick, max(cik) AS cik FROM (
  SELECT c_custkey, 'S' || (c_custkey // 10) || CASE WHEN c_mktsegment = 'BUILDING' THEN 'A' ELSE '' END AS tick, c_mktsegment FROM customer) u
LEFT JOIN (SELECT CASE WHEN s_suppkey > 50 THEN 'S' || s_suppkey ELSE 'S' || s_suppkey || '-A' END AS listed, lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS cik FROM supplier) l
  ON listed = tick OR (c_mktsegment = 'BUILDING' AND length(tick) >= 3 AND listed = left(tick, length(tick) - 1) || '-A')
GROUP BY c_custkey, tick""",
)
def j9(spark, sf):
    c = B.table(spark, sf, "customer")
    building = F.col("c_mktsegment") == "BUILDING"
    tick = F.concat(F.lit("S"), F.floor(F.col("c_custkey") / 10).cast("string"), F.when(building, F.lit("A")).otherwise(F.lit("")))
    name = F.when(building, F.lit("Some Corp Class A")).otherwise(F.lit("Some Corp"))
    u = c.select("c_custkey", tick.alias("tick"), name.alias("name"))
    s = B.suppliers(spark, sf)
    listed = s.select(
        F.when(F.col("s_suppkey") > 50, F.col("symbol")).otherwise(F.concat("symbol", F.lit("-A"))).alias("listed"),
        F.lpad(F.col("s_suppkey").cast("string"), 10, "0").alias("cik"),
    )
    return J.priority_lookup(u, ticker_variants("tick", "name"), listed, "listed", "cik", ["c_custkey"]).select("c_custkey", "tick", "cik")


def holdings_pairs(spark, sf):
    """Holdings lines (ticker, name) of parts against a listing of suppliers and parts."""
    p = B.table(spark, sf, "part")
    code = F.concat(F.upper(F.substring("p_type", 1, 2)), F.col("p_size").cast("string"))
    lines = p.select(F.concat(F.lit(" "), code, F.substring("p_brand", 7, 1)).alias("ticker"), F.col("p_name").alias("name"))
    master = p.select(
        F.concat(code, F.when(F.col("p_retailprice") > 950, F.lit(".")).when(F.col("p_retailprice") > 930, F.lit("-")).otherwise(F.lit("")), F.substring("p_brand", 7, 1)).alias("symbol"),
        "p_partkey",
        "p_name",
    )
    return lines, master.groupBy("symbol").agg(F.min_by("p_name", "p_partkey").alias("name"))


# Token-set score in SQL. Word lists become sorted texts; the common subsequence is counted with one bit per
# character of the first text (all texts here are shorter than 60 characters).
def _lcs(a: str, b: str) -> str:
    return f"""(length({a}) - bit_count(list_reduce(list_prepend((1::BIGINT << length({a})) - 1, list_transform(string_split({b}, ''),
      lambda ch: list_sum(list_transform(range(0, length({a})), lambda i: CASE WHEN substr({a}, (i + 1)::INT, 1) = ch THEN 1::BIGINT << i::INT ELSE 0 END))::BIGINT)),
      lambda r, m: ((r + (r & m)) | (r - (r & m))) & ((1::BIGINT << length({a})) - 1))))"""


RESOLVED = f"""
WITH part_codes AS (SELECT *, upper(left(p_type, 2)) || p_size AS code, substr(p_brand, 7, 1) AS tail FROM part),
lines AS (SELECT DISTINCT ' ' || code || tail AS ticker, p_name AS name FROM part_codes),
master AS (SELECT symbol, arg_min(p_name, p_partkey) AS cand FROM (SELECT code || CASE WHEN p_retailprice > 950 THEN '.' WHEN p_retailprice > 930 THEN '-' ELSE '' END || tail AS symbol, p_name, p_partkey FROM part_codes) GROUP BY symbol),
keyed AS (SELECT *, regexp_replace(symbol, '[^A-Z0-9]', '', 'g') AS k FROM master),
sizes AS (SELECT k, count(*) AS n, min(symbol) AS one FROM keyed GROUP BY k),
base AS (SELECT l.*, upper(trim(ticker)) AS t, e.symbol AS exact, s.k, s.n, s.one FROM lines l LEFT JOIN master e ON e.symbol = upper(trim(ticker)) LEFT JOIN sizes s ON s.k = regexp_replace(upper(ticker), '[^A-Z0-9]', '', 'g')),
pairs AS (SELECT b.ticker, b.name, m.symbol, list_sort(list_intersect(x, y)) AS both_words, list_sort(list_filter(x, lambda w: NOT list_contains(y, w))) AS ra, list_sort(list_filter(y, lambda w: NOT list_contains(x, w))) AS rb
  FROM base b JOIN keyed m ON m.k = b.k CROSS JOIN LATERAL (SELECT list_distinct(string_split(b.name, ' ')) AS x, list_distinct(string_split(m.cand, ' ')) AS y) w WHERE b.exact IS NULL AND b.n > 1),
texts AS (SELECT *, array_to_string(both_words, ' ') AS sh, trim(array_to_string(list_concat(both_words, ra), ' ')) AS fa, trim(array_to_string(list_concat(both_words, rb), ' ')) AS fb FROM pairs),
scored AS (SELECT ticker, name, symbol, CASE WHEN len(both_words) > 0 AND (len(ra) = 0 OR len(rb) = 0) THEN 100.0
   WHEN len(both_words) = 0 THEN 200.0 * {_lcs("fa", "fb")} / (length(fa) + length(fb))
   ELSE greatest(200.0 * {_lcs("fa", "fb")} / (length(fa) + length(fb)), 200.0 * length(sh) / (length(sh) + length(fa)), 200.0 * length(sh) / (length(sh) + length(fb))) END AS score FROM texts),
best AS (SELECT ticker, name, max(CASE WHEN r = 1 THEN symbol END) AS sym, max(CASE WHEN r = 1 THEN score END) AS top, max(CASE WHEN r = 2 THEN score END) AS second
  FROM (SELECT *, row_number() OVER (PARTITION BY ticker, name ORDER BY score DESC, symbol) AS r FROM scored) GROUP BY ticker, name),
kinds AS (SELECT b.*, x.sym, x.top, CASE WHEN exact IS NOT NULL THEN 'EXACT' WHEN n IS NULL THEN 'REJECT' WHEN n = 1 THEN 'NORMALIZED' WHEN top >= 90 AND top - second >= 5 THEN 'NAME_FUZZY' ELSE 'AMBIGUOUS' END AS kind
  FROM base b LEFT JOIN best x ON x.ticker = b.ticker AND x.name = b.name)
SELECT ticker, name, CASE kind WHEN 'EXACT' THEN t WHEN 'NORMALIZED' THEN one WHEN 'NAME_FUZZY' THEN sym ELSE '' END AS ticker_fixed, kind AS match_type,
  CASE WHEN kind IN ('NAME_FUZZY', 'AMBIGUOUS') THEN round(top::DOUBLE, 6) END AS match_score, CASE kind WHEN 'EXACT' THEN 1 WHEN 'REJECT' THEN 0 ELSE n END::BIGINT AS candidate_count,
  CASE kind WHEN 'REJECT' THEN 'no_symbol_match' WHEN 'AMBIGUOUS' THEN 'fuzzy_tie_or_low_score' END AS reason FROM kinds"""


@query("J10_blocked_fuzzy_match", RESOLVED)
def j10(spark, sf):
    lines, master = holdings_pairs(spark, sf)
    return M.resolve_tickers(lines, master, "ticker", "name")


@query(
    "J11_select_fact_for_slot",
    """
SELECT cik, slot, metric, CAST("end" AS VARCHAR) AS "end", CAST("start" AS VARCHAR) AS "start", round(val, 6) AS val, tag, unit, accn, fy, fp, form, CAST(filed AS VARCHAR) AS filed, match_basis
FROM picked""",
    "picked",
    )
def j11(spark, sf):
    return picked(spark, sf).drop("frame")


_INTEREST = """
SELECT s.cik, s.slot, CAST(s."end" AS VARCHAR) AS slot_end, CAST(x."end" AS VARCHAR) AS "end", round(x.val, 6) AS val, x.tag, x.accn, x.src AS interest_source, x.basis AS match_basis, x."start" AS start_date
FROM slots s LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY cik, slot ORDER BY step, dist, o2, rk1, fym, fpm, fut, gap, acc DESC NULLS LAST, rk, doc_pos, src_pos) AS k FROM (
    SELECT s.cik, s.slot, f."end", f."start", f.val, f.tag, f.accn, CASE WHEN f.tag = 'InterestPaidNet' THEN 'CFS' ELSE 'PNL' END AS src,
      CASE WHEN own THEN 'ACCN' ELSE 'END' END AS basis,
      CASE WHEN own THEN 0 WHEN f."end" = s."end" THEN 2 ELSE 4 END + CASE WHEN f.tag = 'InterestPaidNet' THEN 1 ELSE 0 END AS step,
      abs(date_diff('day', f."end", s."end")) AS dist, CASE WHEN f."end" <> s."end" THEN -length(f.accn) ELSE 0 END AS o2,
      0 AS rk1, CASE WHEN own AND f.fy <> s.fy THEN 1 ELSE 0 END AS fym, CASE WHEN own AND f.fp <> s.fp THEN 1 ELSE 0 END AS fpm,
      CASE WHEN own AND f.filed > s.filed THEN 1 ELSE 0 END AS fut, CASE WHEN own THEN abs(date_diff('day', f.filed, s.filed)) ELSE 0 END AS gap,
      CASE WHEN NOT own AND f."end" = s."end" THEN f.accn END AS acc, 0 AS rk, f.doc_pos, f.src_pos
    FROM facts f JOIN slots s ON s.cik = f.cik AND abs(date_diff('day', f."end", s."end")) <= 3
    CROSS JOIN LATERAL (SELECT f."end" = s."end" AND f.accn = s.accn AND coalesce(date_diff('day', f."start", f."end") BETWEEN 60 AND 400, true) AS own) o
    WHERE f.tag IN ('InterestExpense', 'InterestPaidNet'))
) x ON x.cik = s.cik AND x.slot = s.slot AND x.k = 1
"""
_CONCEPT = """
  SELECT * FROM (SELECT s.cik, s.slot, r."end", r."start", r.val, r.tag, r.accn, r.form,
      CASE WHEN r.tag = 'InterestPaid' THEN 'CONCEPT_CFO' ELSE 'CONCEPT_PNL' END AS interest_source,
      row_number() OVER (PARTITION BY s.cik, s.slot ORDER BY abs(date_diff('day', r."end", s."end")), r.accn <> s.accn, NOT (r.filed <= s.filed),
        abs(date_diff('day', r.filed, s.filed)), r.form NOT IN ('10-Q', '10-K'), r.tag = 'InterestPaid', r."end" DESC, r.filed DESC, r.accn DESC, r.tag_rank, r.src_pos) AS k
    FROM concepts r JOIN slots s ON s.cik = r.cik AND abs(date_diff('day', r."end", s."end")) <= 7) WHERE k = 1
"""


@query(
    "J12_select_interest_for_slot",
    f"""
SELECT i.cik, i.slot, i.slot_end, coalesce(i."end", CAST(c."end" AS VARCHAR)) AS "end", coalesce(i.val, round(c.val, 6)) AS val, coalesce(i.tag, c.tag) AS tag,
  coalesce(i.accn, c.accn) AS accn, coalesce(i.interest_source, c.interest_source) AS interest_source,
  coalesce(i.match_basis, CASE WHEN c.cik IS NOT NULL THEN 'CONCEPT' END) AS match_basis
FROM ({_INTEREST}) i LEFT JOIN ({_CONCEPT}) c ON c.cik = i.cik AND c.slot = i.slot""",
    "slots facts concepts",
    )
def j12(spark, sf):
    f = facts(spark, sf)
    c = read_concept_records(B.concept_documents(spark, sf))
    i = X.select_interest_for_slot(f, A.build_slots(f), c)
    return i.select("cik", "slot", "slot_end", "end", "val", "tag", "accn", "interest_source", "match_basis")


@query(
    "J13_select_concept_for_slot",
    f'SELECT cik, slot, CAST("end" AS VARCHAR) AS "end", CAST("start" AS VARCHAR) AS "start", round(val, 6) AS val, tag, accn, form, interest_source FROM ({_CONCEPT})',
    "slots concepts",
    )
def j13(spark, sf):
    c = read_concept_records(B.concept_documents(spark, sf))
    out = X.select_concept_for_slot(c, A.build_slots(facts(spark, sf)))
    return out.select("cik", "slot", "end", "start", "val", "tag", "accn", "form", "interest_source")


_SHARED = "SELECT c_custkey, c_name, 'S' || (c_custkey // 10) AS symbol, c_custkey AS pos FROM customer"


@query(
    "J14_replicate_shared_key",
    f"""
SELECT 'copy' AS strategy, n.c_custkey, n.c_name, n.symbol, round(t.revenue, 6) AS revenue FROM ({_SHARED}) n JOIN ttm t USING (symbol)
UNION ALL
SELECT 'skip', n.c_custkey, n.c_name, n.symbol, round(t.revenue, 6)
FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY pos) AS k FROM ({_SHARED})) n JOIN ttm t USING (symbol) WHERE k = 1""",
    "ttm",
    )
def j14(spark, sf):
    c = B.table(spark, sf, "customer")
    names = c.select("c_custkey", "c_name", F.concat(F.lit("S"), F.floor(F.col("c_custkey") / 10).cast("string")).alias("symbol"), F.col("c_custkey").alias("pos"))
    t = A.ttm_block(B.financials(spark, sf), ties=["period"]).select("symbol", "revenue")
    cols = ["c_custkey", "c_name", "symbol", "revenue"]
    parts = [J.replicate_shared_key(names, t, "symbol", "pos", s).select(F.lit(s).alias("strategy"), *cols) for s in ("copy", "skip")]
    return parts[0].union(parts[1])


@query(
    "J15_feature_assembly",
    """
SELECT p.symbol, CAST(p.t AS VARCHAR) AS t, round(t.revenue, 6) AS revenue, s."sharesOutstanding", x."targetPrice", d.ttm
FROM probe p LEFT JOIN ttm t USING (symbol)
LEFT JOIN (SELECT symbol, arg_max("sharesOutstanding", "asOfDate") FILTER (WHERE "sharesOutstanding" IS NOT NULL) AS "sharesOutstanding" FROM shares GROUP BY symbol) s USING (symbol)
LEFT JOIN (SELECT symbol, arg_max("targetPrice", "asOfDate") FILTER (WHERE "targetPrice" IS NOT NULL) AS "targetPrice" FROM targets GROUP BY symbol) x USING (symbol)
LEFT JOIN (SELECT p.symbol, round(sum(CASE WHEN "exDate" BETWEEN t - 365 AND t THEN dividend END), 6) AS ttm FROM probe p JOIN divs USING (symbol) GROUP BY 1) d USING (symbol)""",
    "probe ttm shares targets divs",
    )
def j15(spark, sf):
    p = probes(spark, sf)
    features = [
        A.ttm_block(B.financials(spark, sf), ties=["period"]).select("symbol", "revenue"),
        A.latest_composite_row(B.shares(spark, sf), "symbol", "asOfDate", ["sharesOutstanding"]).drop("asOfDate"),
        A.latest_composite_row(B.targets(spark, sf), "symbol", "asOfDate", ["targetPrice"]).drop("asOfDate"),
        J.range_sum(p, B.dividends(spark, sf), "symbol", "t", "exDate", "dividend", {"ttm": J.dividend_windows("t")["ttm"]}).drop("t"),
    ]
    return J.feature_assembly(p, features, "symbol")


def daily_returns(spark, sf):
    st = B.adjusted(spark, sf).withColumn("ret", W.returns("close", W.by_key())).select("symbol", "date", "ret")
    mk = W.price_series(B.market(spark, sf), ["close"]).withColumn("ret", W.returns("close", W.by_key())).select("date", "ret")
    return J.aligned_returns(st, mk, "date")


@query(
    "J16_aligned_returns",
    """
SELECT symbol, CAST(date AS VARCHAR) AS date, round(i.ret, 6) AS stock_ret, round(m.ret, 6) AS mkt_ret
FROM ind i JOIN (SELECT date, close / lag(close) OVER (ORDER BY date) - 1 AS ret FROM market) m USING (date) WHERE i.ret IS NOT NULL AND m.ret IS NOT NULL""",
    "ind market",
)
def j16(spark, sf):
    return daily_returns(spark, sf).select("symbol", "date", "stock_ret", "mkt_ret")


@query(
    "J17_calendar_consistency",
    """
SELECT symbol, CAST(cd AS VARCHAR) AS calendar_date, CAST(ed AS VARCHAR) AS ex_date,
  CASE WHEN cd IS NULL THEN 'MISSING_CALENDAR' WHEN ed IS NULL THEN 'MISSING_EXDATE' WHEN cd = ed THEN 'MATCH' ELSE 'MISMATCH' END AS status
FROM (SELECT symbol, arg_min(date, l_orderkey) AS cd FROM (SELECT symbol, l_orderkey, min(date) AS date FROM li WHERE l_returnflag = 'R' GROUP BY ALL) GROUP BY symbol)
FULL JOIN (SELECT symbol, arg_min(date, l_orderkey) AS ed FROM (SELECT symbol, l_orderkey, min(date) AS date FROM li GROUP BY ALL) GROUP BY symbol) USING (symbol)""",
    "li",
)
def j17(spark, sf):
    li = B.lines(spark, sf)
    cal = li.filter("l_returnflag = 'R'").groupBy("symbol", "l_orderkey").agg(F.min("date").alias("d"))
    ev = li.groupBy("symbol", "l_orderkey").agg(F.min("date").alias("d"))
    return J.calendar_consistency(cal, ev, "symbol", "d", "d", "l_orderkey")
