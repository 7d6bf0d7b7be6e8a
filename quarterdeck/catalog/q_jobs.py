"""Queries of the composed jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterdeck.catalog import bindings as B
from quarterdeck.catalog.q_aggregates import DILUTION, EPS_YOY
from quarterdeck.catalog.q_formulas import DIVIDEND_SUMS, GROWTH, INDICATORS, PLACES, WIDE, growth_sql
from quarterdeck.catalog.q_joins import _CONCEPT, _INTEREST, RESOLVED, facts, holdings_pairs
from quarterdeck.catalog.q_payloads import TRANSACTIONS_SQL, insider_rows
from quarterdeck.catalog.registry import query
from quarterdeck.functions import fixed
from quarterdeck.operators import formulas as R
from quarterdeck.operators import payloads as N
from quarterdeck.plans import company_facts as C
from quarterdeck.plans import factors as P
from quarterdeck.plans import ingest as I
from quarterdeck.plans import quality as Q
from quarterdeck.plans import universe as U
from quarterdeck.session import materialise, scratch_path
from quarterdeck.sources.xbrl import read_concept_records

# ---- C1 ------------------------------------------------------------------------------------------------------

_LAGS = {"Perf Week": 5, "Perf Month": 21, "Perf Quarter": 63, "Perf Half Y": 126, "Perf Year": 252, "Perf 3Y": 756, "Perf 5Y": 1260, "Perf 10Y": 2520}


def _over(fn: str, c: str, n: int) -> str:
    return f"CASE WHEN rn >= {n} THEN {fn}({c}) OVER (PARTITION BY symbol ORDER BY date ROWS {n - 1} PRECEDING) END"


_PRICE = {
    "Price": "close",
    "Prev Close": "prev",
    "Change": "(close - prev) / nullif(prev, 0)",
    "Volume": "volume",
    "Avg Volume": _over("avg", "volume", 63),
    "Rel Volume": f"volume / nullif({_over('avg', 'volume', 63)}, 0)",
    **{f"SMA{n}": _over("avg", "close", n) for n in (20, 50, 200)},
    "52W High": _over("max", "close", 250),
    "52W Low": _over("min", "close", 250),
    "Volatility": "CASE WHEN count(ret) OVER (PARTITION BY symbol ORDER BY date ROWS 62 PRECEDING) = 63 THEN stddev_samp(ret) OVER (PARTITION BY symbol ORDER BY date ROWS 62 PRECEDING) END",
    "ATR(14)": "CASE WHEN rn >= 15 THEN (sum(tr) OVER (PARTITION BY symbol ORDER BY date ROWS 13 PRECEDING) + lag(own, 14) OVER (PARTITION BY symbol ORDER BY date)) / 15 END",
    **{k: f"close / nullif(lag(close, {n}) OVER (PARTITION BY symbol ORDER BY date), 0) - 1" for k, n in _LAGS.items()},
    "Perf YTD": "close / nullif(first_value(close) OVER (PARTITION BY symbol, year(date) ORDER BY date), 0) - 1",
}
_RSI = """SELECT symbol, CASE WHEN max(n) >= 15 THEN CASE WHEN sum(l * wt) = 0 THEN CASE WHEN sum(g * wt) > 0 THEN 100.0 END ELSE 100.0 - 100.0 / (1 + sum(g * wt) / sum(l * wt)) END END AS rsi
  FROM (SELECT symbol, n, greatest(close - prev, 0) AS g, greatest(prev - close, 0) AS l, CASE WHEN rn <= 15 THEN power(13.0 / 14.0, n - 15) ELSE power(13.0 / 14.0, n - rn) END / 14.0 AS wt FROM ind WHERE rn > 1) GROUP BY symbol"""
_INSIDER = """
SELECT p.symbol, CASE WHEN base > 0 THEN round(greatest(0, least(100, 100.0 * h.v / base)), 2) END AS own,
  CASE WHEN base > 0 AND coalesce(h.v - g.v, net.v) IS NOT NULL THEN round(greatest(-99, least(99, 100.0 * coalesce(h.v - g.v, net.v) / base)), 2) END AS trans, h.v AS held
FROM (SELECT *, t - 90 AS t2 FROM probe) p
ASOF LEFT JOIN (SELECT symbol, "asOfDate", "securitiesOwned" AS v FROM held) h ON h.symbol = p.symbol AND p.t >= h."asOfDate"
ASOF LEFT JOIN (SELECT symbol, "asOfDate", "securitiesOwned" AS v FROM held) g ON g.symbol = p.symbol AND p.t2 >= g."asOfDate"
ASOF LEFT JOIN cfacts c ON c.symbol = p.symbol AND p.t >= c."asOfDate"
LEFT JOIN (SELECT symbol, arg_max("sharesOutstanding", "asOfDate") AS so FROM shares GROUP BY symbol) s ON s.symbol = p.symbol
LEFT JOIN (SELECT symbol, arg_max("sharesOutstanding", "fiscalDate") FILTER (WHERE "sharesOutstanding" IS NOT NULL) AS so FROM fin GROUP BY symbol) f ON f.symbol = p.symbol
LEFT JOIN (SELECT p.symbol, coalesce(sum(sign * "securitiesTransacted"), 0.0) AS v FROM probe p JOIN (SELECT *, CASE WHEN "acquisitionOrDisposition" = 'A' THEN 1 WHEN "acquisitionOrDisposition" = 'D' THEN -1
   WHEN "transactionType" = 'S-Sale' THEN -1 WHEN "transactionType" IN ('P-Purchase', 'Acquired by gift') THEN 1 END AS sign FROM itx) x
   ON x.symbol = p.symbol AND x."transactionDate" > p.t - 90 AND x."transactionDate" <= p.t GROUP BY p.symbol) net ON net.symbol = p.symbol
CROSS JOIN LATERAL (SELECT CASE WHEN CASE WHEN c."sharesOutstanding_shares" > 0 THEN c."sharesOutstanding_shares" ELSE c."sharesOutstanding_profile" END > 0
   THEN CASE WHEN c."sharesOutstanding_shares" > 0 THEN c."sharesOutstanding_shares" ELSE c."sharesOutstanding_profile" END
   WHEN coalesce(s.so, f.so) > 0 THEN coalesce(s.so, f.so) END AS base) b"""
_FACTS_AT = """
SELECT symbol, max(CASE WHEN k = 1 THEN "ipoDate" END) AS ipo, arg_min(employees, k) FILTER (WHERE employees >= 0 AND k <= 3) AS emp
FROM (SELECT p.symbol, c."ipoDate", c.employees, row_number() OVER (PARTITION BY p.symbol ORDER BY c."asOfDate" DESC) AS k FROM probe p JOIN cfacts c ON c.symbol = p.symbol AND c."asOfDate" <= p.t) GROUP BY symbol"""


def _yoy(value: str, test: str) -> str:
    return f"""(SELECT symbol, s1 / s2 - 1 AS v FROM (SELECT symbol, sum(CASE WHEN rn <= 4 THEN "{value}" END) AS s1, sum(CASE WHEN rn > 4 THEN "{value}" END) AS s2, count("{value}") AS n
  FROM finr WHERE rn <= 8 GROUP BY symbol) WHERE n = 8 AND s2 {test} 0)"""


_EXPR = {
    **{k: f'x."{k}"' for k in _PRICE},
    **{k: f'i."{k}"' for k in R.INDICATORS},
    "RSI(14)": "rsi.rsi",
    "Beta": "betas.beta",
    "Revenue YoY": "yr.v",
    "OCF YoY": "yo.v",
    "OCF/NI": "oni.v",
    "EPS YoY": "ey.eps_yoy",
    "Share Dilution": "dil.share_dilution",
    "Interest Coverage": "ic.v",
    "OPM volatility": "ov.v",
    "Dividend TTM": "dv.ttm",
    "Dividend Est": "dv.ttm",
    "Dividend Gr. 3Y": growth_sql("ago_3y", 3).replace("ttm", "dv.ttm").replace("ago_3y", "dv.ago_3y"),
    "Dividend Gr. 5Y": growth_sql("ago_5y", 5).replace("ttm", "dv.ttm").replace("ago_5y", "dv.ago_5y"),
    "Employees": "fa.emp",
    "Shs Float": "sf.v",
    "Target Price": "tg.v",
    "EPS This Y": "g.this_y",
    "EPS Next Y": "g.next_y",
    "EPS Next Q": "eq.v",
    "EPS Next 5Y": "g.growth",
    "Forward P/E": 'x."Price" / nullif(g.next_y, 0)',
    "PEG": 'CASE WHEN g.growth > 0 THEN i."P/E" / g.growth END',
}
_TEXT = {
    "asOfDate": "CAST(x.date AS VARCHAR)",
    "symbol": "x.symbol",
    "price_date": "CAST(x.date AS VARCHAR)",
    "financials_date": "CAST(i.fd AS VARCHAR)",
    "IPO (Date)": "CAST(fa.ipo AS VARCHAR)",
    "Dividend Ex-Date": "CAST(ex.d AS VARCHAR)",
    "Earnings (Date)": "NULL::VARCHAR",
    "Index": 'mb."isMember"',
    "Insider Own/Trans": "CASE WHEN ins.own IS NULL THEN 'N/A' ELSE printf('%.2f%%', ins.own::DOUBLE) END || ' / ' || CASE WHEN ins.trans IS NULL THEN 'N/A' WHEN ins.trans >= 0 THEN printf('+%.2f%%', ins.trans::DOUBLE) ELSE printf('%.2f%%', ins.trans::DOUBLE) END",
}


def _factor(c: str) -> str:
    if c in _TEXT:
        return f'{_TEXT[c]} AS "{c}"'
    if c in fixed.FACTOR_PLACEHOLDERS:
        return f'NULL::DOUBLE AS "{c}"'
    return f'round({_EXPR[c]}, {PLACES.get(c, 6)}) AS "{c}"'


FACTORS_SQL = f"""
SELECT {", ".join(_factor(c) for c in fixed.FACTOR_COLUMNS)}
FROM (SELECT * FROM (SELECT symbol, date, rn, n, {", ".join(f'{e} AS "{k}"' for k, e in _PRICE.items())}
  FROM (SELECT *, CASE WHEN prev IS NOT NULL THEN greatest(high - low, abs(high - prev), abs(low - prev)) END AS tr, greatest(high - low, abs(high - close), abs(low - close)) AS own FROM ind)) WHERE rn = n) x
LEFT JOIN ({INDICATORS}) i ON i.symbol = x.symbol
LEFT JOIN ({_RSI}) rsi ON rsi.symbol = x.symbol LEFT JOIN betas ON betas.symbol = x.symbol
LEFT JOIN {_yoy("revenue", ">")} yr ON yr.symbol = x.symbol LEFT JOIN {_yoy("operatingCashFlow", "<>")} yo ON yo.symbol = x.symbol
LEFT JOIN (SELECT symbol, sum("operatingCashFlow") / sum("netIncome") AS v FROM finr WHERE rn <= 4 GROUP BY symbol HAVING count("operatingCashFlow") = 4 AND count("netIncome") = 4 AND sum("netIncome") <> 0) oni ON oni.symbol = x.symbol
LEFT JOIN ({EPS_YOY}) ey ON ey.symbol = x.symbol LEFT JOIN ({DILUTION}) dil ON dil.symbol = x.symbol
LEFT JOIN (SELECT symbol, sum("operatingIncome") / abs(sum("operatingIncome") - sum("incomeBeforeTax")) AS v FROM finr WHERE rn <= 4 GROUP BY symbol HAVING count(*) = 4 AND abs(sum("operatingIncome") - sum("incomeBeforeTax")) >= 1e-12) ic ON ic.symbol = x.symbol
LEFT JOIN (SELECT symbol, stddev_samp("operatingIncome" / revenue) AS v FROM finr WHERE rn <= 8 AND revenue <> 0 GROUP BY symbol HAVING count("operatingIncome" / revenue) >= 4) ov ON ov.symbol = x.symbol
LEFT JOIN ({DIVIDEND_SUMS}) dv ON dv.symbol = x.symbol
LEFT JOIN (SELECT p.symbol, coalesce(min(CASE WHEN "exDate" > t THEN "exDate" END), max(CASE WHEN "exDate" <= t THEN "exDate" END)) AS d FROM probe p JOIN divs USING (symbol) GROUP BY 1) ex ON ex.symbol = x.symbol
LEFT JOIN ({_FACTS_AT}) fa ON fa.symbol = x.symbol
LEFT JOIN (SELECT symbol, arg_max("sharesFloat", "asOfDate") FILTER (WHERE "sharesFloat" IS NOT NULL) AS v FROM shares GROUP BY symbol) sf ON sf.symbol = x.symbol
LEFT JOIN (SELECT symbol, arg_max("targetPrice", "asOfDate") FILTER (WHERE "targetPrice" IS NOT NULL) AS v FROM targets GROUP BY symbol) tg ON tg.symbol = x.symbol
LEFT JOIN (SELECT symbol, arg_max("epsNextQ", "asOfDate") FILTER (WHERE "epsNextQ" IS NOT NULL) AS v FROM estq GROUP BY symbol) eq ON eq.symbol = x.symbol
LEFT JOIN ({GROWTH}) g ON g.symbol = x.symbol
LEFT JOIN (SELECT "memberSymbol", "isMember" FROM members WHERE "asOfDate" = (SELECT max("asOfDate") FROM members)) mb ON mb."memberSymbol" = x.symbol
LEFT JOIN ({_INSIDER}) ins ON ins.symbol = x.symbol"""
_C1 = "ind betas fin finr ttm shares probe divs eps est estq targets members held cfacts itx"


@query("C1_factors_job", FACTORS_SQL, _C1, places=PLACES)
def c1(spark, sf):
    return P.factor_rows(B.factor_inputs(spark, sf))


@query(
    "C1_factors_coverage",
    f"SELECT count(*) AS n_rows, count(DISTINCT symbol) AS n_keys, {', '.join(f'''count("{c}") AS "{c}"''' for c in fixed.FACTOR_COLUMNS if c not in ('asOfDate', 'symbol'))} FROM ({FACTORS_SQL})",
    _C1,
)
def c1_coverage(spark, sf):
    return P.coverage(P.factor_rows(B.factor_inputs(spark, sf)))


# ---- C2 ------------------------------------------------------------------------------------------------------


def classified(spark, sf):
    lines, master = holdings_pairs(spark, sf)
    p = B.table(spark, sf, "part").select("p_partkey", "p_size", "p_name", "p_type", "p_brand")
    kind = F.when(F.col("p_size") < 5, F.lit("Cash")).when(F.col("p_size") < 30, F.lit("Equity")).otherwise(F.lit("ETF"))
    code = F.concat(F.upper(F.substring("p_type", 1, 2)), F.col("p_size").cast("string"), F.substring("p_brand", 7, 1))
    rows = p.select(
        F.lit("f").alias("file"), F.col("p_partkey").alias("pos"), F.when(F.col("p_size") == 20, F.lit("")).otherwise(code).alias("ticker_raw"),
        F.col("p_name").alias("name_raw"), kind.alias("asset_class"), F.col("p_size").cast("string").alias("weight"),
    )
    return U.classify(rows, master)


_CLASSIFIED = f"""
SELECT q.p_partkey AS pos, CASE WHEN p_size = 20 THEN '' ELSE code END AS ticker_raw, p_name AS name_raw,
  CASE WHEN p_size = 20 OR bad THEN '' ELSE r.ticker_fixed END AS ticker_fixed, CASE WHEN p_size = 20 OR bad THEN 'REJECT' ELSE r.match_type END AS match_type,
  CASE WHEN NOT (p_size = 20 OR bad) THEN r.match_score END AS match_score, CASE WHEN p_size = 20 OR bad THEN 0 ELSE r.candidate_count END::BIGINT AS candidate_count,
  CASE WHEN p_size = 20 THEN 'empty_ticker' WHEN bad THEN 'non_equity' ELSE r.reason END AS reason, CAST(p_size AS VARCHAR) AS weight
FROM (SELECT *, upper(left(p_type, 2)) || p_size || substr(p_brand, 7, 1) AS code, p_size < 5 OR p_size >= 30 AS bad FROM part) q
JOIN ({RESOLVED}) r ON r.ticker = ' ' || q.code AND r.name = q.p_name"""


@query("C2_universe_job", _CLASSIFIED)
def c2(spark, sf):
    return classified(spark, sf).drop("file")


@query("C2_reject_reasons", f"SELECT reason, count(*) AS n FROM ({_CLASSIFIED}) WHERE match_type = 'REJECT' GROUP BY reason ORDER BY n DESC, reason LIMIT 10")
def c2_reasons(spark, sf):
    return U.reject_reasons(classified(spark, sf))


# ---- C3, C4 ----------------------------------------------------------------------------------------------------

_SOURCED = {"Revenue": "rev", "NetIncome": "ni", "InterestExpense": "ie", "CostOfRevenue": "cost", "SGnA": "sga"}
_STOCKS = {"Assets": "a", "Liabilities": "l", "Equity": "e", "SharesOutstanding": "so"}


def _metric(m: str) -> str:
    quarter = m.endswith("_Quarter")
    base, suf = m.removesuffix("_Quarter"), "_q" if quarter else ""
    if base in _SOURCED:
        return f'round(w.{_SOURCED[base]}{suf}, 6) AS "{m}"'
    if base in _STOCKS and not quarter:
        return f'round(w.{_STOCKS[base]}, 6) AS "{m}"'
    if base == "GrossProfit":
        return f'CASE WHEN abs(w.rev{suf}) >= 1e-12 THEN round(w.rev{suf} - w.cost{suf}, 6) END AS "{m}"'
    if base == "OperatingExpenses":
        return f'round(w.sga{suf}, 6) AS "{m}"'
    return f'NULL::DOUBLE AS "{m}"'


QUARTERS_SQL = f"""
SELECT s.cik, s.slot, CAST(s."end" AS VARCHAR) AS "end", s.fy, s.fp, s.form, CAST(s.filed AS VARCHAR) AS filed, s.accn, {", ".join(_metric(m) for m in C.metric_columns())},
  CASE WHEN abs(w.a) >= 1e-12 THEN abs(w.a - (w.l + w.e)) / abs(w.a) <= 0.01 END AS balance_sheet_ok,
  round(CASE WHEN abs(w.a) >= 1e-12 THEN abs(w.a - (w.l + w.e)) / abs(w.a) END, 6) AS bs_diff_pct
FROM slots s LEFT JOIN ({WIDE}) w ON w.cik = s.cik AND w.slot = s.slot WHERE s.slot <= 8"""


@query("C3_xbrl_quarters_job", QUARTERS_SQL, "slots quarterised")
def c3(spark, sf):
    return C.quarters_of_documents(spark, B.documents(spark, sf), "body", "doc_pos")


_FOUND = f"""
SELECT i.cik, i.slot, 'InterestExpense' AS metric, CASE WHEN i.tag IS NULL THEN c."end" ELSE CAST(i."end" AS DATE) END AS "end", CASE WHEN i.tag IS NULL THEN c."start" ELSE i.start_date END AS "start",
  coalesce(i.val, c.val) AS val, coalesce(i.tag, c.tag) AS tag, coalesce(i.accn, c.accn) AS accn, CASE WHEN i.tag IS NULL THEN 'CONCEPT' ELSE i.match_basis END AS match_basis, coalesce(i.interest_source, c.interest_source) AS interest_source
FROM ({_INTEREST}) i LEFT JOIN ({_CONCEPT}) c ON c.cik = i.cik AND c.slot = i.slot WHERE coalesce(i.tag, c.tag) IS NOT NULL"""
_TRACED = f"""
SELECT *, CASE WHEN metric IN ('Revenue', 'NetIncome', 'InterestExpense', 'CostOfRevenue', 'SGnA') THEN CASE k WHEN 1 THEN val WHEN 2 THEN val - prev END END AS qv
FROM (SELECT *, CASE WHEN k > 0 THEN lag(val) OVER (PARTITION BY cik, metric, "start", k > 0 ORDER BY slot DESC) END AS prev
  FROM (SELECT *, CASE WHEN d BETWEEN 70 AND 110 THEN 1 WHEN d >= 330 OR d BETWEEN 150 AND 320 THEN 2 ELSE 0 END AS k
    FROM (SELECT *, date_diff('day', "start", "end") AS d FROM (
      SELECT cik, slot, metric, "end", "start", val, tag, accn, match_basis, NULL::VARCHAR AS interest_source FROM picked WHERE metric <> 'InterestExpense' UNION ALL {_FOUND}))))"""


@query(
    "C3_traced_quarters",
    f"""
SELECT t.cik, t.slot, CAST(s."end" AS VARCHAR) AS slot_end, metric, round(val, 6) AS val, round(qv, 6) AS quarter_value, tag, t.accn, match_basis, interest_source, derived_source, NULL::VARCHAR AS contamination_flag,
  CASE WHEN abs(w.a) >= 1e-12 THEN abs(w.a - (w.l + w.e)) / abs(w.a) <= 0.01 END AS balance_sheet_ok, round(CASE WHEN abs(w.a) >= 1e-12 THEN abs(w.a - (w.l + w.e)) / abs(w.a) END, 6) AS bs_diff_pct
FROM (
  SELECT cik, slot, metric, val, qv, tag, accn, match_basis, interest_source, NULL::VARCHAR AS derived_source FROM ({_TRACED})
  UNION ALL SELECT cik, slot, 'GrossProfit', CASE WHEN abs(rev) >= 1e-12 THEN rev - cost END AS v, CASE WHEN abs(rev_q) >= 1e-12 THEN rev_q - cost_q END, NULL, NULL, NULL, NULL, CASE WHEN v IS NOT NULL THEN 'REV-COGS' END FROM ({WIDE})
  UNION ALL SELECT cik, slot, 'OperatingExpenses', sga, sga_q, NULL, NULL, NULL, NULL, CASE WHEN sga IS NOT NULL THEN 'SGnA+RD' END FROM ({WIDE})) t
JOIN slots s ON s.cik = t.cik AND s.slot = t.slot LEFT JOIN ({WIDE}) w ON w.cik = t.cik AND w.slot = t.slot
WHERE t.slot <= 8 AND (val IS NOT NULL OR qv IS NOT NULL)""",
    "slots quarterised concepts",
)
def c3_traced(spark, sf):
    return C.traced_quarters(spark, facts(spark, sf), read_concept_records(B.concept_documents(spark, sf)))


def universe_lines(spark, sf):
    """Customers as universe lines: ten on each company, some excluded, some without a listing."""
    c, k = B.table(spark, sf, "customer"), F.col("c_nationkey")
    name = F.when(k == 0, F.concat("c_name", F.lit(" - CVR"))).when(k == 1, F.concat(F.lit("Cash "), "c_name")).otherwise(F.col("c_name"))
    ticker = F.when(k == 2, F.lit("USD")).when(k == 3, F.concat(F.lit("X"), "c_custkey")).otherwise(F.concat(F.lit("S"), F.floor(F.col("c_custkey") / 10).cast("string")))
    return c.select(F.col("c_custkey").alias("pos"), ticker.alias("ticker"), name.alias("name"), F.col("c_mktsegment").alias("sector"))


def listing(spark, sf):
    return B.suppliers(spark, sf).select(F.col("symbol").alias("ticker"), F.lpad(F.col("s_suppkey").cast("string"), 10, "0").alias("cik"))


def report(spark, sf, strategy="copy"):
    names = C.resolve_companies(universe_lines(spark, sf), listing(spark, sf))
    ids = listing(spark, sf)
    known = ids.filter(F.col("cik") % 10 < 8)
    return C.extraction_report(names, known, ids.filter(F.col("cik") % 10 == 8), strategy)


_REPORT = """
SELECT *, CASE WHEN excl IS NOT NULL THEN excl WHEN cik IS NULL THEN 'no_cik' WHEN cik::INT % 10 = 8 THEN 'parse_error' WHEN cik::INT % 10 = 9 THEN 'fetch_error'
  WHEN pos > min(CASE WHEN excl IS NULL AND cik IS NOT NULL THEN pos END) OVER (PARTITION BY cik) THEN 'duplicate_cik_copy' ELSE 'ok' END AS reason FROM (
  SELECT u.*, CASE WHEN excl IS NULL THEN lpad(CAST(s.s_suppkey AS VARCHAR), 10, '0') END AS cik FROM (
    SELECT c_custkey AS pos, CASE c_nationkey WHEN 2 THEN 'USD' WHEN 3 THEN 'X' || c_custkey ELSE 'S' || (c_custkey // 10) END AS ticker,
      CASE c_nationkey WHEN 0 THEN c_name || ' - CVR' WHEN 1 THEN 'Cash ' || c_name ELSE c_name END AS name, c_mktsegment AS sector,
      CASE c_nationkey WHEN 0 THEN 'excluded_cvr' WHEN 2 THEN 'excluded_currency_ticker' WHEN 1 THEN 'excluded_non_company_name' END AS excl FROM customer) u
  LEFT JOIN sup s ON s.symbol = u.ticker)"""


@query("C4_extraction_report", f"SELECT pos, ticker, name, sector, reason, coalesce(cik, '') AS cik FROM ({_REPORT})", "sup")
def c4_report(spark, sf):
    return report(spark, sf)


@query("C4_outcome_counts", f"SELECT reason, count(*) AS n FROM ({_REPORT}) GROUP BY reason", "sup")
def c4_counts(spark, sf):
    return C.outcome_counts(report(spark, sf))


def landed_facts(spark, sf):
    """Company documents with their landed names, as the job finds them: written once below the shared folder. Every tenth is cut off,
    every tenth missing, and silent companies are empty ones."""
    cik = F.substring("symbol", 2, 9).cast("long")
    docs = B.documents(spark, sf).withColumn("key", F.concat(F.lit("2024-05-01/CIK"), F.lpad(cik.cast("string"), 10, "0"), F.lit(".json")))
    docs = docs.filter(cik % 10 < 9).select("key", F.when(cik % 10 == 8, F.substring("body", 1, 60)).otherwise(F.col("body")).alias("body"))
    # Companies that file nothing in these data count as landed empty documents.
    silent = listing(spark, sf).filter(F.col("cik") % 10 < 8).select(F.concat(F.lit("CIK"), "cik").alias("key"), F.format_string('{"cik": %d, "facts": {}}', F.col("cik").cast("long")).alias("body"))
    return materialise(docs.unionByName(silent), "landed")


@query("C4_extraction_run", f"SELECT ticker, name, reason, coalesce(cik, '') AS cik FROM ({_REPORT})", "sup")
def c4_run(spark, sf):
    """The job over landed documents, some of them cut off or missing; its report is read back."""
    out = scratch_path(spark, "extraction")
    C.run(spark, universe_lines(spark, sf), listing(spark, sf), landed_facts(spark, sf), out, report_only=True)
    back = spark.read.csv(f"{out}/universe_extraction_report", header=True)
    return back.select("ticker", "name", "reason", F.coalesce("cik", F.lit("")).alias("cik"))


_BASE = ", ".join("CAST(x.fy AS BIGINT) AS fy" if c == "fy" else f'r."{c}"' if c in ("ticker", "cik", "name", "sector") else f'x."{c}"' for c in C.BASE)
_VALUES = ", ".join('CASE WHEN "Revenue" = 0 AND "GrossProfit" > 0 THEN NULL ELSE "Revenue" END AS "Revenue"' if c == "Revenue" else f'x."{c}"' for c in [*C.metric_columns(), *C.CHECKS])


@query(
    "C4_extraction_metrics",
    f"SELECT {_BASE}, {_VALUES} FROM ({_REPORT}) r JOIN ({QUARTERS_SQL}) x ON x.cik = r.cik WHERE r.reason IN ('ok', 'duplicate_cik_copy')",
    "sup slots quarterised",
)
def c4_metrics(spark, sf):
    """The whole job over landed documents, broken ones included; its quarterly file is read back."""
    out = scratch_path(spark, "extraction")
    C.run(spark, universe_lines(spark, sf), listing(spark, sf), landed_facts(spark, sf), out)
    types = {"fy": "bigint", "balance_sheet_ok": "boolean", "bs_diff_pct": "double", **dict.fromkeys(C.metric_columns(), "double")}
    schema = ", ".join(f"`{c}` {types.get(c, 'string')}" for c in [*C.BASE, *C.metric_columns(), *C.CHECKS])
    return spark.read.schema(schema).csv(f"{out}/universe_metrics_quarterly", header=True)


@query(
    "C4_universe_extract_job",
    f"""
SELECT r.pos, r.ticker, r.name, r.sector, x.* REPLACE (CASE WHEN "Revenue" = 0 AND "GrossProfit" > 0 THEN NULL ELSE "Revenue" END AS "Revenue")
FROM ({_REPORT}) r JOIN ({QUARTERS_SQL}) x ON x.cik = r.cik WHERE r.reason IN ('ok', 'duplicate_cik_copy')""",
    "sup slots quarterised",
)
def c4(spark, sf):
    return C.universe_rows(report(spark, sf), C.quarters(spark, facts(spark, sf)))


# ---- C5 ------------------------------------------------------------------------------------------------------------


_SINCE = """(SELECT * FROM (SELECT l.*, row_number() OVER (PARTITION BY l.symbol, date ORDER BY o DESC, l_tax DESC) AS k FROM li l
  LEFT JOIN (SELECT symbol, max("fiscalDate") AS w FROM fin WHERE "fiscalDate" < DATE '2000-01-01' AND symbol <> 'S1' GROUP BY symbol) f USING (symbol)
  WHERE l_linenumber = {line} AND date BETWEEN greatest(coalesce(w - 7, DATE '1996-01-01'), DATE '1996-01-01') AND DATE '2001-06-30') WHERE k = 1)"""


@query(
    "C5_financials_since",
    f"""
SELECT symbol, CAST(date AS VARCHAR) AS "fiscalDate", i.l_extendedprice AS revenue, b.l_extendedprice AS "totalAssets", c.l_tax AS "freeCashFlow"
FROM {_SINCE.format(line=1)} i FULL JOIN {_SINCE.format(line=2)} b USING (symbol, date) FULL JOIN {_SINCE.format(line=3)} c USING (symbol, date)""",
    "li fin",
)
def c5_financials(spark, sf):
    def feed(line, **fields):
        return B.landed(B.lines(spark, sf).filter(F.col("l_linenumber") == line), ["symbol", *B.ORDER, "l_tax"], date=F.col("date").cast("string"), **fields)

    stored = B.financials(spark, sf).filter("fiscalDate < date '2000-01-01' and symbol <> 'S1'")
    out = I.financials_since(
        feed(1, revenue=F.col("l_extendedprice")), feed(2, totalAssets=F.col("l_extendedprice")), feed(3, freeCashFlow=F.col("l_tax")),
        stored, "2001-06-30", "1996-01-01", [*B.ORDER, "l_tax"],
    )
    return out.select("symbol", "fiscalDate", "revenue", "totalAssets", "freeCashFlow")


# ---- C6 -----------------------------------------------------------------------------------------------------------


@query(
    "C6_quality_job",
    """
SELECT 'rows' AS section, 'prices_eod' AS check_name, count(*)::DOUBLE AS value FROM prices UNION ALL SELECT 'rows', 'earnings_events', 0.0
UNION ALL SELECT 'rows', 'financials_quarterly', count(*)::DOUBLE FROM fin
UNION ALL SELECT 'prices', 'n_rows', count(*)::DOUBLE FROM prices UNION ALL SELECT 'prices', 'n_latest', count(*)::DOUBLE FROM prices WHERE date = (SELECT max(date) FROM prices)
UNION ALL SELECT 'prices', 'lag_days', date_diff('day', max(date), DATE '2001-11-12')::DOUBLE FROM prices UNION ALL SELECT 'prices', 'stale', CASE WHEN date_diff('day', max(date), DATE '2001-11-12') > 6 THEN 1.0 ELSE 0.0 END FROM prices
UNION ALL SELECT 'prices', 'missing_rate', round(avg(CASE WHEN "adjClose" IS NULL THEN 1 ELSE 0 END), 6) FROM prices
UNION ALL SELECT 'prices', 'missing_rate_latest', round(avg(CASE WHEN "adjClose" IS NULL THEN 1 ELSE 0 END), 6) FROM prices WHERE date = (SELECT max(date) FROM prices)
UNION ALL SELECT 'financials', 'revenue_zero', count(*)::DOUBLE FROM fin WHERE revenue = 0 UNION ALL SELECT 'financials', 'revenue_missing', count(*)::DOUBLE FROM fin WHERE revenue IS NULL
UNION ALL SELECT 'financials', 'gross_profit_above_revenue', count(*)::DOUBLE FROM fin WHERE "grossProfit" > revenue
UNION ALL SELECT 'calendar', CASE WHEN c.d IS NULL THEN 'MISSING_CALENDAR' WHEN e.d IS NULL THEN 'MISSING_EXDATE' WHEN c.d = e.d THEN 'MATCH' ELSE 'MISMATCH' END, count(*)::DOUBLE
FROM (SELECT symbol, arg_min("exDate", o) AS d FROM divs WHERE dividend > 0.05 GROUP BY symbol) c FULL JOIN (SELECT symbol, arg_min("exDate", o) AS d FROM divs GROUP BY symbol) e USING (symbol) GROUP BY 2""",
    "prices fin divs",
)
def c6(spark, sf):
    p, f = B.stored_prices(spark, sf), B.financials(spark, sf)
    ev = B.dividends(spark, sf).withColumn("pos", F.struct(*B.ORDER))
    return Q.report(Q.price_days(p), f, ev.filter("dividend > 0.05"), ev, F.lit("2001-11-12").cast("date"), {"earnings_events": None})


@query(
    "C6_stored_price_days",
    """
SELECT 'rows' AS section, 'prices_eod' AS check_name, count(*)::DOUBLE AS value FROM prices
UNION ALL SELECT 'prices', 'n_rows', count(*)::DOUBLE FROM prices UNION ALL SELECT 'prices', 'n_latest', count(*)::DOUBLE FROM prices WHERE date = (SELECT max(date) FROM prices)
UNION ALL SELECT 'prices', 'lag_days', date_diff('day', max(date), DATE '2001-11-12')::DOUBLE FROM prices UNION ALL SELECT 'prices', 'stale', CASE WHEN date_diff('day', max(date), DATE '2001-11-12') > 6 THEN 1.0 ELSE 0.0 END FROM prices
UNION ALL SELECT 'prices', 'missing_rate', round(avg(CASE WHEN "adjClose" IS NULL THEN 1 ELSE 0 END), 6) FROM prices
UNION ALL SELECT 'prices', 'missing_rate_latest', round(avg(CASE WHEN "adjClose" IS NULL THEN 1 ELSE 0 END), 6) FROM prices WHERE date = (SELECT max(date) FROM prices)""",
    "prices",
)
def c6_stored(spark, sf):
    """The price checks from stored day counts: first all days up to 1999 and some later ones without their closes, then those anew."""
    p, path, today = B.stored_prices(spark, sf), scratch_path(spark, "price_days"), F.lit("2001-11-12").cast("date")
    Q.store_price_days(spark, path, p.withColumn("adjClose", F.when(F.col("date") < "2000-01-01", F.col("adjClose"))).filter("date < date '2000-03-01'"))
    Q.store_price_days(spark, path, p.filter("date >= date '2000-01-01'"))
    return Q.price_report(spark.read.parquet(path), today)

