"""SQL of the domain tables: name -> (needed tables, body). Written apart from the Spark bindings."""

_ORDER = "l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_returnflag, l_discount"


def _snap(line: int, *cols: str) -> tuple[str, str]:
    return "li", f"SELECT symbol, date AS \"asOfDate\", {', '.join(cols)} FROM li WHERE l_linenumber = {line} GROUP BY symbol, date"


CTES: dict[str, tuple[str, str]] = {
    "li": ("", f"SELECT *, 'S' || l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS date, ROW({_ORDER}) AS o FROM lineitem"),
    "od": ("", "SELECT *, 'C' || o_custkey AS symbol, CAST(o_orderdate AS DATE) AS date FROM orders"),
    "prices": (
        "li",
        """
  SELECT symbol, date, arg_min(l_extendedprice, o) AS open, max(l_extendedprice) AS high, min(l_extendedprice) AS low,
         arg_max(l_extendedprice, o) AS close,
         CASE WHEN arg_max(l_returnflag, o) <> 'R' THEN arg_max(l_extendedprice, o) * (1 - arg_max(l_discount, o)) END AS "adjClose",
         sum(l_quantity) AS volume
  FROM li GROUP BY symbol, date""",
    ),
    "px": ("prices", 'SELECT symbol, date, open, high, low, coalesce("adjClose", close) AS close, volume FROM prices'),
    "market": ("px", "SELECT date, avg(close) AS close FROM px GROUP BY date"),
    "ind": (
        "px",
        """
  SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY symbol) AS n,
         lag(close) OVER w AS prev, close / nullif(lag(close) OVER w, 0) - 1 AS ret
  FROM px WINDOW w AS (PARTITION BY symbol ORDER BY date)""",
    ),
    "fin": (
        "li",
        """
  SELECT symbol, CAST(date_trunc('quarter', date) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS "fiscalDate",
    'Q' || max(quarter(date)) AS period,
    sum(l_extendedprice * (1 - l_discount)) AS revenue,
    sum(l_extendedprice * (l_discount - l_tax / 2)) AS "netIncome",
    sum(CASE WHEN l_linenumber <= 2 THEN l_extendedprice * l_discount END) AS "grossProfit",
    sum(l_extendedprice * l_discount) AS "operatingIncome",
    sum(l_extendedprice * (l_discount + 0.02)) AS "EBITDA",
    sum(l_extendedprice * (l_discount - l_tax / 4)) AS "incomeBeforeTax",
    sum(l_extendedprice * (l_tax / 4)) AS "incomeTaxExpense",
    sum(l_extendedprice * l_tax) AS "cashAndCashEquivalents",
    sum(l_quantity * 10) AS receivables,
    sum(l_quantity) AS "shortTermInvestments",
    sum(l_extendedprice) / 2 AS "currentAssets",
    sum(CASE WHEN l_linestatus = 'F' THEN l_extendedprice END) AS "currentLiabilities",
    sum(l_extendedprice) * 2 AS "totalAssets",
    sum(l_extendedprice * l_tax) + sum(l_extendedprice) AS "totalStockholdersEquity",
    sum(CASE WHEN l_linenumber <= 2 AND l_returnflag = 'R' THEN l_extendedprice END) AS "totalDebt",
    sum(CASE WHEN l_linenumber <= 2 AND l_returnflag = 'A' THEN l_extendedprice END) AS "longTermDebt",
    sum(CASE WHEN l_returnflag = 'N' THEN l_extendedprice * l_discount ELSE -l_extendedprice * l_tax END) AS "freeCashFlow",
    sum(CASE WHEN l_linestatus = 'F' AND l_linenumber <= 4 THEN l_extendedprice * l_discount END) AS "operatingCashFlow",
    -sum(CASE WHEN l_returnflag = 'N' THEN l_extendedprice * 0.01 END) AS "dividendsPaid",
    sum(l_quantity) AS "weightedAverageSharesDiluted",
    sum(CASE WHEN l_linenumber = 1 AND l_returnflag = 'R' THEN l_quantity * 100 END) AS "sharesOutstanding"
  FROM li GROUP BY 1, 2""",
    ),
    "finr": ("fin", 'SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY "fiscalDate" DESC, period DESC) AS rn FROM fin'),
    "divs": (
        "li",
        """
  SELECT symbol, date AS "exDate", l_tax + 0.01 AS dividend, l_tax / 2 AS "adjDividend", date + 1 AS "recordDate",
         CASE WHEN l_returnflag <> 'N' THEN date + 14 END AS "paymentDate", date - 14 AS "declarationDate",
         'Quarterly' AS frequency, l_discount AS yield, o
  FROM li WHERE l_linenumber = 1""",
    ),
    "shares": _snap(
        2,
        'sum(l_quantity * 1000) AS "sharesOutstanding"',
        "sum(CASE WHEN l_returnflag <> 'R' THEN l_quantity * 800 END) AS \"sharesFloat\"",
    ),
    "targets": _snap(3, "max(CASE WHEN l_returnflag <> 'A' THEN l_extendedprice END) AS \"targetPrice\""),
    "est": _snap(4, 'sum(l_discount * 10) AS "epsThisY"', "sum(CASE WHEN l_returnflag <> 'N' THEN l_tax * 20 END) AS \"epsNextY\""),
    "estq": _snap(5, "sum(CASE WHEN l_returnflag <> 'N' THEN l_tax END) AS \"epsNextQ\""),
    "cfacts": _snap(
        6,
        "sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS employees",
        'sum(l_quantity * 1000) AS "sharesOutstanding_profile"',
        "sum(CASE WHEN l_returnflag <> 'A' THEN l_quantity * 900 END) AS \"sharesOutstanding_shares\"",
        'sum(l_quantity * 700) AS "sharesFloat"',
        'date - 3650 AS "ipoDate"',
    ),
    "holds": (
        "li",
        """
  SELECT symbol, last_day(date) AS "asOfDate",
         CASE WHEN l_returnflag <> 'N' THEN 'P' || CAST(floor(l_partkey / 100) AS BIGINT) END AS "reportingName",
         l_quantity * 50 AS "securitiesOwned"
  FROM li WHERE l_linenumber = 7""",
    ),
    "held": (
        "holds",
        """
  SELECT symbol, "asOfDate", sum(m) AS "securitiesOwned" FROM (
    SELECT symbol, "asOfDate", "reportingName", max("securitiesOwned") AS m FROM holds WHERE "reportingName" IS NOT NULL GROUP BY ALL)
  GROUP BY symbol, "asOfDate\"""",
    ),
    "itx": (
        "li",
        """
  SELECT symbol, date AS "transactionDate", 'P' || CAST(floor(l_partkey / 100) AS BIGINT) AS "reportingCik",
         'Person ' || CAST(floor(l_partkey / 100) AS BIGINT) AS "reportingName",
         CASE WHEN l_linenumber <= 2 THEN 'S-Sale' WHEN l_linenumber <= 4 THEN 'P-Purchase'
              WHEN l_linenumber = 5 THEN 'Acquired by gift' ELSE 'Award' END AS "transactionType",
         l_quantity AS "securitiesTransacted", l_extendedprice AS price, l_extendedprice * l_quantity AS value,
         CASE WHEN l_returnflag <> 'R' THEN l_quantity * 100 END AS "securitiesOwned",
         CASE WHEN l_linenumber <= 3 THEN 'Common Stock' ELSE 'Option' END AS "securityName",
         CASE WHEN l_returnflag = 'A' THEN 'A' WHEN l_returnflag = 'R' THEN 'D' END AS "acquisitionOrDisposition", o
  FROM li""",
    ),
    "sup": ("", "SELECT *, 'S' || s_suppkey AS symbol FROM supplier"),
    "uni": ("sup", "SELECT symbol FROM sup WHERE s_acctbal > 0"),
    "members": (
        "sup",
        """
  SELECT 'SP500' AS "indexSymbol", d AS "asOfDate", symbol AS "memberSymbol",
         s_acctbal > CASE WHEN d = DATE '2001-12-31' THEN 2000.0 ELSE 5000.0 END AS "isMember"
  FROM sup CROSS JOIN (VALUES (DATE '2001-06-30'), (DATE '2001-12-31')) v(d)""",
    ),
    "probe": ("px", "SELECT symbol, max(date) AS t FROM px GROUP BY symbol"),
    "eps": (
        "fin",
        """
  SELECT symbol, "fiscalDate", CASE WHEN count("netIncome") OVER w = 4 AND count("weightedAverageSharesDiluted") OVER w = 4
    THEN sum("netIncome") OVER w / nullif(avg("weightedAverageSharesDiluted") OVER w, 0) END AS eps_ttm
  FROM fin WINDOW w AS (PARTITION BY symbol ORDER BY "fiscalDate", period ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""",
    ),
    "betas": (
        "px market",
        """
  SELECT l.symbol, round(coalesce(m.b, d.b), 2) AS beta FROM (SELECT DISTINCT symbol FROM px) l
  LEFT JOIN (
    SELECT symbol, CASE WHEN count(*) >= 24 AND var_samp(mr) <> 0 THEN greatest(-10, least(10, regr_slope(sr, mr))) END AS b FROM (
      SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY mon DESC) AS k FROM (
        SELECT symbol, mon,
          CASE WHEN lag(mon) OVER w = mon - INTERVAL 1 MONTH THEN sc / lag(sc) OVER w - 1 END AS sr,
          CASE WHEN lag(mm) OVER w = mon - INTERVAL 1 MONTH THEN mc / lag(mfull) OVER w - 1 ELSE
            mc / (SELECT arg_max(close, date) FROM market q WHERE date_trunc('month', q.date) = mon - INTERVAL 1 MONTH) - 1 END AS mr
        FROM (
          SELECT s.symbol, s.mon, s.sc, s.mon AS mm,
            (SELECT arg_max(close, date) FROM market q WHERE date_trunc('month', q.date) = s.mon AND q.date <= s.last) AS mc,
            (SELECT arg_max(close, date) FROM market q WHERE date_trunc('month', q.date) = s.mon) AS mfull
          FROM (SELECT p.symbol, date_trunc('month', date) AS mon, arg_max(close, date) AS sc, max(x.last) AS last
                FROM px p JOIN (SELECT symbol, max(date) AS last FROM px GROUP BY symbol) x USING (symbol) GROUP BY p.symbol, mon) s)
        WINDOW w AS (PARTITION BY symbol ORDER BY mon)) WHERE sr IS NOT NULL AND mr IS NOT NULL) WHERE k <= 60 GROUP BY symbol) m USING (symbol)
  LEFT JOIN (
    SELECT symbol, CASE WHEN count(*) >= 60 AND var_samp(mr) <> 0 THEN greatest(-10, least(10, regr_slope(sr, mr))) END AS b FROM (
      SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS k FROM (
        SELECT symbol, date, px.close / nullif(lag(px.close) OVER w, 0) - 1 AS sr, market.close / lag(market.close) OVER w - 1 AS mr
        FROM px JOIN market USING (date) WINDOW w AS (PARTITION BY symbol ORDER BY date)) WHERE sr IS NOT NULL AND mr IS NOT NULL)
    WHERE k <= 252 GROUP BY symbol) d USING (symbol)""",
    ),
    "ttm": (
        "finr",
        """
  SELECT symbol, sum("netIncome") AS "netIncome", sum(revenue) AS revenue, sum("EBITDA") AS "EBITDA",
    sum("freeCashFlow") AS "freeCashFlow", sum("operatingCashFlow") AS "operatingCashFlow", sum("dividendsPaid") AS "dividendsPaid",
    sum("operatingIncome") AS "operatingIncome", sum("incomeBeforeTax") AS "incomeBeforeTax",
    sum("incomeTaxExpense") AS "incomeTaxExpense", sum("grossProfit") AS "grossProfit",
    avg("weightedAverageSharesDiluted") AS "weightedAverageSharesDiluted",
    max(CASE WHEN rn = 1 THEN "sharesOutstanding" END) AS "sharesOutstanding"
  FROM finr WHERE rn <= 4 GROUP BY symbol HAVING count(*) = 4""",
    ),
    # company documents
    "xf": (
        "fin",
        """
  SELECT symbol, "fiscalDate" AS e, year("fiscalDate") AS y, quarter("fiscalDate") AS qn, lpad(substr(symbol, 2), 10, '0') AS cik,
    date_trunc('quarter', "fiscalDate")::DATE AS qs, date_trunc('year', "fiscalDate")::DATE AS ys,
    'A-' || substr(symbol, 2) || '-' || year("fiscalDate") || '-' || quarter("fiscalDate") AS accn,
    "fiscalDate" + 40 AS filed,
    CASE WHEN quarter("fiscalDate") = 4 THEN 'FY' ELSE 'Q' || quarter("fiscalDate") END AS fp,
    CASE WHEN quarter("fiscalDate") = 4 THEN '10-K' ELSE '10-Q' END AS form,
    year("fiscalDate") * 10 + quarter("fiscalDate") AS doc_pos,
    revenue AS rev, sum(revenue) OVER ytd AS rev_ytd, sum("netIncome") OVER ytd AS ni_ytd,
    "totalAssets" AS assets, lag("totalAssets", 4) OVER b AS assets_ago, lag("fiscalDate", 4) OVER b AS end_ago,
    "totalAssets" - "totalStockholdersEquity" + "totalDebt" * 0.2 AS liabilities, "totalStockholdersEquity" AS equity,
    sum("operatingIncome") OVER ytd AS cost_ytd, sum("incomeTaxExpense") OVER ytd AS sga_ytd,
    "cashAndCashEquivalents" AS interest, "weightedAverageSharesDiluted" AS sh, "totalDebt" IS NULL AS no_debt
  FROM fin WINDOW ytd AS (PARTITION BY symbol, year("fiscalDate") ORDER BY "fiscalDate"), b AS (PARTITION BY symbol ORDER BY "fiscalDate")""",
    ),
    "facts": (
        "xf",
        """
  SELECT cik, ns, tag, unit, doc_pos::BIGINT AS doc_pos, src_pos::BIGINT AS src_pos, f_start AS "start", f_end AS "end", val, accn, y AS fy, fp, form, filed FROM (
    SELECT *, 'us-gaap' AS ns, 'Revenues' AS tag, 'USD' AS unit, 0 AS src_pos, qs AS f_start, e AS f_end, rev AS val FROM xf WHERE qn <= 2
    UNION ALL SELECT *, 'us-gaap', 'Revenues', 'USD', CASE WHEN qn = 2 THEN 1 ELSE 0 END, ys, e, rev_ytd FROM xf WHERE qn >= 2
    UNION ALL SELECT *, 'us-gaap', 'NetIncomeLoss', 'USD', 0, ys, e, ni_ytd FROM xf
    UNION ALL SELECT *, 'us-gaap', 'Assets', 'USD', 0, NULL, end_ago, assets_ago FROM xf WHERE end_ago IS NOT NULL
    UNION ALL SELECT *, 'us-gaap', 'Assets', 'USD', CASE WHEN end_ago IS NULL THEN 0 ELSE 1 END, NULL, e, assets FROM xf
    UNION ALL SELECT *, 'us-gaap', 'Liabilities', 'USD', 0, NULL, e, liabilities FROM xf WHERE liabilities IS NOT NULL
    UNION ALL SELECT *, 'us-gaap', 'StockholdersEquity', 'USD', 0, NULL, e, equity FROM xf
    UNION ALL SELECT *, 'us-gaap', 'CostOfRevenue', 'USD', 0, ys, e, cost_ytd FROM xf WHERE no_debt
    UNION ALL SELECT *, 'us-gaap', 'CostOfGoodsAndServicesSold', 'USD', 0, ys, e, cost_ytd * 2 FROM xf
    UNION ALL SELECT *, 'us-gaap', 'SellingGeneralAndAdministrativeExpense', 'USD', 0, ys, e, sga_ytd FROM xf WHERE qn <> 3
    UNION ALL SELECT *, 'us-gaap', 'InterestExpense', 'USD', 0, qs, e, interest FROM xf WHERE qn = 1
    UNION ALL SELECT *, 'us-gaap', 'InterestExpense', 'USD', 0, qs, e - 2, interest FROM xf WHERE qn = 4
    UNION ALL SELECT *, 'us-gaap', 'InterestPaidNet', 'USD', 0, qs, e, interest FROM xf WHERE qn = 2
    UNION ALL SELECT *, 'dei', 'EntityCommonStockSharesOutstanding', 'shares', 1000000000000, NULL, e, sh FROM xf)""",
    ),
    "concepts": (
        "xf",
        """
  SELECT cik, CASE WHEN qn = 3 THEN 'InterestPaid' ELSE 'InterestExpenseDebt' END AS tag, CASE WHEN qn = 3 THEN 1 ELSE 6 END AS tag_rank,
         0 AS src_pos, qs AS "start", e - CASE WHEN no_debt THEN 5 ELSE 9 END AS "end", interest / 2 AS val, accn, y AS fy, fp, form, filed
  FROM xf WHERE qn >= 3""",
    ),
    "anchors": (
        "facts",
        """
  SELECT cik, tag AS anchor, n AS n_ends FROM (
    SELECT *, row_number() OVER (PARTITION BY cik ORDER BY n DESC, r) AS k FROM (
      SELECT cik, tag, count(DISTINCT "end") AS n, list_position(['Revenues', 'SalesRevenueNet', 'NetIncomeLoss', 'ProfitLoss', 'Assets'], tag) AS r
      FROM facts WHERE tag IN ('Revenues', 'SalesRevenueNet', 'NetIncomeLoss', 'ProfitLoss', 'Assets') GROUP BY cik, tag)) WHERE k = 1""",
    ),
    "slots": (
        "anchors",
        """
  SELECT * FROM (
    SELECT cik, row_number() OVER (PARTITION BY cik ORDER BY "end" DESC) AS slot, "end", accn, form, filed, fp, fy FROM (
      SELECT f.*, row_number() OVER (PARTITION BY f.cik, "end" ORDER BY doc_pos, src_pos) AS k
      FROM facts f JOIN anchors a ON a.cik = f.cik AND a.anchor = f.tag) WHERE k = 1) WHERE slot <= 11""",
    ),
    "config": (
        "",
        """
  SELECT * FROM (VALUES
    ('Revenue', 0, 0, 'Revenues', 'USD', true), ('NetIncome', 0, 0, 'NetIncomeLoss', 'USD', true),
    ('InterestExpense', 0, 0, 'InterestExpense', 'USD', true), ('InterestExpense', 0, 4, 'InterestPaidNet', 'USD', true),
    ('Assets', 0, 0, 'Assets', 'USD', false), ('Liabilities', 0, 0, 'Liabilities', 'USD', false),
    ('Equity', 0, 0, 'StockholdersEquity', 'USD', false),
    ('CostOfRevenue', 0, 0, 'CostOfRevenue', 'USD', true), ('CostOfRevenue', 1, 0, 'CostOfGoodsAndServicesSold', 'USD', true),
    ('SGnA', 0, 0, 'SellingGeneralAndAdministrativeExpense', 'USD', true),
    ('SharesOutstanding', 0, 0, 'EntityCommonStockSharesOutstanding', 'shares', false)) v(metric, grp, tag_rank, tag, unit, is_flow)""",
    ),
    "picked": (
        "facts slots config",
        """
  SELECT * FROM (
    SELECT f.cik, s.slot, c.metric, f."end", f."start", f.val, f.tag, f.unit, f.accn, f.fy, f.fp, f.form, f.filed,
      CASE WHEN own THEN 'ACCN' ELSE 'END' END AS match_basis,
      row_number() OVER (PARTITION BY f.cik, s.slot, c.metric ORDER BY c.grp, NOT own,
        CASE WHEN own THEN c.tag_rank END, CASE WHEN own THEN f.fy <> s.fy END, CASE WHEN own THEN f.fp <> s.fp END,
        CASE WHEN own THEN f.filed > s.filed END, CASE WHEN own THEN abs(date_diff('day', f.filed, s.filed)) END,
        f.accn DESC, c.tag_rank, f.doc_pos, f.src_pos) AS k
    FROM (SELECT f.*, f.accn AS fa FROM facts f) f JOIN config c ON c.tag = f.tag AND c.unit = f.unit
    JOIN slots s ON s.cik = f.cik AND s."end" = f."end"
    CROSS JOIN LATERAL (SELECT f.accn = s.accn AND (NOT c.is_flow OR coalesce(date_diff('day', f."start", f."end") BETWEEN 60 AND 400, true)) AS own) o
  ) WHERE k = 1""",
    ),
    "quarterised": (
        "picked",
        """
  SELECT p.*, CASE WHEN metric IN ('Revenue', 'NetIncome', 'InterestExpense', 'CostOfRevenue', 'SGnA') THEN
      CASE ptype WHEN 'QUARTER' THEN val WHEN 'YTD' THEN val - prev WHEN 'FY' THEN val - prev END END AS qv FROM (
    SELECT *, CASE WHEN ptype IN ('QUARTER', 'YTD', 'FY') THEN lag(val) OVER (PARTITION BY cik, metric, "start", ptype IN ('QUARTER', 'YTD', 'FY') ORDER BY "end") END AS prev
    FROM (SELECT *, CASE WHEN d IS NULL THEN 'INSTANT' WHEN d >= 330 THEN 'FY' WHEN d BETWEEN 150 AND 320 THEN 'YTD'
             WHEN d BETWEEN 70 AND 110 THEN 'QUARTER' ELSE 'UNKNOWN' END AS ptype
          FROM (SELECT *, date_diff('day', "start", "end") AS d FROM picked))) p""",
    ),
}
