"""Scalar column expressions: field picking, normalisation, predicates and small formulas.

Everything here is a built-in expression, so it stays inside whole-stage code generation. Missing is always
NULL; NaN never leaves `to_number`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarterdeck.functions import fixed

SPACES = " \t\n\r\x0b\x0c"
_NUMERIC = r"^([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)$"
#: A day at the start; year 0 is none.
_DAY = r"^((?!0000)\d{4}-\d{2}-\d{2})"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- picking fields -------------------------------------------------------------------------------------


def text(c: Column | str) -> Column:
    """Trimmed text, blank becomes NULL."""
    t = F.trim(col(c).cast("string"), F.lit(SPACES))
    return F.when(t != "", t)


def pick_text(*cs: Column | str) -> Column:
    """First alternate that is neither NULL nor blank, trimmed.

    Each alternate is looked up and trimmed once. A chain of CASEs repeats both in every use, and a row with twenty picks
    then makes a method that the JVM no longer compiles.
    """
    trimmed = F.transform(F.array(*[col(c).cast("string") for c in cs]), lambda x: F.trim(x, F.lit(SPACES)))
    return F.get(F.filter(trimmed, lambda x: x != ""), F.lit(0))


def _number(v: Column) -> Column:
    """Double of a plain decimal number; the pattern has one group, so the text is computed once."""
    return F.regexp_extract(v, _NUMERIC, 1).try_cast("double")


def pick_num(*cs: Column | str) -> Column:
    """First alternate that is neither NULL nor blank, as a double; text that is no number gives NULL."""
    return _number(pick_text(*cs))


def leading_day(t: Column) -> Column:
    """Date of the first ten characters of a text."""
    # The cast gives NULL for a day that does not exist; a parser with a pattern raises and catches for each of them.
    return F.regexp_extract(t, _DAY, 1).try_cast("date")


def pick_date(*cs: Column | str) -> Column:
    """First non-blank alternate, cut to ten characters and read as a date."""
    return leading_day(pick_text(*cs))


def to_number(c: Column | str) -> Column:
    """Number that may carry thousands commas; blank, text and NaN become NULL."""
    return _number(F.regexp_replace(F.trim(col(c).cast("string"), F.lit(SPACES)), ",", ""))


def norm_period(c: Column | str) -> Column:
    """Reporting period with every spelling of missing mapped to the empty string."""
    t = F.trim(col(c).cast("string"), F.lit(SPACES))
    return F.when(t.isNull() | t.isin(*fixed.MISSING_PERIOD_TEXTS), F.lit("")).otherwise(t)


def norm_symbol(c: Column | str) -> Column:
    return F.upper(F.trim(col(c).cast("string"), F.lit(SPACES)))


def norm_key(c: Column | str) -> Column:
    """Upper case, letters and digits only."""
    return F.regexp_replace(F.upper(col(c)), "[^A-Z0-9]", "")


def norm_item_key(c: Column | str) -> Column:
    """Lower case without spaces and underscores, for line-item names."""
    return F.translate(F.lower(col(c)), " _", "")


# ---- identifiers ----------------------------------------------------------------------------------------


def stable_person_id(cik: Column | str, name: Column | str, link: Column | str) -> Column:
    """The person's own id, else `H_` and 16 hex digits of sha1(name|link).

    The joined base always holds the separator, so it is never blank and needs no further fallback.
    """
    base = F.concat(F.coalesce(col(name), F.lit("")), F.lit("|"), F.coalesce(col(link), F.lit("")))
    return F.coalesce(text(cik), F.concat(F.lit("H_"), F.substring(F.sha1(base.cast("binary")), 1, 16)))


def pad_cik(c: Column | str) -> Column:
    t = text(c)
    return F.when(t.rlike(r"^\d{1,10}$"), F.lpad(t, 10, "0")).otherwise(t)


def shard_filter(symbol: Column | str, shards: int, shard: int) -> Column:
    """Predicate for one shard of a symbol list; a bad shard id or fewer than two shards keeps everything."""
    if shards <= 1 or not 0 <= shard < shards:
        return F.lit(True)
    return F.crc32(col(symbol).cast("binary")) % shards == shard


def ticker_variants(ticker: Column | str, name: Column | str) -> Column:
    """Ordered array of spellings under which a registry may list the ticker."""
    t, n = norm_symbol(ticker), col(name)
    stem = t.substr(F.lit(1), F.length(t) - 1)
    letter = t.substr(F.length(t), F.lit(1))
    classed = n.rlike(r"(?i)\b(?:CLASS|SERIES)\s+[A-Z]\b") & (F.length(t) >= 3) & letter.isin("A", "B")
    exception = None
    for known, listed in fixed.TICKER_EXCEPTIONS.items():
        exception = F.when(t == known, F.lit(listed)) if exception is None else exception.when(t == known, F.lit(listed))
    dash_b = (F.length(t) <= 4) & n.rlike(r"(?i)class\s+b\b") & ~t.contains("-")
    return F.when(
        t != "",
        F.array_distinct(
            F.array_compact(
                F.array(
                    exception,
                    F.when(classed, F.concat(stem, F.lit("-"), letter)),
                    F.when(classed, F.concat(stem, F.lit("."), letter)),
                    t,
                    F.replace(t, F.lit("."), F.lit("-")),
                    F.when(dash_b, F.concat(t, F.lit("-B"))),
                )
            )
        ),
    ).otherwise(F.array().cast("array<string>"))


# ---- exclusion rules ------------------------------------------------------------------------------------


def reject_non_equity(name: Column | str, asset_class: Column | str, ticker: Column | str, in_master: Column) -> Column:
    """True for holdings lines that are no company share.

    Keywords match as substrings of name and asset class. A line whose asset class says equity and whose
    ticker is a listed symbol is never rejected by keyword.
    """
    n, a = F.coalesce(text(name), F.lit("")), F.coalesce(text(asset_class), F.lit(""))
    low = F.lower(a)
    listed = in_master & (F.coalesce(col(ticker), F.lit("")) != "")
    hay = F.concat(F.lit(" "), F.upper(n), F.lit(" "), F.upper(a), F.lit(" "))
    words = F.array(*[F.lit(k) for k in fixed.REJECT_KEYWORDS])
    hit = F.exists(words, lambda k: F.contains(hay, k))
    return (
        F.when(low.isin(*fixed.REJECT_ASSET_CLASSES), F.lit(True))
        .when(low.isin("equity", "equities") & listed, F.lit(False))
        .when((n == "") & (a == ""), F.lit(False))
        .otherwise(hit & ~(listed & low.contains("equity")))
    )


def exclude_non_company(ticker: Column | str, name: Column | str, sector: Column | str) -> Column:
    """Reason to leave a universe line out, or NULL. Rules are tried in this order."""
    t, n, s = norm_symbol(ticker), F.coalesce(text(name), F.lit("")), F.coalesce(text(sector), F.lit(""))
    bad_name = F.lit(False)
    for p in fixed.NON_COMPANY_NAME_PATTERNS:
        bad_name = bad_name | F.upper(n).rlike(p)
    return (
        F.when(n.endswith(" CVR") | n.rlike(r"\s+-\s*CVR\s*$"), F.lit("excluded_cvr"))
        .when(t.isin(*fixed.CURRENCY_TICKERS), F.lit("excluded_currency_ticker"))
        .when(s.isin(*fixed.NON_COMPANY_SECTORS), F.lit("excluded_non_company_sector"))
        .when(bad_name, F.lit("excluded_non_company_name"))
    )


# ---- arithmetic -----------------------------------------------------------------------------------------


def safe_div(a: Column | str, b: Column | str) -> Column:
    """a / b, NULL when either is NULL or b is 0."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def clamp(c: Column | str, low: float, high: float) -> Column:
    """Limit to [low, high]. The guard matters: greatest/least skip NULL."""
    v = col(c)
    return F.when(v.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), v)))


def split_factor(numerator: Column | str, denominator: Column | str, ratio: Column | str) -> Column:
    """Backward price factor of a split: denominator / numerator, else read from a `n/d` text."""
    parts = F.split(text(ratio), "/")
    two = F.size(parts) == 2
    by_text = safe_div(
        F.when(two, F.try_element_at(parts, F.lit(2))).try_cast("double"),
        F.when(two, F.try_element_at(parts, F.lit(1))).try_cast("double"),
    )
    den = col(denominator)
    return F.coalesce(F.when(den != 0, safe_div(den, numerator)), by_text)


def txn_sign(acq_disp: Column | str, kind: Column | str) -> Column:
    """+1 for acquired, -1 for disposed, NULL when neither field tells."""
    a, k = norm_symbol(acq_disp), F.lower(col(kind))
    return (
        F.when(a == "A", 1)
        .when(a == "D", -1)
        .when(k.rlike("sale|sell|disposed"), -1)
        .when(k.rlike("buy|purchase|acquired"), 1)
    )


def own_pct(holdings: Column | str, shares: Column | str) -> Column:
    s = col(shares)
    return F.round(clamp(F.when(s > 0, 100.0 * col(holdings) / s), 0.0, 100.0), 2)


def trans_pct(now: Column | str, prev: Column | str, net: Column | str, shares: Column | str) -> Column:
    """Change of holdings in percent of shares when both snapshots exist, else net transactions."""
    n, p, s = col(now), col(prev), col(shares)
    moved = F.when(n.isNotNull() & p.isNotNull(), n - p).otherwise(col(net))
    return F.round(clamp(F.when(s > 0, 100.0 * moved / s), -99.0, 99.0), 2)


def format_pair(own: Column | str, trans: Column | str) -> Column:
    o, t = col(own), col(trans)
    left = F.coalesce(F.when(o.isNotNull(), F.format_string("%.2f%%", o)), F.lit("N/A"))
    right = F.when(t >= 0, F.format_string("+%.2f%%", t)).when(t < 0, F.format_string("%.2f%%", t))
    return F.concat(left, F.lit(" / "), F.coalesce(right, F.lit("N/A")))


def zero_repair(revenue: Column | str, gross_profit: Column | str) -> Column:
    """A revenue of 0 beside a positive gross profit is a missing value."""
    r = col(revenue)
    return F.when(~F.coalesce((r == 0) & (col(gross_profit) > 0), F.lit(False)), r)


# ---- periods --------------------------------------------------------------------------------------------


def period_type(start: Column | str, end: Column | str) -> Column:
    """INSTANT, FY, YTD, QUARTER or UNKNOWN from the length of a reporting period."""
    d = F.datediff(col(end), col(start))
    return (
        F.when(d.isNull(), F.lit("INSTANT"))
        .when(d >= 330, F.lit("FY"))
        .when(d.between(150, 320), F.lit("YTD"))
        .when(d.between(70, 110), F.lit("QUARTER"))
        .otherwise(F.lit("UNKNOWN"))
    )


def flow_period_ok(start: Column | str, end: Column | str, low: int = 60, high: int = 400) -> Column:
    return F.coalesce(F.datediff(col(end), col(start)).between(low, high), F.lit(True))


def unit_matches(unit: Column | str, candidates: list[str], reject: list[str] | None = None) -> Column:
    u = F.lower(F.trim(col(unit), F.lit(SPACES)))
    ok = u.isin(*[c.strip().lower() for c in candidates])
    for r in reject or []:
        ok = ok & ~u.contains(r.lower())
    return F.coalesce(ok, F.lit(False))


def prev_trade_date(day: Column | str) -> Column:
    """The weekday before `day`; Saturday, Sunday and Monday give the Friday before."""
    d, w = col(day), F.weekday(col(day))
    return F.date_sub(d, F.when(w >= 5, w - 4).when(w == 0, F.lit(3)).otherwise(F.lit(1)))


def quarter_key(frame: Column | str, fy: Column | str, fp: Column | str) -> Column:
    """`2025Q2` from a calendar frame, else from fiscal year and period."""
    f, p = F.upper(text(frame)), F.upper(text(fp))
    by_frame = F.when(f.rlike(fixed.QUARTER_FRAME), F.regexp_replace(f, fixed.QUARTER_FRAME, "$1Q$2"))
    by_period = F.when(p.isin("Q1", "Q2", "Q3", "Q4"), F.concat(col(fy).cast("string"), p))
    return F.coalesce(by_frame, by_period)


def quarter_key_order(key: Column | str) -> Column:
    k = col(key)
    return F.struct(F.substring(k, 1, 4).try_cast("int").alias("year"), F.substring(k, 6, 1).try_cast("int").alias("quarter"))
