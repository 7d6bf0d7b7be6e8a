"""Declared tables: column types, primary keys and conforming a frame to them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterdeck.functions import fixed

_TYPES = {"s": T.StringType(), "d": T.DateType(), "f": T.DoubleType(), "b": T.BooleanType(), "i": T.IntegerType()}


@dataclass(frozen=True)
class Table:
    name: str
    schema: T.StructType
    key: list[str]
    required_dates: tuple[str, ...] = ()
    symbol: str = "symbol"

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


def _table(name: str, spec: str, key: str, required: str = "", symbol: str = "symbol") -> Table:
    fields = [T.StructField(c.rsplit(":", 1)[0], _TYPES[c.rsplit(":", 1)[1]]) for c in spec.split()]
    return Table(name, T.StructType(fields), key.split(), tuple(required.split()), symbol)


_PRICES = "symbol:s date:d open:f high:f low:f close:f adjClose:f volume:f"
TABLES = {
    t.name: t
    for t in [
        _table("prices_eod", _PRICES, "symbol date", "date"),
        _table("sp500_prices", _PRICES, "symbol date", "date"),
        _table(
            "financials_quarterly",
            "symbol:s fiscalDate:d period:s revenue:f netIncome:f grossProfit:f operatingIncome:f EBITDA:f"
            " incomeBeforeTax:f incomeTaxExpense:f cashAndCashEquivalents:f receivables:f shortTermInvestments:f"
            " currentAssets:f currentLiabilities:f totalAssets:f totalStockholdersEquity:f totalDebt:f longTermDebt:f"
            " freeCashFlow:f operatingCashFlow:f dividendsPaid:f weightedAverageSharesDiluted:f sharesOutstanding:f",
            "symbol fiscalDate period",
        ),
        _table(
            "dividends_events",
            "symbol:s exDate:d dividend:f adjDividend:f recordDate:d paymentDate:d declarationDate:d frequency:s yield:f",
            "symbol exDate paymentDate dividend",
            "exDate",
        ),
        _table(
            "earnings_events",
            "symbol:s earningsDate:d epsActual:f epsEstimated:f revenueActual:f revenueEstimated:f fiscalDate:d lastUpdated:s",
            "symbol earningsDate",
        ),
        _table("estimates_snapshot", "symbol:s asOfDate:d epsNextY:f epsNextQ:f epsThisY:f epsNext5Y:f", "symbol asOfDate"),
        _table("estimates_quarterly_snapshot", "symbol:s asOfDate:d epsNextQ:f", "symbol asOfDate"),
        _table("targets_snapshot", "symbol:s asOfDate:d targetPrice:f", "symbol asOfDate"),
        _table("shares_snapshot", "symbol:s asOfDate:d sharesOutstanding:f sharesFloat:f", "symbol asOfDate"),
        _table(
            "index_membership",
            "indexSymbol:s asOfDate:d memberSymbol:s isMember:b",
            "indexSymbol asOfDate memberSymbol",
            symbol="memberSymbol",
        ),
        _table(
            "company_facts_snapshot",
            "symbol:s asOfDate:d sector:s industry:s employees:f ipoDate:d sharesOutstanding_profile:f"
            " sharesOutstanding_shares:f sharesFloat:f",
            "symbol asOfDate",
        ),
        _table(
            "insider_transactions",
            "symbol:s transactionDate:d reportingCik:s reportingName:s transactionType:s securitiesTransacted:f price:f"
            " value:f securitiesOwned:f securityName:s formType:s acquisitionOrDisposition:s link:s",
            "symbol transactionDate reportingCik transactionType securitiesTransacted securityName",
        ),
        _table(
            "insider_holdings_snapshot",
            "symbol:s asOfDate:d reportingCik:s reportingName:s securitiesOwned:f securityName:s lastTransactionDate:d",
            "symbol asOfDate reportingCik securityName",
        ),
    ]
}

_FACTOR_DATES = {"asOfDate", "price_date", "financials_date", "IPO (Date)", "Dividend Ex-Date", "Earnings (Date)"}


def _factor_type(name: str) -> T.DataType:
    if name in _FACTOR_DATES:
        return T.DateType()
    if name in ("symbol", "Insider Own/Trans"):
        return T.StringType()
    return T.BooleanType() if name == "Index" else T.DoubleType()


FACTORS = Table(
    "factors_latest",
    T.StructType([T.StructField(c, _factor_type(c)) for c in fixed.FACTOR_COLUMNS]),
    ["asOfDate", "symbol"],
)


def q(name: str) -> str:
    """Column reference that is safe for names with dots."""
    return f"`{name}`"


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared columns in declared order: absent ones as typed NULL, undeclared ones dropped, NaN as NULL."""
    have = {c.lower(): c for c in df.columns}
    out = []
    for f in schema.fields:
        c = F.col(q(have[f.name.lower()])) if f.name.lower() in have else F.lit(None)
        c = c.try_cast(f.dataType) if isinstance(c, F.Column) else c
        if isinstance(f.dataType, T.DoubleType):
            c = F.nullif(c, F.lit(float("nan")))
        out.append(c.alias(f.name))
    return df.select(*out)
