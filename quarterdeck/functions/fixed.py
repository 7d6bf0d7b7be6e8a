"""Word lists, names and thresholds that results must agree on."""

# --- Fixed values: missing periods, shards, tickers, rejects -------------------------------------------

MISSING_PERIOD_TEXTS = ("<NA>", "nan", "None")

MARKET_SYMBOL = "^GSPC"
MARKET_SYMBOL_CANDIDATES = ["^GSPC", "GSPC", "SP500", "^SPX", "SPX", "S&P500", "S&P 500"]

HISTORY_CUTOFF = "2020-01-01"

TICKER_EXCEPTIONS = {"BRKB": "BRK-B", "BFB": "BF-B"}

CURRENCY_TICKERS = ["USD", "USDT", "USDC", "EUR", "GBP", "JPY", "CNY", "HKD", "AUD", "CAD", "CHF", "SGD"]

NON_COMPANY_SECTORS = ["Cash and/or Derivatives"]

NON_COMPANY_NAME_PATTERNS = [
    r"\bCASH\b",
    r"\bCURRENCY\b",
    r"\bCOLLATERAL\b",
    r"\bDERIVATIVE\b",
    r"\bFUTURE(S)?\b",
    r"\bSWAP(S)?\b",
]

REJECT_KEYWORDS = [
    "CASH", "USD", "US DOLLAR", "DOLLAR", "CURRENCY", "FX",
    "SWAP", "FUTURE", "FORWARD", "OPTION", "DERIVATIVE",
    "ETF", "FUND", "TRUST", "MONEY MARKET",
]
REJECT_ASSET_CLASSES = ["cash", "currency", "currencies", "derivatives", "money market", "commodity"]

TICKER_COLUMNS = ["Ticker", "ticker", "Symbol", "symbol"]
NAME_COLUMNS = ["Name", "name", "Security Name", "Holding", "Description"]
ASSET_CLASS_COLUMNS = ["Asset Class", "assetClass", "Asset Class ", "Type"]
WEIGHT_COLUMNS = ["Weight (%)", "Weight", "% Weight", "Market Value Weight", "Weight (%) ", "Market Value"]
UNIVERSE_SYMBOL_COLUMNS = ["symbol", "ticker_fixed", "ticker"]

HEADER_TICKER_WORDS = ["TICKER", "SYMBOL"]
HEADER_NAME_WORDS = ["NAME", "SECURITY", "HOLDING"]
HEADER_SCAN_LINES = 200

# --- Fixed values: as-reported line items ----------------------------------------------------------------

ITEM_NAME_FIELDS = ["name", "label", "account", "lineItem", "title", "concept", "tag"]
ITEM_VALUE_FIELDS = ["value", "amount", "val", "number", "raw", "usd", "valueUSD"]

DIVIDENDS_PAID_KEY = "paymentsofdividends"
SHARES_OUTSTANDING_KEY = "commonstocksharesoutstanding"
OPERATING_CASH_FLOW_KEYS = [
    "netcashprovidedbyusedinoperatingactivities",
    "netcashprovidedbyoperatingactivities",
    "cashfromoperations",
    "operatingcashflow",
]

# --- Fixed values: limits ---------------------------------------------------------------------------------

ADJ_FILL_MISSING = 0.05
ADJ_FALLBACK_MISSING = 0.80
ADJ_WARN_MISSING = 0.20
ADJ_WARN_TOP = 20
STALE_DAYS = 6

INTEREST_EXPENSE_COLUMNS = [
    "interestExpense",
    "interestAndDebtExpense",
    "interestExpenseNonOperating",
    "interestExpenseNet",
    "netInterestExpense",
    "interestExpenseTotal",
]

# --- Fixed values: company-facts tags ----------------------------------------------------------------------

QUARTER_FRAME = r"^(?:CY|FY)(\d{4})Q([1-4])$"
NAMESPACES = ["us-gaap", "dei"]
ANCHOR_TAGS = ["Revenues", "SalesRevenueNet", "NetIncomeLoss", "ProfitLoss", "Assets"]

SLOTS_OUT = 8
SLOTS_BACKFILL = 3
INTEREST_TOLERANCE_DAYS = 3
CONCEPT_TOLERANCE_DAYS = 7
CONCEPT_MAX_AGE_DAYS = 92

INTEREST_PNL_TAGS = [
    "InterestExpense",
    "InterestExpenseNonoperating",
    "InterestAndDebtExpense",
    "InterestExpenseBorrowings",
    "InterestExpenseDebt",
    "InterestCostsIncurred",
]
INTEREST_CASH_TAGS = ["InterestPaidNet", "InterestPaid"]
INTEREST_CONCEPT_TAGS = INTEREST_CASH_TAGS + INTEREST_PNL_TAGS

# Each metric holds groups of tags; groups are tried one after the other, tags inside a group by rank.
METRIC_TAGS = {
    "Revenue": [[
        "Revenues", "SalesRevenueNet",
        "RevenueFromContractWithCustomerExcludingAssessedTax",
        "RevenueFromContractWithCustomerIncludingAssessedTax",
        "RegulatedAndUnregulatedOperatingRevenue", "UtilityOperatingRevenue",
        "ElectricUtilityOperatingRevenue", "PublicUtilitiesRevenue",
        "GasUtilityOperatingRevenue", "WaterUtilityOperatingRevenue",
        "LicenseAndCollaborationRevenue", "ResearchAndDevelopmentRevenue",
        "RevenueFromGrants", "ContractWithCustomerLiabilityRevenueRecognized",
        "HealthCareOrganizationRevenue",
        "RentalRevenueGoodsAndServices", "RealEstateRevenueNet",
        "RentalIncomeNonoperating",
        "OilAndGasRevenue",
        "InterestAndDividendIncomeOperating", "InvestmentIncomeNet",
        "BankingRevenue", "NoninterestIncome",
    ]],
    "OperatingIncome": [[
        "OperatingIncomeLoss",
        "OperatingProfitLoss",
        "IncomeLossFromContinuingOperationsBeforeIncomeTaxesExtraordinaryItemsNoncontrollingInterest",
        "IncomeLossFromContinuingOperationsBeforeIncomeTaxes",
        "RealEstateOperatingIncome",
    ]],
    "NetIncome": [["NetIncomeLoss", "ProfitLoss", "NetIncomeLossAvailableToCommonStockholdersBasic"]],
    "InterestExpense": [[
        "InterestExpense", "InterestExpenseNonoperating",
        "InterestAndDebtExpense", "InterestExpenseBorrowings",
        "InterestPaidNet", "InterestPaid",
    ]],
    "PretaxIncome": [[
        "IncomeLossFromContinuingOperationsBeforeIncomeTaxesExtraordinaryItemsNoncontrollingInterest",
        "IncomeLossFromContinuingOperationsBeforeIncomeTaxes",
        "IncomeLossFromContinuingOperationsBeforeTax",
    ]],
    "IncomeTaxExpense": [["IncomeTaxExpenseBenefit", "CurrentIncomeTaxExpenseBenefit"]],
    "OCF": [[
        "NetCashProvidedByUsedInOperatingActivities",
        "NetCashProvidedByUsedInOperatingActivitiesContinuingOperations",
    ]],
    "CAPEX": [[
        "PaymentsToAcquirePropertyPlantAndEquipment",
        "CapitalExpenditures",
        "PaymentsToAcquireProductiveAssets",
        "PaymentsToAcquireRealEstate",
        "PaymentsToAcquireAndDevelopRealEstate",
        "PaymentsForCapitalImprovements",
        "PaymentsToDevelopRealEstateAssets",
        "PaymentsToAcquireOilAndGasProperty",
        "PaymentsForExplorationAndDevelopmentOfOilAndGasProperties",
    ]],
    "Assets": [["Assets", "AssetsTotal"]],
    "Liabilities": [["Liabilities", "LiabilitiesTotal"]],
    "Equity": [[
        "StockholdersEquity",
        "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest",
        "CommonStockholdersEquity", "PartnersCapital",
    ]],
    "Cash": [[
        "CashAndCashEquivalentsAtCarryingValue",
        "CashCashEquivalentsRestrictedCashAndCashEquivalents",
        "Cash",
    ]],
    "SharesOutstanding": [[
        "EntityCommonStockSharesOutstanding",
        "CommonStockSharesOutstanding",
        "CommonStockSharesIssued",
        "WeightedAverageNumberOfSharesOutstandingBasic",
    ]],
    "WeightedAvgSharesDiluted": [[
        "WeightedAverageNumberOfDilutedSharesOutstanding",
        "WeightedAverageNumberOfSharesOutstandingDiluted",
    ]],
    "EPSDiluted": [["EarningsPerShareDiluted"]],
    "CostOfRevenue": [["CostOfRevenue"], ["CostOfGoodsAndServicesSold"]],
    "GrossProfit": [["GrossProfit"]],
    "OperatingExpenses": [["OperatingExpenses"]],
    "SGnA": [["SellingGeneralAndAdministrativeExpense"], ["GeneralAndAdministrativeExpense"]],
    "RD": [["ResearchAndDevelopmentExpense"]],
    "DepreciationAmortization": [[
        "DepreciationDepletionAndAmortization",
        "DepreciationAndAmortization",
        "AmortizationOfIntangibleAssets",
        "Depreciation",
        "AmortizationOfCapitalizedComputerSoftwareCosts",
        "DepreciationAndAmortizationOfPropertyPlantAndEquipment",
    ]],
    "ShareBasedCompensation": [["ShareBasedCompensation"]],
    "AssetsCurrent": [["AssetsCurrent"]],
    "LiabilitiesCurrent": [["LiabilitiesCurrent"]],
    "LongTermDebt": [["LongTermDebt"], ["LongTermDebtNoncurrent"]],
    "LongTermDebtCurrent": [["LongTermDebtCurrent"], ["DebtCurrent"]],
    "AccountsReceivableNetCurrent": [["AccountsReceivableNetCurrent"], ["AccountsReceivableNet"]],
    "InventoryNet": [["InventoryNet"], ["InventoryFinishedGoods"]],
    "PPENet": [["PropertyPlantAndEquipmentNet"]],
    "Goodwill": [["Goodwill"]],
    "IntangiblesNetExGoodwill": [["IntangibleAssetsNetExcludingGoodwill"], ["IntangibleAssetsNetIncludingGoodwill"]],
    "RetainedEarnings": [["RetainedEarningsAccumulatedDeficit"]],
    "DividendsPaid": [["PaymentsOfDividends"], ["PaymentsOfDividendsCommonStock"]],
    "ShareRepurchase": [["PaymentsForRepurchaseOfCommonStock"], ["PaymentsForRepurchaseOfEquity"]],
    "DebtIssued": [["ProceedsFromIssuanceOfLongTermDebt"], ["ProceedsFromIssuanceOfDebt"]],
    "DebtRepaid": [["RepaymentsOfLongTermDebt"], ["RepaymentsOfDebt"]],
    "AcquisitionsNet": [["PaymentsToAcquireBusinessesNetOfCashAcquired"], ["PaymentsToAcquireBusinesses"]],
}
METRICS = list(METRIC_TAGS)

# Every unit is USD except these.
METRIC_UNITS = {
    "SharesOutstanding": ["shares", "Shares"],
    "WeightedAvgSharesDiluted": ["shares", "Shares"],
    "EPSDiluted": ["USD/shares", "USDPerShare"],
}

# Balances at a point in time; every other metric is a flow over a period.
STOCK_METRICS = [
    "Assets", "Liabilities", "Equity", "Cash", "SharesOutstanding",
    "AssetsCurrent", "LiabilitiesCurrent", "LongTermDebt", "LongTermDebtCurrent",
    "AccountsReceivableNetCurrent", "InventoryNet", "PPENet", "Goodwill",
    "IntangiblesNetExGoodwill", "RetainedEarnings",
]
# Marks of values that were not reported themselves, and of a gross profit without a revenue.
DERIVED_SOURCES = {"GrossProfit": "REV-COGS", "OperatingExpenses": "SGnA+RD"}
CONTAMINATION_FLAG = "GP_PRESENT_REV_MISSING_OR_ZERO"

FLOW_METRICS = [m for m in METRICS if m not in STOCK_METRICS]
# Averages and per-share figures are flows that cannot be split by subtraction.
QUARTERISED_METRICS = [m for m in FLOW_METRICS if m not in ("WeightedAvgSharesDiluted", "EPSDiluted")]

# --- Fixed values: columns of the factor table -----------------------------------------------------------

FACTOR_COLUMNS = [
    "asOfDate", "symbol", "price_date", "financials_date",
    "Price", "Prev Close", "Change", "Volume", "Avg Volume", "Rel Volume",
    "SMA20", "SMA50", "SMA200",
    "52W High", "52W Low",
    "Volatility", "ATR(14)", "RSI(14)",
    "Perf Week", "Perf Month", "Perf Quarter", "Perf Half Y", "Perf Year",
    "Perf 3Y", "Perf 5Y", "Perf 10Y", "Perf YTD",
    "Beta",
    "Income (Net)", "Sales (Rev)", "Revenue YoY", "OCF YoY", "Book/sh", "Cash/sh",
    "Dividend TTM", "Payout", "Employees", "IPO (Date)",
    "EPS (ttm)", "EPS YoY", "P/E", "P/S", "P/B", "P/C", "P/FCF",
    "Market Cap", "Enterprise Value(EV)", "EV/EBITDA", "EV/Sales",
    "Quick Ratio", "Current Ratio", "Debt/Eq", "LT Debt/Eq", "Interest Coverage",
    "ROA", "ROE", "ROIC",
    "Gross Margin", "Oper. Margin", "Profit Margin", "OCF/NI", "OPM volatility",
    "Shs Outstand", "Share Dilution", "Shs Float",
    "Earnings (Date)", "Forward P/E", "PEG", "Dividend Est", "Dividend Gr. 3Y", "Dividend Gr. 5Y", "Dividend Ex-Date",
    "EPS This Y", "EPS Next Y", "EPS Next Q", "EPS Next 5Y",
    "Insider Own/Trans", "Inst Own/Trans",
    "Short Float", "Short Interest", "Short Ratio", "Recom",
    "Target Price", "Index",
]
# Kept for the layout; no source feeds them.
FACTOR_PLACEHOLDERS = [
    "Earnings (Date)", "Inst Own/Trans", "Short Float", "Short Interest", "Short Ratio", "Recom",
]
