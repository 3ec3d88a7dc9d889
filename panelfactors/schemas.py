"""Source schemas, fixed label lists and default calendar bounds."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Source schemas (explicit, never inferred)
# ---------------------------------------------------------------------------

MARKETCAP = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("stock_id", T.StringType()),
    T.StructField("market_value", T.LongType()),
])

MONTHRET = T.StructType([
    T.StructField("stock_id", T.StringType()),
    T.StructField("month", T.DateType()),
    T.StructField("ret", T.DoubleType()),
])

DAYRET = T.StructType([
    T.StructField("stock_id", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("ret", T.DoubleType()),
])

STATEMENT = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("stock_id", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("origin_name", T.StringType()),
])

INDEX_PRICE = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("stock_id", T.StringType()),
    T.StructField("price", T.DoubleType()),
])

# bond yield file: text date yyyy/M/d and the closing yield in percent a year
BOND_YIELD = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("close", T.DoubleType()),
])

LISTING = T.StructType([
    T.StructField("stock_id", T.StringType()),
    T.StructField("industry", T.StringType()),
])

DELISTED = T.StructType([T.StructField("stock_id", T.StringType())])

ADJPRICE = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("stock_id", T.StringType()),
    T.StructField("Trading_Volume", T.DecimalType(20, 0)),
    T.StructField("Trading_money", T.DecimalType(20, 0)),
    T.StructField("open", T.DoubleType()),
    T.StructField("max", T.DoubleType()),
    T.StructField("min", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("spread", T.DoubleType()),
    T.StructField("Trading_turnover", T.LongType()),
])

# JSON response envelope: {"data": [ {...}, ... ]}
def envelope(row_schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("data", T.ArrayType(row_schema))])


# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# ---------------------------------------------------------------------------

BALANCE_ITEMS = ["Equity", "TotalAssets"]
INCOME_ITEMS = ["Revenue", "CostOfGoodsSold", "OperatingExpenses"]

SIZE_CUTS = [0, 0.5, 1]
SIZE_LABELS = ["s1", "s2"]
TERCILE_CUTS = [0, 0.3, 0.7, 1]
BM_LABELS = ["bm1", "bm2", "bm3"]
OP_LABELS = ["op1", "op2", "op3"]
INV_LABELS = ["inv1", "inv2", "inv3"]
MOM_LABELS = ["mom1", "mom2", "mom3"]

# momentum window: rows t-12 ... t-2 of the row dated t
MOM_FIRST_LAG = 12
MOM_LAST_LAG = 2

# industry text of financial companies in the listing files
FINANCIAL_INDUSTRY = "金融"

# value the CSV staging writes for a missing return
MISSING_RETURN_SENTINEL = 123.0

# yield (percent a year) to a monthly / daily rate
MONTHLY_RATE_DIVISOR = 12 * 100
DAILY_RATE_DIVISOR = 100 * 365

# the report's benchmark series and the chart's six factors
BENCHMARK_PORT = "MKTPR"
CHART_FACTORS = ["MKTPR", "SMB5", "HML", "RMW", "CMA", "UMD"]

# the fixed sample period (a preset, not a default)
YEARLY_RET_START = "2001-07-01"
YEARLY_RET_END = "2026-06-30"
YEARLY_GROUP_START = "2000-12-01"
YEARLY_GROUP_END = "2024-12-01"
MOMENTUM_RET_START = "1980-02-01"
MOMENTUM_RET_END = "2026-02-01"
FACTOR_UNTIL = "2025-04-01"

# ---------------------------------------------------------------------------
# Portfolio names
# ---------------------------------------------------------------------------

YEARLY_SEP = ""
MOMENTUM_SEP = "_"


def portfolio_names(sizes, others, sep=""):
    return [f"{s}{sep}{o}" for s in sizes for o in others]


# the 18 yearly-sorted portfolios in column (name) order
FF_PORTS = sorted(portfolio_names(SIZE_LABELS, BM_LABELS + OP_LABELS + INV_LABELS, YEARLY_SEP))
MOM_PORTS = sorted(portfolio_names(SIZE_LABELS, MOM_LABELS, MOMENTUM_SEP))
FF_FACTORS = ["HML", "RMW", "CMA", "SMB3", "SMB5"]


def exact_cuts(cuts) -> list[Fraction]:
    """Quantile cuts as exact fractions (0.3 -> 3/10), so bucket arithmetic is integer."""
    return [Fraction(str(c)) for c in cuts]
