"""Sorting signals: industry exclusion, characteristics, momentum."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S


def excluded_codes(listings: list[DataFrame], pattern: str) -> DataFrame:
    """Codes of companies whose industry text contains ``pattern``."""
    allc = listings[0]
    for other in listings[1:]:
        allc = allc.unionByName(other, allowMissingColumns=True)
    return allc.filter(F.col("industry").contains(pattern)).select(F.col("stock_id").cast("string"))


def exclude_industry(df: DataFrame, listings: list[DataFrame], pattern: str) -> DataFrame:
    """Drop rows of companies whose industry contains ``pattern``.

    A left-anti join: rows with a NULL code stay, as with a negated membership
    test, and a code listed twice changes nothing (so no distinct shuffle).
    The code list is one row per listed company; the runtime planner
    broadcasts it when its measured size allows, else it is a shuffled join.
    """
    codes = excluded_codes(listings, pattern)
    return df.join(codes, "stock_id", "left_anti")


def characteristics(fundamentals: DataFrame) -> DataFrame:
    """Book-to-market, operating profit to equity, asset growth.

    ``Inv`` is ln A_t - ln A_prev with the previous *surviving* row of the same
    stock (a missing year makes it reach further back).  Rows without a
    previous year, or with an undefined ratio, are dropped.
    """
    w = Window.partitionBy("stock_id").orderBy("year")
    ln_a = F.ln("TotalAssets")
    return (fundamentals
            .withColumn("BMratio", F.try_divide("Equity", "MC"))
            .withColumn("OPtoE", F.try_divide("yOP", "Equity"))
            .withColumn("Inv", ln_a - F.lag(ln_a).over(w))
            .na.drop(subset=["year", "stock_id", "Equity", "TotalAssets", "MC", "yOP",
                             "BMratio", "OPtoE", "Inv"]))


def momentum(monthret: DataFrame, first_lag: int = S.MOM_FIRST_LAG, last_lag: int = S.MOM_LAST_LAG,
             month_col: str = "month") -> DataFrame:
    """Prior-return momentum: product of (1 + ret) over rows t-first_lag ... t-last_lag (U16).

    Rows are positional over the stock's non-missing returns; all
    ``first_lag - last_lag + 1`` rows must exist.  The window is per stock, so
    its size is the stock's history length.
    """
    need = first_lag - last_lag + 1
    r = monthret.select("stock_id", F.col(month_col).alias("mom_month"), "ret").na.drop()
    w = Window.partitionBy("stock_id").orderBy("mom_month").rowsBetween(-first_lag, -last_lag)
    return (r.withColumn("_cnt", F.count("ret").over(w))
            .withColumn("mom", F.product(F.lit(1.0) + F.col("ret")).over(w))
            .filter(F.col("_cnt") == need)
            .select("stock_id", "mom_month", "mom"))
