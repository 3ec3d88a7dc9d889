"""Index return, risk-free rate and market premium.

These are single time series (one row per day or month); windows are
partitioned by the series id, so each holds one series' history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.dates import month_key, parse_slash_date
from ..functions.guards import require_unique
from ..functions.sweep import asof_fill


def index_return(index: DataFrame, freq: str, denominator: str = "current") -> DataFrame:
    """Index return per month (last price of the month) or per day.

    The reference divides the change by the *current* price; pass
    ``denominator="previous"`` for the textbook return.  ``index`` holds one
    index: a date with prices of two fails the job, as it would multiply dates
    in every later join.
    """
    if freq == "month":
        px = (index.groupBy("stock_id", month_key("date").alias("ret_date"))
              .agg(F.max_by("price", "date").alias("price")))
    elif freq == "day":
        px = index.select("stock_id", F.col("date").alias("ret_date"), "price")
    else:
        raise ValueError("freq must be 'month' or 'day'")
    prev = F.lag("price").over(Window.partitionBy("stock_id").orderBy("ret_date"))
    base = F.col("price") if denominator == "current" else prev
    ret = px.select("ret_date", F.try_divide(F.col("price") - prev, base).alias("ret"))
    return require_unique(ret, ["ret_date"], "index prices of more than one index")


def risk_free(bond: DataFrame, freq: str, index_days: DataFrame | None = None) -> DataFrame:
    """Risk-free rate from a yearly percent yield.

    month: last yield of each month / 1200 (a month without a yield is absent).
    day:   yield / 36500 on the index's days, forward-filled over those days; a
           yield dated on a day without an index value is never seen.
    """
    b = bond.select(parse_slash_date("date").alias("date"), F.col("close").cast("double").alias("close"))
    if freq == "month":
        return (b.groupBy(month_key("date").alias("ret_date"))
                .agg(F.max_by("close", "date").alias("close"))
                .select("ret_date", (F.col("close") / F.lit(float(S.MONTHLY_RATE_DIVISOR))).alias("RFrate")))
    if freq == "day":
        if index_days is None:
            raise ValueError("daily risk-free needs the index days")
        rf = b.select(F.col("date").alias("ret_date"),
                      (F.col("close") / F.lit(float(S.DAILY_RATE_DIVISOR))).alias("_rf"))
        days = index_days.select("ret_date").distinct()
        seen = rf.join(days, "ret_date", "left_semi").withColumnRenamed("_rf", "RFrate")
        return asof_fill(days, seen, "ret_date")
    raise ValueError("freq must be 'month' or 'day'")


def market_premium(index_ret: DataFrame, rf: DataFrame) -> DataFrame:
    """MKTPR = index return - risk-free, dates with both."""
    return (index_ret.join(rf, "ret_date", "inner").na.drop()
            .select("ret_date", (F.col("ret") - F.col("RFrate")).alias("MKTPR")))
