"""Rebalance calendars as closed-form date keys.

No calendar table is generated or joined: the grouping period of a return date
is an expression, and the calendar's range is a filter on it, which Catalyst
pushes into the return scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import between_dates, month_key, previous_month, rebalance_year


def with_rebalance_year(df: DataFrame, date_col: str = "ret_date",
                        ret_start: str | None = None, ret_end: str | None = None,
                        group_start: str | None = None,
                        group_end: str | None = None) -> DataFrame:
    """Attach ``year`` (December of the grouping year) and keep dates in the calendar.

    A panel stored by grouping year brings it as a partition column; then the
    calendar's range filters that column, and other years are not read.
    """
    y = F.col("group_year") if "group_year" in df.columns else rebalance_year(date_col)
    return (df.filter(between_dates(date_col, ret_start, ret_end))
              .withColumn("year", y).drop("group_year")
              .filter(between_dates("year", group_start, group_end)))


def with_momentum_months(df: DataFrame, date_col: str = "ret_date",
                         ret_start: str | None = None,
                         ret_end: str | None = None) -> DataFrame:
    """Attach ``mom_month`` (month of the return) and ``mc_month`` (the month before)."""
    mm = month_key(date_col)
    return (df.filter(between_dates(date_col, ret_start, ret_end))
              .withColumn("mom_month", mm)
              .withColumn("mc_month", previous_month(mm)))


def rebalance_calendar(dates: DataFrame, date_col: str = "ret_date", **bounds) -> DataFrame:
    """Distinct return dates of the data with their grouping year."""
    d = dates.select(F.col(date_col).alias("ret_date")).distinct()
    return with_rebalance_year(d, "ret_date", **bounds).select("ret_date", "year")


def monthly_calendar(dates: DataFrame, date_col: str = "ret_date", **bounds) -> DataFrame:
    """Distinct return dates with their momentum month and cap month."""
    d = dates.select(F.col(date_col).alias("ret_date")).distinct()
    return with_momentum_months(d, "ret_date", **bounds).select("ret_date", "mom_month", "mc_month")
