"""Date keys as Column expressions (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def year_key(date) -> Column:
    """The year a date belongs to, keyed by December 1st (``yyyy-12-01``)."""
    d = _c(date)
    return F.make_date(F.year(d), F.lit(12), F.lit(1))


def month_key(date) -> Column:
    """First day of the date's month."""
    return F.trunc(_c(date), "month")


def quarter_end(date) -> Column:
    """Last day of the date's calendar quarter."""
    return F.last_day(F.add_months(F.trunc(_c(date), "quarter"), 2))


def previous_month(month) -> Column:
    return F.add_months(_c(month), -1)


def rebalance_year(ret_date) -> Column:
    """Grouping year for a return date: July y ... June y+1 use December y-1.

    Closed form of the yearly rebalance calendar, so no calendar table is
    generated or joined: a return dated in the first half of year y belongs to
    the groups formed at December y-2, the second half to December y-1.
    """
    d = _c(ret_date)
    return F.make_date(F.year(F.add_months(d, -6)) - 1, F.lit(12), F.lit(1))


def parse_slash_date(text) -> Column:
    """``yyyy/M/d`` text (padded or not) to DATE."""
    return F.to_date(_c(text), "yyyy/M/d")


def between_dates(col, start: str | None, end: str | None) -> Column:
    c = _c(col)
    cond = F.lit(True)
    if start is not None:
        cond = cond & (c >= F.lit(start).cast("date"))
    if end is not None:
        cond = cond & (c <= F.lit(end).cast("date"))
    return cond
