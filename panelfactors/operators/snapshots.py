"""Period-end snapshots and statement shaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.dates import month_key, year_key
from ..functions.guards import fail_when


def period_last(df: DataFrame, keys: list[str], period: Column, period_name: str,
                order: str, value: str, alias: str, within_month: bool = False) -> DataFrame:
    """Last ``value`` per entity and period by ``order``.

    ``max_by`` on a primitive ordering is a hash aggregate that combines
    map-side before the shuffle; a NULL value at the last date stays NULL.
    Sources are keyed by (entity, date); a repeated date within a year or
    shorter period fails the job.  The check is part of the same aggregation:
    the days seen are bits (of ``_DAY_WORDS`` long values, of one where no period
    exceeds a month), and their sum differs from their OR exactly when a day repeats.
    """
    day = (F.dayofmonth(order) if within_month else F.dayofyear(order)) - 1
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), day % _DAY_BITS)
    aggs = [F.max_by(value, order).alias(alias)]
    repeated = F.lit(False)
    for w in range(1 if within_month else _DAY_WORDS):
        here = F.when(F.floor(day / _DAY_BITS) == w, bit)
        aggs += [F.sum(here).alias(f"_sum{w}"), F.bit_or(here).alias(f"_or{w}")]
        repeated = repeated | F.coalesce(F.col(f"_sum{w}") != F.col(f"_or{w}"), F.lit(False))
    last = df.groupBy(*keys, period.alias(period_name)).agg(*aggs)
    return (last.filter(fail_when(repeated, f"repeated date of one {', '.join(keys)}"))
            .select(*keys, period_name, alias))


#: bits of a long that hold one day each (sums stay exact up to 2^15 repeats), and the words of a year
_DAY_BITS, _DAY_WORDS = 48, 8


def year_end_cap(marketcap: DataFrame) -> DataFrame:
    """Last market value of each stock and calendar year, zero caps removed."""
    caps = period_last(marketcap, ["stock_id"], year_key("date"), "year", "date", "market_value", "MC")
    return caps.filter(F.col("MC") != 0)


def month_end_cap(marketcap: DataFrame) -> DataFrame:
    """Last market value of each stock and month (zero caps kept)."""
    return period_last(marketcap, ["stock_id"], month_key("date"), "mc_month", "date", "market_value", "MC", within_month=True)


def widen_statement(df: DataFrame, items: list[str], keys=("date", "stock_id")) -> DataFrame:
    """Long line items -> one column per item.

    The key (date, stock_id, type) must be unique: a repeated one fails the job
    (the check is a filter inside the same aggregation, so it cannot be pruned).
    """
    keys = list(keys)
    t = F.col("type")
    aggs, dup = [], None
    for item in items:
        aggs.append(F.first(F.when(t == item, F.col("value")), ignorenulls=True).alias(item))
        cnt = F.count(F.when(t == item, F.lit(1)))
        aggs.append(cnt.alias(f"_cnt_{item}"))
    wide = df.filter(t.isin(items)).groupBy(*keys).agg(*aggs)
    for item in items:
        c = F.col(f"_cnt_{item}") > 1
        dup = c if dup is None else (dup | c)
    wide = wide.filter(F.when(dup, F.raise_error(F.lit("duplicate statement key (date, stock_id, type)")))
                       .otherwise(F.lit(True)))
    return wide.select(*keys, *items)


def annual_balance(balancesheet: DataFrame) -> DataFrame:
    """Year-end (December) balance sheets with positive equity.

    Keyed by the statement's month start, so a December report is ``yyyy-12-01``.
    """
    wide = widen_statement(balancesheet, S.BALANCE_ITEMS)
    return (wide.select(month_key("date").alias("year"), "stock_id", *S.BALANCE_ITEMS)
            .filter((F.col("Equity") > 0) & (F.month("year") == 12)))


def annual_operating_profit(incomestatement: DataFrame, with_quarters: bool = False) -> DataFrame:
    """Revenue - cost of goods sold - operating expenses, summed per year (U4).

    Only quarters with all three items count; like the reference there is no
    check that four are present - ``with_quarters=True`` adds ``n_quarters``
    so a caller can apply one.
    """
    wide = widen_statement(incomestatement, S.INCOME_ITEMS).na.drop(subset=S.INCOME_ITEMS)
    op = F.col("Revenue") - F.col("CostOfGoodsSold") - F.col("OperatingExpenses")
    aggs = [F.sum(op).alias("yOP")]
    if with_quarters:
        aggs.append(F.count(F.lit(1)).alias("n_quarters"))
    return wide.groupBy("stock_id", year_key("date").alias("year")).agg(*aggs)


def assemble_fundamentals(balance: DataFrame, caps: DataFrame, profit: DataFrame) -> DataFrame:
    """Balance sheet + year-end cap + yearly profit, complete rows only.

    The reference's two left joins followed by dropping incomplete rows are
    inner joins on (stock_id, year).
    """
    return (balance.join(caps, ["stock_id", "year"], "inner")
            .join(profit, ["stock_id", "year"], "inner")
            .select("year", "stock_id", "Equity", "TotalAssets", "MC", "yOP")
            .na.drop())
