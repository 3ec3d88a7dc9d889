"""Factor tables composed from the operators.

Plan shape (both frequencies):

* sort groups are built on the stock-period grain (one row per stock and year
  or month) - small next to the return panel;
* the return panel is scanned once with the calendar as a pushed-down filter
  and a computed period key, and joined once to the groups on
  (stock_id, period) - a key holds one period of one stock, so no key is hot;
* portfolio returns are one aggregation with map-side partial sums, then a
  pivot of the (date x portfolio) table, which is small.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.stats import DEFAULT_METHOD, bucket_frames, qbuckets
from ..operators.calendars import with_momentum_months, with_rebalance_year
from ..operators.market import index_return, market_premium, risk_free
from ..operators.portfolios import (attach_groups, factor_spreads, momentum_spread, to_wide,
                                    vw_return)
from ..operators.report import to_long
from ..operators.signals import characteristics, exclude_industry, momentum
from ..operators.snapshots import (annual_balance, annual_operating_profit, assemble_fundamentals,
                                   month_end_cap, year_end_cap)


@dataclass
class FactorInputs:
    """The finance tables a factor run reads (any source: adapter, parquet, CSV)."""

    marketcap: DataFrame
    monthret: DataFrame          # stock_id, month, ret
    dayret: DataFrame            # stock_id, date, ret
    balancesheet: DataFrame
    incomestatement: DataFrame
    index: DataFrame             # date, stock_id, price
    bond_yield: DataFrame        # date text, close
    listings: list[DataFrame]    # stock_id, industry


@dataclass
class YearlyBounds:
    """Range of the yearly calendar; open by default, so no return is dropped."""

    ret_start: str | None = None
    ret_end: str | None = None
    group_start: str | None = None
    group_end: str | None = None

    def kwargs(self):
        return dict(ret_start=self.ret_start, ret_end=self.ret_end,
                    group_start=self.group_start, group_end=self.group_end)


@dataclass
class MomentumBounds:
    """Range of the momentum calendar; open by default."""

    ret_start: str | None = None
    ret_end: str | None = None

    def kwargs(self):
        return dict(ret_start=self.ret_start, ret_end=self.ret_end)


#: the fixed sample period, to be passed explicitly (with ``until=S.FACTOR_UNTIL``)
SAMPLE_YEARLY = YearlyBounds(S.YEARLY_RET_START, S.YEARLY_RET_END, S.YEARLY_GROUP_START, S.YEARLY_GROUP_END)
SAMPLE_MOMENTUM = MomentumBounds(S.MOMENTUM_RET_START, S.MOMENTUM_RET_END)


def _check_freq(freq: str) -> None:
    if freq not in ("month", "day"):
        raise ValueError(f"unknown return frequency {freq!r}: use 'month' or 'day'")


def returns(inp: FactorInputs, freq: str, drop_missing: bool = True) -> DataFrame:
    _check_freq(freq)
    src, day = (inp.monthret, "month") if freq == "month" else (inp.dayret, "date")
    stored = [c for c in ("group_year",) if c in src.columns]   # of panels stored by grouping year (sources/facts.py)
    r = src.select("stock_id", F.col(day).alias("ret_date"), "ret", *stored)
    return r.na.drop() if drop_missing else r


def fundamentals(inp: FactorInputs, pattern: str = S.FINANCIAL_INDUSTRY,
                 exclude: bool = True) -> DataFrame:
    caps = year_end_cap(inp.marketcap)
    bal = annual_balance(inp.balancesheet)
    op = annual_operating_profit(inp.incomestatement)
    fund = assemble_fundamentals(bal, caps, op)
    return exclude_industry(fund, inp.listings, pattern) if exclude else fund


def year_groups(inp: FactorInputs, pattern: str = S.FINANCIAL_INDUSTRY,
                method: str | None = None) -> DataFrame:
    """Per year and stock: December cap and the four independent sorts."""
    chars = characteristics(fundamentals(inp, pattern))
    specs = [
        ("MC", S.SIZE_CUTS, S.SIZE_LABELS, "g_size"),
        ("BMratio", S.TERCILE_CUTS, S.BM_LABELS, "g_bm"),
        ("OPtoE", S.TERCILE_CUTS, S.OP_LABELS, "g_op"),
        ("Inv", S.TERCILE_CUTS, S.INV_LABELS, "g_inv"),
    ]
    g = qbuckets(chars, ["year"], specs, method=method)
    return g.select("year", "stock_id", "MC", "g_size", "g_bm", "g_op", "g_inv")


def yearly_panel(inp: FactorInputs, freq: str, groups: DataFrame,
                 bounds: YearlyBounds = YearlyBounds()) -> DataFrame:
    ret = with_rebalance_year(returns(inp, freq), "ret_date", **bounds.kwargs())
    return attach_groups(ret, groups, ["stock_id", "year"])


def market_series(inp: FactorInputs, freq: str) -> DataFrame:
    idx = index_return(inp.index, freq)
    rf = risk_free(inp.bond_yield, freq, index_days=idx if freq == "day" else None)
    return market_premium(idx, rf)


def five_factor(inp: FactorInputs, freq: str, bounds: YearlyBounds = YearlyBounds(),
                until: str | None = None, pattern: str = S.FINANCIAL_INDUSTRY,
                method: str | None = None, groups: DataFrame | None = None) -> dict[str, DataFrame]:
    """Five-factor table (U23): 18 portfolios, HML RMW CMA SMB3 SMB5, MKTPR."""
    _check_freq(freq)
    if groups is None:
        groups = year_groups(inp, pattern, method)
    panel = yearly_panel(inp, freq, groups, bounds)
    long = vw_return(panel, "g_size", ["g_bm", "g_op", "g_inv"], S.YEARLY_SEP)
    wide = factor_spreads(to_wide(long, S.FF_PORTS))
    wide = wide.join(market_series(inp, freq), "ret_date", "left")
    if until is not None:
        wide = wide.filter(F.col("ret_date") < F.lit(until).cast("date"))
    wide = wide.select("ret_date", *S.FF_PORTS, *S.FF_FACTORS, "MKTPR")
    return {"wide": wide, "long": to_long(wide)}


def momentum_groups(inp: FactorInputs, method: str | None = None,
                    exclude_pattern: str | None = None) -> DataFrame:
    """Per stock and momentum month: momentum tercile and the previous month's size half.

    Both sorts are formed over their own full cross-section first (momentum
    over all stocks with a signal, size over all stocks with a cap) and only
    then joined, so the return panel meets a single group table.  With the
    edges method both sorts share one selection pass.

    Like the reference's code (not its prose), financial companies stay in the
    momentum sorts; ``exclude_pattern`` drops them before sorting.
    """
    mom, caps = momentum(inp.monthret), month_end_cap(inp.marketcap)
    if exclude_pattern is not None:
        mom = exclude_industry(mom, inp.listings, exclude_pattern)
        caps = exclude_industry(caps, inp.listings, exclude_pattern)
    return momentum_sorts(mom, caps, method)


def momentum_sorts(mom: DataFrame, caps: DataFrame, method: str | None = None) -> DataFrame:
    """The two sorts of ``momentum_groups`` over given signals and month-end caps, joined."""
    mom_specs = [("mom", S.TERCILE_CUTS, S.MOM_LABELS, "g_mom")]
    cap_specs = [("MC", S.SIZE_CUTS, S.SIZE_LABELS, "g_size")]
    if (method or DEFAULT_METHOD) == "edges":
        mom, caps = bucket_frames([(mom, ["mom_month"], mom_specs), (caps, ["mc_month"], cap_specs)])
    else:
        mom = qbuckets(mom, ["mom_month"], mom_specs, method=method)
        caps = qbuckets(caps, ["mc_month"], cap_specs, method=method)
    mom = mom.withColumn("mc_month", F.add_months("mom_month", -1))
    return mom.join(caps, ["stock_id", "mc_month"], "inner").select(
        "stock_id", "mom_month", "mc_month", "mom", "g_mom", "MC", "g_size")


def momentum_factor_table(inp: FactorInputs, freq: str, bounds: MomentumBounds = MomentumBounds(),
                          method: str | None = None, groups: DataFrame | None = None,
                          exclude_pattern: str | None = None) -> dict[str, DataFrame]:
    """Momentum table (U24): six size x momentum portfolios and UMD."""
    _check_freq(freq)
    if groups is None:
        groups = momentum_groups(inp, method, exclude_pattern)
    wide = momentum_wide(returns(inp, freq), groups, bounds)
    return {"wide": wide, "long": to_long(wide)}


def momentum_wide(ret: DataFrame, groups: DataFrame, bounds: MomentumBounds = MomentumBounds()) -> DataFrame:
    """Wide momentum table of returns (stock_id, ret_date, ret) over given groups."""
    ret = with_momentum_months(ret, "ret_date", **bounds.kwargs()).drop("mc_month")
    panel = attach_groups(ret, groups.drop("mc_month"), ["stock_id", "mom_month"])
    long = vw_return(panel, "g_size", ["g_mom"], S.MOMENTUM_SEP)
    return momentum_spread(to_wide(long, S.MOM_PORTS)).select("ret_date", *S.MOM_PORTS, "UMD")


def six_factor(five_wide: DataFrame, umd_wide: DataFrame) -> dict[str, DataFrame]:
    """Five-factor and momentum tables on common dates (U25), wide and long."""
    wide = five_wide.join(umd_wide, "ret_date", "inner")
    return {"wide": wide, "long": to_long(wide)}


def factor_tables(inp: FactorInputs, bounds: YearlyBounds = YearlyBounds(),
                  mom_bounds: MomentumBounds = MomentumBounds(), until: str | None = None,
                  pattern: str = S.FINANCIAL_INDUSTRY, method: str | None = None) -> dict[str, DataFrame]:
    """Monthly and daily five-factor and momentum tables plus the six-factor table.

    The sort groups (stock-year and stock-month grain) are built once and
    checkpointed to the shared checkpoint folder, then reused by both
    frequencies - the reference rebuilds them for every frequency.
    """
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(inp.marketcap.sparkSession)
    ygroups = year_groups(inp, pattern, method).checkpoint(eager=True)
    mgroups = momentum_groups(inp, method).checkpoint(eager=True)
    out = {}
    for freq in ("month", "day"):
        five = five_factor(inp, freq, bounds, until, pattern, method, groups=ygroups)
        umd = momentum_factor_table(inp, freq, mom_bounds, method, groups=mgroups)
        out[f"five_factor_{freq}"] = five["wide"]
        out[f"umd_{freq}"] = umd["wide"]
    six = six_factor(out["five_factor_month"], out["umd_month"])
    out["six_factor_wide"], out["six_factor_long"] = six["wide"], six["long"]
    return out
