"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables through the adapter (so its work grows
with them) and runs over the whole tables.  Double outputs are rounded to six
decimals, the precision the oracle comparison uses.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.contracts import Contract
from ..functions.contracts import contract_report as _contract_report
from ..functions.stats import percentiles, qbucket
from ..functions.stats import tied_edges as _tied_edges
from ..functions.sweep import asof_fill, average_rank, running_product
from ..operators.calendars import monthly_calendar as _monthly_calendar
from ..operators.calendars import rebalance_calendar as _rebalance_calendar
from ..operators.calendars import with_momentum_months
from ..operators.market import index_return, market_premium, risk_free
from ..operators.portfolios import (attach_groups, factor_spreads, momentum_spread, to_wide,
                                    vw_return, vw_weights)
from ..operators.profiling import (clip_negative, fill_sentinel, item_counts, null_counts,
                                   null_sentinel, profile, top_rows)
from ..operators.report import (chart_bounds, chart_feed, cumulative_index, final_rank, report)
from ..operators.signals import characteristics, momentum
from ..operators.snapshots import (annual_balance, annual_operating_profit, month_end_cap,
                                   widen_statement, year_end_cap)
from ..session import scratch_path
from ..sources import adapter as A
from ..sources.bulk_load import bulk_load
from ..sources.drift import read_drifting
from ..sources.facts import read_facts, write_facts
from ..sources.landing import land_json as _land_json
from ..sources.landing import merge_extracts as _merge_extracts
from ..sources.landing import universe as _universe
from ..sources.landing import write_csv, write_envelopes
from ..sources.readers import LISTING_HEADERS, read_listing, read_return_csv
from ..streaming.upsert import read_current, start_upsert
from . import pipelines as P
from .upkeep import FactorStore

DATA_BOUNDS = P.YearlyBounds(A.DATA_RET_START, A.DATA_RET_END, A.DATA_GROUP_START, A.DATA_GROUP_END)
PATTERN = A.FINANCIAL_PATTERN
ROUND = 6


def round_double(c, digits: int = ROUND):
    """Round a double on its binary value: nearest integer of x * 10^d, then / 10^d.

    (``F.round`` rounds the shortest decimal text of the double, which turns a
    value just below a half into an exact half.)
    """
    scale = float(10 ** digits)
    # "+ 0.0" turns a -0.0 (a tiny negative rounded away) into 0.0
    return F.round(c * F.lit(scale), 0) / F.lit(scale) + F.lit(0.0)


def rounded(df: DataFrame, digits: int = ROUND) -> DataFrame:
    """Round every DOUBLE column (comparison precision)."""
    return df.select(*[
        round_double(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
        else F.col(f.name)
        for f in df.schema.fields
    ])


class StoredInputs(P.FactorInputs):
    """The adapter's tables, each stored when it is first asked for."""

    def __init__(self, tables):
        self._tables = tables

    marketcap = cached_property(lambda self: self._tables.marketcap())
    monthret = cached_property(lambda self: self._tables.monthret())
    dayret = cached_property(lambda self: self._tables.dayret())
    balancesheet = cached_property(lambda self: self._tables.balancesheet())
    incomestatement = cached_property(lambda self: self._tables.incomestatement())
    index = cached_property(lambda self: self._tables.taiex())
    bond_yield = cached_property(lambda self: self._tables.bond_yield())
    listings = cached_property(lambda self: [self._tables.listing_tse(), self._tables.listing_otc()])


def inputs(spark: SparkSession, sf_dir: str) -> P.FactorInputs:
    return StoredInputs(A.finance_tables(spark, sf_dir))


# ---------------------------------------------------------------------------
# snapshots
# ---------------------------------------------------------------------------

def q_year_end_cap(spark, sf):
    return year_end_cap(inputs(spark, sf).marketcap).select("stock_id", "year", "MC")


def q_month_end_cap(spark, sf):
    return month_end_cap(inputs(spark, sf).marketcap).select("stock_id", "mc_month", "MC")


def q_widen_balance(spark, sf):
    return rounded(widen_statement(inputs(spark, sf).balancesheet, S.BALANCE_ITEMS))


def q_widen_income(spark, sf):
    return rounded(widen_statement(inputs(spark, sf).incomestatement, S.INCOME_ITEMS))


def q_annual_balance(spark, sf):
    return rounded(annual_balance(inputs(spark, sf).balancesheet))


def q_annual_op(spark, sf):
    return rounded(annual_operating_profit(inputs(spark, sf).incomestatement))


def q_fundamentals(spark, sf):
    return rounded(P.fundamentals(inputs(spark, sf), PATTERN, exclude=False))


def q_exclude_industry(spark, sf):
    return rounded(P.fundamentals(inputs(spark, sf), PATTERN, exclude=True))


def _chars(spark, sf):
    return characteristics(P.fundamentals(inputs(spark, sf), PATTERN))


def q_characteristics(spark, sf):
    return rounded(_chars(spark, sf))


# ---------------------------------------------------------------------------
# signals and buckets
# ---------------------------------------------------------------------------

def q_momentum(spark, sf):
    return rounded(momentum(inputs(spark, sf).monthret))


def q_bucket_size(spark, sf):
    b = qbucket(_chars(spark, sf), "year", "MC", S.SIZE_CUTS, S.SIZE_LABELS, "g_size")
    return b.select("year", "stock_id", "MC", "g_size")


def q_bucket_bm(spark, sf):
    b = qbucket(_chars(spark, sf), "year", "BMratio", S.TERCILE_CUTS, S.BM_LABELS, "g_bm")
    return rounded(b.select("year", "stock_id", "BMratio", "g_bm"))


def q_bucket_mom(spark, sf):
    b = qbucket(momentum(inputs(spark, sf).monthret), "mom_month", "mom", S.TERCILE_CUTS, S.MOM_LABELS, "g_mom")
    return rounded(b.select("stock_id", "mom_month", "mom", "g_mom"))


def q_bucket_edges(spark, sf):
    p = percentiles(_chars(spark, sf), ["year"], {"BMratio": "BMratio", "MC": "MC"}, [0.3, 0.5, 0.7])
    return rounded(p.select("year", F.col("BMratio__n").alias("n"),
                            F.col("BMratio__p0").alias("bm_p30"), F.col("BMratio__p2").alias("bm_p70"),
                            F.col("MC__p1").alias("mc_p50")))


def q_year_groups(spark, sf):
    return P.year_groups(inputs(spark, sf), PATTERN)


# ---------------------------------------------------------------------------
# calendars and panel
# ---------------------------------------------------------------------------

def q_rebalance_calendar(spark, sf):
    return _rebalance_calendar(inputs(spark, sf).monthret, "month", **DATA_BOUNDS.kwargs())


def q_rebalance_calendar_day(spark, sf):
    return _rebalance_calendar(inputs(spark, sf).dayret, "date", **DATA_BOUNDS.kwargs())


def q_monthly_calendar(spark, sf):
    return _monthly_calendar(inputs(spark, sf).dayret, "date")


def _yearly_panel(spark, sf, freq="month"):
    inp = inputs(spark, sf)
    return P.yearly_panel(inp, freq, P.year_groups(inp, PATTERN), DATA_BOUNDS)


def q_factor_panel(spark, sf):
    p = _yearly_panel(spark, sf)
    return rounded(p.select("stock_id", "ret_date", "ret", "year", "MC", "g_size", "g_bm", "g_op", "g_inv"))


# ---------------------------------------------------------------------------
# portfolios
# ---------------------------------------------------------------------------

def _vw(others, sep=""):
    def q(spark, sf):
        return rounded(vw_return(_yearly_panel(spark, sf), "g_size", others, sep))
    return q


def _momentum_panel(spark, sf, freq="month"):
    inp = inputs(spark, sf)
    ret = with_momentum_months(P.returns(inp, freq), "ret_date").drop("mc_month")
    return attach_groups(ret, P.momentum_groups(inp).drop("mc_month"), ["stock_id", "mom_month"])


def q_vw_mom(spark, sf):
    return rounded(vw_return(_momentum_panel(spark, sf), "g_size", ["g_mom"], S.MOMENTUM_SEP))


def q_vw_weights(spark, sf):
    w = vw_weights(_yearly_panel(spark, sf), ["g_size", "g_bm"])
    return rounded(w.select("ret_date", "stock_id", "g_size", "g_bm", "MC", "ret", "weight", "weight_ret"))


def _ports_wide(spark, sf):
    long = vw_return(_yearly_panel(spark, sf), "g_size", ["g_bm", "g_op", "g_inv"], S.YEARLY_SEP)
    return to_wide(long, S.FF_PORTS)


def q_portfolios_wide(spark, sf):
    return rounded(_ports_wide(spark, sf))


def q_five_factors(spark, sf):
    return rounded(factor_spreads(_ports_wide(spark, sf)))


def q_umd(spark, sf):
    long = vw_return(_momentum_panel(spark, sf), "g_size", ["g_mom"], S.MOMENTUM_SEP)
    return rounded(momentum_spread(to_wide(long, S.MOM_PORTS)).select("ret_date", "UMD"))


# ---------------------------------------------------------------------------
# market
# ---------------------------------------------------------------------------

def q_index_ret_month(spark, sf):
    return rounded(index_return(inputs(spark, sf).index, "month"))


def q_index_ret_day(spark, sf):
    return rounded(index_return(inputs(spark, sf).index, "day"))


def q_rf_month(spark, sf):
    return rounded(risk_free(inputs(spark, sf).bond_yield, "month"))


def q_rf_day_ffill(spark, sf):
    inp = inputs(spark, sf)
    return rounded(risk_free(inp.bond_yield, "day", index_days=index_return(inp.index, "day")))


def q_mktpr_month(spark, sf):
    return rounded(P.market_series(inputs(spark, sf), "month"))


def q_mktpr_day(spark, sf):
    return rounded(P.market_series(inputs(spark, sf), "day"))


# ---------------------------------------------------------------------------
# pipelines
# ---------------------------------------------------------------------------

def _five(spark, sf, freq):
    return P.five_factor(inputs(spark, sf), freq, DATA_BOUNDS, pattern=PATTERN)


def _umd(spark, sf, freq):
    return P.momentum_factor_table(inputs(spark, sf), freq)


def q_five_factor_month(spark, sf):
    return rounded(_five(spark, sf, "month")["wide"])


def q_five_factor_day(spark, sf):
    return rounded(_five(spark, sf, "day")["wide"])


def q_umd_month(spark, sf):
    return rounded(_umd(spark, sf, "month")["wide"])


def q_umd_day(spark, sf):
    return rounded(_umd(spark, sf, "day")["wide"])


def _six(spark, sf):
    inp = inputs(spark, sf)
    five = P.five_factor(inp, "month", DATA_BOUNDS, pattern=PATTERN)["wide"]
    umd = P.momentum_factor_table(inp, "month")["wide"]
    return P.six_factor(five, umd)


def q_six_factor_wide(spark, sf):
    return rounded(_six(spark, sf)["wide"])


def q_six_factor_long(spark, sf):
    return rounded(_six(spark, sf)["long"])


# ---------------------------------------------------------------------------
# report
# ---------------------------------------------------------------------------

def q_cumret(spark, sf):
    return rounded(cumulative_index(_six(spark, sf)["long"]))


def q_port_rank(spark, sf):
    return rounded(final_rank(cumulative_index(_six(spark, sf)["long"])))


def q_report_table(spark, sf):
    return rounded(report(_six(spark, sf)["long"]))


def q_chart_feed(spark, sf):
    return rounded(chart_feed(_six(spark, sf)["long"]))


def q_chart_bounds(spark, sf):
    return chart_bounds(chart_feed(_six(spark, sf)["long"]))


def q_item_counts(spark, sf):
    return item_counts(inputs(spark, sf).incomestatement)


# ---------------------------------------------------------------------------
# data care
# ---------------------------------------------------------------------------

def q_profile_describe(spark, sf):
    return rounded(profile(inputs(spark, sf).dayret, ["ret"]))


def q_profile_caps(spark, sf):
    return rounded(profile(inputs(spark, sf).marketcap, ["market_value"]))


def q_profile_monthret(spark, sf):
    return rounded(profile(inputs(spark, sf).monthret, ["ret"]))


def q_profile_prices(spark, sf):
    prices = A.finance_tables(spark, sf).adjprice_new()
    return rounded(profile(prices, ["open", "max", "min", "close", "spread"]))


def q_null_counts(spark, sf):
    return null_counts(inputs(spark, sf).incomestatement)


def q_null_sentinel(spark, sf):
    """June returns carry the marker besides the missing ones; all of them become NULL."""
    staged = fill_sentinel(inputs(spark, sf).monthret)
    marked = staged.withColumn("ret", F.when(F.month("month") == 6, F.lit(S.MISSING_RETURN_SENTINEL)).otherwise(F.col("ret")))
    return rounded(null_sentinel(marked))


def q_clip_caps(spark, sf):
    """Caps of every fifth day of the month are reported with a minus sign and clip to 0."""
    caps = inputs(spark, sf).marketcap
    signed = caps.withColumn("market_value", F.when(F.dayofmonth("date") % 5 == 0, -F.col("market_value")).otherwise(F.col("market_value")))
    return clip_negative(signed, "market_value").select("date", "stock_id", "market_value")


def q_clip_negative(spark, sf):
    return rounded(clip_negative(inputs(spark, sf).balancesheet, "value"))


def q_merge_extracts(spark, sf):
    t = A.finance_tables(spark, sf)
    return rounded(_merge_extracts([t.adjprice_old(), t.adjprice_new()], ["date", "stock_id"]))


def q_universe(spark, sf):
    t = A.finance_tables(spark, sf)
    return _universe(t.listing_tse(), t.listing_otc(), t.delisted())


def q_top_rows(spark, sf):
    return top_rows(inputs(spark, sf).marketcap, ["date", "stock_id"], 5)


def q_land_json(spark, sf):
    """Landed per-company JSON responses (written from the balance sheet) read back."""
    path = scratch_path(spark, "landed-balancesheet")
    write_envelopes(inputs(spark, sf).balancesheet, "stock_id", path)
    return rounded(_land_json(spark, path, S.STATEMENT))


def q_csv_roundtrip(spark, sf):
    """Returns staged to CSV with the missing-value marker, bulk-read back and repaired."""
    path = scratch_path(spark, "staged-monthret")
    write_csv(fill_sentinel(inputs(spark, sf).monthret), path)
    return rounded(read_return_csv(spark, path))


# ---------------------------------------------------------------------------
# as-of values, ranks and products over range slices
# ---------------------------------------------------------------------------

def _book(spark, sf):
    return widen_statement(inputs(spark, sf).balancesheet, S.BALANCE_ITEMS)


def q_asof_book_day(spark, sf):
    """Every stock-day with the book values of its stock's last statement."""
    return rounded(asof_fill(inputs(spark, sf).marketcap, _book(spark, sf), "date", ["stock_id"]))


def q_asof_book_recent(spark, sf):
    """The same, statements of the last 60 days only."""
    return rounded(asof_fill(inputs(spark, sf).marketcap, _book(spark, sf), "date", ["stock_id"], max_age_days=60))


def q_rank_stocks_month(spark, sf):
    return rounded(average_rank(inputs(spark, sf).monthret, "ret", ["month"]))


def q_rank_stocks_all(spark, sf):
    """All stock-days of all time in one ranking of their caps."""
    return average_rank(inputs(spark, sf).marketcap, "market_value")


def q_cumret_stock_day(spark, sf):
    return rounded(running_product(inputs(spark, sf).dayret, "ret", "date", ["stock_id"], out="cumret", base=100.0))


# ---------------------------------------------------------------------------
# bulk load, keyed landing, upkeep, contracts
# ---------------------------------------------------------------------------

def _staged_statements(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The balance sheet staged as CSV text and loaded back.

    Some texts hold quotes, separators and line ends; four kinds of records are
    spoiled, one each by quarter and by the stock's number modulo 4.
    """
    b = inputs(spark, sf).balancesheet
    sid, month, day = F.col("stock_id").cast("long"), F.month("date"), F.date_format("date", "yyyy-MM-dd")
    text = F.when(sid % 5 == 0, F.concat(F.lit('"'), F.col("origin_name"), F.lit(' ""A"", x\ny"'))).otherwise(F.col("origin_name"))
    good = F.concat_ws(",", day, "stock_id", "type", F.col("value").cast("string"), text)
    line = (F.when((sid % 4 == 0) & (month == 3), F.concat_ws(",", day, "stock_id", "type", F.lit("n/a,x")))
            .when((sid % 4 == 1) & (month == 6), F.concat_ws(",", day, "stock_id", "type"))
            .when((sid % 4 == 2) & (month == 9), F.concat_ws(",", day, "stock_id", "type", F.lit("1.5,a,b")))
            .when((sid % 4 == 3) & (month == 12), F.concat_ws(",", F.concat(F.year("date"), F.lit("-13-31")), "stock_id", "type",
                                                              F.lit("1.5,a"))).otherwise(good))
    path = scratch_path(spark, "staged-statements")
    b.select(line.alias("value")).write.text(path)
    return bulk_load(spark, path, S.STATEMENT, header=False)


def q_bulk_load_rows(spark, sf):
    return rounded(_staged_statements(spark, sf)[0])


def q_bulk_load_rejects(spark, sf):
    return _staged_statements(spark, sf)[1].select("record", "reason")


def q_landed_upsert(spark, sf):
    """Two downloads of statements through the stream, the second correcting the first, then the first once more."""
    b = inputs(spark, sf).balancesheet
    first = b.where(F.col("date") < F.lit("1997-01-01").cast("date")).withColumn("value", F.col("value") + 1.0)
    second = b.where(F.col("date") >= F.lit("1996-07-01").cast("date"))
    src, table, state = (scratch_path(spark, f"upsert-{x}") for x in ("files", "table", "state"))
    version = F.regexp_extract("_metadata.file_path", "wave-([0-9]+)", 1).cast("int")
    for name, wave in (("wave-1", first), ("wave-2", second), ("wave-1-again", first)):
        write_envelopes(wave, "stock_id", f"{src}/{name}")
        start_upsert(spark, src, S.STATEMENT, ["date", "stock_id", "type"], table, state, version).awaitTermination()
    return rounded(read_current(spark, table, S.STATEMENT))


def q_incremental_umd_month(spark, sf):
    """The momentum table of a store built from an older extract with faults, after the newer extract is taken over."""
    inp = inputs(spark, sf)
    sid, split, since = F.col("stock_id").cast("long"), F.lit("2001-07-01").cast("date"), F.lit("2001-04-01").cast("date")
    late = F.col("month") >= since
    old_r = (inp.monthret.where((F.col("month") < split) & ~(late & (sid % 7 == 0)))
             .withColumn("ret", F.when(late & (sid % 5 == 0), F.col("ret") + 0.1).otherwise(F.col("ret"))))
    old_c = (inp.marketcap.where(F.col("date") < split)
             .withColumn("market_value", F.when((F.col("date") >= since) & (sid % 3 == 0), F.col("market_value") * 2)
                         .otherwise(F.col("market_value"))))
    store = FactorStore(spark, scratch_path(spark, "factor-store")).build(old_r, old_c)
    store.apply_extract(inp.monthret.where(late), inp.marketcap.where(F.col("date") >= since))
    return rounded(store.factors())


CONTRACTS = [
    Contract("marketcap", S.MARKETCAP, ("date", "stock_id"), ("date", "stock_id", "market_value"),
             least={"market_value": 0}, most={"market_value": 100_000}, longest={"stock_id": 20}),
    Contract("monthret", S.MONTHRET, ("stock_id", "month"), ("stock_id", "month", "ret"), least={"ret": -1}, longest={"stock_id": 20}),
    Contract("dayret", S.DAYRET, ("stock_id", "date"), ("stock_id", "date", "ret"), least={"ret": -1}, most={"ret": 0.5}),
    Contract("balancesheet", S.STATEMENT, ("date", "stock_id"), ("date", "stock_id", "type", "value"),
             least={"value": 0}, longest={"origin_name": 6}, allowed={"type": ("Equity",)}),
]


def q_contract_report(spark, sf):
    """The rules of four tables; some are set so that the data break them."""
    inp = inputs(spark, sf)
    out = None
    for c in CONTRACTS:
        one = _contract_report(getattr(inp, c.name), c)
        out = one if out is None else out.unionByName(one)
    return out


def q_listing_csv(spark, sf):
    """Listing files with the headers of their source, written and read back."""
    t = A.finance_tables(spark, sf)
    source = {v: k for k, v in LISTING_HEADERS.items()}
    path = scratch_path(spark, "staged-listing")
    listing = t.listing_tse().unionByName(t.listing_otc()).select("stock_id", "industry")
    write_csv(listing.withColumn("note", F.lit('a "b", c')).withColumnsRenamed(source), path)
    return read_listing(spark, path)


def q_bucket_tied_edges(spark, sf):
    """Months in which caps in steps of 50,000 leave bin edges equal."""
    caps = month_end_cap(inputs(spark, sf).marketcap).withColumn("level", F.floor(F.col("MC") / 50_000))
    specs = [("level", S.SIZE_CUTS, S.SIZE_LABELS, "size"), ("level", S.TERCILE_CUTS, S.MOM_LABELS, "tercile")]
    return _tied_edges(caps, ["mc_month"], specs)


def q_five_factor_day_range(spark, sf):
    """The daily five factors of two grouping years, from a panel stored by grouping year."""
    inp = inputs(spark, sf)
    path = scratch_path(spark, "dayret-facts")
    write_facts(inp.dayret, path, "date")
    inp.dayret = read_facts(spark, path, S.DAYRET)
    bounds = P.YearlyBounds(group_start="1998-12-01", group_end="1999-12-01")
    return rounded(P.five_factor(inp, "day", bounds, pattern=PATTERN)["wide"])


def q_union_drift(spark, sf):
    """Three extracts of returns: numbers for codes and another name of the return, an extra text, no return but lots."""
    r = inputs(spark, sf).monthret
    year = F.year("month")
    parts = {
        "early": r.where(year < 1997).select(F.col("stock_id").cast("int").alias("stock_id"), "month", F.col("ret").alias("Mtrue_ret")),
        "middle": r.where(year.between(1997, 1998)).select("month", "stock_id", "ret", F.lit("checked").alias("note"),
                                                           F.month("month").alias("lots")),
        "late": r.where(year > 1998).select("stock_id", "month", F.length("stock_id").cast("long").alias("lots")),
        "later": r.where(year > 1998).select("stock_id", F.add_months("month", 120).alias("month"), F.lit(7).cast("long").alias("lots")),
    }
    paths = {n: scratch_path(spark, f"drift-{n}") for n in parts}
    for n, df in parts.items():
        df.write.parquet(paths[n])
    return rounded(read_drifting(spark, paths, {"Mtrue_ret": "ret"}))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "year_end_cap": q_year_end_cap,
    "month_end_cap": q_month_end_cap,
    "widen_balance": q_widen_balance,
    "widen_income": q_widen_income,
    "annual_balance": q_annual_balance,
    "annual_op": q_annual_op,
    "fundamentals": q_fundamentals,
    "exclude_industry": q_exclude_industry,
    "characteristics": q_characteristics,
    "momentum": q_momentum,
    "bucket_size": q_bucket_size,
    "bucket_bm": q_bucket_bm,
    "bucket_mom": q_bucket_mom,
    "bucket_edges": q_bucket_edges,
    "year_groups": q_year_groups,
    "rebalance_calendar": q_rebalance_calendar,
    "rebalance_calendar_day": q_rebalance_calendar_day,
    "monthly_calendar": q_monthly_calendar,
    "factor_panel": q_factor_panel,
    "vw_bm": _vw(["g_bm"]),
    "vw_op": _vw(["g_op"]),
    "vw_inv": _vw(["g_inv"]),
    "vw_all": _vw(["g_bm", "g_op", "g_inv"]),
    "vw_mom": q_vw_mom,
    "vw_weights": q_vw_weights,
    "portfolios_wide": q_portfolios_wide,
    "five_factors": q_five_factors,
    "umd": q_umd,
    "index_ret_month": q_index_ret_month,
    "index_ret_day": q_index_ret_day,
    "rf_month": q_rf_month,
    "rf_day_ffill": q_rf_day_ffill,
    "mktpr_month": q_mktpr_month,
    "mktpr_day": q_mktpr_day,
    "five_factor_month": q_five_factor_month,
    "five_factor_day": q_five_factor_day,
    "umd_month": q_umd_month,
    "umd_day": q_umd_day,
    "six_factor_wide": q_six_factor_wide,
    "six_factor_long": q_six_factor_long,
    "cumret": q_cumret,
    "port_rank": q_port_rank,
    "report_table": q_report_table,
    "chart_feed": q_chart_feed,
    "chart_bounds": q_chart_bounds,
    "item_counts": q_item_counts,
    "profile_describe": q_profile_describe,
    "profile_caps": q_profile_caps,
    "profile_monthret": q_profile_monthret,
    "profile_prices": q_profile_prices,
    "null_counts": q_null_counts,
    "null_sentinel": q_null_sentinel,
    "clip_negative": q_clip_negative,
    "clip_caps": q_clip_caps,
    "merge_extracts": q_merge_extracts,
    "universe": q_universe,
    "top_rows": q_top_rows,
    "land_json": q_land_json,
    "csv_roundtrip": q_csv_roundtrip,
    "asof_book_day": q_asof_book_day,
    "asof_book_recent": q_asof_book_recent,
    "rank_stocks_month": q_rank_stocks_month,
    "rank_stocks_all": q_rank_stocks_all,
    "cumret_stock_day": q_cumret_stock_day,
    "bulk_load_rows": q_bulk_load_rows,
    "bulk_load_rejects": q_bulk_load_rejects,
    "landed_upsert": q_landed_upsert,
    "incremental_umd_month": q_incremental_umd_month,
    "contract_report": q_contract_report,
    "listing_csv": q_listing_csv,
    "bucket_tied_edges": q_bucket_tied_edges,
    "five_factor_day_range": q_five_factor_day_range,
    "union_drift": q_union_drift,
}

# keys without an SQL oracle
ROWS_ONLY: set[str] = set()
