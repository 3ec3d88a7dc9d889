"""Operator unit tests on tiny literal frames, one per semantic trap."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelfactors import schemas as S
from panelfactors.operators import market, portfolios, report, signals, snapshots
from panelfactors.operators.calendars import with_momentum_months, with_rebalance_year

D = dt.date


def _stmt(spark, rows):
    return spark.createDataFrame(rows, S.STATEMENT)


# ---- snapshots -------------------------------------------------------------

def test_duplicate_statement_key_raises(spark):
    bs = _stmt(spark, [(D(2012, 12, 31), "1101", "Equity", 1.0, "e"),
                       (D(2012, 12, 31), "1101", "Equity", 2.0, "e")])
    with pytest.raises(Exception, match="duplicate statement key"):
        snapshots.widen_statement(bs, S.BALANCE_ITEMS).collect()


def test_widen_keeps_missing_items_null(spark):
    inc = _stmt(spark, [(D(2012, 3, 31), "1", "Revenue", 10.0, "r"),
                        (D(2012, 3, 31), "1", "CostOfGoodsSold", 4.0, "c")])
    row = snapshots.widen_statement(inc, S.INCOME_ITEMS).collect()[0]
    assert row.Revenue == 10.0 and row.OperatingExpenses is None
    assert snapshots.annual_operating_profit(inc).count() == 0  # incomplete quarter skipped
    full = inc.unionByName(_stmt(spark, [(D(2012, 3, 31), "1", "OperatingExpenses", 1.0, None),
                                         (D(2012, 6, 30), "1", "Revenue", 7.0, None),
                                         (D(2012, 6, 30), "1", "CostOfGoodsSold", 2.0, None),
                                         (D(2012, 6, 30), "1", "OperatingExpenses", 1.0, None)]))
    y = snapshots.annual_operating_profit(full, with_quarters=True).first()
    assert (y.yOP, y.n_quarters) == (9.0, 2)


def test_annual_balance_only_december_positive_equity(spark):
    bs = _stmt(spark, [
        (D(2012, 1, 31), "1", "Equity", 5.0, None), (D(2012, 1, 31), "1", "TotalAssets", 9.0, None),
        (D(2012, 12, 31), "1", "Equity", 5.0, None), (D(2012, 12, 31), "1", "TotalAssets", 9.0, None),
        (D(2013, 12, 31), "1", "Equity", -1.0, None), (D(2013, 12, 31), "1", "TotalAssets", 9.0, None),
    ])
    rows = snapshots.annual_balance(bs).collect()
    assert [(r.year, r.Equity) for r in rows] == [(D(2012, 12, 1), 5.0)]


def test_period_end_caps(spark):
    caps = spark.createDataFrame([
        (D(2012, 5, 2), "1", 10), (D(2012, 12, 28), "1", 0), (D(2013, 3, 1), "1", 7),
        (D(2012, 5, 31), "2", 3), (D(2012, 5, 1), "2", 4),
    ], S.MARKETCAP)
    ye = {(r.stock_id, r.year): r.MC for r in snapshots.year_end_cap(caps).collect()}
    assert ye == {("1", D(2013, 12, 1)): 7, ("2", D(2012, 12, 1)): 3}  # zero year-end cap removed
    me = {(r.stock_id, r.mc_month): r.MC for r in snapshots.month_end_cap(caps).collect()}
    assert me[("1", D(2012, 12, 1))] == 0 and me[("2", D(2012, 5, 1))] == 3
    # a NULL at the last date stays NULL (no fallback to an earlier value)
    last_null = spark.createDataFrame([(D(2012, 6, 30), "4", None), (D(2012, 6, 1), "4", 2)], S.MARKETCAP)
    assert snapshots.month_end_cap(last_null).first().MC is None


# ---- signals ---------------------------------------------------------------

def test_asset_growth_lag_spans_a_missing_year(spark):
    fund = spark.createDataFrame([
        (D(2010, 12, 1), "1", 1.0, 100.0, 10, 1.0),
        (D(2012, 12, 1), "1", 1.0, 200.0, 10, 1.0),
    ], "year date, stock_id string, Equity double, TotalAssets double, MC long, yOP double")
    rows = signals.characteristics(fund).collect()
    assert len(rows) == 1 and rows[0].year == D(2012, 12, 1)
    assert rows[0].Inv == pytest.approx(0.6931471805599453)
    assert rows[0].BMratio == pytest.approx(0.1)


def test_momentum_first_signal_on_row_13_and_holes_shift(spark):
    months = [D(2000 + (m // 12), m % 12 + 1, 1) for m in range(15)]
    rets = [0.01 * (i + 1) for i in range(15)]
    full = spark.createDataFrame([("1", m, r) for m, r in zip(months, rets)], S.MONTHRET)
    mom = signals.momentum(full).orderBy("mom_month").collect()
    assert mom[0].mom_month == months[12]
    want = 1.0
    for r in rets[0:11]:
        want *= 1 + r
    assert mom[0].mom == pytest.approx(want)
    holed = spark.createDataFrame([("1", m, None if i == 5 else r) for i, (m, r) in enumerate(zip(months, rets))],
                                  S.MONTHRET)
    assert signals.momentum(holed).orderBy("mom_month").first().mom_month == months[13]


def test_exclude_industry_keeps_unlisted_and_null_codes(spark):
    df = spark.createDataFrame([("1",), ("2",), (None,)], "stock_id string")
    tse = spark.createDataFrame([("1", "FIN"), ("2", "IND3")], S.LISTING)
    otc = spark.createDataFrame([("9", "FIN")], S.LISTING)
    kept = {r.stock_id for r in signals.exclude_industry(df, [tse, otc], "FIN").collect()}
    assert kept == {"2", None}


# ---- calendars -------------------------------------------------------------

def test_calendars_drop_no_date_by_default(spark):
    df = spark.createDataFrame([(D(1970, 1, 31),), (D(2031, 8, 1),)], "ret_date date")
    assert with_rebalance_year(df).count() == 2 and with_momentum_months(df).count() == 2


def test_rebalance_year_and_momentum_months(spark):
    df = spark.createDataFrame([(D(2001, 7, 1),), (D(2002, 6, 30),), (D(2002, 7, 1),), (D(2001, 6, 30),)],
                               "ret_date date")
    got = {r.ret_date: r.year for r in with_rebalance_year(df, ret_start="2001-07-01").collect()}
    assert got == {D(2001, 7, 1): D(2000, 12, 1), D(2002, 6, 30): D(2000, 12, 1), D(2002, 7, 1): D(2001, 12, 1)}
    m = with_momentum_months(df).filter(F.col("ret_date") == D(2002, 7, 1)).first()
    assert (m.mom_month, m.mc_month) == (D(2002, 7, 1), D(2002, 6, 1))


# ---- portfolios ------------------------------------------------------------

def test_weights_over_stocks_with_a_return(spark):
    panel = spark.createDataFrame([
        (D(2020, 1, 1), "a", 0.1, 100, "s1", "bm1"),
        (D(2020, 1, 1), "b", 0.3, 300, "s1", "bm1"),
    ], "ret_date date, stock_id string, ret double, MC long, g_size string, g_bm string")
    w = portfolios.vw_weights(panel, ["g_size", "g_bm"]).collect()
    assert sum(r.weight for r in w) == pytest.approx(1.0)
    pr = portfolios.vw_return(panel, "g_size", ["g_bm"]).collect()[0]
    assert (pr.Port, pr.Portret) == ("s1bm1", pytest.approx(0.25))


def test_factor_spread_identities(spark):
    import random
    rnd = random.Random(1)
    vals = {p: rnd.uniform(-0.1, 0.1) for p in S.FF_PORTS}
    wide = spark.createDataFrame([tuple([D(2020, 1, 1)] + [vals[p] for p in S.FF_PORTS])],
                                 ["ret_date"] + S.FF_PORTS)
    r = portfolios.factor_spreads(wide).first()
    smb = lambda k: sum(vals[f"s1{x}"] - vals[f"s2{x}"] for x in k) / 3
    assert r.SMB5 == pytest.approx((smb(S.BM_LABELS) + smb(S.OP_LABELS) + smb(S.INV_LABELS)) / 3)
    assert r.HML == pytest.approx(((vals["s2bm3"] - vals["s2bm1"]) + (vals["s1bm3"] - vals["s1bm1"])) / 2)
    assert r.CMA == pytest.approx(((vals["s2inv1"] - vals["s2inv3"]) + (vals["s1inv1"] - vals["s1inv3"])) / 2)


# ---- market ----------------------------------------------------------------

def test_index_return_divides_by_current_price(spark):
    idx = spark.createDataFrame([(D(2020, 1, 2), "I", 100.0), (D(2020, 1, 3), "I", 125.0)], S.INDEX_PRICE)
    r = market.index_return(idx, "day").orderBy("ret_date").collect()
    assert r[0].ret is None and r[1].ret == pytest.approx(0.2)
    assert market.index_return(idx, "day", denominator="previous").orderBy("ret_date").collect()[1].ret == \
        pytest.approx(0.25)


def test_daily_risk_free_fills_over_index_days_only(spark):
    days = spark.createDataFrame([(D(2020, 1, d),) for d in (1, 2, 3, 4, 5)], "ret_date date")
    bond = spark.createDataFrame([("2020/1/1", 3.65), ("2020/01/04", 7.3), ("2020/01/06", 99.0)], S.BOND_YIELD)
    rf = {r.ret_date.day: r.RFrate for r in market.risk_free(bond, "day", index_days=days).collect()}
    assert rf[1] == pytest.approx(0.0001) and rf[3] == pytest.approx(0.0001)
    assert rf[4] == pytest.approx(0.0002) and rf[5] == pytest.approx(0.0002)
    assert 6 not in rf
    monthly = market.risk_free(bond, "month").collect()
    assert monthly[0].RFrate == pytest.approx(99.0 / 1200)


# ---- report ----------------------------------------------------------------

def test_cumulative_index_skips_nulls(spark):
    long = spark.createDataFrame([(D(2020, m, 1), "X", r) for m, r in ((1, 0.1), (2, None), (3, 0.1))],
                                 "ret_date date, Port string, Portret double")
    got = [r.cumret for r in report.cumulative_index(long).orderBy("ret_date").collect()]
    assert got[0] == pytest.approx(110.0) and got[1] is None and got[2] == pytest.approx(121.0)


def test_final_rank_averages_ties_and_leaves_null_unranked(spark):
    cum = spark.createDataFrame([(D(2020, 1, 1), p, None, c) for p, c in
                                 (("A", 3.0), ("B", 3.0), ("C", 1.0), ("D", None))],
                                "ret_date date, Port string, Portret double, cumret double")
    got = {r.Port: r.Portrank for r in report.final_rank(cum).collect()}
    assert got == {"A": 1.5, "B": 1.5, "C": 3.0, "D": None}


def test_wide_long_round_trip(spark):
    wide = spark.createDataFrame([(D(2020, 1, 1), 0.1, None), (D(2020, 2, 1), 0.2, 0.3)],
                                 "ret_date date, HML double, UMD double")
    long = report.to_long(wide)
    assert long.count() == 4  # NULL cell kept
    back = portfolios.to_wide(long, ["HML", "UMD"]).orderBy("ret_date").collect()
    assert [tuple(r) for r in back] == [tuple(r) for r in wide.orderBy("ret_date").collect()]
