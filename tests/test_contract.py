"""Driver contract and pipeline identities on the given tables."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from panelfactors import schemas as S
from panelfactors.plans import pipelines as P
from panelfactors.plans.queries import DATA_BOUNDS, PATTERN, QUERIES, inputs
from tests.conftest import SF_SMALL


def test_entry_runs_with_stable_schema(spark):
    df = E.entry(spark)
    assert df.columns == ["ret_date", *S.MOM_PORTS, "UMD"]
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_rows_only():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert not (set(q) - set(o)) & set(QUERIES)


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10]
    return v


@pytest.mark.parametrize("key", ["umd_month", "month_end_cap", "momentum", "bucket_mom", "rf_day_ffill",
                                 "item_counts", "merge_extracts", "universe"])
def test_oracle_parity_small(spark, key):
    con = duckdb.connect()
    for t in ("lineitem", "orders", "supplier"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    res = con.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    df = E.queries()[key](spark, SF_SMALL)
    assert sorted(df.columns) == sorted(dcols)
    order = sorted(dcols)
    key_fn = lambda t: tuple((x is None, str(x)) for x in t)
    sp = sorted((tuple(_norm(r[c]) for c in order) for r in (row.asDict() for row in df.collect())), key=key_fn)
    dk = sorted((tuple(_norm(dict(zip(dcols, r))[c]) for c in order) for r in drows), key=key_fn)
    assert sp == dk


def test_weights_sum_to_one_and_month_day_groups_agree(spark):
    inp = inputs(spark, "/root/testdata/sf0.01")
    groups = P.year_groups(inp, PATTERN)
    panel = P.yearly_panel(inp, "month", groups, DATA_BOUNDS)
    from panelfactors.operators.portfolios import vw_weights
    w = vw_weights(panel, ["g_size", "g_bm"]).groupBy("ret_date", "g_size", "g_bm").agg(F.sum("weight").alias("s"))
    assert w.filter(F.abs(F.col("s") - 1) > 1e-9).count() == 0
    # the daily panel uses the same yearly groups as the monthly one
    day = (P.yearly_panel(inp, "day", groups, DATA_BOUNDS)
           .select("stock_id", "year", F.col("g_size").alias("d_size"), F.col("g_bm").alias("d_bm")).distinct())
    month = panel.select("stock_id", "year", "g_size", "g_bm").distinct()
    j = day.join(month, ["stock_id", "year"])
    assert j.count() > 0
    assert j.filter((F.col("d_size") != F.col("g_size")) | (F.col("d_bm") != F.col("g_bm"))).count() == 0


def test_freq_guard(spark):
    inp = inputs(spark, SF_SMALL)
    with pytest.raises(ValueError):
        P.five_factor(inp, "week")
    with pytest.raises(ValueError):
        P.momentum_factor_table(inp, "year")


def test_momentum_exclusion_option_drops_financials(spark):
    inp = inputs(spark, SF_SMALL)
    fin = {r.stock_id for r in inp.listings[0].unionByName(inp.listings[1]).filter("industry = 'FIN'").collect()}
    assert fin
    g = P.momentum_groups(inp, exclude_pattern=PATTERN)
    assert g.filter(F.col("stock_id").isin(list(fin))).count() == 0
    assert P.momentum_groups(inp).filter(F.col("stock_id").isin(list(fin))).count() > 0


def assert_same_by_date(left, right):
    """Equal rows by ret_date; doubles to a relative 1e-9, as separate runs add in another order."""
    a, b = ({r.ret_date: r.asDict() for r in df.collect()} for df in (left, right))
    assert a and a.keys() == b.keys()
    for date, row in a.items():
        for name, value in row.items():
            if isinstance(value, float) and b[date][name] is not None:
                assert math.isclose(value, b[date][name], rel_tol=1e-9, abs_tol=1e-12), (date, name)
            else:
                assert value == b[date][name], (date, name)


def test_factor_tables_share_groups_and_match_single_runs(spark):
    sf = "/root/testdata/sf0.01"
    inp = inputs(spark, sf)
    allt = P.factor_tables(inp, DATA_BOUNDS, pattern=PATTERN)
    one = P.momentum_factor_table(inputs(spark, sf), "day")["wide"]
    assert_same_by_date(allt["umd_day"], one)
    five = P.five_factor(inputs(spark, sf), "month", DATA_BOUNDS, pattern=PATTERN)["wide"]
    assert_same_by_date(allt["five_factor_month"], five)
