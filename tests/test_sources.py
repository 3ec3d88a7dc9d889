"""Cleaning, profiling, landing, merge, universe and the streaming landing."""

import datetime as dt
import json
import os

import numpy as np
import pytest

from panelfactors import schemas as S
from panelfactors.operators import profiling
from panelfactors.sources import landing, readers
from panelfactors.streaming.landing import read_landed, start_landing

D = dt.date


def test_sentinel_and_clip(spark):
    df = spark.createDataFrame([("1", D(2020, 1, 1), 123.0), ("1", D(2020, 2, 1), 0.5)], S.MONTHRET)
    assert [r.ret for r in profiling.null_sentinel(df).orderBy("month").collect()] == [None, 0.5]
    caps = spark.createDataFrame([(D(2020, 1, 1), "1", -5), (D(2020, 1, 2), "1", 0), (D(2020, 1, 3), "1", None)],
                                 S.MARKETCAP)
    assert [r.market_value for r in profiling.clip_negative(caps, "market_value").orderBy("date").collect()] == \
        [0, 0, None]


def test_profile_matches_pandas_describe(spark):
    vals = np.random.default_rng(5).normal(size=777)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = {r.summary: r.x for r in profiling.profile(df, ["x"]).collect()}
    want = __import__("pandas").Series(vals).describe()
    for k in ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]:
        assert got[k] == pytest.approx(want[k], rel=1e-9)


def test_null_counts_and_item_counts(spark):
    st = spark.createDataFrame([(D(2020, 3, 31), "1", "Revenue", 1.0, "revenue"),
                                (D(2020, 3, 31), "1", "OperatingExpenses", None, None)], S.STATEMENT)
    nc = {r.column_name: r.null_count for r in profiling.null_counts(st).collect()}
    assert nc == {"date": 0, "stock_id": 0, "type": 0, "value": 1, "origin_name": 1}
    ic = [tuple(r) for r in profiling.item_counts(st).collect()]
    assert ic == [(1, "revenue"), (0, None)]


def test_merge_extracts_newest_wins(spark):
    old = spark.createDataFrame([(D(2020, 1, 1), "1", 1.0), (D(2020, 1, 2), "1", 2.0)], "date date, stock_id string, close double")
    new = spark.createDataFrame([(D(2020, 1, 2), "1", 20.0), (D(2020, 1, 3), "1", 3.0)], "date date, stock_id string, close double")
    got = [r.close for r in landing.merge_extracts([old, new], ["date", "stock_id"]).orderBy("date").collect()]
    assert got == [1.0, 20.0, 3.0]


def test_universe_flags_delisted(spark):
    tse = spark.createDataFrame([("1101", "X")], S.LISTING)
    otc = spark.createDataFrame([("6488", "Y")], S.LISTING)
    gone = spark.createDataFrame([("1234",), ("12345",)], S.DELISTED)
    rows = {(r.stock_id, r.market, r.delisted) for r in landing.universe(tse, otc, gone).collect()}
    assert rows == {("1101", "TSE", False), ("6488", "OTC", False), ("1234", "DELISTED", True)}


def test_json_envelopes_and_csv_headers(spark, tmp_dir):
    p = os.path.join(tmp_dir, "resp")
    os.makedirs(p)
    with open(os.path.join(p, "a.json"), "w") as f:
        json.dump({"data": [{"date": "2020-12-31", "stock_id": "1101", "type": "Equity", "value": 5.5,
                             "origin_name": "equity"},
                            {"date": "2020-12-31", "stock_id": "1101", "type": "TotalAssets", "value": 9.0,
                             "origin_name": "assets"}]}, f)
    rows = landing.land_json(spark, p, S.STATEMENT, multiline=True).collect()
    assert len(rows) == 2 and rows[0].date == D(2020, 12, 31)
    csv = os.path.join(tmp_dir, "listing.csv")
    with open(csv, "w", encoding="utf-8") as f:
        f.write("公司代號,公司名稱,產業類別\n1101,A,水泥工業\n2801,B,金融保險業\n")
    lst = readers.read_listing(spark, csv)
    assert {r.stock_id for r in lst.filter(lst.industry.contains(S.FINANCIAL_INDUSTRY)).collect()} == {"2801"}
    bond = os.path.join(tmp_dir, "bond.csv")
    with open(bond, "w", encoding="utf-8") as f:
        f.write('日期,收市,開市\n"2025/4/2",1.6,1.5\n')
    assert readers.read_bond_yield(spark, bond).first().close == 1.6


def test_streaming_landing_newest_epoch_wins(spark, tmp_dir):
    src, table, ckpt = (os.path.join(tmp_dir, x) for x in ("src", "table", "ckpt"))
    os.makedirs(src)

    def drop(name, value):
        with open(os.path.join(src, name), "w") as f:
            f.write(json.dumps({"data": [{"date": "2020-12-31", "stock_id": "1", "type": "Equity",
                                          "value": value, "origin_name": "e"}]}) + "\n")

    drop("a.json", 1.0)
    start_landing(spark, src, S.STATEMENT, table, ckpt).awaitTermination(120)
    drop("b.json", 2.0)
    start_landing(spark, src, S.STATEMENT, table, ckpt).awaitTermination(120)
    rows = read_landed(spark, table, ["date", "stock_id", "type"]).collect()
    assert [r.value for r in rows] == [2.0]


def test_parquet_sink_partitioned_by_year_prunes(spark, tmp_dir):
    from panelfactors.sources.sinks import read_year_range, write_parquet_by_year
    df = spark.createDataFrame([(D(2000 + y, 1, 1), "HML", 0.01 * y) for y in range(5)],
                               "ret_date date, Port string, Portret double")
    path = os.path.join(tmp_dir, "factors")
    write_parquet_by_year(df, path)
    back = read_year_range(spark, path, 2001, 2002)
    assert sorted(r.ret_date.year for r in back.collect()) == [2001, 2002]
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "year" in plan


def test_readers_clean_caps_and_returns(spark, tmp_dir):
    caps = os.path.join(tmp_dir, "caps")
    spark.createDataFrame([(D(2020, 1, 2), "1101", -5), (D(2020, 1, 3), "1101", 7), (D(2020, 1, 4), "1101", None)],
                          "date date, stock_id string, market_value long").write.parquet(caps)
    assert [r.market_value for r in readers.read_marketcap(spark, caps).orderBy("date").collect()] == [0, 7, None]
    csv = os.path.join(tmp_dir, "ret.csv")
    with open(csv, "w", encoding="utf-8") as f:
        f.write("stock_id,month,ret\n1101,2020-01-01,123\n1101,2020-02-01,0.5\n")
    assert [r.ret for r in readers.read_return_csv(spark, csv).orderBy("month").collect()] == [None, 0.5]


def test_adapter_stores_only_the_tables_asked_for(spark, tmp_dir):
    from panelfactors.plans.queries import StoredInputs
    from panelfactors.sources.adapter import FinanceTables, StoredFinanceTables
    from tests.conftest import SF_SMALL
    stored, lazy = StoredFinanceTables(spark, SF_SMALL, tmp_dir), FinanceTables(spark, SF_SMALL)
    inp = StoredInputs(stored)
    assert os.listdir(tmp_dir) == []
    assert sorted(map(tuple, inp.marketcap.collect()), key=str) == sorted(map(tuple, lazy.marketcap().collect()), key=str)
    assert os.listdir(tmp_dir) == ["marketcap"]
    for name in ("balancesheet", "incomestatement", "dayret", "monthret", "taiex", "bond_yield"):
        got, want = getattr(stored, name)(), getattr(lazy, name)()
        assert got.schema == want.schema or got.dtypes == want.dtypes
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_profile_joins_no_whole_column_into_one_task(spark):
    df = spark.range(1000).selectExpr("id % 37 as x", "cast(null as double) as y")
    got = profiling.profile(df, ["x", "y"])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = {r.summary: r for r in got.collect()}
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert (rows["count"].x, rows["50%"].x, rows["max"].x, rows["count"].y, rows["50%"].y) == (1000.0, 18.0, 36.0, 0.0, None)
    assert profiling.profile(df.limit(0), ["x"]).count() == 0
