"""Repeated keys fail the job; tied values do not reach a sort one by one."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelfactors.functions.stats import qbucket
from panelfactors.operators.market import index_return
from panelfactors.operators.portfolios import attach_groups, to_wide, vw_return
from panelfactors.operators.snapshots import month_end_cap, year_end_cap


def caps(spark, rows):
    return spark.createDataFrame([(s, dt.date.fromisoformat(d), v) for s, d, v in rows],
                                 "stock_id string, date date, market_value long")


def test_repeated_snapshot_date_raises(spark):
    good = caps(spark, [("a", "2020-01-31", 1), ("a", "2020-12-30", 2), ("a", "2020-12-31", 3), ("b", "2020-12-31", 4)])
    assert {(r.stock_id, r.MC) for r in year_end_cap(good).collect()} == {("a", 3), ("b", 4)}
    bad = good.unionByName(caps(spark, [("a", "2020-12-31", 9)]))
    for f in (year_end_cap, month_end_cap):
        with pytest.raises(Exception, match="repeated date"):
            f(bad).collect()


def test_every_day_of_a_leap_year_is_distinct(spark):
    days = [(dt.date(2020, 1, 1) + dt.timedelta(days=i)).isoformat() for i in range(366)]
    got = year_end_cap(caps(spark, [("a", d, i + 1) for i, d in enumerate(days)])).collect()
    assert [r.MC for r in got] == [366]


def test_repeated_portfolio_cell_raises(spark):
    long = spark.createDataFrame([("d", "p", 1.0), ("d", "p", 2.0)], "ret_date string, Port string, Portret double")
    with pytest.raises(Exception, match="portfolio returns"):
        to_wide(long, ["p"]).collect()


def test_repeated_group_key_raises(spark):
    ret = spark.createDataFrame([("a", 1, 0.1)], "stock_id string, year int, ret double")
    groups = spark.createDataFrame([("a", 1, "s1"), ("a", 1, "s2")], "stock_id string, year int, g_size string")
    with pytest.raises(Exception, match="sort groups"):
        attach_groups(ret, groups, ["stock_id", "year"]).collect()


def test_two_indexes_raise(spark):
    idx = spark.createDataFrame([(dt.date(2020, 1, d), s, 1.0 * d) for d in (1, 2) for s in ("x", "y")],
                                "date date, stock_id string, price double")
    assert index_return(idx.where("stock_id = 'x'"), "day").count() == 2
    with pytest.raises(Exception, match="more than one index"):
        index_return(idx, "day").collect()


def test_value_weights_over_several_sorts(spark):
    rows = [("d", "s1", "b1", "o2", 1, 0.1), ("d", "s1", "b1", "o1", 3, 0.2), ("d", "s1", "b2", "o1", 4, 0.4)]
    panel = spark.createDataFrame(rows, "ret_date string, size string, bm string, op string, MC long, ret double")
    got = {r.Port: round(r.Portret, 9) for r in vw_return(panel, "size", ["bm", "op"]).collect()}
    assert got == {"s1b1": round(0.7 / 4, 9), "s1b2": 0.4, "s1o1": round(2.2 / 7, 9), "s1o2": 0.1}


def test_buckets_of_a_group_that_is_mostly_one_value(spark):
    df = spark.range(0, 20_000).select(F.lit(1).alias("g"), "id", F.when(F.col("id") % 10 == 0, F.col("id"))
                                       .otherwise(0).cast("double").alias("x"))
    labels = ["t1", "t2", "t3"]
    args = (["g"], "x", [0, 0.3, 0.95, 1], labels, "b")
    edges, window = (qbucket(df, *args, method=m).groupBy("b").count().collect() for m in ("edges", "window"))
    assert sorted(edges) == sorted(window)
