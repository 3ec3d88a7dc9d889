"""Panels stored by grouping year, tied bin edges, extracts with drifting columns."""

import os
import random
from datetime import date, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelfactors import schemas as S
from panelfactors.functions.stats import qbuckets, tied_edges
from panelfactors.operators.calendars import with_rebalance_year
from panelfactors.operators.portfolios import attach_groups
from panelfactors.sources.drift import common_schema, read_drifting, wider
from panelfactors.sources.facts import read_facts, write_facts


def panel(spark):
    rows = [(str(i % 5), date(2000, 1, 3) + timedelta(days=7 * i), i / 1000) for i in range(300)]
    return spark.createDataFrame(rows, S.DAYRET)


def test_only_the_asked_years_are_read(spark, tmp_dir):
    df = panel(spark)
    write_facts(df, tmp_dir, "date")
    for d in os.listdir(tmp_dir):   # files of other years are spoiled
        if d.startswith("group_year=") and d[11:15] not in ("2001", "2002"):
            for f in os.listdir(os.path.join(tmp_dir, d)):
                os.remove(os.path.join(tmp_dir, d, f))
            with open(os.path.join(tmp_dir, d, "part-0.parquet"), "wb") as f:
                f.write(b"not parquet")
    stored = read_facts(spark, tmp_dir, S.DAYRET).withColumnRenamed("date", "ret_date")
    groups = spark.createDataFrame([(str(i), date(y, 12, 1), f"g{i}") for i in range(5) for y in range(1998, 2005)],
                                   "stock_id string, year date, g string")
    bounds = dict(group_start="2001-12-01", group_end="2002-12-01")
    got = attach_groups(with_rebalance_year(stored, **bounds), groups, ["stock_id", "year"])
    want = attach_groups(with_rebalance_year(df.withColumnRenamed("date", "ret_date"), **bounds), groups, ["stock_id", "year"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(group_year" in plan
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect())) and got.count() > 90
    # a filter on the group table alone reaches the scan through the join
    some = attach_groups(with_rebalance_year(stored), groups.where("year = date'2002-12-01'"), ["stock_id", "year"])
    assert some.count() == got.where("year = date'2002-12-01'").count()


def test_run_time_pruning_by_another_column_of_the_groups(spark, tmp_dir):
    write_facts(panel(spark), os.path.join(tmp_dir, "facts"), "date")
    groups = spark.createDataFrame([(str(i), date(y, 12, 1), f"g{y}") for i in range(5) for y in range(1998, 2005)],
                                   "stock_id string, year date, g string")
    groups.write.parquet(os.path.join(tmp_dir, "groups"))
    stored = read_facts(spark, os.path.join(tmp_dir, "facts"), S.DAYRET).withColumnRenamed("date", "ret_date")
    some = spark.read.parquet(os.path.join(tmp_dir, "groups")).where("g = 'g2002'")
    joined = with_rebalance_year(stored).join(some, ["stock_id", "year"])
    assert "dynamicpruning" in joined._jdf.queryExecution().executedPlan().toString().lower()
    assert joined.select("year").distinct().collect() == [(date(2002, 12, 1),)]


def test_writing_a_year_again_leaves_the_others(spark, tmp_dir):
    df = panel(spark)
    write_facts(df, tmp_dir, "date")
    write_facts(df.where("date >= '2004-07-01'").withColumn("ret", F.lit(9.0)), tmp_dir, "date")
    back = read_facts(spark, tmp_dir, S.DAYRET)
    assert back.count() == 300 and back.where("ret = 9").count() == df.where("date >= '2004-07-01'").count()


def test_tied_edges_equal_definition(spark):
    r = random.Random(5)
    rows = [(g, float(r.choice([1, 1, 1, 2, 3])) if r.random() < 0.9 else None, r.random()) for g in "abcdefgh" for _ in range(r.randint(1, 9))]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    specs = [("x", S.TERCILE_CUTS, S.BM_LABELS, "sx"), ("y", S.SIZE_CUTS, S.SIZE_LABELS, "sy")]
    want = set()
    for g in "abcdefgh":
        for j, (_, cuts, _, name) in enumerate(specs):
            v = sorted(x[1 + j] for x in rows if x[0] == g and x[1 + j] is not None)
            if not v:
                continue

            def edge(q):
                at = (len(v) - 1) * q
                low = int(at + 1e-9)
                return v[low] + (v[min(low + 1, len(v) - 1)] - v[low]) * (at - low)
            want |= {(g, name, float(a), float(b)) for a, b in zip(cuts, cuts[1:]) if abs(edge(a) - edge(b)) < 1e-12}
    got = {(t.g, t.sort, t.low_cut, t.high_cut) for t in tied_edges(df, ["g"], specs).collect()}
    assert got == want and {w[1] for w in want} == {"sx", "sy"}
    with pytest.raises(PySparkException, match="bin edges must be unique: s"):
        qbuckets(df, ["g"], specs, strict=True).collect()
    fine = spark.createDataFrame([("a", float(i), float(i)) for i in range(10)], "g string, x double, y double")
    assert qbuckets(fine, ["g"], specs, strict=True).count() == 10


def test_wider_types():
    i, n, d, s = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
    assert wider(i, n) == n and wider(i, d) == d and wider(n, d) is None and wider(n, s) == s and wider(T.NullType(), d) == d
    assert wider(T.DecimalType(10, 2), n) == T.DecimalType(21, 2) and wider(T.DecimalType(38, 25), n) is None
    assert wider(T.DateType(), T.TimestampType()) == T.TimestampType() and wider(T.DateType(), i) is None
    assert wider(T.ArrayType(i), s) is None and wider(T.FloatType(), d) == d
    with pytest.raises(ValueError, match="x: bigint and date"):
        common_schema({"a": T.StructType([T.StructField("x", n)]), "b": T.StructType([T.StructField("x", T.DateType())])})


def test_drifting_extracts(spark, tmp_dir):
    frames = {"a": spark.createDataFrame([(1, 0.5)], "code int, Mtrue_ret double"),
              "b": spark.createDataFrame([("2", 0.25, "n")], "code string, ret double, note string"),
              "c": spark.createDataFrame([("3", None, "m")], "code string, ret double, note string"),
              "d": spark.createDataFrame([], "code string, extra date")}
    paths = {n: os.path.join(tmp_dir, n) for n in frames}
    for n, df in frames.items():
        df.write.parquet(paths[n])
    got = read_drifting(spark, paths, {"Mtrue_ret": "ret"})
    assert got.dtypes == [("code", "string"), ("ret", "double"), ("note", "string"), ("extra", "date"), ("extract", "string")]
    assert sorted(map(tuple, got.collect())) == [("1", 0.5, None, None, "a"), ("2", 0.25, "n", None, "b"), ("3", None, "m", None, "c")]
    few = read_drifting(spark, paths, {"Mtrue_ret": "ret"}, ["ret", "code"])
    assert few.columns == ["ret", "code", "extract"] and few.count() == 3
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 3   # b and c share a scan
    with pytest.raises(ValueError, match="in no extract"):
        read_drifting(spark, paths, columns=["nothing"])
