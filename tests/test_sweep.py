"""As-of fill, averaged ranks and running products over range slices, against definitions in Python."""

import math
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from panelfactors.functions.sweep import SLICE, asof_fill, average_rank, dealt, running_product

D0 = date(2020, 1, 1)


def day(n):
    return None if n is None else D0 + timedelta(days=n)


def asof(left, right, max_age=None):
    out = []
    for s, d, tag in left:
        got = []
        for j in (2, 3):
            best = None
            for r in right:
                if s is not None and r[0] == s and d is not None and r[1] is not None and r[1] <= d and r[j] is not None:
                    k = (r[1], *[(x is not None, x if x is not None else 0) for x in r[2:4]])
                    if best is None or k > best[0]:
                        best = (k, r[j])
            ok = best and (max_age is None or (d - best[0][0]).days <= max_age)
            got.append(best[1] if ok else None)
        out.append((s, d, tag, *got))
    return sorted(out, key=repr)


def series(seed, n, m, hot=0.6):
    r = random.Random(seed)
    def name():
        return "hot" if r.random() < hot else r.choice(["a", "b", "c", None])
    left = [(name(), day(r.choice([None, *range(60)])), i) for i in range(n)]
    right = [(name(), day(r.choice([None, *range(60)])), r.choice([None, r.random()]), r.choice([None, r.randrange(9)])) for _ in range(m)]
    return left, right


@pytest.mark.parametrize("max_age", [None, 5])
def test_asof_fill_equals_definition(spark, max_age):
    left, right = series(1, 400, 120)
    lf = spark.createDataFrame(left, "s string, d date, tag int")
    rf = spark.createDataFrame(right, "s string, d date, x double, y int")
    got = asof_fill(lf, rf, "d", ["s"], max_age, slices=7)
    assert got.columns == ["s", "d", "tag", "x", "y"]
    assert sorted(map(tuple, got.collect()), key=repr) == asof(left, right, max_age)


def test_asof_fill_without_series_and_empty_sides(spark):
    lf = spark.createDataFrame([(day(i), i) for i in range(50)] * 2, "d date, tag int")
    rf = spark.createDataFrame([(day(10), 1.0), (day(30), None), (day(40), 4.0)], "d date, x double")
    got = {(r.d, r.x) for r in asof_fill(lf, rf, "d", slices=5).collect()}
    assert got == {(day(i), None if i < 10 else 1.0 if i < 40 else 4.0) for i in range(50)}
    assert asof_fill(lf, rf.limit(0), "d").where("x IS NULL").count() == 100
    assert asof_fill(lf.limit(0), rf, "d").count() == 0
    with pytest.raises(ValueError, match="both sides"):
        asof_fill(lf, rf.withColumn("tag", F.lit(1)), "d")


def test_no_slice_holds_a_hot_series_or_tie(spark):
    """One series holds all rows, one date half of them."""
    df = spark.range(20_000).select(F.lit("s").alias("s"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("d"), "id")
    sizes = [r["count"] for r in dealt(df, ["s", "d", F.xxhash64("id")], 8).groupBy(SLICE).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 4000


def ranks(values, descending):
    ok = [v for v in values if v is not None and not math.isnan(v)]
    out = []
    for v in values:
        if v is None or math.isnan(v):
            out.append(None)
        else:
            first = sum((x > v) if descending else (x < v) for x in ok)
            out.append(first + (ok.count(v) + 1) / 2)
    return out


@pytest.mark.parametrize("descending", [True, False])
def test_average_rank_equals_definition(spark, descending):
    r = random.Random(4)
    rows = [(r.choice(["a", "b", None]), r.choice([None, float("nan"), 1.0, -0.0, 0.0, r.random(), 1.0]), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, v double, id int")
    for by in ([], ["g"]):
        got = {x.id: x["rank"] for x in average_rank(df, "v", by, descending=descending, slices=6).collect()}
        for g in ({None} if not by else {"a", "b", None}):
            part = [x for x in rows if not by or x[0] == g]
            assert [got[x[2]] for x in part] == ranks([x[1] for x in part], descending)
    assert len(got) == 500


def test_rank_of_one_value_only(spark):
    df = spark.range(3000).select("id", F.lit(7).alias("v"))
    got = average_rank(df, "v", slices=6)
    assert got.select("rank").distinct().collect()[0][0] == 1500.5 and got.count() == 3000
    assert average_rank(df.limit(0), "v").count() == 0


def test_running_product_equals_definition(spark):
    r = random.Random(9)
    rows = [("hot" if i % 3 else r.choice(["a", None]), day(i), r.choice([None, r.uniform(-0.1, 0.12)])) for i in range(600)]
    rows[5] = ("hot", day(5), -1.5)
    df = spark.createDataFrame(rows, "s string, d date, ret double")
    got = {(x.s, x.d): x["product"] for x in running_product(df, "ret", "d", ["s"], base=100.0, slices=9).collect()}
    for s in ("hot", "a", None):
        p = 100.0
        for x in [x for x in rows if x[0] == s]:
            if x[2] is None:
                assert got[s, x[1]] is None
            else:
                p *= 1 + x[2]
                assert got[s, x[1]] == pytest.approx(p, rel=1e-12)
    whole = running_product(df.drop("s"), "ret", "d", slices=9).orderBy("d").collect()
    assert len(whole) == 600 and whole[0]["product"] is None or whole[0]["product"] == pytest.approx(1 + rows[0][2])
