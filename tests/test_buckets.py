"""Quantile buckets: rank rule, edges vs window, parity with interpolated-edge qcut."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelfactors import schemas as S
from panelfactors.functions.stats import bucket_frames, percentiles, qbucket, qbuckets

METHODS = ["edges", "window"]


def _labels(spark, values, cuts, labels, method, group=None):
    group = group or [0] * len(values)
    df = spark.createDataFrame(
        [(g, i, None if v is None else float(v)) for i, (g, v) in enumerate(zip(group, values))],
        "g int, i int, x double")
    out = qbucket(df, "g", "x", cuts, labels, "b", method=method).orderBy("i").collect()
    return [r["b"] for r in out]


@pytest.mark.parametrize("method", METHODS)
def test_edge_row_goes_low(spark, method):
    vals = list(range(1, 12))
    got = _labels(spark, vals, S.TERCILE_CUTS, S.BM_LABELS, method)
    want = list(pd.qcut(pd.Series(vals, dtype=float), S.TERCILE_CUTS, labels=S.BM_LABELS).astype(str))
    assert got == want
    # 4 is exactly the 30% edge (position 3 of 0..10): right-closed, so it stays in bm1
    assert got[3] == "bm1"


@pytest.mark.parametrize("method", METHODS)
def test_tied_values_and_nulls(spark, method):
    got = _labels(spark, [1, 1, 1, 1, 2, None], S.TERCILE_CUTS, S.BM_LABELS, method)
    # ranks 0,0,0,0,4 of n=5: floor(4*.3)=1, floor(4*.7)=2 -> the ties are low, 2 is top
    assert got == ["bm1", "bm1", "bm1", "bm1", "bm3", None]


def test_strict_raises_on_tied_edges(spark):
    df = spark.createDataFrame([(0, float(v)) for v in [1, 1, 1, 1, 2]], "g int, x double")
    with pytest.raises(Exception, match="bin edges must be unique"):
        qbucket(df, "g", "x", S.TERCILE_CUTS, S.BM_LABELS, "b", strict=True).collect()
    ok = spark.createDataFrame([(0, float(v)) for v in range(1, 12)], "g int, x double")
    assert qbucket(ok, "g", "x", S.TERCILE_CUTS, S.BM_LABELS, "b", strict=True).count() == 11


def test_random_groups_match_qcut_and_methods_agree(spark):
    rng = np.random.default_rng(7)
    rows = []
    for g, n in enumerate([1, 2, 3, 5, 9, 40, 137, 600, 2500]):
        vals = rng.lognormal(size=n)
        if n > 10:
            vals[: n // 10] = np.round(vals[: n // 10], 1)  # some ties
        rows += [(g, i, float(v)) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "g int, i int, x double")
    specs = [("x", S.TERCILE_CUTS, S.BM_LABELS, "b3"), ("x", S.SIZE_CUTS, S.SIZE_LABELS, "b2")]
    a = qbuckets(df, ["g"], specs, method="edges").toPandas().sort_values(["g", "i"]).reset_index(drop=True)
    b = qbuckets(df, ["g"], specs, method="window").toPandas().sort_values(["g", "i"]).reset_index(drop=True)
    assert (a["b3"] == b["b3"]).all() and (a["b2"] == b["b2"]).all()
    # against the interpolated-edge definition (pandas qcut), where its edges are distinct
    pdf = pd.DataFrame(rows, columns=["g", "i", "x"]).sort_values(["g", "i"]).reset_index(drop=True)
    diff = 0
    for g, part in pdf.groupby("g"):
        try:
            q = pd.qcut(part["x"], S.TERCILE_CUTS, labels=S.BM_LABELS).astype(str)
        except ValueError:
            continue
        diff += int((q.values != a.loc[part.index, "b3"].values).sum())
    assert diff <= 2  # only rows lying exactly on a floating edge may differ


def test_bucket_frames_two_tables(spark):
    a = spark.createDataFrame([(1, i, float(i)) for i in range(10)], "p int, i int, x double")
    b = spark.createDataFrame([(1, i, float(-i)) for i in range(4)], "q int, i int, y double")
    oa, ob = bucket_frames([(a, ["p"], [("x", S.SIZE_CUTS, S.SIZE_LABELS, "gx")]),
                            (b, ["q"], [("y", S.TERCILE_CUTS, S.MOM_LABELS, "gy")])])
    assert [r.gx for r in oa.orderBy("i").collect()] == ["s1"] * 5 + ["s2"] * 5
    assert [r.gy for r in ob.orderBy("i").collect()] == ["mom3", "mom2", "mom2", "mom1"]  # edges -2.1, -0.9


def test_percentiles_match_linear_interpolation(spark):
    rng = np.random.default_rng(3)
    vals = rng.normal(size=1001)
    df = spark.createDataFrame([(0, float(v)) for v in vals], "g int, x double")
    got = percentiles(df, ["g"], {"x": "x"}, [0.25, 0.3, 0.5, 0.75]).collect()[0]
    want = np.quantile(vals, [0.25, 0.3, 0.5, 0.75])
    assert got["x__n"] == 1001
    for i, w in enumerate(want):
        assert got[f"x__p{i}"] == pytest.approx(w, rel=1e-12, abs=1e-12)


def test_large_group_uses_bracket_and_stays_exact(spark):
    # one group large enough for the sketch bracket (not the whole-group fallback)
    n = 20000
    df = spark.range(n).select(F.lit(0).alias("g"), F.col("id").cast("int").alias("i"),
                               ((F.col("id") * 7919) % n).cast("double").alias("x"))
    a = qbucket(df, "g", "x", S.TERCILE_CUTS, S.BM_LABELS, "b").groupBy("b").count().orderBy("b").collect()
    # values are a permutation of 0..n-1: edges at positions floor((n-1)*.3) and floor((n-1)*.7)
    k1, k2 = (n - 1) * 3 // 10, (n - 1) * 7 // 10
    assert [r["count"] for r in a] == [k1 + 1, k2 - k1, n - 1 - k2]


def test_hot_period_sorts_only_a_bracket(spark):
    """One period holds a third of all rows: only a small bracket of it reaches the sort."""
    from panelfactors.functions.stats import _candidates, _floor_pos
    from fractions import Fraction
    hot_n, cold = 60000, 40
    hot = spark.range(hot_n).select(F.lit(0).alias("_g0"), F.lit("x").alias("_key"),
                                    ((F.col("id") * 7919) % hot_n).cast("double").alias("_v"))
    rest = spark.range(2 * hot_n).select((F.col("id") % cold + 1).cast("int").alias("_g0"), F.lit("x").alias("_key"),
                                         F.rand(11).alias("_v"))
    base = hot.unionByName(rest)
    targets = [(f"e{f}", (lambda n, f=f: _floor_pos(n, f)), float(f)) for f in (Fraction(3, 10), Fraction(7, 10))]
    cand = _candidates(base, ["_g0", "_key"], targets)
    per = {r["_g0"]: r["count"] for r in cand.groupBy("_g0").count().collect()}
    assert per[0] < 0.01 * hot_n  # bracket rows of the hot period, both targets together
    # and the labels still equal the rank rule
    df = base.withColumnRenamed("_g0", "g")
    a = qbucket(df, "g", "_v", S.TERCILE_CUTS, S.BM_LABELS, "b", method="edges").filter("g = 0")
    counts = {r.b: r["count"] for r in a.groupBy("b").count().collect()}
    k1, k2 = (hot_n - 1) * 3 // 10, (hot_n - 1) * 7 // 10
    assert counts == {"bm1": k1 + 1, "bm2": k2 - k1, "bm3": hot_n - 1 - k2}
