import math
import random

import duckdb
import numpy as np
import pytest

from panelfactors.llm.hard_negatives import SQL, Packed, mine, op11_hard_negatives, quantized
from tests.conftest import SF_MID

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, every=50):
    """(anchor, positive, rank, negative, positive score, negative score) by the definition, over Python integers."""
    keep = [(k, i, [math.floor(256 * int(x)) if abs(x) >= 2**53 else math.floor(256 * x) for x in e], lab)
            for k, (i, e, lab) in enumerate(rows)
            if lab is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []

    def first(found, n):
        return sorted(found, key=lambda f: (-f[0], f[1] is None, f[1] or 0))[:n]
    for k, i, q, lab in keep:
        if i is None or i % every:
            continue
        s = [(max(-2**63 + 1, min(2**63 - 1, sum(a * b for a, b in zip(q, c)))), j, other) for m, j, c, other in keep if m != k]
        for p, pid, _ in first([x for x in s if x[2] == lab], 5):
            for rank, (n, nid, _) in enumerate(first([x for x in s if x[2] != lab and 50 * p <= 100 * x[0] <= 95 * p], 3), 1):
                out.append((i, pid, rank, nid, p, n))
    return sorted(out, key=repr)


def mined(spark, rows, every=50, extra=False):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        for c in ("row", "score", "anchor", "chunk", "part", "scores"):
            df = df.selectExpr("*", f"'x' AS {c}")
    got = mine(df, every=every).collect()
    return sorted([(r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in got], key=repr)


def vectors(n, d, seed, labels=4, scale=1.0):
    r = random.Random(seed)
    centre = [[r.gauss(0.3, 1) for _ in range(d)] for _ in range(labels)]
    return [(i, [scale * (c + r.gauss(0, 0.7)) for c in centre[r.randrange(labels)]], r.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("scale", [1.0, 1e-3, 1e4, 1e9, 1e17, 1e200])
def test_packed_scores_are_exact(scale):
    r = np.random.default_rng(1)
    q, a = (quantized(x * scale) for x in (r.normal(size=(37, 9)), r.normal(size=(11, 9))))
    got = Packed(q).scores(a)
    for i in range(11):
        for j in range(37):
            want = sum(int(x) * int(y) for x, y in zip(a[i], q[j]))
            assert got[i, j] == max(-2**63 + 1, min(2**63 - 1, want))


def test_fields_of_one_word_do_not_touch():
    """The largest sums of either sign side by side."""
    q = np.array([[-256.0] * 64, [256.0] * 64, [0.0] * 64, [-256.0] * 64, [255.0] * 64] * 3)
    a = np.array([[256.0] * 64, [-256.0] * 64, [1.0] + [0.0] * 63])
    p = Packed(q)
    assert (p.scores(a) == (a @ q.T)).all() and len(p.words) == 1
    assert 2 in p.words and Packed(np.ones((9, 4))).scores(np.ones((2, 4))).tolist() == [[4] * 9] * 2


def test_equals_brute_force(spark):
    rows = vectors(300, 6, 3)
    assert mined(spark, rows, 10, extra=True) == brute(rows, 10)


def test_nulls_ties_repeats_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    base = vectors(120, 4, 8, labels=3)
    rows = base + base[:40] + [                       # repeated rows and ids
        (50, None, 1), (50, [1.0, None], 1), (50, [nan, 1.0], 1), (50, [inf], 1), (50, [1.0, 2.0, 3.0, 4.0], None),
        (None, [1.0, 1.0, 1.0, 1.0], 1), (None, [1.0, 1.0, 1.0, 1.0], 2), (100, [], 1), (150, [1.0], 1), (-50, [2.0, 1.0], 0),
        (51, [1e30, 1.0, 0.0, 0.0], 2), (200, [1e30, 1e30, 1.0, 1.0], 0), (201, [9e29, 1.0], 1), (202, [1e30], 0)]
    rows += [(1000 + i, [0.5, 0.5, 0.5, 0.5], i % 2) for i in range(60)]   # ties
    assert mined(spark, rows) == brute(rows)


def test_empty_and_without_anchors(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    assert mined(spark, [(0, [1.0], 1)]) == [] and mined(spark, [(0, [], 1), (1, [], 1), (2, [], 2)]) == brute(
        [(0, [], 1), (1, [], 1), (2, [], 2)])


def test_hot_label_and_copies(spark):
    """One vector, half of all rows."""
    rows = vectors(150, 5, 4) + [(1000 + i, [1.0, 0.2, 0.3, 0.1, 0.5], 1) for i in range(150)]
    assert mined(spark, rows) == brute(rows)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_MID}/embeddings.parquet'")
    df = op11_hard_negatives(spark, SF_MID)
    rel = con.sql(SQL)
    assert sorted(tuple(r) for r in df.select(*rel.columns).collect()) == sorted(rel.fetchall())
