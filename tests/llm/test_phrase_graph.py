import random
import re
from collections import Counter

import duckdb
import numpy as np

from panelfactors.llm import phrase_graph as P
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.conftest import docs_frame

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(texts):
    """Counts of all phrases of 1 to 4 words, by tuple."""
    f = Counter()
    for t in texts:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (t or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 5):
                f.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    return f


def brute(rows, least, top):
    """rows: (lang, text)."""
    out = []
    for lang in {r[0] or "und" for r in rows}:
        f = grams([t for x, t in rows if (x or "und") == lang])
        n = sum(v for g, v in f.items() if len(g) == 1)
        c = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        found = []
        for g, a in c.items():
            if any(100 * b >= 80 * a and any(h[i:i + len(g)] == g for i in range(len(h) - len(g) + 1))
                   for h, b in c.items() if len(h) > len(g)):
                continue
            score, k = min((2000000 * a // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        found.sort()
        out += [(lang, i, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(found[:top], 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, rows, **kw):
    df = docs_frame(spark, [t for _, t in rows], **kw)
    langs = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(rows)], "doc_id long, lang string")
    return df.drop("lang").join(langs, "doc_id")


def random_rows(n, seed):
    r = random.Random(seed)
    vocab = ["a", "B", "c", "É", "é", "don't", "日本", "x1", "the", "of", "%_", "\\"] + [f"w{i}" for i in range(30)]
    line = "in witness whereof the parties have signed this deed today"
    rows = []
    for _ in range(n):
        words = [r.choice(vocab[:6] if r.random() < 0.5 else vocab) + r.choice([" ", " ", "  ", "\t", ", ", ".", "\n", " \n "])
                 for _ in range(r.randint(0, 60))]
        rows.append((r.choice(["en", "fr", None, "und"]), "".join(words) + (line if r.random() < 0.4 else "")))
    return rows


def test_equals_brute_force(spark):
    rows = random_rows(150, 1)
    for least, top in ((2, 2000), (5, 7)):
        assert got(P.collocations(frame(spark, rows), least, top)) == brute(rows, least, top)
    assert len(got(P.collocations(frame(spark, rows), 2, None))) == len(brute(rows, 2, 10**9))


def test_rare_pairs_change_no_count(spark):
    """All counts of the least number or more with an open gate, with the gate, and by the definition."""
    rows = [("en", t) for _, t in random_rows(80, 4)]
    df, want = frame(spark, rows), grams([t for _, t in rows])
    shut = P.gate(P.frequent_pairs(df, 4))
    for bits in (np.full_like(shut, -1), shut):
        levels = P.node_flow(P.longest_phrases(df, bits))
        for k, level in enumerate(levels, 1):
            assert {r.phrase: r.n for r in level.collect() if r.n >= 4} == {
                " ".join(g): n for g, n in want.items() if len(g) == k and n >= 4}
    assert sum(r.n for r in levels[0].collect()) == sum(n for g, n in want.items() if len(g) == 1)


def test_passages_are_the_unary_paths(spark):
    long = " ".join(f"p{i}" for i in range(300))
    texts = [f"x{i % 3} {long} y{i % 3}" for i in range(9)] + ["a b c d e"] * 4 + ["z a b c d q"] * 3 + ["u u u u u u u"] * 2
    levels = P.node_flow(P.longest_phrases(docs_frame(spark, texts), np.full(P.GATE_BITS // 64, -1)))
    found = {r.phrase: r.n for r in P.passages(levels[3], levels[2]).collect()}
    # a b c and b c d are both entered and left by several edges
    assert found == {long: 9, **{f"x{i} p0 p1 p2": 3 for i in range(3)}, **{f"p297 p298 p299 y{i}": 3 for i in range(3)},
                     "a b c d": 7, "b c d e": 4, "z a b c": 3, "b c d q": 3, "u u u u": 8}


def test_a_loop_in_a_text_is_no_endless_path(spark):
    texts = ["one two three four " * 30] * 3
    levels = P.node_flow(P.longest_phrases(docs_frame(spark, texts), np.full(P.GATE_BITS // 64, -1)))
    rows = P.passages(levels[3], levels[2]).collect()
    assert sum(r.n * (len(r.phrase.split(" ")) - 3) for r in rows) == sum(r.n for r in levels[3].collect())


def test_odd_rows(spark):
    texts = [None, "", " \t\n", "...", "A a", "a b a b", "x" * 200_000, "w v " * 50_000, "a, b. c"] + ["a b c"] * 5
    rows = [("en", t) for t in texts]
    df = frame(spark, rows, extra={"k": "1", "phrase": "2", "n": "3"})
    assert got(P.collocations(df, 3)) == brute(rows, 3, 2000)
    assert got(P.collocations(df.limit(0))) == [] and got(P.collocations(docs_frame(spark, [None]))) == []
    assert got(P.collocations(frame(spark, rows, ids=[1] * len(rows)).limit(0), 1)) == []


def test_products_beyond_64_bits(spark):
    a, b = 6 * 10**12, 7 * 10**12
    row = spark.createDataFrame([(a, b, b + 1)], "a long, l long, r long").selectExpr(
        "(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + r) AS score").first()
    assert row.score == 2000000 * a // (2 * b + 1)


def test_query_equals_sql(spark):
    for sf in (SF_SMALL, SF_MID):
        con = duckdb.connect()
        con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
        rel = con.sql(P.SQL)
        assert got(P.op13_phrases(spark, sf).select(*rel.columns)) == sorted(rel.fetchall())
