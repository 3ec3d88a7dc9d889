import random
import re

import numpy as np
import pytest

from panelfactors.llm import ngram_join as J
from panelfactors.llm.ngram_join import components, op2_ngram_jaccard_join, one_per_component, similar_documents
from tests.llm.conftest import docs_frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_sets(texts):
    out = []
    for t in texts:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        out.append({tuple(w[i:i + 3]) for i in range(max(len(w) - 2, 1))} if w else set())
    return out


def brute(texts, ids):
    sets = brute_sets(texts)
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    by = {}
    for i, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(i)
    seen = set()
    for v in by.values():
        for k, i in enumerate(v):
            for j in v[k + 1:]:
                if (i, j) not in seen:
                    seen.add((i, j))
                    n = len(sets[i] & sets[j])
                    if 100 * n >= 90 * len(sets[i] | sets[j]):
                        root[find(j)] = find(i)
    least = {}
    for i in range(len(sets)):
        if ids[i] is not None:
            least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return [(ids[i], len(s), least.get(find(i)) if s else ids[i]) for i, s in enumerate(sets)]


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def near_copies(r, words, n, edits):
    out = []
    for _ in range(n):
        w = words.copy()
        for _ in range(r.randint(0, edits)):
            w[r.randrange(len(w))] = f"e{r.random()}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("part,block,frequent", [(2048, 64, 32), (7, 3, 4)])
def test_groups_of_near_copies(spark, monkeypatch, part, block, frequent):
    """Pairs on both sides of the threshold, chains, a frequent passage, long lists cut into parts."""
    monkeypatch.setattr(J, "PART", part)
    monkeypatch.setattr(J, "FREQUENT_FROM", frequent)
    r = random.Random(3)
    texts = []
    for size, n, edits in ((200, 60, 5), (80, 25, 3), (40, 30, 2), (400, 20, 9), (12, 12, 1), (4, 8, 1)):
        texts += near_copies(r, [f"w{size}x{i}" for i in range(size)], n, edits)
    chain = [f"c{i}" for i in range(300)]
    for i in range(40):      # each links to the next, the ends do not
        chain = chain.copy()
        chain[r.randrange(300)] = f"d{i}"
        texts.append(" ".join(chain))
    passage = "this common passage stands in every one of these different documents of ours"
    texts += [passage + " " + " ".join(f"u{i}x{j}" for j in range(r.randint(5, 60))) for i in range(60)]
    texts += ["The Same", "the same", "the  same\n", "SAME the", "one", "One", "a a a a a a", "a a a", None, "", " \t"]
    r.shuffle(texts)
    ids = list(range(len(texts)))
    r.shuffle(ids)
    assert got(similar_documents(docs_frame(spark, texts, ids=ids))) == sorted(brute(texts, ids), key=repr)


def test_blocks_skip_no_pair():
    r = np.random.default_rng(1)
    n = r.integers(10, 200, 300)
    pos = (r.random(300) * (n - J.need(n) + J.SHARED)).astype(int)
    comp, pivot, part = r.integers(0, 50, 300), r.integers(0, 20, 300), r.integers(0, 2, 300)
    for i, j in ((0, 0), (0, 1)):
        a, b = J.list_pairs(n, pos, comp, pivot, part, i, j, block=16)
        rest, least = n - pos, J.need(n)
        want = {(x, y) for x in range(300) for y in range(x + 1, 300)
                if min(rest[x], rest[y]) >= max(least[x], least[y]) and 10 * min(n[x], n[y]) >= 9 * max(n[x], n[y])
                and comp[x] != comp[y] and pivot[x] != pivot[y] and (i == j or part[x] != part[y])}
        assert {(min(x, y), max(x, y)) for x, y in zip(a, b)} == want and len(a) == len(want)
    cols = {"n": n, "pos": pos, "comp": comp, "pivot": pivot}
    starts, sizes = np.arange(0, 300, 10), np.full(30, 10)
    short = [(x, y) for a, b in J.short_pairs(starts, sizes, cols, lambda x, y: J.may_link(x, y, passed=0)) for x, y in zip(a, b)]
    a, b = J.list_pairs(n, pos, comp, pivot, part, 0, 0)
    assert sorted(short) == sorted((x, y) for x, y in ((min(p), max(p)) for p in zip(a, b)) if x // 10 == y // 10)


def test_differences_skip_no_pair():
    r = np.random.default_rng(2)
    over, rest, link = r.integers(-1500, 3000, 300), r.integers(1, 12, 300), r.random(300) < 0.4
    part = r.integers(0, 2, 300)
    for within in (True, False):
        for i, j in ((0, 0), (0, 1)):
            a, b = J.band_pairs(over, rest, link, part, i, j, within, block=16)
            want = {(x, y) for x in range(300) for y in range(x + 1, 300)
                    if 0 < over[x] + over[y] <= 380 * min(rest[x], rest[y]) and (within or not (link[x] and link[y]))
                    and (i == j or part[x] != part[y])}
            assert {(min(p), max(p)) for p in zip(a, b)} == want and len(a) == len(want)


def test_pairs_listed_grow_with_the_group(spark):
    """A group of near copies with edits at random: few pairs are listed, and per copy hardly more in a larger group."""
    def listed(size):
        r = random.Random(size)
        texts = near_copies(r, [f"w{i}" for i in range(150)], size, 7)
        docs = docs_frame(spark, texts)
        posts = J.postings(docs, J.frequent_tokens(J.read_sets(docs).where("kind = 1")))
        reps = J.read_sets(docs).where("kind = 0").groupBy("c").agg({"key": "min"}).toDF("c", "key")
        sets = J.token_sets(docs, reps)
        centre = posts.groupBy("c").agg({"rare": "min"}).orderBy("min(rare)", "c").first().c
        pivots = J.verify_pivots(reps.where(reps.c != centre).selectExpr("c", f"unhex('{centre.hex()}') AS pivot"), sets)
        return J.pivot_pairs(pivots, False, "test-differences").count()
    small, large = listed(300), listed(600)
    assert large < 600 * 600 / 2 / 20 and large <= 2 * 1.3 * small + 100


def test_components(spark):
    r = random.Random(2)
    for edges in ([(i, i + 1) for i in range(60)], [(r.randrange(300), r.randrange(300)) for _ in range(160)], []):
        df = spark.createDataFrame([(str(a), str(b)) for a, b in edges], "a string, b string")
        out = {x.c: x.comp for x in components(df, "t").collect()}
        adj = {}
        for a, b in edges:
            adj.setdefault(str(a), set()).add(str(b))
            adj.setdefault(str(b), set()).add(str(a))
        for c in out:
            seen, todo = {c}, [c]
            while todo:
                for y in adj[todo.pop()] - seen:
                    seen.add(y)
                    todo.append(y)
            assert out[c] == min(seen)
        assert set(out) == {str(x) for a, b in edges if a != b for x in (a, b)}


def test_rows_null_ids_and_clashing_columns(spark):
    long_text = " ".join(f"l{i % 40_000}" for i in range(120_000))
    texts = ["x y z w", "x y z w", "x y z w", long_text, long_text + " end", None, None, "", "q r s", "q r s"]
    ids = [7, None, 7, 3, 2, 1, 1, None, None, None]
    df = docs_frame(spark, texts, ids=ids, extra={"join_key": "k", "c": "x", "token": "y", "n": "z"})
    assert got(similar_documents(df)) == sorted(brute(texts, ids), key=repr)
    kept = one_per_component(df)
    assert kept.columns == df.columns
    assert sorted((str(r.doc_id), (r.text or "")[:5]) for r in kept.collect()) == sorted(
        [("7", "x y z"), ("2", "l0 l1"), ("1", ""), ("1", ""), ("None", ""), ("None", "q r s")])
    assert similar_documents(df.limit(0)).count() == 0 and one_per_component(df.limit(0)).count() == 0


def test_query(spark):
    import pyarrow.parquet as pq
    sf = "/root/testdata/sf0.01"
    rows = pq.read_table(f"{sf}/documents.parquet").to_pylist()
    want = brute([r["text"] for r in rows], [r["doc_id"] for r in rows])
    assert got(op2_ngram_jaccard_join(spark, sf)) == sorted(want, key=repr)


def cut_groups(r, sizes, copies):
    """Groups whose members lack or add words at the start or end, or are edited there."""
    out = []
    for size in sizes:
        for g in range(copies):
            w = [f"t{size}g{g}x{i}" for i in range(size + 2)]      # size shingles
            k = size // 11
            out += [" ".join(x) for x in (w, w[:-k], w[k:], w + [f"e{g}y{i}" for i in range(k)], [f"s{g}y{i}" for i in range(k)] + w,
                                          w[:-1] + ["z"], ["z"] + w[1:], w[k // 2:-(k - k // 2)])]
    r.shuffle(out)
    return out


def test_truncated_extended_and_end_edited_groups(spark):
    r = random.Random(11)
    texts = cut_groups(r, (11, 19, 20, 22, 25, 29, 33, 60, 100, 101, 150, 210), 12)
    ids = list(range(len(texts)))
    assert got(similar_documents(docs_frame(spark, texts, ids=ids))) == sorted(brute(texts, ids), key=repr)


def test_cut_on_both_sides_is_linked(spark):
    """A and C miss each other but both link to B; only one of the pairs can be a pivot pair."""
    texts = []
    for g in range(40):
        w = [f"b{g}x{i}" for i in range(102)]
        texts += [" ".join(w), " ".join(w[:-9]), " ".join(w[9:])]
    rows = {r.doc_id: r.component_id for r in similar_documents(docs_frame(spark, texts)).collect()}
    assert all(rows[i] == i // 3 * 3 for i in rows)


def test_components_with_null_or_repeated_ids_keep_one_row_each(spark):
    texts = [f"{x} text that is like no other {x} one {x}" for x in ("red", "green", "blue", "black", "white")]
    texts += texts[:2] + [texts[3].upper()]
    ids = [None, None, None, 7, 7, None, None, 7]
    kept = one_per_component(docs_frame(spark, texts, ids=ids)).collect()
    assert sorted(r.text.lower() for r in kept) == sorted(texts[:5])
    assert sorted(str(r.doc_id) for r in kept) == ["7", "7", "None", "None", "None"]


def test_links_are_counted_within_components(spark):
    r = random.Random(5)
    texts = cut_groups(r, (20, 60, 110), 6) + near_copies(r, [f"n{i}" for i in range(200)], 50, 6) + ["same words here now"] * 3 + ["", None]
    ids = list(range(len(texts)))
    sets = brute_sets(texts)
    want = [sum(1 for j, y in enumerate(sets) if i != j and x and 100 * len(x & y) >= 90 * len(x | y)) for i, x in enumerate(sets)]
    df = similar_documents(docs_frame(spark, texts, ids=ids), count_links=True)
    assert {x.doc_id: x.n_links for x in df.collect()} == dict(zip(ids, want))
    assert got(df) == sorted(brute(texts, ids), key=repr)
