import hashlib
import random

import numpy as np
import pytest

from panelfactors.llm import suffix_dedup as S
from panelfactors.llm.suffix_dedup import intervals, op8_suffix_dedup, removed_bytes
from tests.llm.conftest import docs_frame


def brute(docs):
    """docs: (id, bytes) in order -> (id, bytes, removed, spans, kept)."""
    seen, out = set(), []
    for d, data in docs:
        cover = np.zeros(len(data) + 1, bool)
        for s in range(len(data) - 99):
            w = data[s:s + 100]
            if w in seen:
                cover[s:s + 100] = True
            seen.add(w)
        spans = int((cover[:-1] & ~np.concatenate([[False], cover[:-2]])).sum()) if len(data) else 0
        kept = bytes(np.frombuffer(data, np.uint8)[~cover[:len(data)]])
        out.append((d, len(data), int(cover[:len(data)].sum()), spans, kept))
    return out


def got(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect()), key=repr)


def corpus(seed):
    r = random.Random(seed)
    vocab = ["".join(r.choice("aeinrstéñ") for _ in range(r.randint(1, 7))) for _ in range(400)]

    def prose(n):
        return " ".join(r.choice(vocab) for _ in range(n))
    passages = [prose(n) for n in (14, 18, 22, 40, 90)]
    texts = []
    for i in range(120):
        parts = [prose(r.randint(1, 50)) for _ in range(r.randint(1, 4))]
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            if r.random() < 0.5:
                a = r.randrange(len(p) // 2)
                p = p[a:a + r.randint(60, 140)]
            parts.insert(r.randrange(len(parts) + 1), p)
        texts.append(" ".join(parts))
    near = prose(80)
    for _ in range(30):
        w = near.split()
        w[r.randrange(80)] = "edit" + str(r.random())
        texts.append(" ".join(w))
    texts += [texts[3]] * 4 + ["x" * 450, "ab" * 300, "abc" * 90 + "ab" * 80, "short", "", "short", "y" * 99, "y" * 100, "y" * 101,
                               "\u0000" * 150, "p" * 50 + "\u0000" * 120, "é" * 77]
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize("hot,chunk,seed", [(50_000, 200_000, 1), (50_000, 50, 2), (5, 200_000, 3), (1, 50, 4)])
def test_against_brute_force(spark, monkeypatch, hot, chunk, seed):
    monkeypatch.setattr(S, "HOT", hot)
    monkeypatch.setattr(S, "CHUNK", chunk)
    texts = corpus(seed)
    ids = list(range(0, 3 * len(texts), 3))
    random.Random(seed).shuffle(ids)
    df = docs_frame(spark, texts, ids=ids, extra={"h": "x", "o1": "y", "ctx": "z", "first": "f", "pos": "p"})
    want = brute(sorted((i, t.encode()) for i, t in zip(ids, texts)))
    assert got(removed_bytes(df)) == sorted(want, key=repr)


def test_interval_tree():
    r = random.Random(0)
    for _ in range(200):
        lcp = [0] + [r.choice([0, 31, 32, 33, 40, 100]) for _ in range(r.randint(0, 12))]
        want = set()
        for a in range(len(lcp)):
            for b in range(a + 2, len(lcp) + 1):
                low = min(lcp[a + 1:b])
                if low >= 32 and (a == 0 or lcp[a] < low) and (b == len(lcp) or lcp[b] < low):
                    want.add((a, b, low))
        found = list(intervals(lcp))
        assert set(found) == want and len(found) == len(want)


def test_rows_null_ids_repeats_and_long_text(spark):
    r = random.Random(4)
    words = [f"w{r.randrange(10 ** 6)}" for _ in range(40_000)]
    long_text = " ".join(words)
    tail = long_text[:400]
    texts = [long_text, tail + " more", tail, tail, None, None, "", "z" * 200, "z" * 200]
    ids = [5, 9, 9, None, 1, None, 2, 7, 7]
    rows = got(removed_bytes(docs_frame(spark, texts, ["s"] * 9, ids)))
    assert len(rows) == 9
    by = {}
    for d, n, removed, spans, kept in rows:
        by.setdefault((d, n), []).append((removed, spans, len(kept)))
    assert by[5, len(long_text)] == [(0, 0, len(long_text))]
    assert by[9, 405] == [(400, 1, 5)] and by[9, 400] == [(400, 1, 0)] and by[None, 400] == [(400, 1, 0)]
    # a repeated row is one document with the same result
    assert by[7, 200] == [(199, 1, 1)] * 2
    assert by[1, 0] == by[2, 0] == [(0, 0, 0)]
    assert removed_bytes(docs_frame(spark, texts, ids=ids).limit(0)).count() == 0


def test_query(spark):
    import pyarrow.parquet as pq
    sf = "/root/testdata/sf0.01"
    rows = pq.read_table(f"{sf}/documents.parquet").to_pylist()
    want = brute(sorted((r["doc_id"], (r["text"] or "").encode()) for r in rows))
    want = sorted((d, n, k, s, hashlib.sha256(t).hexdigest()) for d, n, k, s, t in want)
    assert sorted(tuple(r) for r in op8_suffix_dedup(spark, sf).collect()) == want
