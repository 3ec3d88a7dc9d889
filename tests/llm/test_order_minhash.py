import hashlib

import pytest

from panelfactors.llm import order_minhash as O
from panelfactors.llm.order_minhash import fingerprint, fingerprints, op5_document_fingerprints
from tests.conftest import SF_SMALL
from tests.llm.conftest import docs_frame

BODY = " ".join(f"w{i % 97}x{i // 50}" for i in range(900))


def brute_edited(rows):
    """rows: doc_id -> text; the contract's edited text of each."""
    order = sorted(rows, reverse=True)
    out = {}
    for i, d in enumerate(order):
        text, other = rows[d] or "", rows[order[(i + 1) % len(order)]] or ""
        half = len(text) // 2
        out[d] = text[:len(text) - half] + other[:half]
    return out


@pytest.fixture
def slices(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("slices", [1, 3, 40], indirect=True)
def test_edited_text_of_the_next_document(spark, slices):
    texts = {0: "alpha beta gamma", 2: None, 7: "", 8: "é😀" * 9, 9: "one two three four", 40: BODY, 41: "x"}
    df = docs_frame(spark, list(texts.values()), ids=list(texts), extra={"fingerprint": "f", "_b": "b", "_h": "h", "edited": "e"})
    got = {r.doc_id: r for r in fingerprints(df).collect()}
    want = brute_edited(texts)
    assert {d: r.edited for d, r in got.items()} == want
    fp = {d: r.fingerprint for d, r in got.items()}
    order = sorted(texts, reverse=True)
    for i, d in enumerate(order):
        nxt = fp[order[(i + 1) % len(order)]]
        assert got[d].near_next == likeness(fp[d], nxt)
        assert got[d].near_edited == likeness(fp[d], got[d].edited_fingerprint)


def likeness(a, b):
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    a, b = set(a.split("-")), set(b.split("-"))
    return len(a & b) / len({c[:2] for c in a | b})


def test_components_are_the_smallest_numbered_kmers_in_text_order(spark):
    """Selection against plain Python, the pairs' hashes taken from Spark."""
    from pyspark.sql import functions as F
    texts = [BODY, "a b c " * 300, "a b c d e " * 7 + BODY, " ".join(f"q{i}" for i in range(5000)), "one", "one two", ""]
    out = [r.fp for r in fingerprint(docs_frame(spark, texts), "text", "fp").orderBy("doc_id").collect()]
    for text, fp in zip(texts, out):
        words = text.split()
        kmers = [tuple(words[i:i + O.K]) for i in range(max(len(words) - O.K, 0) + 1)] if words else []
        seen, pairs = {}, []
        for i, k in enumerate(kmers):
            pairs.append((i, list(k), seen.get(k, 0)))
            seen[k] = seen.get(k, 0) + 1
        if not pairs:
            assert fp == ""
            continue
        hashed = spark.createDataFrame(pairs, "i int, k array<string>, n int").select(
            "i", F.expr("xxhash64(xxhash64(k), n)").alias("h")).collect()
        bins = {}
        for r in hashed:
            bins.setdefault((r.h % 2 ** 64) >> (64 - O.BIN_BITS), []).append((r.h, r.i))
        tuples = {b: [h for _, h in sorted((i, h) for h, i in sorted(v)[:O.TUPLE])] for b, v in bins.items()}
        names = list(tuples)
        comp = spark.createDataFrame([(b, tuples[b]) for b in names], "b int, t array<long>").select(
            F.expr("concat(lpad(lower(hex(b)), 2, '0'), lpad(lower(hex(xxhash64(t))), 16, '0'))").alias("c")).collect()
        assert set(fp.split("-")) == {r.c for r in comp}


def test_likeness_follows_edits_and_order(spark):
    words = BODY.split()
    few = words.copy()
    few[100] = few[500] = "edited"
    moved = words[450:] + words[:450]
    texts = [BODY, " ".join(few), " ".join(moved), " ".join(reversed(words)), " ".join(f"z{i}" for i in range(900))]
    fps = [r.fp for r in fingerprint(docs_frame(spark, texts), "text", "fp").orderBy("doc_id").collect()]
    near = [likeness(fps[0], f) for f in fps]
    assert near[0] == 1 and near[1] > 0.8 and near[1] > near[2] > near[4] == 0 and near[3] == 0


def test_ties_and_empty(spark):
    df = docs_frame(spark, ["a b c d", "a b c d", "e f g h", "x"], ids=[5, 5, 5, None])
    rows = fingerprints(df).collect()
    assert len(rows) == 4
    assert fingerprints(df.limit(0)).count() == 0
    assert fingerprints(docs_frame(spark, ["solo words here"])).first().near_next == 1


def test_query(spark, sample_texts):
    rows = {r.doc_id: r for r in op5_document_fingerprints(spark, SF_SMALL).collect()}
    texts = {d: r["text"] for d, r in sample_texts.items()}
    want = brute_edited(texts)
    assert len(rows) == len(texts)
    for d, r in rows.items():
        assert r.n_chars == len(texts[d] or "")
        assert r.edited_sha256 == hashlib.sha256(want[d].encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def test_next_with_missing_repeated_and_sparse_ids(spark):
    """The next row against plain Python; every id NULL, one id for a third of all rows, 64-bit ids far apart."""
    import random
    r = random.Random(5)
    n = 400
    sparse = [r.randrange(-2 ** 63, 2 ** 63) for _ in range(n - 2)] + [2 ** 63 - 1, -2 ** 63]
    for ids in ([None] * n, [7 if i % 3 == 0 else i for i in range(n)], sparse, [None if i % 2 else -i for i in range(n)], [3]):
        texts = [f"text {i} " + "word " * (i % 7) for i in range(len(ids))]
        df = docs_frame(spark, texts, ids=ids, extra={"_o": "x", "_at": "y", "next_text": "z"})
        rows = O.with_next(df.select("doc_id", "text").repartition(5), ["text"]).collect()
        order = sorted(zip(ids, texts), key=lambda x: (x[0] is None, -(x[0] or 0), hashlib.md5(x[1].encode()).hexdigest()))
        want = {t: order[(i + 1) % len(order)][1] for i, (_, t) in enumerate(order)}
        assert len(rows) == len(ids) and {x.text: x.next_text for x in rows} == want
    # the id that a third of the rows hold is spread over the slices
    hot = docs_frame(spark, [f"text {i}" for i in range(3000)], ids=[7 if i % 3 == 0 else i for i in range(3000)])
    from pyspark.sql import functions as F
    sizes = [x["count"] for x in O.with_next(hot.select("doc_id", "text"), ["text"]).groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 3 * 3000 / int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_very_long_text_and_extra_columns(spark):
    words = [f"w{i * i % 70001}" for i in range(200_000)]
    df = docs_frame(spark, [" ".join(words), " ".join(words[:-5]), "short one here"], extra={"fingerprint": "f", "edited": "e", "_p": "p"})
    rows = {r.doc_id: r for r in fingerprints(df).collect()}
    assert rows[1].near_next > 0.9 and rows[2].near_next == likeness(rows[2].fingerprint, rows[1].fingerprint) and rows[0].near_next < 0.2
