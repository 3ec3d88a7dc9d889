import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from panelfactors.llm import ppm_langid as P
from panelfactors.llm.ppm_langid import Model, grams, op9_language_id, predict
from tests.llm.conftest import docs_frame


def brute_bits(train: bytes, text: bytes) -> float:
    """Code length with dictionaries of counts, byte by byte."""
    counts = {}
    padded = b" " * P.ORDER + train
    for i in range(P.ORDER, len(padded)):
        for k in range(P.ORDER + 1):
            c = counts.setdefault(padded[i - k:i], {})
            c[padded[i]] = c.get(padded[i], 0) + 1
    total, padded = 0.0, b" " * P.ORDER + text
    for i in range(P.ORDER, len(padded)):
        for k in range(P.ORDER, -2, -1):
            if k < 0:
                total += 8
                break
            c = counts.get(padded[i - k:i])
            if c is None:
                continue
            n, d = sum(c.values()), len(c)
            if padded[i] in c:
                total -= math.log2(c[padded[i]] / (n + d))
                break
            total -= math.log2(d / (n + d))
    return total


def test_code_lengths_are_exact():
    train = ("the cat and the hat sat on the mat, then they met. " * 5 + "été là-bas").encode()
    g, n = np.unique(grams(np.frombuffer(train, np.uint8)), return_counts=True)
    model = Model(g.astype(np.int64), n.astype(np.int64))
    for text in ("the cat", "zzz", "là été xyz the", "", "then\x00they"):
        data = text.encode()
        got = model.cost(grams(np.frombuffer(data, np.uint8))).sum()
        assert abs(got - brute_bits(train, data)) < 1e-2, text


def test_blocks_do_not_change_the_code_length(spark, monkeypatch):
    texts = ["the quick brown fox and the dog " * 20, "le renard brun et le chien " * 20] * 20
    df = docs_frame(spark, texts).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en").otherwise("fr"))
    whole = {r.doc_id: r.bits for r in predict(df).collect()}
    monkeypatch.setattr(P, "BLOCK", 7)
    for r in predict(df).collect():
        assert abs(r.bits - whole[r.doc_id]) < 1e-6 * r.bits


def test_edges(spark):
    texts = ["the dog and the cat " * 9, "el perro y los gatos " * 9] * 12 + [None, "", "123 !!", "the cat " * 30_000]
    df = docs_frame(spark, texts, ids=[*range(24), 24, 25, None, 27], extra={"held_out": "x", "score": "y", "letters": "z"})
    df = df.withColumn("lang", F.when(F.col("doc_id") > 23, None).when(F.col("doc_id") % 2 == 0, "en").otherwise("es"))
    rows = {r.doc_id: r for r in predict(df).collect()}
    assert len(rows) == 28
    for i in range(24):
        assert rows[i].lang_pred == ("en", "es")[i % 2] and 0.5 < rows[i].score <= 1
        assert rows[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 for i in (24, 25, None))
    assert rows[27].lang_pred == "en" and rows[None].held_out is False
    assert predict(df.limit(0)).count() == 0
    assert {r.lang_pred for r in predict(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.col("lang").alias("true"))
    got = op9_language_id(spark, sf).where("held_out").join(docs, "doc_id").collect()
    assert len(got) > 200
    assert sum(r.lang_pred == r.true for r in got) / len(got) > 0.95


def test_rare_contexts_are_kept(monkeypatch):
    """More contexts than get a row of their own: the code lengths stay those of all statistics."""
    monkeypatch.setattr(P, "MAX_CONTEXTS", 20)
    train = ("".join(chr(0x4E00 + i * 37 % 900) for i in range(700)) + "the cat and the hat sat on the mat, then they met").encode()
    g, n = np.unique(grams(np.frombuffer(train, np.uint8)), return_counts=True)
    model = Model(g.astype(np.int64), n.astype(np.int64))
    for text in ("the cat", train[:300].decode(), train[600:900].decode() + " zzz", "一二三 mat", ""):
        data = text.encode()
        assert abs(model.cost(grams(np.frombuffer(data, np.uint8))).sum() - brute_bits(train, data)) < 1e-2, text


def test_many_languages_share_one_context_table():
    """60 languages of 200 KB each: the numbered look-up equals each model's own, well under 1 GB."""
    import resource
    r = np.random.default_rng(3)
    words = [bytes(r.integers(97, 123, r.integers(2, 9)).astype(np.uint8)) for _ in range(3000)]
    trained = {}
    for i in range(60):
        text = b" ".join(words[j] for j in r.integers(i * 40, i * 40 + 600, 30_000))
        g, n = np.unique(grams(np.frombuffer(text, np.uint8)), return_counts=True)
        trained[f"l{i}"] = (g.astype(np.int64), n.astype(np.int64))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    models, numbers = P.models_of(trained)
    assert (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024 < 1000
    codes = grams(np.frombuffer("unknown é bytes and ".encode() + b" ".join(words[:50]), np.uint8))
    for m in models.values():
        assert np.array_equal(m.cost(codes), m.cost(codes, numbers[codes >> np.uint32(8)]))


def test_sample_is_the_least_crc_with_repeated_ids(spark):
    """The sample against plain Python: repeated ids count as often as they occur and are taken once."""
    ids = [i // 3 if i % 5 == 0 else i for i in range(900)] + [11] * 300 + [None] * 5
    texts = [f"text number {i}" for i in range(len(ids))]
    df = docs_frame(spark, texts, ids=ids).withColumn("lang", F.when(F.col("doc_id") % 7 == 0, "b").when(F.col("doc_id") != 13, "a"))
    for limit in (1, 40, 10_000):
        want = {}
        for lang in ("a", "b"):
            mine = [i for i in ids if i is not None and i != 13 and ("b" if i % 7 == 0 else "a") == lang and zlib.crc32(str(i).encode()) % 4 != 2]
            taken = set(sorted(mine, key=lambda i: (zlib.crc32(str(i).encode()), i))[:limit])
            want[lang] = sum(len(t.encode()) for i, t in zip(ids, texts) if i in taken)
        got = {r.lang: r.n for r in P.training_grams(df, limit).groupBy("lang").agg(F.sum("n").alias("n")).collect()}
        assert got == want, limit
