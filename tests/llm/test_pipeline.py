import hashlib
import re
import struct
from collections import Counter

import pytest

import __spark_entry__ as E
import corpus_pipeline as P
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of every stage over the smallest documents table."""
    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), {}
    for name, stage in P.STAGES:
        result = P.written(spark, stage(spark, docs, SF_SMALL), f"test-{name}")
        out[name] = docs.collect(), result.collect(), result.columns
        docs = result
    return out


def test_stages(stages):
    assert [n for n, _ in P.STAGES] == ["quality_rules", "ngram_join", "secret_scan", "source_mix", "bpe_codec"]
    for name in list(stages)[:-1]:
        assert stages[name][2] == COLUMNS and stages[name][1]


def test_quality_stage(stages):
    from tests.llm.test_quality_rules import brute
    before, after, _ = stages["quality_rules"]
    kept = {r.doc_id for r in after}
    passed = {r.doc_id for r in before if not brute(r.text)[-1]}
    assert kept <= passed and len(kept) > 0.9 * len(passed)


def test_join_stage(stages):
    from tests.llm.test_ngram_join import brute
    before, after, _ = stages["ngram_join"]
    found = brute([r.text for r in before], [r.doc_id for r in before])
    assert sorted(r.doc_id for r in after) == sorted({c for _, n, c in found if n} | {d for d, n, _ in found if not n})


def test_secret_stage(stages):
    from tests.llm.test_secret_scan import brute
    before, after, _ = stages["secret_scan"]
    assert sorted(r.doc_id for r in before) == sorted(r.doc_id for r in after)
    now = {r.doc_id: r for r in after}
    assert any(brute(r.text) for r in before)
    for r in before:
        assert not brute(now[r.doc_id].text) and now[r.doc_id].n_chars == len(now[r.doc_id].text)
        if not brute(r.text) and "[SECRET]" not in now[r.doc_id].text:
            assert now[r.doc_id] == r


def test_mix_stage(stages):
    from tests.llm.test_source_mix import brute_targets
    before, after, _ = stages["source_mix"]
    sizes, taken = Counter(), Counter()
    for r in before:
        sizes[r.source] += len(WORD.findall(r.text or ""))
    times = Counter(r.doc_id for r in after)
    for r in after:
        taken[r.source] += len(WORD.findall(r.text or ""))
    largest = max(len(WORD.findall(r.text or "")) for r in before)
    assert max(times.values()) <= 2 and set(times) <= {r.doc_id for r in before}
    for s, target in brute_targets(dict(sizes)).items():
        assert abs(taken[s] - target) <= largest


def test_encoding_stage(stages):
    from tests.llm.test_bpe_codec import library
    before, after, _ = stages["bpe_codec"]
    lib, texts = library(), {r.doc_id: r.text for r in before}
    assert Counter(r.doc_id for r in before) == Counter(r.doc_id for r in after)
    for r in after:
        want = lib.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(want)}I", *want)).hexdigest()


def test_run_is_registered():
    assert "pipeline" in E.queries()


def test_stages_on_empty_and_odd_tables(spark):
    from tests.llm.conftest import docs_frame
    body = " ".join(chr(97 + i % 26) * (1 + i // 26) for i in range(60))
    odd = docs_frame(spark, [None, "", body, body, body + " é", None], [None, "a", "a", None, None, "a"], [1, None, None, 2, 2, 1],
                     {"key": "k", "n_words": "x", "copies": "y"})
    for name, stage in P.STAGES:
        assert stage(spark, odd.limit(0), "").count() == 0, name
        out = stage(spark, odd, "")
        assert name == "bpe_codec" or out.columns == odd.columns
        assert out.count() >= 1, name
