import hashlib
import random
import struct

from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelfactors.llm import bpe_codec
from panelfactors.llm.bpe_codec import Codec, Lexicon, Merger, bpe, compile_lexicon, op7_bpe, tokenizer_path
from tests.conftest import SF_SMALL
from tests.llm.conftest import docs_frame


def library():
    t = Tokenizer.from_file(tokenizer_path())
    t.no_padding()
    t.no_truncation()
    return t


def spec():
    import json
    return json.load(open(tokenizer_path(), encoding="utf-8"))


def words(n, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice("abcdestnré") for _ in range(r.randint(1, 9))) for _ in range(n)]


CASES = ["", " \n", "Hello, World! it's they'll 'tis 42nd", "a<|endoftext|>b <|startoftext|><|ENDOFTEXT|>", "Ünïcödé ÉÀ é ΣΑΣ İi ﬁ",
         "日本語 text 😀😀👍🏽 ½ ² ٣", "tab\tnew\nline nbsp em\x1cfs\x85nel​zw", "'s's't''re", "x" * 5000, "ab" * 30_000,
         "...!!!???###" * 50, "<|endoftext", "can't’t don’T", "\u0000\u0001 control", "Å̧ ẛ̣"]


def test_same_ids_and_text_as_the_library():
    lib, s = library(), spec()
    merger = Merger(s)
    lexicon = compile_lexicon({w.encode(): merger.encode(w.encode()) for w in ["hello", "world", "the", "it", "é"]})
    codec = Codec(s, lexicon)
    r = random.Random(5)
    chars = "abcdeé ßñ'sIİΣ12²!#.,-\n\t <|>日本😀́ "
    texts = CASES + ["".join(r.choice(chars) for _ in range(r.randint(0, 60))) for _ in range(3000)]
    for text in texts:
        want = lib.encode(text, add_special_tokens=False).ids
        ids, decoded = codec.encode(text)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == want, text[:60]
        assert decoded == lib.decode(want, skip_special_tokens=False), text[:60]


def test_lexicon_is_minimal_and_exact():
    entries = {w.encode(): [i, i * i] for i, w in enumerate(sorted(set(words(4000))))}
    lex = Lexicon(compile_lexicon(entries))
    assert all(lex.get(w) == ids for w, ids in entries.items())
    assert all(lex.get(w.encode()) is None for w in words(2000, 9) if w.encode() not in entries)
    assert lex.get(b"") is None and Lexicon(compile_lexicon({})).get(b"a") is None
    # suffixes are shared: words a.ing, b.ing ... need one chain for the end
    shared = {bytes([c]) + b"ing": [c] for c in range(97, 123)}
    assert struct.unpack_from("<5i", compile_lexicon(shared))[1] == 5


def test_rows(spark):
    df = docs_frame(spark, CASES + [None], extra={"ids": "x", "n_tokens": "y"})
    rows = {r.doc_id: r for r in bpe(df, tokenizer_path(), full=True).collect()}
    lib = library()
    for i, text in enumerate(CASES + [None]):
        want = lib.encode(text or "", add_special_tokens=False).ids
        assert rows[i].ids == want and rows[i].n_tokens == len(want)
    assert bpe(df.limit(0), tokenizer_path()).count() == 0
    assert bpe(docs_frame(spark, ["a b"] * 3, ids=[None, 1, 1]), tokenizer_path()).count() == 3


def test_query(spark, sample_texts):
    lib = library()
    rows = op7_bpe(spark, SF_SMALL).collect()
    assert len(rows) == len(sample_texts)
    for r in rows:
        want = lib.encode(sample_texts[r.doc_id]["text"] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(want)}I", *want)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(want, skip_special_tokens=False).encode()).hexdigest()


def test_no_document_is_read_for_the_lexicon(spark):
    """The lexicon comes from the tokenizer file: building the plan runs no job over the texts."""
    bad = docs_frame(spark, ["a b"]).withColumn("text", F.raise_error(F.lit("text was read")).cast("string"))
    assert bpe(bad, tokenizer_path()).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_vocabulary_words_and_kept_words(monkeypatch):
    s, lib = spec(), library()
    merger, inside = Merger(s), bpe_codec.vocabulary_words(s)
    assert len(inside) == len(set(inside)) and b"the" in inside
    monkeypatch.setattr(bpe_codec, "KEPT", 3)   # cleared again and again
    codec = Codec(s, compile_lexicon({w: merger.encode(w) for w in inside[:500]}))
    for w in words(300) + words(300):
        assert codec.word(w.encode()) == merger.encode(w.encode())
        assert len(codec.kept) <= 3
    text = " ".join(words(400, 3))
    want = lib.encode(text, add_special_tokens=False).ids
    assert codec.encode(text)[0] == struct.pack(f"<{len(want)}I", *want)
