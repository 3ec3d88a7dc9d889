import hashlib
import random

import numpy as np
import pytest
import tiktoken

import public_tokenizers
from panelfactors.llm.columnar import blocks, char_classes
from panelfactors.llm.prefix_bpe import (Prefixes, Vocabulary, byte_bpe, encode_piece, encode_texts, op12_byte_bpe,
                                         ranks_path, read_ranks)
from tests.conftest import SF_SMALL
from tests.llm.conftest import docs_frame

CASES = ["", " ", "\n", "  \n ", "Hello, World! it's they'll 'tis 42nd we've I'd I'm you're", "a  b   c\t\td \n\n e f  ",
         "'s's 's ''s 'll'x 're've'vex 'rx '", "Ünïcödé ÉÀ 日本語 text 😀😀👍🏽 ½ ² ٣ x²", "<|endoftext|> <|x|>", "x" * 5000,
         "ab" * 30_000, "...!!!???###" * 50, "a\x1cb\x1fc\x85d e　f​g", "can't’t don’T DON'T", "\u0000\u0001 control",
         "12345 6 789a1 1a", "tail space ", "tail two  ", "don't\n't 's\n's"]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(ranks_path()),
                             special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(read_ranks(ranks_path())), np.frombuffer(char_classes(), np.uint8)


def random_texts(n, seed=3):
    r = random.Random(seed)
    chars = "abcdeglmrstv ''  \n\t12é²ß日😀.,- ́Ⅷ"
    return ["".join(r.choice(chars) for _ in range(r.randint(0, 60))) for _ in range(n)]


def test_same_ids_as_the_library(library, vocabulary):
    v, classes = vocabulary
    texts = CASES + random_texts(4000)
    for part in blocks(texts, 20_000):
        ids, at = encode_texts(v, classes, part)
        decoded, places = v.decode(ids)
        for i, t in enumerate(part):
            assert ids[at[i]:at[i + 1]].tolist() == library.encode_ordinary(t), t[:60]
            assert decoded[places[at[i]]:places[at[i + 1]]] == t.encode()


def test_code_points_have_the_library_s_classes(library, vocabulary):
    v, classes = vocabulary
    texts = [f"a{chr(c)}b {chr(c)}1" for c in (*range(0x3100), *range(0x3100, 0x110000, 97))
             if not 0xD800 <= c < 0xE000]
    wrong, want = [], library.encode_ordinary_batch(texts, num_threads=4)
    at = 0
    for part in blocks(texts):
        ids, b = encode_texts(v, classes, part)
        wrong += [t for i, t in enumerate(part) if ids[b[i]:b[i + 1]].tolist() != want[at + i]]
        at += len(part)
    assert not wrong, (len(wrong), [hex(ord(t[1])) for t in wrong[:20]])


def test_prefixes_append_and_edit_equal_encoding_anew(library, vocabulary):
    v, _ = vocabulary
    r = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz"
    for _ in range(60):
        text = "".join(r.choice(letters) for _ in range(r.randint(1, 900)))
        p = Prefixes(v)
        for i in range(0, len(text), 70):
            p.append(text[i:i + 70].encode())
        assert p.ids() == v.merge(text.encode()) == Prefixes(v, text.encode()).ids()
        n = r.randint(0, len(text))
        assert p.ids(n) == v.merge(text[:n].encode())
        for _ in range(5):
            a = r.randint(0, len(text))
            b = min(len(text), a + r.randint(0, 12))
            new = "".join(r.choice(letters) for _ in range(r.randint(0, 12)))
            text = text[:a] + new + text[b:]
            p.edit(a, b, new.encode())
            assert p.data == text.encode() and p.last == Prefixes(v, text.encode()).last


def test_an_edit_touches_only_what_is_near(vocabulary):
    v, _ = vocabulary
    r = random.Random(2)
    text = "".join(r.choice("etaoinshrdlu") for _ in range(200_000)).encode()
    p, asked = Prefixes(v, text), []
    fits = v.fits
    v.fits = lambda a, b: asked.append(1) or fits(a, b)
    try:
        p.edit(100, 103, b"the")
    finally:
        del v.fits
    assert len(asked) < 5000 and len(p.ids()) == len(Prefixes(v, p.data).ids())


def test_tokens_that_merging_does_not_make():
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"abc": 300, b"bc": 200 + 57, b"xyz": 301}
    v = Vocabulary(ranks)
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert v.whole == {b"xyz": 301}
    for w in ("xyz", "xyzx", "abc", "abcabc", "bcab", "aabcc"):
        assert encode_piece(v, w.encode()) == lib.encode_ordinary(w)


def test_rows(spark, library):
    texts = CASES + [None, "word " * 300_000]
    df = docs_frame(spark, texts, extra={"ids": "x", "n_tokens": "y"})
    rows = {r.doc_id: r for r in byte_bpe(df, ranks_path(), full=True).collect()}
    for i, text in enumerate(texts):
        want = library.encode_ordinary(text or "")
        assert rows[i].ids == want and rows[i].n_tokens == len(want) and bytes(rows[i].decoded) == (text or "").encode()
    assert byte_bpe(df.limit(0), ranks_path()).count() == 0
    assert byte_bpe(docs_frame(spark, ["a b"] * 3, ids=[None, 1, 1]), ranks_path()).count() == 3


def test_query(spark, sample_texts, library):
    rows = op12_byte_bpe(spark, SF_SMALL).collect()
    assert len(rows) == len(sample_texts)
    for r in rows:
        text = sample_texts[r.doc_id]["text"] or ""
        want = library.encode_ordinary(text)
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
