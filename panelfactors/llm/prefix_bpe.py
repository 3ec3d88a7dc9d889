"""Byte-level BPE by prefix dynamic programming.

The encoding of a text's prefix ends in one token, and this token is unique:
``t`` is the last token of a prefix exactly if it is a suffix of it and merging
``t`` together with the last token of the prefix before it gives these two
again.  ``Prefixes`` keeps that token for every prefix.  It is filled from left
to right with the tokens that an automaton over the vocabulary finds to end at
each byte, so that

* an append only computes the new prefixes,
* an edit recomputes from its place until the table runs as before, and
* the ids are read back from the end.

A whole piece that is a token gets that token, as in the rank files' library,
also where merging would not make it.  Texts are cut into pieces by the fixed
pattern of the rank files; a column's pieces are found by character classes,
the distinct pieces of a block are encoded once, in one prefix table.

The rank file is read on the driver (its path is a parameter) and broadcast:
its size is that of the vocabulary.  NULL text counts as empty: no ids.  Rows
are independent (no shuffle): repeated rows repeat their result, an empty table
gives none, other columns are ignored.  Memory is bounded by a block of four
times ``columnar.BLOCK`` characters or the longest text.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .columnar import BLOCK, OTHER, SPACE, Characters, blocks, char_classes, expand, slices
from .common import table, text_of

#: pairs whose verdict a worker remembers; more are judged again
PAIRS = 1_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:   # a parameter of the driver, not a table
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Vocabulary:
    """Tokens by rank: merging, valid neighbours, decoding."""

    def __init__(self, ranks: dict[bytes, int], whole: dict[bytes, int] | None = None):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self.pairs: dict[tuple[int, int], bool] = {}
        self.automaton = ahocorasick.Automaton()
        #: tokens that merging their own bytes does not make: only ever a whole piece
        self.whole = {t: i for t, i in ranks.items() if self.merge(t) != [i]} if whole is None else whole
        for t, i in ranks.items():
            if t not in self.whole:
                self.automaton.add_word(t.decode("latin-1"), (i, len(t)))
        self.automaton.make_automaton()
        self.sizes = {i: len(t) for i, t in self.tokens.items()}
        size = max(self.tokens) + 1
        self.column = pa.array([self.tokens.get(i, b"") for i in range(size)], pa.binary())

    def merge(self, data: bytes) -> list[int]:
        """Merges of the lowest rank first, the leftmost of equal ones: the definition, for short strings."""
        parts = [data[i:i + 1] for i in range(len(data))]
        get = self.ranks.get
        while len(parts) > 1:
            found = [(r, i) for i in range(len(parts) - 1) if (r := get(parts[i] + parts[i + 1])) is not None]
            if not found:
                break
            i = min(found)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def fits(self, a: int, b: int) -> bool:
        """Whether ``b`` may follow ``a``: merging both together leaves them as they are."""
        got = self.pairs.get((a, b))
        if got is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            got = self.pairs[a, b] = self.merge(self.tokens[a] + self.tokens[b]) == [a, b]
        return got

    def decode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of all ids side by side, and the place of each id's first byte (and the end)."""
        if not len(ids):
            return b"", np.zeros(1, np.int64)
        got = self.column.take(pa.array(ids.astype(np.int64)))
        places = np.frombuffer(got.buffers()[1], np.int32, len(ids) + 1).astype(np.int64)
        return got.buffers()[2].to_pybytes()[:places[-1]], places


class Prefixes:
    """The last token of every prefix of a byte string that grows and changes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.v, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def _fill(self, data: bytes, known: list[int], old: list[int] | None = None, same_from: int = 0) -> list[int]:
        """``known``, the table of a prefix of ``data``, continued to all of it.

        ``old`` is a table whose last entries belong to the same bytes; once as
        many entries in a row as the longest token has bytes agree, the rest does.
        """
        v, done = self.v, len(known) - 1
        shift = len(data) + 1 - len(old) if old else 0
        last = known + [-1] * (len(data) - done)
        begin, run, at = max(0, done + 1 - v.longest), 0, done
        for end, (token, size) in v.automaton.iter(data[begin:].decode("latin-1")):
            i = begin + end + 1
            if i <= done or last[i] >= 0 or size > i:
                continue
            if size == i or v.fits(last[i - size], token):
                last[i] = token
                if old and i > same_from:
                    run = run + 1 if i == at + 1 and old[i - shift] == token else int(old[i - shift] == token)
                    at = i
                    if run > v.longest:
                        last[i + 1:] = old[i - shift + 1:]
                        break
        return last

    def append(self, more: bytes) -> None:
        self.data += more
        self.last = self._fill(self.data, self.last)

    def edit(self, start: int, end: int, new: bytes) -> None:
        """Replaces the bytes from ``start`` to ``end``."""
        data = self.data[:start] + new + self.data[end:]
        self.last = self._fill(data, self.last[:start + 1], self.last, start + len(new))
        self.data = data

    def ids(self, n: int | None = None) -> list[int]:
        """The encoding of the first ``n`` bytes (default: all)."""
        out, i = [], len(self.data) if n is None else n
        while i:
            out.append(self.last[i])
            i -= len(self.v.tokens[out[-1]])
        return out[::-1]


def encode_pieces(v: Vocabulary, pieces: list[bytes]) -> list[list[int]]:
    """The ids of each piece, from one prefix table over all pieces side by side.

    A character that is in no token stands between two pieces, so no token crosses.
    """
    if not pieces:
        return []
    text = "\u0100".join([p.decode("latin-1") for p in pieces])
    last = [-1] * (len(text) + 1)
    begins, at = [], 0
    for p in pieces:
        last[at] = -2   # the empty prefix of a piece: any token may follow
        begins.append(at)
        at += len(p) + 1
    known, fits = v.pairs, v.fits
    for end, (token, size) in v.automaton.iter(text):
        if last[end + 1] == -1:
            before = last[end + 1 - size]
            if before == -2:
                last[end + 1] = token
            elif (ok := known.get((before, token))) or (ok is None and fits(before, token)):
                last[end + 1] = token
    out, tokens, whole = [], v.sizes, v.whole
    for p, begin in zip(pieces, begins):
        i, ids = begin + len(p), []
        while i > begin:
            ids.append(last[i])
            i -= tokens[last[i]]
        ids.reverse()
        out.append(ids)
    if whole:
        out = [[whole[p]] if p in whole else ids for p, ids in zip(pieces, out)]
    return out


def encode_piece(v: Vocabulary, piece: bytes) -> list[int]:
    return encode_pieces(v, [piece])[0]


def piece_starts(chars: Characters, classes: np.ndarray) -> np.ndarray:
    """Where the matches of the rank files' pattern begin (they cover a text without gaps), by character.

    A match is a run of letters, of numbers or of other characters, with the
    blank before it; a run of white space less its last character where more
    text follows; or one of the short forms after an apostrophe.
    """
    c, first = chars.points, chars.first
    n = len(c)
    k = classes[c]
    start = first[:n].copy()
    start[1:] |= k[1:] != k[:-1]
    # a run of white space gives its last character to what follows
    ends = np.flatnonzero((k[:-1] == SPACE) & (k[1:] != SPACE) & ~first[1:n])
    start[ends] = True
    start[ends + 1] = c[ends] != 32
    # fixed values: the short forms 's 't 'm 'd and 're 've 'll
    p = np.flatnonzero((c[:-1] == 39) & (k[:-1] == OTHER) & start[:-1] & ~first[1:n])
    one = c[p + 1]
    two = np.where((p + 2 < n) & ~first[np.minimum(p + 2, n)], c[np.minimum(p + 2, n - 1)], 0)
    short = np.isin(one, [ord(x) for x in "stmd"])
    long = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    start[p[short | long] + 1] = False
    after = np.concatenate((p[short] + 2, p[long] + 3))
    start[after[after < n]] = True
    return np.flatnonzero(start)


def encode_texts(v: Vocabulary, classes: np.ndarray, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts side by side, and the place where each text's ids begin (and the end)."""
    chars = Characters(texts)
    if not len(chars.points):
        return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
    starts = piece_starts(chars, classes)
    places = chars.byte_places()[np.concatenate((starts, [len(chars.points)]))]
    pieces = slices(chars.bytes, places).dictionary_encode()
    ids, at = expand(encode_pieces(v, pieces.dictionary.to_pylist()), pieces.indices.to_numpy())
    return ids, at[np.searchsorted(starts, chars.bounds)]


_READY: dict[str, tuple[Vocabulary, np.ndarray]] = {}


def _ready(ranks: dict[bytes, int], whole: dict[bytes, int], classes: bytes, key: str) -> tuple[Vocabulary, np.ndarray]:
    """One vocabulary a Python worker, kept between tasks."""
    if key not in _READY:
        _READY.clear()
        _READY[key] = Vocabulary(ranks, whole), np.frombuffer(classes, np.uint8)
    return _READY[key]


def byte_bpe(docs: DataFrame, path: str, full: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row; ``full`` adds ids (array) and decoded (binary)."""
    ranks = read_ranks(path)
    key = hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()
    # bounded: the vocabulary, a byte a code point
    sent = docs.sparkSession.sparkContext.broadcast((ranks, Vocabulary(ranks).whole, char_classes()))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, classes = _ready(*sent.value, key)
        for batch in batches:
            at = 0
            for texts in blocks(batch.column(1).to_pylist(), 4 * BLOCK):
                ids, bounds = encode_texts(v, classes, texts)
                decoded, places = v.decode(ids)
                raw, ends = ids.astype("<u4").tobytes(), places[bounds]
                cols = [batch.column(0).slice(at, len(texts)), pa.array(np.diff(bounds), pa.int64()),
                        pa.array([hashlib.sha256(raw[4 * a:4 * b]).hexdigest() for a, b in zip(bounds, bounds[1:])], pa.string()),
                        pa.array([hashlib.sha256(decoded[a:b]).hexdigest() for a, b in zip(ends, ends[1:])], pa.string())]
                if full:
                    cols += [pa.array([ids[a:b].astype(np.int32) for a, b in zip(bounds, bounds[1:])], pa.list_(pa.int32())),
                             pa.array([decoded[a:b] for a, b in zip(ends, ends[1:])], pa.binary())]
                at += len(texts)
                yield pa.RecordBatch.from_arrays(cols, names=names)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (
        ", ids array<int>, decoded binary" if full else "")
    names = [c.strip().split(" ")[0] for c in schema.split(", ")]
    return docs.select("doc_id", text_of(docs).alias("text")).mapInArrow(encode, schema)


def ranks_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op12_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Contract digest over all ``documents``."""
    return byte_bpe(table(spark, sf_dir, "documents"), ranks_path())
