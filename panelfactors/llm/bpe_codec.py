"""BPE encoding and decoding with a minimal acyclic transducer lexicon.

The words that the vocabulary itself holds are encoded once and compiled, on
the driver, into a minimal acyclic automaton (shared prefixes and suffixes) whose
arcs count the words they skip, so a walk gives a word's number, and the number
its ids.  The compiled lexicon is bounded by the tokenizer file, is sent to the
tasks as one byte string and is memory-mapped there.  Words outside it are merged
exactly, by rank.  A worker keeps the ids of up to ``KEPT`` words it has met.  The
lexicon only saves time: any lexicon gives the same ids.  Nothing is counted or sampled.

Texts are cut into words by character classes, a block of whole texts at a time;
the automaton is asked once for each distinct word of a block, and ids and decoded
texts are taken by index.

The tokenizer file (word-level BPE with ``</w>`` word ends) is read on the
driver; its path is a parameter.  Normalization is NFC and character-wise lower
case; the file's added tokens are found in the raw text.  Decoding joins the
ids' tokens with a blank, as the library does for a file without decoder.

NULL text counts as empty: no ids.  Rows are independent (no shuffle), so
repeated rows repeat their result; extra columns are ignored.  Memory is bounded
by a block of four times ``columnar.BLOCK`` characters or the longest text.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import struct
import tempfile
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .columnar import BLOCK, NUMBER, SPACE, Characters, blocks, char_classes, expand, slices
from .common import table, text_of

#: words that a worker keeps with their ids, and their length in bytes at most
KEPT, MAX_KEPT_WORD = 50_000, 64
#: words up to this many bytes are merged by scanning, longer ones by a heap
SHORT = 24
END = "</w>"


def byte_chars() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, n = {b: chr(b) for b in plain}, 0
    for b in range(256):
        if b not in out:
            out[b], n = chr(256 + n), n + 1
    return [out[b] for b in range(256)]


class Merger:
    """Exact merges of one word, and decoding; built from the tokenizer file's contents."""

    def __init__(self, spec: dict):
        vocab = spec["model"]["vocab"]
        chars = byte_chars()
        self.first = [vocab[c] for c in chars]
        self.last = [vocab[c + END] for c in chars]
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.pairs[vocab[a], vocab[b]] = rank, vocab[a + b]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (vocab | self.added).items()}
        #: each token's text and a blank
        self.column = pa.array([(self.tokens.get(i, "") + " ").encode() for i in range(max(self.tokens) + 1)], pa.binary())

    def encode(self, word: bytes) -> list[int]:
        """Merges by rank, leftmost first."""
        ids = [self.first[b] for b in word[:-1]] + [self.last[word[-1]]]
        return self.scan(ids) if len(ids) <= SHORT else self.heap(ids)

    def scan(self, ids: list[int]) -> list[int]:
        """The best pair is looked for anew after each merge: fastest for short words."""
        get = self.pairs.get
        found = [get(p) for p in zip(ids, ids[1:])]
        while True:
            best = None
            for i, f in enumerate(found):
                if f is not None and (best is None or f < best):
                    best, at = f, i
            if best is None:
                return ids
            ids[at:at + 2] = [best[1]]
            del found[at]
            if at:
                found[at - 1] = get((ids[at - 1], ids[at]))
            if at < len(found):
                found[at] = get((ids[at], ids[at + 1]))

    def heap(self, ids: list[int]) -> list[int]:
        """A heap over a linked list: n log n for any length."""
        n = len(ids)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*self.pairs[p], i, *p) for i, p in enumerate(zip(ids, ids[1:])) if p in self.pairs]
        heapq.heapify(heap)
        while heap:
            _, new, i, a, b = heapq.heappop(heap)
            j = right[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], right[i] = new, -1, right[j]
            if right[j] < n:
                left[right[j]] = i
            for k in (left[i], i):
                if k >= 0 and right[k] < n and (p := (ids[k], ids[right[k]])) in self.pairs:
                    heapq.heappush(heap, (*self.pairs[p], k, *p))
        return [i for i in ids if i >= 0]

    def decode(self, ids: Iterable[int]) -> str:
        return " ".join(self.tokens[i] for i in ids)


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """The minimal acyclic automaton of the words, with the ids of each by its number in sorted order.

    Words are added in order; a finished branch is replaced by the equal state
    registered before (same finality, arcs and targets), so suffixes are shared.
    """
    register: dict[tuple, int] = {}
    finals: list[bool] = []
    arcs: list[tuple] = []
    count: list[int] = []
    # the branch still open: [final, {byte: target}] of each state on the last word's path
    path: list[list] = [[False, {}]]
    last = b""

    def close(down_to: int) -> None:
        while len(path) > down_to:
            final, out = path.pop()
            key = (final, tuple(sorted(out.items())))
            if key not in register:
                register[key] = len(finals)
                finals.append(final)
                arcs.append(key[1])
                count.append(final + sum(count[t] for _, t in key[1]))
            if path:
                path[-1][1][last[len(path) - 1]] = register[key]

    words = sorted(entries)
    for w in words:
        same = next((i for i, (a, b) in enumerate(zip(w, last)) if a != b), min(len(w), len(last)))
        close(same + 1)
        path.extend([False, {}] for _ in w[same:])
        path[-1][0] = True
        last = w
    close(0)
    starts, labels, targets, skips = [0], bytearray(), [], []
    for final, out in zip(finals, arcs):
        n = int(final)
        for b, t in out:
            labels.append(b)
            targets.append(t)
            skips.append(n)
            n += count[t]
        starts.append(len(labels))
    offsets, ids = [0], []
    for w in words:
        ids += entries[w]
        offsets.append(len(ids))
    head = (len(finals) - 1, len(finals), len(labels), len(words), len(ids))
    return (struct.pack("<5i", *head) + b"".join(struct.pack(f"<{len(x)}i", *x) for x in (starts, targets, skips, offsets, ids))
            + bytes(finals) + bytes(labels))


class Lexicon:
    """A compiled lexicon, memory-mapped: the file is removed at once and lives as long as the mapping."""

    def __init__(self, compiled: bytes):
        with tempfile.TemporaryFile() as f:
            f.write(compiled)
            f.flush()
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        self.root, states, arcs, words, ids = struct.unpack_from("<5i", self.map)
        at, view = 20, memoryview(self.map)
        for name, n in (("starts", states + 1), ("targets", arcs), ("skips", arcs), ("offsets", words + 1), ("ids", ids)):
            setattr(self, name, view[at:at + 4 * n].cast("i"))
            at += 4 * n
        self.finals, self.labels = at, at + states

    def get(self, word: bytes) -> list[int] | None:
        state, number = self.root, 0
        for b in word:
            base = self.labels
            k = self.map.find(bytes((b,)), base + self.starts[state], base + self.starts[state + 1]) - base
            if k < 0:
                return None
            number += self.skips[k]
            state = self.targets[k]
        if not self.map[self.finals + state]:
            return None
        return list(self.ids[self.offsets[number]:self.offsets[number + 1]])


def normalize(text: str) -> str:
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")   # no word-final form
    return text.lower()


def word_starts(chars: Characters, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs begin, by character, and whether each is a word (and not white space).

    A word is a run of letters or of other characters, a single number, or one of
    the short forms after an apostrophe.
    """
    c, first = chars.points, chars.first
    n = len(c)
    k = classes[c]
    start = first[:n] | (k == NUMBER)
    start[1:] |= k[1:] != k[:-1]
    # fixed values: the short forms 's 't 'm 'd and 're 've 'll
    p = np.flatnonzero((c[:-1] == 39) & start[:-1] & ~first[1:n])
    one = c[p + 1]
    two = np.where((p + 2 < n) & ~first[np.minimum(p + 2, n)], c[np.minimum(p + 2, n - 1)], 0)
    short = np.isin(one, [ord(x) for x in "stmd"])
    long = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    start[p[short | long] + 1] = False
    after = np.concatenate((p[short] + 2, p[long] + 3))
    start[after[after < n]] = True
    at = np.flatnonzero(start)
    return at, k[at] != SPACE


class Codec:
    """Encodes texts with the lexicon, and with the exact merges beyond it."""

    def __init__(self, spec: dict, compiled: bytes, classes: bytes | None = None):
        self.merger = Merger(spec)
        self.lexicon = Lexicon(compiled)
        self.kept: dict[bytes, list[int]] = {}
        self.classes = np.frombuffer(classes or char_classes(), np.uint8)
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.merger.added, key=len, reverse=True))) + ")")

    def word(self, word: bytes) -> list[int]:
        ids = self.kept.get(word)
        if ids is None:
            ids = self.lexicon.get(word)
            if ids is None:
                ids = self.merger.encode(word)
            if len(word) <= MAX_KEPT_WORD:
                if len(self.kept) >= KEPT:
                    self.kept.clear()
                self.kept[word] = ids
        return ids

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of normalized texts side by side, and the place where each text's ids begin (and the end)."""
        chars = Characters(texts)
        if not len(chars.points):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        starts, is_word = word_starts(chars, self.classes)
        places = chars.byte_places()[np.concatenate((starts, [len(chars.points)]))]
        pieces = slices(chars.bytes, places).filter(pa.array(is_word)).dictionary_encode()
        ids, at = expand([self.word(w) for w in pieces.dictionary.to_pylist()], pieces.indices.to_numpy())
        return ids, at[np.searchsorted(starts[is_word], chars.bounds)]

    def encode_many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of raw texts side by side, and the place where each text's ids begin (and the end)."""
        parts, begins, added = [], [], []
        for text in texts:
            begins.append(len(parts))
            for i, part in enumerate(self.special.split(text) if "<|" in text else (text,)):
                if i % 2:
                    added.append((len(parts), self.merger.added[part]))
                parts.append("" if i % 2 else normalize(part))
        ids, at = self.words(parts)
        if added:
            where = np.array([i for i, _ in added])
            ids = np.insert(ids, at[where], [t for _, t in added]).astype(np.uint32)
            at = at + np.concatenate(([0], np.cumsum(np.bincount(where, minlength=len(parts)))))
        return ids, at[[*begins, len(parts)]]

    def decode_many(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The tokens' texts, a blank after each, side by side, and the place of each (and the end)."""
        if not len(ids):
            return b"", np.zeros(1, np.int64)
        got = self.merger.column.take(pa.array(ids.astype(np.int64)))
        places = np.frombuffer(got.buffers()[1], np.int32, len(ids) + 1).astype(np.int64)
        return got.buffers()[2].to_pybytes()[:places[-1]], places

    def encode(self, text: str) -> tuple[bytes, str]:
        """The ids as little-endian unsigned 32-bit integers, and the text they decode to."""
        ids, _ = self.encode_many([text])
        return ids.astype("<u4").tobytes(), self.decode_many(ids)[0][:-1].decode()


def vocabulary_words(spec: dict) -> list[bytes]:
    """The words that are tokens of their own, in bytes."""
    byte = {c: b for b, c in enumerate(byte_chars())}
    words = (t.removesuffix(END) for t in spec["model"]["vocab"] if t.endswith(END))
    return [bytes(byte[c] for c in w) for w in words if w and all(c in byte for c in w)]


_READY: dict[str, Codec] = {}


def _ready(spec: dict, compiled: bytes, classes: bytes, key: str) -> Codec:
    """One codec a Python worker, kept between tasks."""
    if key not in _READY:
        _READY.clear()
        _READY[key] = Codec(spec, compiled, classes)
    return _READY[key]


def bpe(docs: DataFrame, path: str, full: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row; ``full`` adds ids (array) and decoded."""
    with open(path, encoding="utf-8") as f:   # a parameter of the driver, not a table
        spec = json.load(f)
    merger = Merger(spec)
    sc = docs.sparkSession.sparkContext
    # bounded by the vocabulary file
    compiled = compile_lexicon({w: merger.encode(w) for w in vocabulary_words(spec)})
    sent = sc.broadcast((spec, compiled, char_classes()))
    key = hashlib.sha256(compiled + path.encode()).hexdigest()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _ready(*sent.value, key)
        for batch in batches:
            at = 0
            for texts in blocks(batch.column(1).to_pylist(), 4 * BLOCK):
                ids, bounds = codec.encode_many(texts)
                text, places = codec.decode_many(ids)
                raw = ids.astype("<u4").tobytes()
                # without the blank after a text's last token
                decoded = [text[a:max(a, b - 1)] for a, b in zip(places[bounds], places[bounds[1:]])]
                cols = [batch.column(0).slice(at, len(texts)), pa.array(np.diff(bounds), pa.int64()),
                        pa.array([hashlib.sha256(raw[4 * a:4 * b]).hexdigest() for a, b in zip(bounds, bounds[1:])], pa.string()),
                        pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string())]
                if full:
                    cols += [pa.array([ids[a:b].astype(np.int32) for a, b in zip(bounds, bounds[1:])], pa.list_(pa.int32())),
                             pa.array([d.decode() for d in decoded], pa.string())]
                at += len(texts)
                yield pa.RecordBatch.from_arrays(cols, names=names)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (
        ", ids array<int>, decoded string" if full else "")
    names = [c.strip().split(" ")[0] for c in schema.split(", ")]
    return docs.select("doc_id", text_of(docs).alias("text")).mapInArrow(encode, schema)


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op7_bpe(spark, sf_dir: str) -> DataFrame:
    """Contract digest over all ``documents``."""
    return bpe(table(spark, sf_dir, "documents"), tokenizer_path())
