"""Texts of a batch as numpy and Arrow columns: characters, pieces, distinct pieces, their ids.

Shared by the tokenizer operators.  A batch is cut into blocks of whole texts,
so that memory is bounded by ``BLOCK`` characters or the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex

#: characters of a block; a longer text is a block of its own
BLOCK = 1 << 20
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: fixed values: the code points with the White_Space property
WHITE = (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


def char_classes() -> bytes:
    """The class of each code point: one byte for each, 1.1 MB."""
    chars = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    out = np.zeros(0x110000, np.uint8)
    for kind, p in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}")):
        out[np.frombuffer("".join(regex.findall(p, chars)).encode("utf-32-le"), np.uint32)] = kind
    out[list(WHITE)] = SPACE
    return out.tobytes()


def blocks(texts: list[str], limit: int = BLOCK) -> Iterator[list[str]]:
    """``texts`` in order, in lists of at most ``limit`` characters (or one longer text)."""
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > limit:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


class Characters:
    """Code points of several texts side by side, with the place where each text begins."""

    def __init__(self, texts: list[str]):
        whole = "".join(texts)
        self.bytes = whole.encode()
        self.points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        #: first character of each text, and the number of all characters
        self.bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))
        self.first = np.zeros(len(self.points) + 1, bool)
        self.first[self.bounds] = True

    def byte_places(self) -> np.ndarray:
        """Byte offset of each character, and of the end."""
        c = self.points
        size = 1 + (c >= 0x80).astype(np.int32) + (c >= 0x800) + (c >= 0x10000)
        return np.concatenate(([0], np.cumsum(size, dtype=np.int64)))


def slices(data: bytes, offsets: np.ndarray) -> pa.Array:
    """The binary column whose value i is ``data[offsets[i]:offsets[i + 1]]``, without a copy."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1,
                                 [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def expand(values: list[list[int]], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists of all codes in order as one array, and the place where each code's list begins (and the end)."""
    sizes = np.fromiter(map(len, values), np.int64, len(values))
    flat = np.fromiter((i for v in values for i in v), np.uint32, int(sizes.sum()))
    begins = np.cumsum(sizes) - sizes
    n = sizes[codes]
    ends = np.cumsum(n)
    at = np.repeat(begins[codes] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
    return flat[at], np.concatenate(([0], ends))
