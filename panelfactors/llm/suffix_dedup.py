"""Exact substring dedup with the common-prefix interval tree of an enhanced suffix array.

Every byte covered by a ``LENGTH``-byte string that also starts earlier (in a
document of a smaller id, or earlier in the same document) is removed.

Equal whole texts are settled first: only the first document of each takes part
(a later copy of at least LENGTH bytes is removed whole).

The suffix array is sparse and distributed: suffixes start at anchors, the
GRAM-byte strings whose hash is the least in some window of LENGTH bytes
(winnowing, all ties).  Every LENGTH-byte string holds an anchor, equal strings
hold the same one, so all occurrences of a string meet at its anchor's hash.
Anchors that occur once go; the others get the bytes around them (LENGTH - GRAM
to the left, LENGTH to the right), and are sorted by hash and right context in
the tasks.  A stack scan over the common prefixes of neighbours lists the
intervals of the tree: sets of occurrences with a common right extension.  In
each, the occurrences are split by their left extensions, down to the least
length that still makes a repeat: that gives the maximal repeats with all their
occurrences, and all but the first occurrence of each are removed.

An anchor with more than ``HOT`` occurrences is not sorted in one task: its
windows are hashed (128 bits), and the first occurrence of each is found by an
aggregation that combines before it shuffles.

NULL text is empty.  Documents are ordered by id (NULL last), then by the key
of the row; repeated rows are one document and share their result.  Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import row_key, table, text_of, written

LENGTH, GRAM, HOT = 100, 32, 50_000
LEFT = LENGTH - GRAM
LAST_ID = 2 ** 63 - 1
CHUNK = 200_000      # occurrences sorted together in a task; a hash is never cut (HOT at most beyond)


def _slide(x: np.ndarray, width: int, op) -> np.ndarray:
    """op (minimum or maximum) of every ``width`` neighbours, by doubling."""
    done = 1
    out = x
    while 2 * done <= width:
        out, done = op(out[:-done], out[done:]), 2 * done
    return op(out[:len(out) - (width - done)], out[width - done:]) if done < width else out


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of one text: least hash of some window, all ties."""
    if len(data) < LENGTH:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h, step = data.astype(np.uint64) + np.uint64(1), 1
    for odd in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F):
        h = h[:-step] * np.uint64(odd) + (h[step:] ^ (h[step:] >> np.uint64(29)))   # GRAM = 2 ** 5 bytes
        step *= 2
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xE7037ED1A0B428DB)
    h ^= h >> np.uint64(29)
    least = _slide(h, LEFT + 1, np.minimum)             # of each window's grams
    pad = np.zeros(LEFT, np.uint64)
    best = _slide(np.concatenate([pad, least, pad]), LEFT + 1, np.maximum)   # of the windows each gram is in
    at = np.flatnonzero(best == h)
    return at, h[at]


def find_anchors(first: DataFrame) -> DataFrame:
    """(h, o1, o2, pos) of the anchors of all first documents (o1, o2, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for o1, o2, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                at, h = anchors(np.frombuffer(text.encode(), np.uint8))
                parts.append((h.view(np.int64), np.full(len(at), o1, np.int64), np.full(len(at), o2, np.int32), at.astype(np.int32)))
            if parts:
                cols = [pa.array(np.concatenate(x)) for x in zip(*parts)]
                yield pa.RecordBatch.from_arrays(cols, names=["h", "o1", "o2", "pos"])
    return first.select("o1", "o2", "text").mapInArrow(run, "h long, o1 long, o2 int, pos int")


def repeated(found: DataFrame) -> DataFrame:
    """The anchors whose hash occurs more than once, by a pass over each task's sorted hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, same = None, False      # the last row so far, and whether it equals the one before it
        for batch in batches:
            if not len(batch):
                continue
            both = pa.Table.from_batches([held, batch] if held is not None else [batch]).combine_chunks()
            h = both.column("h").to_numpy()
            equal = np.zeros(len(h) + 1, bool)
            equal[1:-1] = h[1:] == h[:-1]
            equal[0] = same
            keep = equal[:-1] | equal[1:]
            yield from both.slice(0, len(h) - 1).filter(pa.array(keep[:-1])).to_batches()
            held, same = both.slice(len(h) - 1).to_batches()[0], bool(equal[len(h) - 1])
        if held is not None and same:
            yield held
    return found.repartition("h").sortWithinPartitions("h").mapInArrow(run, found.schema)


def contexts(texts: DataFrame) -> DataFrame:
    """(h, o1, o2, pos, left, ctx) of the repeated anchors ``at`` of each document (o1, o2, text, at)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {k: [] for k in ("h", "o1", "o2", "pos", "left", "ctx")}
            for o1, o2, text, at in zip(*(batch.column(i).to_pylist() for i in range(4))):
                data = text.encode()
                for a in at:
                    p = a["pos"]
                    left = min(p, LEFT)
                    rows["h"].append(a["h"])
                    rows["o1"].append(o1)
                    rows["o2"].append(o2)
                    rows["pos"].append(p)
                    rows["left"].append(left)
                    rows["ctx"].append(data[p - left:p + LENGTH])
                if len(rows["h"]) > 20_000:
                    yield pa.RecordBatch.from_pydict(rows, schema=schema)
                    rows = {k: [] for k in rows}
            yield pa.RecordBatch.from_pydict(rows, schema=schema)
    schema = pa.schema([("h", pa.int64()), ("o1", pa.int64()), ("o2", pa.int32()), ("pos", pa.int32()), ("left", pa.int32()),
                        ("ctx", pa.binary())])
    return texts.mapInArrow(run, "h long, o1 long, o2 int, pos int, left int, ctx binary")


def _matrix(rows: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of bytes, zero-padded to a multiple of 8, and their lengths."""
    pad = -(-width // 8) * 8
    return (np.frombuffer(b"".join([r.ljust(pad, b"\0") for r in rows]), np.uint8).reshape(-1, pad),
            np.fromiter(map(len, rows), np.int64, len(rows)))


def _order(m: np.ndarray, n: np.ndarray, first: np.ndarray | None = None) -> np.ndarray:
    """Lexicographic order of the rows (after ``first``), shorter before longer."""
    words = np.ascontiguousarray(m).view(">u8").astype(np.uint64)
    keys = [n, *(words[:, i] for i in range(words.shape[1] - 1, -1, -1))]
    return np.lexsort(keys + [first] if first is not None else keys)


def _common(m: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Common prefix of each row with the one before it (0 for the first)."""
    out = np.zeros(len(m), np.int64)
    if len(m) > 1:
        differ = m[1:] != m[:-1]
        lcp = np.where(differ.any(1), differ.argmax(1), m.shape[1])
        out[1:] = np.minimum(lcp, np.minimum(n[1:], n[:-1]))
    return out


def intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """The interval tree by one stack scan: (from, to exclusive, common prefix) with at least GRAM in common."""
    stack: list[tuple[int, int]] = []       # (start, common prefix) of the open intervals, prefixes ascending
    for i, c in enumerate([*lcp[1:], 0], 1):
        start = i - 1
        while stack and stack[-1][1] > c:
            start, value = stack.pop()
            yield start, i, value
        if c >= GRAM and (not stack or stack[-1][1] < c):
            stack.append((start, c))


def repeats(h: np.ndarray, order: np.ndarray, pos: np.ndarray, left: np.ndarray, ctx: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Removed span (from, to) of each occurrence, empty where to = 0; ``order``: the rank of the occurrence.

    All repeats of an occurrence hold its anchor, so their union is one span.
    """
    right, right_n = _matrix([c[k:] for c, k in zip(ctx, left.tolist())], LENGTH)
    back, back_n = _matrix([c[:k][::-1] for c, k in zip(ctx, left.tolist())], LEFT)
    by = _order(right, right_n, h)
    right, right_n, back, back_n, rank = right[by], right_n[by], back[by], back_n[by], order[by]
    lcp = _common(right, right_n)
    lcp[1:][h[by][1:] != h[by][:-1]] = 0
    reach_left, reach_right = np.zeros(len(by), np.int64), np.zeros(len(by), np.int64)
    pairs = []
    for lo, hi, value in intervals(lcp.tolist()):
        if hi - lo == 2:
            pairs.append((lo, value))
            continue
        least = LENGTH - value                # left extension that makes a repeat
        who = lo + np.flatnonzero(back_n[lo:hi] >= least)
        if len(who) < 2:
            continue
        who = who[_order(back[who], back_n[who])]
        near = _common(back[who], back_n[who])
        near[0] = -1
        # left-extension diversity: each common left extension that occurs is a maximal repeat
        for extent in np.unique(near[1:][near[1:] >= least]):
            border = np.flatnonzero(near < extent)
            firsts = np.minimum.reduceat(rank[who], border)
            later = rank[who] != np.repeat(firsts, np.diff(np.append(border, len(who))))
            hit = who[later]
            reach_left[hit] = np.maximum(reach_left[hit], extent)
            reach_right[hit] = np.maximum(reach_right[hit], value)
    if pairs:
        at, value = np.array(pairs).T
        differ = back[at] != back[at + 1]
        extent = np.minimum(np.where(differ.any(1), differ.argmax(1), back.shape[1]), np.minimum(back_n[at], back_n[at + 1]))
        ok = extent + value >= LENGTH
        hit = np.where(rank[at] > rank[at + 1], at, at + 1)[ok]
        reach_left[hit] = np.maximum(reach_left[hit], extent[ok])
        reach_right[hit] = np.maximum(reach_right[hit], value[ok])
    p = pos[by]
    out_from, out_to = np.zeros(len(by), np.int64), np.zeros(len(by), np.int64)
    out_from[by] = p - reach_left
    out_to[by] = np.where(reach_right > 0, p + reach_right, 0)
    return out_from, out_to


SPANS = "o1 long, o2 int, start int, end int"


def sorted_spans(ctx: DataFrame) -> DataFrame:
    """Removed spans (o1, o2, start, end) of the anchors that are sorted in the tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0

        def flush(t: pa.Table) -> pa.RecordBatch:
            col = {k: t.column(k).to_numpy() for k in ("h", "o1", "o2", "pos", "left")}
            rank = np.empty(len(t), np.int64)
            rank[np.lexsort((col["pos"], col["o2"], col["o1"]))] = np.arange(len(t))
            start, end = repeats(col["h"], rank, col["pos"].astype(np.int64), col["left"].astype(np.int64), t.column("ctx").to_pylist())
            k = end > 0
            return pa.RecordBatch.from_arrays([pa.array(col["o1"][k]), pa.array(col["o2"][k]), pa.array(start[k].astype(np.int32)),
                                               pa.array(end[k].astype(np.int32))], names=["o1", "o2", "start", "end"])
        for batch in batches:
            if rows >= CHUNK and len(batch):
                h = batch.column("h").to_numpy()
                last = held[-1].column("h")[-1].as_py()
                cut = int(np.argmax(h != last)) if (h != last).any() else len(h)
                if cut < len(h):     # the held hashes end here
                    yield flush(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                    held, rows, batch = [], 0, batch.slice(cut)
            if len(batch):
                held.append(batch)
                rows += len(batch)
        if held:
            yield flush(pa.Table.from_batches(held))
    return ctx.repartition("h").sortWithinPartitions("h").mapInArrow(run, SPANS)


def hot_spans(ctx: DataFrame) -> DataFrame:
    """Removed spans of the anchors with many occurrences: the windows around them, each kept at its first start."""
    windows = ctx.select("o1", "o2", F.explode(F.expr(
        f"""transform(filter(sequence(0, left), k -> length(ctx) - k >= {LENGTH}),
            k -> named_struct('start', pos - left + k, 'w', md5(substring(ctx, k + 1, {LENGTH}))))""")).alias("x"))
    windows = windows.select("o1", "o2", "x.start", "x.w").distinct()
    first = windows.groupBy("w").agg(F.min(F.struct("o1", "o2", "start")).alias("f"))
    return windows.join(first, "w").where("NOT (o1 = f.o1 AND o2 = f.o2 AND start = f.start)").select(
        "o1", "o2", "start", F.expr(f"CAST(start + {LENGTH} AS int)").alias("end"))


def removed_bytes(docs: DataFrame) -> DataFrame:
    """key, doc_id, n_bytes, n_removed, n_spans, kept (binary) of every row."""
    spark = docs.sparkSession
    keyed = docs.select(row_key(docs).alias("key"), text_of(docs).alias("text"))
    ids = written(spark, docs.select(
        row_key(docs).alias("key"), "doc_id", F.md5(text_of(docs)).alias("d"), F.octet_length(text_of(docs)).alias("nb"))
        .distinct(), "suffix-ids")
    ids = ids.withColumn("o1", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))).withColumn(
        "o2", F.row_number().over(Window.partitionBy("doc_id").orderBy("key")))
    first = ids.groupBy("d").agg(F.min(F.struct("o1", "o2")).alias("f"))
    ids = written(spark, ids.join(first, "d").select("key", "doc_id", "nb", "o1", "o2", F.expr(
        "o1 = f.o1 AND o2 = f.o2").alias("first")), "suffix-order")
    of = ids.where(f"first AND nb >= {LENGTH}").select("key", "o1", "o2")
    # repeated rows: one text per key
    texts = keyed.join(of, "key").dropDuplicates(["key"]).select("o1", "o2", "text")
    again = written(spark, repeated(find_anchors(texts)), "suffix-anchors")
    hot = again.groupBy("h").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > HOT).select("h", F.lit(True).alias("hot"))
    at = again.groupBy("o1", "o2").agg(F.collect_list(F.struct("h", "pos")).alias("at"))   # bounded by the text
    at = at.join(of, ["o1", "o2"]).select("key", "o1", "o2", "at")
    ctx = contexts(keyed.join(at, "key").dropDuplicates(["key"]).select("o1", "o2", "text", "at"))
    ctx = written(spark, ctx.join(hot, "h", "left"), "suffix-contexts")
    spans = sorted_spans(ctx.where("hot IS NULL").drop("hot")).unionByName(hot_spans(ctx.where("hot")))
    spans = spans.groupBy("o1", "o2").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    spans = written(spark, ids.join(spans, ["o1", "o2"], "left").select("key", "doc_id", "first", "spans"), "suffix-spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, doc_id, text, is_first, found in zip(*(batch.column(i).to_pylist() for i in range(5))):
                data = text.encode()
                runs: list[list[int]] = [] if is_first or len(data) < LENGTH else [[0, len(data)]]
                for s, e in sorted((x["start"], x["end"]) for x in found or ()):
                    if runs and s <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], e)
                    else:
                        runs.append([s, e])
                borders = [0, *(x for r in runs for x in r), len(data)]
                out.append((key, doc_id, len(data), sum(e - s for s, e in runs), len(runs),
                            b"".join([data[a:b] for a, b in zip(borders[::2], borders[1::2])])))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), schema)] if out
                                             else [pa.array([], f.type) for f in schema], schema=schema)
    schema = pa.schema([("key", pa.string()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                        ("n_spans", pa.int64()), ("kept", pa.binary())])
    rows = keyed.join(spans, "key").select("key", F.col("doc_id").cast("long").alias("doc_id"), "text", "first", "spans")
    return rows.mapInArrow(run, "key string, doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op8_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract digest over all ``documents``."""
    return removed_bytes(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
