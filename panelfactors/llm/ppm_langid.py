"""Language identification by prediction by partial matching (PPM).

Each language has a byte context tree of order ``ORDER``: how often each byte
followed each context of 0 to ORDER bytes in its training texts.  A byte seen n
times after a context with N occurrences and d different followers costs
``-log2(n / (N + d))`` bits; an unseen one costs the escape ``-log2(d / (N + d))``
plus its cost after the context one byte shorter, down to the uniform 8 bits
(escape method C, without exclusions).  The statistics are frozen, so the cost
of every byte after every context is a table, and a text's code length is a sum
of look-ups.  The language with the shortest code wins (ties: the first by
name); ``score`` is its share of the posterior with equal priors.

Training uses at most ``TRAIN_DOCS`` documents a language, those of the least
crc32 of their id among the documents that are not held out (crc32 mod 4 is not
2) and have a language: a bounded, documented sample.  Their counts are
summed in Spark and sent to the tasks, where the tables are built.  No context
is dropped: beyond the ``MAX_CONTEXTS`` most frequent of ORDER bytes a language,
only the bytes seen are stored, not a row of 256; the table from 3 bytes to a
context (64 MB) is one for all languages.  Prediction covers every document and reads only the text.

NULL text, or one without a letter: ``und`` with score 0.  NULL doc_id: not held
out, and not used in training.  Without training data everything is ``und``.
Rows are independent, repeated rows repeat their result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table

ORDER, TRAIN_DOCS, MAX_CONTEXTS, BLOCK = 3, 400, 8_000, 1 << 20


SHIFTS = (22, 12)   # the sample's cut is sought among 1024 ranges of the crc, then among 1024 of one


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def training_grams(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """(lang, gram, n): the counts of ORDER + 1 bytes in a row in the training sample, packed big-endian."""
    usable = (docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("lang").isNotNull())
              .select("doc_id", "lang", F.crc32(F.col("doc_id").cast("string")).alias("crc")))
    # histograms of the crc per language, the second of the bin that holds the cut: only rows up to it are ranked.
    # A cut is one row a language, as bounded as the models that are sent to the tasks.
    inside, above = usable.select("*", F.lit(0).alias("last"), F.lit(0).alias("done")), 32    # done: rows before the bin
    for shift in SHIFTS:
        earlier = F.coalesce(F.sum("n").over(Window.partitionBy("lang").orderBy("bin").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0))
        cut = (inside.where(F.shiftright("crc", above) == F.col("last"))
               .groupBy("lang", "done", F.shiftright("crc", shift).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
               .withColumn("done", F.col("done") + earlier).where(F.col("done") < train_docs)
               .groupBy("lang").agg(F.max("bin").alias("last"), F.max("done").alias("done")))
        inside, above = usable.join(F.broadcast(cut), "lang"), shift
    near = (inside.where(F.shiftright("crc", above) <= F.col("last")).groupBy("lang", "crc", "doc_id")
            .agg(F.count(F.lit(1)).alias("n")))      # a repeated id is one row here, and counts as often as it occurs
    before = F.coalesce(F.sum("n").over(Window.partitionBy("lang").orderBy("crc", "doc_id").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    ids = (near.withColumn("before", before).where(F.col("before") < train_docs)
           .select(F.col("doc_id").alias("t_id"), F.col("lang").alias("t_lang")))
    texts = docs.join(F.broadcast(ids),   # at most train_docs ids a language
                      (F.col("doc_id") == F.col("t_id")) & (F.col("lang") == F.col("t_lang"))).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                gram, n = np.unique(grams(np.frombuffer((text or "").encode(), np.uint8)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram.astype(np.int64)),
                                                  pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])
    return (texts.mapInArrow(count, "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def grams(data: np.ndarray) -> np.ndarray:
    """Each byte with the ORDER bytes before it (blanks before the start), packed big-endian."""
    padded = np.concatenate([np.full(ORDER, 32, np.uint8), data]).astype(np.uint32)
    out = np.zeros(len(data), np.uint32)
    for i in range(ORDER + 1):
        out = (out << np.uint32(8)) | padded[i:i + len(data)]
    return out


class Model:
    """Cost tables of one language.

    ``bits[row, byte]`` is the exact code length of a byte in a row's context.
    ``top`` are the counted contexts of ORDER bytes, in order, and ``top_row``
    their rows; ``low`` has the row of the longest counted suffix for each value
    of ORDER - 1 bytes.  A negative row is ``-1 - i`` of a rarer context of ORDER
    bytes: ``rare_*`` hold its escape, the row of its suffix and, by gram, the
    bytes seen.
    """

    def __init__(self, gram: np.ndarray, n: np.ndarray):
        bits = np.full((1, 256), 8.0)                     # order -1: uniform
        parent_row = np.zeros(1, np.int64)                # row of each context of the order below
        for order in range(ORDER + 1):
            ctx_of = (gram >> 8) & ((1 << (8 * order)) - 1)
            ctx, row = np.unique(ctx_of, return_inverse=True)
            total = np.bincount(row, n)
            if order == ORDER:
                keep = np.sort(np.argsort(-total, kind="stable")[:MAX_CONTEXTS])
                where = np.full(len(ctx), -1)
                where[keep] = np.arange(len(keep))
                used = where[row] >= 0
                rare = np.flatnonzero(where < 0)
                d = np.bincount(row, minlength=len(ctx))        # a gram of ORDER + 1 bytes is there once
                by = np.flatnonzero(~used)[np.argsort(gram[~used])]
                self.rare_gram = gram[by]
                self.rare_bits = -np.log2(n[by] / (total[row[by]] + d[row[by]]))
                self.rare_escape = -np.log2(d[rare] / (total[rare] + d[rare]))
                self.rare_up = parent_row[ctx[rare] & ((1 << (8 * (order - 1))) - 1)].astype(np.int64)
                self.low, self.top = parent_row.astype(np.int32), ctx.astype(np.int64)
                self.top_row = np.where(where >= 0, len(bits) + where, 0).astype(np.int32)
                self.top_row[rare] = -1 - np.arange(len(rare))
                ctx, rows, sym, cnt = ctx[keep], where[row[used]], gram[used] & 255, n[used]
            else:                                               # at most 65,536 contexts
                rows, sym, cnt = row, gram & 255, n
            counts = np.zeros((len(ctx), 256))
            np.add.at(counts, (rows, sym), cnt)
            seen = counts > 0
            d, all_n = seen.sum(1, keepdims=True), counts.sum(1, keepdims=True)
            up = parent_row[ctx & ((1 << (8 * max(order - 1, 0))) - 1)] if order else np.zeros(len(ctx), np.int64)
            own = np.where(seen, -np.log2(np.maximum(counts, 1) / (all_n + d)), -np.log2(d / (all_n + d)) + bits[up])
            if order < ORDER:
                here = np.tile(parent_row.astype(np.int32), 256) if order else np.zeros(1, np.int32)   # not there: its suffix's row
                here[ctx] = len(bits) + np.arange(len(ctx))
                parent_row = here
            bits = np.concatenate([bits, own])
        self.bits = bits.astype(np.float32).ravel()

    def rows_of(self, contexts: np.ndarray) -> np.ndarray:
        """Row of each context of ORDER bytes."""
        suffix = self.low[contexts & ((1 << (8 * (ORDER - 1))) - 1)]
        if not len(self.top):
            return suffix
        at = np.minimum(np.searchsorted(self.top, contexts), len(self.top) - 1)
        return np.where(self.top[at] == contexts, self.top_row[at], suffix)

    def number(self, tops: np.ndarray) -> None:
        """Rows by the numbers of :func:`context_numbers` over ``tops``."""
        self.row = np.concatenate([self.rows_of(tops), self.low])

    def cost(self, gram: np.ndarray, number: np.ndarray | None = None) -> np.ndarray:
        """Code length of each byte; ``number``: that of its context, where the models have been numbered."""
        row = self.rows_of((gram >> np.uint32(8)).astype(np.int64)) if number is None else self.row[number]
        row, byte = row.astype(np.int64), gram & np.uint32(255)
        if not len(self.rare_gram):
            return self.bits[row * 256 + byte]
        out = self.bits[np.maximum(row, 0) * 256 + byte]
        at = np.flatnonzero(row < 0)
        i = -1 - row[at]
        j = np.minimum(np.searchsorted(self.rare_gram, gram[at]), len(self.rare_gram) - 1)
        out[at] = np.where(self.rare_gram[j] == gram[at], self.rare_bits[j],
                           self.rare_escape[i] + self.bits[self.rare_up[i] * 256 + byte[at]])
        return out


def context_numbers(tops: np.ndarray) -> np.ndarray:
    """One table for all languages: a value of ORDER bytes -> its place in ``tops``, or len(tops) + its last ORDER - 1 bytes."""
    low = 1 << (8 * (ORDER - 1))
    out = np.tile(np.arange(len(tops), len(tops) + low, dtype=np.int32), 256)
    out[tops] = np.arange(len(tops), dtype=np.int32)
    return out


def models_of(grams_by_lang: dict[str, tuple[np.ndarray, np.ndarray]]) -> tuple[dict[str, Model], np.ndarray]:
    """The models by language, and the numbers of their contexts."""
    models = {lang: Model(g, n) for lang, (g, n) in grams_by_lang.items()}
    tops = np.unique(np.concatenate([np.empty(0, np.int64), *(m.top for m in models.values())]))
    for m in models.values():
        m.number(tops)
    return models, context_numbers(tops)


def predict(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, held_out, lang_pred, score, bits (code length of the winner) of every row."""
    rows = training_grams(docs, train_docs).collect()   # bounded by the training sample
    by_lang: dict[str, tuple[list, list]] = {}
    for r in rows:
        by_lang.setdefault(r.lang, ([], []))[0].append(r.gram)
        by_lang[r.lang][1].append(r.n)
    sent = docs.sparkSession.sparkContext.broadcast(
        {lang: (np.array(g, np.int64), np.array(n, np.int64)) for lang, (g, n) in sorted(by_lang.items())})

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, numbers = models_of(sent.value)
        names = list(models)
        for batch in batches:
            raw = [t.encode() if ok else b"" for t, ok in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            bits = np.zeros((len(raw), len(names)))
            for i, data in enumerate(raw):
                codes = None
                for at in range(0, len(data), BLOCK):     # a very long text in blocks, with the context before each
                    block = np.frombuffer(data, np.uint8, min(BLOCK, len(data) - at), at)
                    codes = grams(block)
                    if at:
                        codes = grams(np.frombuffer(data, np.uint8, len(block) + ORDER, at - ORDER))[ORDER:]
                    number = numbers[codes >> np.uint32(8)]
                    for j, name in enumerate(names):
                        bits[i, j] += models[name].cost(codes, number).sum(dtype=np.float64)
            best = bits.argmin(1) if names else np.zeros(len(raw), int)
            least = bits.min(1, keepdims=True) if names else np.zeros((len(raw), 1))
            share = 1 / np.exp2(np.maximum(least - bits, -1000)).sum(1) if names else np.zeros(len(raw))
            known = [bool(d) and bool(names) for d in raw]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1),
                pa.array([names[b] if k else "und" for b, k in zip(best, known)], pa.string()),
                pa.array([float(s) if k else 0.0 for s, k in zip(share, known)], pa.float64()),
                pa.array([float(x) for x in least[:, 0]], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score", "bits"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters")).mapInArrow(
        score, f"doc_id {id_type}, held_out boolean, lang_pred string, score double, bits double")


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    """Contract digest over all ``documents``."""
    return predict(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
