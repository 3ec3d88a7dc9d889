"""Hard-negative mining with Kronecker-packed products.

Anchors (rows whose id is divisible by ``EVERY``) are scored against all rows
by exact integer inner products of their vectors, whose components become
floor(256 * x).  Candidates are packed: the component of several candidates,
biased to be non-negative, are put in separated fields of one wide integer, so
one multiplication by an anchor's component serves all of them.  Sums stay in
their fields, as the field width comes from the vectors' own bounds, and the
exact scores are unpacked.  Words of up to 53 bits are held as doubles (integers
up to 2^53 are exact in them), so a block of anchors is one matrix product;
where one field needs more, words are Python integers of any width.

Rows are dealt into chunks of bounded size by a hash of the row number, a task each.  Every
chunk meets all anchors (a stated query set against all rows, in blocks); a task
holds one chunk and streams the anchors past it.  The first sweep keeps, per
chunk, each anchor's best rows of its own label, the second the best rows of
other labels inside each positive's score band.  Nothing is broadcast or
collected, no group by label or id exists, so neither can be hot.

Rows with a NULL label, a NULL vector, or any NULL or non-finite component take
no part.  Rows are told apart by position, not id: with repeated ids each row
counts.  A NULL id is no anchor and orders last in ties.  Vectors of unequal
length: the shorter counts as filled with zeros.  Scores beyond 64 bits count
as the nearest 64-bit number.  An empty table, or one without anchors, gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table, written

EVERY, POSITIVES, NEGATIVES = 50, 5, 3
#: bytes of a chunk's components (as doubles), and anchors multiplied at once
CHUNK_BYTES, ANCHORS = 64 << 20, 128
WORD = 53   # bits of an integer that a double holds exactly
FIELDS = 8  # candidates in a Python integer
TOP = 2**63 - 1


def quantized(x: np.ndarray) -> np.ndarray:
    """floor(256 * x) of finite doubles; Python integers where doubles would not hold their products."""
    if not x.size or np.abs(x).max() < 2.0**40:
        return np.floor(256.0 * x)
    out = np.empty(x.shape, object)
    out[...] = [[int(v) * 256 if abs(v) >= 2.0**53 else int(np.floor(256.0 * v)) for v in row] for row in x]
    return out


class Packed:
    """Candidates, one a row of ``q``, packed for products with many anchors."""

    def __init__(self, q: np.ndarray):
        self.q, self.n = q, len(q)
        self.bias = int(abs(q).max()) if q.size else 0
        self.words: dict[int, np.ndarray] = {}

    def pack(self, fields: int, width: int, kind: type) -> np.ndarray:
        """Components by words: word t holds candidates t, t + m, t + 2m ... in fields of ``width`` bits."""
        m = -(-self.n // fields)
        out = np.zeros((self.q.shape[1], m), kind)
        for j in range(fields):
            part = as_kind(self.q[j * m:(j + 1) * m].T, kind)
            out[:, :part.shape[1]] += (part + self.bias) * kind_power(kind, width * j)
        return out

    def scores(self, a: np.ndarray) -> np.ndarray:
        """Exact inner products of the anchors (rows of ``a``) with all candidates, held to 64 bits."""
        if not self.n or not a.size:
            return np.zeros((len(a), self.n), np.int64)
        # a biased sum lies within this, in either sign
        most = 2 * self.bias * max(int(s) for s in abs(a).sum(axis=1))
        need = most.bit_length() + 1
        if need <= WORD and a.dtype != object and self.q.dtype != object:
            fields, kind = WORD // need, np.float64
            width = WORD // fields
        else:
            fields, width, kind = FIELDS, need + 1, object   # a double's sum may have been rounded
        key = fields if kind is np.float64 else -width
        if key not in self.words:
            self.words[key] = self.pack(fields, width, kind)
        m = self.words[key].shape[1]
        a = as_kind(a, kind)
        products, base = a @ self.words[key], self.bias * a.sum(axis=1)
        if kind is np.float64:
            products, base = products.astype(np.int64), base.astype(np.int64)
        out = np.empty((len(a), fields * m), kind if kind is object else np.int64)
        half = 1 << (width - 1)
        for j in range(fields):
            low = ((products + half) & (2 * half - 1)) - half
            out[:, j * m:(j + 1) * m] = low - base[:, None]
            products = (products - low) >> width
        return np.clip(out[:, :self.n], -TOP, TOP).astype(np.int64)


def kind_power(kind: type, bits: int):
    return kind(2.0**bits) if kind is np.float64 else 1 << bits


def as_kind(x: np.ndarray, kind: type) -> np.ndarray:
    """Whole numbers as doubles, or as Python integers."""
    if kind is np.float64 or x.dtype == object:
        return x
    out = np.empty(x.shape, object)
    out[...] = [[int(v) for v in row] for row in x]
    return out


def best(scores: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """The ``places`` of the ``k`` highest scores, equal ones in the order of their places."""
    s = scores[places]
    if len(s) > k:
        near = s >= np.partition(s, len(s) - k)[len(s) - k]
        places, s = places[near], s[near]
    return places[np.argsort(-s, kind="stable")[:k]]


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows, filled with zeros up to ``width``."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


class Chunk:
    """Candidates of one chunk in the order of their ids."""

    def __init__(self, rows: pa.Table, width: int):
        rows = rows.combine_chunks().sort_by([("vec_id", "ascending"), ("row", "ascending")])   # NULL ids come last
        self.ids = rows.column("vec_id").combine_chunks()
        self.label = rows.column("label").to_numpy()
        self.places = {r: i for i, r in enumerate(rows.column("row").to_pylist())}
        kinds, of = np.unique(self.label, return_inverse=True)
        self.same = {int(v): np.flatnonzero(of == i) for i, v in enumerate(kinds)}
        self.packed = Packed(quantized(matrix(rows.column("embedding").combine_chunks(), width)))

    def positives(self, row: int, label: int, scores: np.ndarray) -> np.ndarray:
        places = self.same.get(label, np.zeros(0, np.int64))
        if row in self.places:
            places = places[places != self.places[row]]
        return best(scores, places, POSITIVES)

    def negatives(self, label: int, scores: np.ndarray, positive: int) -> np.ndarray:
        low, high = -(-positive // 2), 19 * positive // 20   # 50p <= 100n <= 95p
        if low > high:
            return np.zeros(0, np.int64)
        return best(scores, np.flatnonzero((scores >= low) & (scores <= high) & (self.label != label)), NEGATIVES)


def sweep(vectors: DataFrame, anchors: DataFrame, chunks: int, width: int) -> DataFrame:
    """anchor, of, score, vec_id: from every chunk the best rows for each anchor.

    Without a column ``scores`` in ``anchors``, those of the anchor's label (of: 0);
    with it, for the i-th of these positive scores (of: i, from 1) those of other
    labels in its band.
    """
    second = "scores" in anchors.columns
    cols = ["row", "vec_id", "label", "embedding"]
    none = F.lit(None).cast("array<bigint>")
    rows = vectors.select(F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int").alias("chunk"), F.lit(0).alias("part"), *cols,
                          none.alias("scores"))
    every = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), F.lit(1).alias("part"), *cols,
                           anchors["scores"] if second else none.alias("scores"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, chunk = None, [], None
        for batch in batches:
            key = batch.column(0).to_numpy().astype(np.int64) * 2 + batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)] if len(key) else []
            for a, b in zip(cuts, cuts[1:]):
                part = batch.slice(a, b - a)
                if key[a] != at:
                    if key[a] % 2 == 0:
                        held, chunk = [], None
                    elif at is None or key[a] != at + 1:
                        held, chunk = [], None      # anchors of a chunk without rows
                    at = key[a]
                if key[a] % 2 == 0:
                    held.append(part)
                elif held or chunk:
                    if chunk is None:
                        chunk, held = Chunk(pa.Table.from_batches(held), width), []
                    for i in range(0, len(part), ANCHORS):
                        yield from answer(chunk, part.slice(i, ANCHORS))

    def answer(chunk: Chunk, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        scores = chunk.packed.scores(quantized(matrix(part.column(5), width)))
        out: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        wanted = part.column(6).to_pylist() if second else [None] * len(part)
        for row, label, s, positive in zip(part.column(2).to_pylist(), part.column(4).to_pylist(), scores, wanted):
            if not second:
                found = chunk.positives(row, label, s)
                out.append((row, 0, found, s[found]))
            else:
                for i, p in enumerate(positive):
                    found = chunk.negatives(label, s, p)
                    out.append((row, i + 1, found, s[found]))
        n = [len(f) for _, _, f, _ in out]
        if sum(n):
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat([r for r, _, _, _ in out], n), pa.int64()),
                pa.array(np.repeat([i for _, i, _, _ in out], n), pa.int32()),
                pa.array(np.concatenate([s for _, _, _, s in out]), pa.int64()),
                chunk.ids.take(pa.array(np.concatenate([f for _, _, f, _ in out])))], names=["anchor", "of", "score", "vec_id"])

    dealt = rows.unionByName(every).repartitionById(chunks, F.col("chunk")).sortWithinPartitions("chunk", "part")
    return dealt.mapInArrow(run, "anchor long, of int, score long, vec_id long")


def first(found: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of each anchor and ``of`` by score, then id, with their rank."""
    order = Window.partitionBy("anchor", "of").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def usable(embeddings: DataFrame, label: Column) -> DataFrame:
    """row, vec_id, label, embedding of the rows that take part."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (embeddings.where(F.col("label").isNotNull() & F.col("embedding").isNotNull())
            .where(F.coalesce(fine, F.lit(False)))
            .select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
                    label.alias("label"), F.col("embedding").cast("array<double>").alias("embedding")))


def mine(embeddings: DataFrame, label: Column | None = None, every: int = EVERY) -> DataFrame:
    """anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score.

    ``label``: the label to mine by (default: the column).  Anchors are the rows
    whose id is divisible by ``every``.
    """
    spark = embeddings.sparkSession
    label = (F.col("label") if label is None else label).cast("long")
    v = written(spark, usable(embeddings, label).where(F.col("label").isNotNull()), "negatives-rows")
    n, width = v.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    width = width or 0
    chunks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n * 8 * width // CHUNK_BYTES))
    anchors = v.where(F.col("vec_id") % every == 0)

    top = written(spark, first(sweep(v, anchors, chunks, width), POSITIVES), "negatives-positives")
    lists = top.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("found"))
    asked = anchors.join(lists.select(F.col("anchor").alias("row"), F.col("found.score").alias("scores")), "row")
    negatives = first(sweep(v, asked, chunks, width), NEGATIVES)

    positives = top.select("anchor", F.col("rank").alias("of"), F.col("vec_id").alias("positive_id"),
                           F.col("score").alias("positive_score"))
    ids = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (negatives.join(positives, ["anchor", "of"]).join(ids, "anchor")
            .select("anchor_id", "positive_id", F.col("of").alias("positive_rank"), "rank", F.col("vec_id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Contract rows of all ``embeddings``."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return mine(table(spark, sf_dir, "embeddings"), moved).drop("positive_rank")


SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same,
           list_inner_product(a.q, c.q)::BIGINT AS score
    FROM v a JOIN v c ON a.vec_id % 50 = 0 AND c.vec_id <> a.vec_id),
p AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score
    FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
     AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
