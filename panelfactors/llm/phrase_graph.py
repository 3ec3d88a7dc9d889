"""Phrase collocations from a weighted de Bruijn graph.

Texts are cut into pieces at punctuation and line ends, pieces into words.  The
graph has an edge for every distinct 4-word phrase, weighted by its number of
occurrences, from its first three words (a node) to its last three.  Every word
occurrence yields one row only: the longest phrase, up to 4 words, that begins
there.  A shorter row is a piece-end correction.  Shorter phrases are not counted
in the text: the count of a node is its outgoing flow plus the pieces that end in
it, that of a pair is the flow of its nodes plus the pieces that end in it, and
so for single words.

Nodes whose only incoming and only outgoing edge carry all of their occurrences
are compacted: the edges on such a unary path form one passage (by pointer
doubling), whose phrases all occur as often as the passage.

Rare pairs are left out before the graph is built: a pair below the least count
can be in no phrase that counts, so a piece is cut there without a change of any
count that matters.  Pair hashes are counted exactly by Spark; the frequent ones
set bits of a table of ``GATE_BITS`` bits (4 MB, whatever the input), which the
tasks consult.  Hashes that meet by chance only keep a rare pair, which costs time
and changes no result.

Every aggregation combines in the task first (by block of texts, then by Spark),
so a word, pair or passage that holds a third of the text is one row a task.

Counts are per language (NULL: ``und``).  NULL and empty texts have no words;
repeated rows count as often as they occur; an empty table gives no rows; other
columns are ignored.  Memory is bounded by a block of twice ``columnar.BLOCK``
characters or the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .columnar import BLOCK, blocks
from .common import table, text_of, written

LEAST, TOP, WORDS = 30, 2000, 4
GATE_BITS = 1 << 25
GRAMS = "lang string, k int, phrase string, n long"


def _byte_table() -> bytes:
    """A-Z to lower case, the separators of pieces to a line feed, TAB to a blank."""
    t = bytearray(range(256))
    for c in range(65, 91):
        t[c] = c + 32
    for c in b".,;:!?\n\x0b\x0c\r":
        t[c] = 10
    t[9] = 32
    return bytes(t)


BYTES = _byte_table()
KIND = np.zeros(256, np.uint8)
KIND[32], KIND[10] = 1, 2


class Words:
    """The words of several texts of one language: codes into the distinct words, and where pieces end."""

    def __init__(self, lang: str, texts: list[str]):
        data = np.frombuffer(("\n".join(texts) + "\n").encode().translate(BYTES), np.uint8)
        kind = KIND[data]
        inside = kind == 0
        edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        starts, ends = edge[::2], edge[1::2]
        #: whether word i is the last of its piece
        self.last = np.maximum.reduceat(kind, ends) == 2 if len(ends) else np.zeros(0, bool)
        offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int32)
        words = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside].tobytes())])
        coded = words.dictionary_encode()
        self.codes, self.distinct = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        seed = xxhash.xxh64_intdigest(lang.encode())
        self.hashes = np.array([xxhash.xxh64_intdigest(w.as_buffer(), seed) for w in self.distinct], np.uint64)

    def pairs(self) -> np.ndarray:
        """A hash of each word with the next one; meaningless where a piece ends."""
        h = self.hashes[self.codes]
        x = h * np.uint64(0x9E3779B97F4A7C15) + np.concatenate((h[1:], h[:1]))   # fixed value: 2^64 / golden ratio
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)   # fixed value: an odd mixing constant
        return x ^ (x >> np.uint64(32))


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, list[str]]]:
    texts: dict[str, list[str]] = {}
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        if text:
            texts.setdefault(lang, []).append(text)
    for lang, group in texts.items():
        for part in blocks(group, 2 * BLOCK):
            yield lang, part


def _languages_and_texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"), text_of(docs).alias("text"))


def frequent_pairs(docs: DataFrame, least: int) -> DataFrame:
    """h: the hashes (64 bits, with the language) of pairs that occur ``least`` times or more."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, texts in _by_language(batch):
                w = Words(lang, texts)
                h, n = np.unique(w.pairs()[~w.last], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n, pa.int64())], names=["h", "n"])
    counted = _languages_and_texts(docs).mapInArrow(count, "h long, n long")
    return counted.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("h")


def gate(hashes: DataFrame, bits: int = GATE_BITS) -> np.ndarray:
    """A bit for each hash, in a table of fixed size: at most ``bits`` / 64 rows come to the driver."""
    rows = (hashes.select(F.expr(f"pmod(h, {bits}) div 64").cast("int").alias("word"),
                          F.expr("shiftleft(1L, cast(pmod(h, 64) as int))").alias("bit"))
            .groupBy("word").agg(F.bit_or("bit").alias("bits")))
    got = rows.toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    return out


def longest_phrases(docs: DataFrame, open_pairs: np.ndarray) -> DataFrame:
    """lang, k, phrase, n: for every word occurrence the longest phrase (k words, up to 4) of kept pairs that begins there.

    Rows of 4 words are the edges of the graph; shorter ones end a piece, or stand before a rare pair.
    """
    sent = docs.sparkSession.sparkContext.broadcast(open_pairs)   # bounded: GATE_BITS bits

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        for batch in batches:
            for lang, texts in _by_language(batch):
                w = Words(lang, texts)
                if not len(w.codes):
                    continue
                at = w.pairs().view(np.int64) % (64 * len(bits))
                on = ~w.last & ((bits[at >> 6] >> (at & 63)) & 1).astype(bool)
                # number of words: 1 + as many kept pairs in a row, up to 3
                later = np.concatenate((on, np.zeros(WORDS, bool)))
                size, going = np.ones(len(on), np.int64), on
                for j in range(1, WORDS):
                    size += going
                    going = going & later[j:j + len(on)]
                codes = np.concatenate((w.codes, np.zeros(WORDS, np.int64)))
                for k in range(1, WORDS + 1):
                    i = np.flatnonzero(size == k)
                    if not len(i):
                        continue
                    cols = pa.table({f"w{j}": codes[i + j] for j in range(k)})
                    seen = cols.group_by(cols.column_names, use_threads=False).aggregate([([], "count_all")])
                    words = [w.distinct.take(seen.column(f"w{j}").combine_chunks()) for j in range(k)]
                    m = seen.num_rows
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * m, pa.string()), pa.array(np.full(m, k, np.int32)),
                         pc.binary_join_element_wise(*words, " ") if k > 1 else words[0],
                         seen.column("count_all").combine_chunks()], names=["lang", "k", "phrase", "n"])
    return _summed(_languages_and_texts(docs).mapInArrow(emit, GRAMS))


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"))


def _words(phrase: str, first, n) -> str:
    """SQL of ``n`` words of a phrase from word ``first`` (1 ..)."""
    return f"array_join(slice(split({phrase}, ' '), {first}, {n}), ' ')"


def node_flow(longest: DataFrame) -> list[DataFrame]:
    """Counts of the phrases of 1, 2, 3 and 4 words: each level is the flow of the next longer one plus the ends in it.

    Every level is written once, as the next one and the callers read it again.
    """
    levels = [longest.where(F.col("k") == WORDS)]
    for k in range(WORDS - 1, 0, -1):
        flow = levels[0].select("lang", F.lit(k).alias("k"), F.substring_index("phrase", " ", k).alias("phrase"), "n")
        level = _summed(flow.unionByName(longest.where(F.col("k") == k)))
        levels.insert(0, written(longest.sparkSession, level, "phrase-level"))
    return levels


def passages(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """lang, phrase, n: the unary paths of the graph, each as one passage of words with its count.

    ``edges`` are 4-word phrases with counts, ``nodes`` the 3-word ones.  An
    edge continues the one before it if the node between them occurs as often
    as either.  Pointers double each round; a cycle has an entry, as texts end.
    """
    spark = edges.sparkSession
    e = edges.select("lang", "phrase", "n")
    through = nodes.select("lang", F.col("phrase").alias("node"), F.col("n").alias("node_n"))
    into = e.select("lang", F.expr(_words("phrase", 2, 3)).alias("node"), F.col("n").alias("node_n"),
                    F.col("phrase").alias("before")).join(through, ["lang", "node", "node_n"], "left_semi")
    links = e.select("lang", "phrase", F.expr(_words("phrase", 1, 3)).alias("node"), F.col("n").alias("node_n"))
    # up: the edge ``far`` steps before this one; none: this edge begins its path
    p = links.join(into, ["lang", "node", "node_n"], "left").select(
        "lang", "phrase", F.col("node_n").alias("n"), F.col("before").alias("up"),
        F.when(F.col("before").isNotNull(), 1).otherwise(0).alias("far"))
    p = written(spark, p, "phrase-links")
    while True:
        at = p.select("lang", F.col("phrase").alias("up"), F.col("up").alias("up_up"), F.col("far").alias("up_far"))
        p = p.join(at, ["lang", "up"], "left").select(
            "lang", "phrase", "n", F.coalesce("up_up", "up").alias("up"),
            (F.col("far") + F.coalesce("up_far", F.lit(0))).alias("far"), F.col("up_up").isNotNull().alias("moved"))
        p = written(spark, p, "phrase-links")
        if p.where("moved").isEmpty():
            break
    # a path is no longer than one text, since all its occurrences run through it
    words = F.struct(F.col("far"), F.expr("substring_index(phrase, ' ', -1)").alias("word"))
    return (p.groupBy("lang", F.coalesce("up", "phrase").alias("head"), "n")
            .agg(F.array_sort(F.collect_list(words)).alias("steps"))
            .select("lang", F.expr("concat_ws(' ', substring_index(head, ' ', 3), concat_ws(' ', steps.word))").alias("phrase"), "n"))


def inside(longer: DataFrame, k: int) -> DataFrame:
    """lang, phrase, over: every phrase of ``k`` words within a longer one, with the largest count of these."""
    parts = (f"transform(sequence(1, size(split(phrase, ' ')) - {k - 1}), "
             f"i -> {_words('phrase', 'i', k)})")
    return (longer.where(F.size(F.split("phrase", " ")) > k)
            .select("lang", F.explode(F.array_distinct(F.expr(parts))).alias("phrase"), "n")
            .groupBy("lang", "phrase").agg(F.max("n").alias("over")))


def collocations(docs: DataFrame, least: int = LEAST, top: int | None = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first ``top`` phrases (None: all).

    a: occurrences; l and r: those of the parts of the lowest-scoring cut;
    n: words of the language; score: floor(2000000 * a / (l + r)).
    """
    spark = docs.sparkSession
    longest = written(spark, longest_phrases(docs, gate(frequent_pairs(docs, least))), "phrase-longest")
    levels = node_flow(longest)
    total = levels[0].groupBy("lang").agg(F.sum("n").alias("n"))
    often = [x.where(F.col("n") >= least) for x in levels]
    known = often[0].unionByName(often[1]).unionByName(often[2]).select("lang", "phrase", "n")
    paths = written(spark, passages(often[3], often[2]), "phrase-passages")

    # candidates that no longer one covers: triples of passages and pairs of passages and triples
    over = {3: inside(paths, 3), 2: inside(paths.unionByName(often[2].select("lang", "phrase", "n")), 2)}
    kept = [often[3].select("lang", "k", "phrase", "n")]
    for k in (2, 3):
        c = often[k - 1].join(over[k], ["lang", "phrase"], "left")
        kept.append(c.where(F.coalesce(100 * F.col("over").cast("decimal(20,0)") < 80 * F.col("n").cast("decimal(20,0)"), F.lit(True)))
                    .select("lang", "k", "phrase", "n"))
    c = kept[0].unionByName(kept[1]).unionByName(kept[2]).withColumnRenamed("n", "a")

    cuts = (c.withColumn("cut", F.explode(F.expr("sequence(1, k - 1)")))
            .withColumn("left", F.expr("substring_index(phrase, ' ', cut)"))
            .withColumn("right", F.expr("substring_index(phrase, ' ', cut - k)")))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(known.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)), ["lang", side])
    # products may pass 64 bits: decimals are exact
    score = F.expr("(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + r)")
    best = (cuts.withColumn("score", score.cast("long")).groupBy("lang", "phrase", "a")
            .agg(F.min(F.struct("score", "cut", "l", "r")).alias("best")))
    rows = best.select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_phrases(spark, sf_dir: str) -> DataFrame:
    """Contract rows of all ``documents``."""
    return collocations(table(spark, sf_dir, "documents"))


SQL = r"""
WITH p AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (
    SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f
    FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
          FROM w, (VALUES (1), (2), (3), (4)) AS ks(k) WHERE len(ws) >= k)
    GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM g WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM g WHERE k > 1 AND f >= 30),
covered AS (
    SELECT DISTINCT s.lang, s.phrase
    FROM (SELECT lang, a, j, array_to_string(ws[i:i + j - 1], ' ') AS phrase
          FROM (SELECT lang, a, ws, j, unnest(range(1, k - j + 2)) AS i
                FROM c, (VALUES (2), (3)) AS js(j) WHERE j < k)) s
    JOIN c ON c.lang = s.lang AND c.phrase = s.phrase
    WHERE 100 * s.a >= 80 * c.a),
cut AS (
    SELECT lang, k, phrase, a, i, array_to_string(ws[1:i], ' ') AS lp, array_to_string(ws[i + 1:], ' ') AS rp
    FROM (SELECT *, unnest(range(1, k)) AS i FROM c)),
scored AS (
    SELECT cut.lang, cut.phrase, cut.a, cut.i, x.f AS l, y.f AS r,
           ((2000000::HUGEINT * cut.a) // (x.f + y.f))::BIGINT AS score
    FROM cut JOIN g x ON x.lang = cut.lang AND x.phrase = cut.lp JOIN g y ON y.lang = cut.lang AND y.phrase = cut.rp),
best AS (
    SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) AS pick
    FROM scored ANTI JOIN covered USING (lang, phrase)),
ranked AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
           phrase, a, l, r, score
    FROM best WHERE pick = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""
