"""Exact n-gram Jaccard self-join of documents, with set-relation skipping.

A document's set holds the hashes (64 bits) of its distinct word n-grams.
Documents with equal sets form a class (128-bit digest of the set); classes are
joined, documents only carry their class.

1. Index.  Tokens have one global order: by hash, the frequent ones last by
   frequency.  A set indexes its first ``n - ceil(t n) + l`` tokens, and two sets
   with similarity >= t share at least ``l`` of those (l = ``SHARED``, less for
   tiny sets).  Frequency is counted over all documents; which tokens count as
   frequent (a bounded list) only affects speed, any order gives the same links.
2. Pivots.  Each index list has a leader, its set with the fewest rare tokens.
   Each set is verified against the leader that most sets share lists with; a
   group of near copies then hangs together by one link a set, not by all its
   pairs.  The differences to the pivot are kept.
3. Pairs of one pivot.  Their overlap follows from the pivot's size and the two
   differences.  Small differences link surely: these links are counted by the
   differences' sizes and never listed.  All other pairs need common
   differences, the more the larger these are; they are joined on the
   differences, blocks skipped by position and size, and then derived.
4. Pairs of different pivots.  An index list is cut into blocks by position and
   size, and a pair of blocks is skipped when even its best bound (remaining
   tokens and those passed, sizes) misses the threshold.  These pairs are
   intersected in full.  Where only components matter, pairs within one are skipped.

Long lists are cut into parts that are paired in separate tasks.
Components come from alternating large-star and small-star rounds on the links;
links never leave Spark.  Every step that is read twice is written to the
shared folder.

NULL text and texts without words: empty set, linked with nothing.  Fewer than
n words: the whole sequence is the one n-gram.  Rows with a NULL id take part;
a component's id is its least non-NULL id.  Repeated rows are equal sets, so
they are linked.  Extra columns are ignored; ``one_per_component`` passes them on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, fresh, row_key, table, text_of, written

N, PERCENT, SHARED = 3, 90, 3
FREQUENT, FREQUENT_FROM, BATCH_FROM = 65_536, 32, 4    # length of the list, least count in all, least count in a batch
BLOCK, PART = 64, 2048                                  # postings in a block of a list, in a part of a long list
SHORT = 16                                              # lists up to this length are paired many at a time
PIVOT_PERCENT = 70                                      # differences are kept from this likeness on


class WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 2_000_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, memo: WordHash, n: int = N) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams (words as in the contract: bytes.split cuts at space and TAB..CR)."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    k = min(n, len(words))
    out = np.full(len(words) - k + 1, np.uint64(k))
    for i in range(k):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i:len(words) - k + 1 + i])
    return np.unique(out)


def _digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def need(n):
    """Least overlap of a set of n tokens with any set it links to: ceil(t n)."""
    return -(-PERCENT * n // 100)


def linked(inter, a, b):
    return 100 * inter >= PERCENT * (a + b - inter)


def read_sets(docs: DataFrame) -> DataFrame:
    """One pass over all texts: rows of kind 0 (key, doc_id, c, n) for documents, of kind 1 (token, n) for batch counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHash()
        for batch in batches:
            sets = [shingles(t, memo) for t in batch.column(2).to_pylist()]
            m = len(sets)
            ids = [_digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array([0] * m, pa.int32()), batch.column(0), batch.column(1), pa.array(ids, pa.binary()),
                 pa.array([len(s) for s in sets], pa.int64()), pa.nulls(m, pa.int64())], names=cols)
            distinct = list({i: s for i, s in zip(ids, sets)}.values())   # copies count once
            token, df = np.unique(np.concatenate(distinct), return_counts=True) if distinct else (np.empty(0, np.uint64), np.empty(0, int))
            token, df = token[df >= BATCH_FROM], df[df >= BATCH_FROM]
            m = len(token)
            yield pa.RecordBatch.from_arrays(
                [pa.array([1] * m, pa.int32()), pa.nulls(m, pa.string()), pa.nulls(m, batch.column(1).type), pa.nulls(m, pa.binary()),
                 pa.array(df.astype(np.int64)), pa.array(token.view(np.int64))], names=cols)
    cols = ["kind", "key", "doc_id", "c", "n", "token"]
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(row_key(docs).alias("key"), "doc_id", text_of(docs).alias("text")).mapInArrow(
        run, f"kind int, key string, doc_id {id_type}, c binary, n long, token long")


def frequent_tokens(counts: DataFrame) -> np.ndarray:
    """At most FREQUENT tokens, the rarest first: the tail of the global order."""
    rows = (counts.groupBy("token").agg(F.sum("n").alias("df")).where(F.col("df") >= FREQUENT_FROM)
            .orderBy(F.desc("df"), "token").limit(FREQUENT).collect())
    return np.array([r.token for r in reversed(rows)], np.int64).view(np.uint64)


class Order:
    """The global token order: by hash, then the frequent tokens by frequency."""

    def __init__(self, frequent: np.ndarray):
        self.by_hash = np.argsort(frequent)
        self.sorted = frequent[self.by_hash]

    def sort(self, tokens: np.ndarray) -> tuple[np.ndarray, int]:
        """The tokens in order, and how many of them are not frequent."""
        if not len(self.sorted):
            return tokens, len(tokens)
        at = np.minimum(np.searchsorted(self.sorted, tokens), len(self.sorted) - 1)
        hot = self.sorted[at] == tokens
        tail = tokens[hot][np.argsort(self.by_hash[at[hot]])]
        return np.concatenate([tokens[~hot], tail]), int(len(tokens) - hot.sum())


def _fixed(ids: np.ndarray) -> pa.Array:
    """An Arrow binary array from 16-byte ids."""
    return pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(np.arange(len(ids) + 1, dtype=np.int32) * 16),
                                                         pa.py_buffer(np.ascontiguousarray(ids))])


def postings(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(token, c, n, pos, rare) of every class: its indexed tokens with their position in the global order."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent)   # FREQUENT tokens at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, order = WordHash(), Order(sent.value)
        for batch in batches:
            done: set[bytes] = set()
            parts = []
            for text in batch.column(0).to_pylist():
                s = shingles(text, memo)
                c = _digest(s)
                if not len(s) or c in done:
                    continue
                done.add(c)
                least = need(len(s))
                ordered, rare = order.sort(s)
                p = len(s) - least + min(SHARED, least)
                parts.append((ordered[:p], np.frombuffer(c * p, "V16"), np.full(p, len(s)), np.arange(p), np.full(p, rare)))
            if parts:
                token, c, n, pos, rare = (np.concatenate(x) for x in zip(*parts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(token.view(np.int64)), _fixed(c), pa.array(n.astype(np.int32)), pa.array(pos.astype(np.int32)),
                     pa.array(rare.astype(np.int32))], names=["token", "c", "n", "pos", "rare"])
    rows = docs.select(text_of(docs).alias("text")).mapInArrow(run, "token long, c binary, n int, pos int, rare int")
    # copies in several batches agree in all columns; max moves no flags beside the values, as first does
    return rows.groupBy("token", "c").agg(F.max("n").alias("n"), F.max("pos").alias("pos"), F.max("rare").alias("rare"))


def shared_lists(posts: DataFrame) -> DataFrame:
    """The postings of the lists of two sets or more; a list of one set, which most are, makes no pair."""
    lists = posts.groupBy("token").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("token")
    return posts.join(lists, "token")


def token_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(c, tokens) of the wanted classes, from the text of one document each; ``wanted``: c, key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHash()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(
                [shingles(t, memo).tobytes() for t in batch.column(1).to_pylist()], pa.binary())], names=["c", "tokens"])
    d = docs.select(row_key(docs).alias("key"), text_of(docs).alias("text"))
    # repeated rows have one key: one row per class stays
    return (d.join(wanted, "key").dropDuplicates(["key"]).select("c", "text")
            .mapInArrow(run, "c binary, tokens binary"))


def _ints(b: bytes) -> np.ndarray:
    return np.frombuffer(b, np.uint64)


def verify_pivots(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(c, pivot, link, n, pivot_n, plus, minus) of pairs (c, pivot): overlap and differences, from the full sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for c, p, tc, tp in zip(*(batch.column(i).to_pylist() for i in range(4))):
                x, y = _ints(tc), _ints(tp)
                plus, minus = np.setdiff1d(x, y, True), np.setdiff1d(y, x, True)
                inter = len(x) - len(plus)
                if 100 * inter >= PIVOT_PERCENT * (len(y) + len(plus)):
                    out.append((c, p, bool(linked(inter, len(x), len(y))), len(x), len(y), plus.tobytes(), minus.tobytes()))
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema=schema)
    schema = pa.schema([("c", pa.binary()), ("pivot", pa.binary()), ("link", pa.bool_()), ("n", pa.int64()),
                        ("pivot_n", pa.int64()), ("plus", pa.binary()), ("minus", pa.binary())])
    both = (pairs.join(sets, "c").withColumnRenamed("tokens", "tc")
            .join(sets.select(F.col("c").alias("pivot"), F.col("tokens").alias("tp")), "pivot").select("c", "pivot", "tc", "tp"))
    return both.mapInArrow(run, "c binary, pivot binary, link boolean, n long, pivot_n long, plus binary, minus binary")


def derived_links(pairs: DataFrame) -> DataFrame:
    """Links (a, b) among pairs with the same pivot, from the differences to it (no full set is read)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            names = ("a_plus", "a_minus", "b_plus", "b_minus", "pivot_n", "a_n", "b_n")
            for i, (ap, am, bp, bm, p, x, y) in enumerate(zip(*(batch.column(n).to_pylist() for n in names))):
                ap, am, bp, bm = map(_ints, (ap, am, bp, bm))
                inter = (p - len(am) - len(bm) + len(np.intersect1d(am, bm, True)) + len(np.intersect1d(ap, bp, True)))
                if linked(inter, x, y):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([batch.column("a").take(pa.array(keep, pa.int32())),
                                              batch.column("b").take(pa.array(keep, pa.int32()))], names=["a", "b"])
    return pairs.mapInArrow(run, "a binary, b binary")


def full_links(pairs: DataFrame) -> DataFrame:
    """Links (a, b) among pairs with both full sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist())):
                x, y = _ints(x), _ints(y)
                if linked(len(np.intersect1d(x, y, True)), len(x), len(y)):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([batch.column("a").take(pa.array(keep, pa.int32())),
                                              batch.column("b").take(pa.array(keep, pa.int32()))], names=["a", "b"])
    return pairs.mapInArrow(run, "a binary, b binary")


def list_pairs(n, pos, comp, pivot, part, i, j, block=BLOCK, passed=0):
    """Index pairs of one list (or of parts i and j of it) that may link, block by block.

    A token at position p of a set of n leaves at most n - p common tokens from
    there on; at the pair's first common token that bound holds for both sets.
    At a later one the common tokens before it, ``passed`` at most, are added.
    """
    order = np.lexsort((pos, n))
    n, pos, comp, pivot, part = n[order], pos[order], comp[order], pivot[order], part[order]
    rest, least = n - pos + passed, need(n)
    blocks = [slice(s, min(s + block, len(n))) for s in range(0, len(n), block)]
    most_rest = np.array([rest[b].max() for b in blocks])
    low = np.array([least[b].min() for b in blocks])
    top_n, low_n = np.array([n[b].max() for b in blocks]), np.array([n[b].min() for b in blocks])
    out_a, out_b = [], []
    for x in range(len(blocks)):
        # sizes ascend: later blocks until the smallest size there is out of reach; of these, skip by position
        y = np.arange(x, len(blocks))
        y = y[(100 * top_n[x] >= PERCENT * low_n[y]) & (np.minimum(most_rest[x], most_rest[y]) >= low[y])]
        for k in y:
            bx, by = blocks[x], blocks[k]
            ok = (np.minimum(rest[bx][:, None], rest[by][None]) >= np.maximum(least[bx][:, None], least[by][None]))
            ok &= (100 * n[bx][:, None] >= PERCENT * n[by][None]) & (comp[bx][:, None] != comp[by][None])
            ok &= pivot[bx][:, None] != pivot[by][None]
            if i != j:
                ok &= part[bx][:, None] != part[by][None]
            if k == x:
                ok &= np.triu(np.ones(ok.shape, bool), 1)
            a, b = np.nonzero(ok)
            out_a.append(order[a + bx.start])
            out_b.append(order[b + by.start])
    none = np.empty(0, int)
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (none, none)


def cells(lists: DataFrame, parts: DataFrame, columns: list[str]) -> DataFrame:
    """Postings dealt by list; a list of several ``parts`` (list, parts) has a cell for each pair of its parts."""
    p = lists.join(parts, "list").withColumn("part", F.expr("CAST(pmod(xxhash64(c), parts) AS int)"))
    p = p.withColumn("q", F.explode(F.expr("sequence(0, parts - 1)")))
    p = p.select("list", "c", "part", *columns, F.least("part", "q").alias("i"), F.greatest("part", "q").alias("j"))
    return p.repartition("list", "i", "j").sortWithinPartitions("list", "i", "j")


def parts_of(lists: DataFrame, *more) -> DataFrame:
    """(list, m, parts, and the aggregates ``more``) of every list."""
    return lists.groupBy("list").agg(F.count(F.lit(1)).alias("m"), *more).withColumn("parts", F.expr(f"CAST(ceil(m / {PART}) AS int)"))


def short_pairs(starts, sizes, columns, test):
    """Row pairs (x, y) of short lists that pass ``test(x's columns, y's columns)``, many lists of one length at a time."""
    for m in np.unique(sizes):
        one, other = np.triu_indices(m, 1)
        at = starts[sizes == m]
        step = max(1, 200_000 // len(one))
        for k in range(0, len(at), step):
            x, y = ((at[k:k + step, None] + side).ravel() for side in (one, other))
            ok = test({n: v[x] for n, v in columns.items()}, {n: v[y] for n, v in columns.items()})
            yield x[ok], y[ok]


def pairs_in_cells(p: DataFrame, columns: list[str], find, test, keep=None, schema: str = "") -> DataFrame:
    """Pairs (a, b) of classes, a < b, that ``find(column arrays, part, i, j)`` gives for each cell.

    ``test`` is the condition of ``find`` on single pairs, for short lists.
    ``keep(column arrays, x, y)`` adds columns (named in ``schema``) to the pairs of rows x and y.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(chunk: pa.Table) -> Iterator[pa.RecordBatch]:
            c = np.frombuffer(b"".join(chunk.column("c").to_pylist()), "V16")
            cell = [chunk.column(k).to_numpy() for k in ("list", "i", "j")]
            part = chunk.column("part").to_numpy()
            col = {k: chunk.column(k).to_numpy().astype(np.int64) for k in columns}

            def rows(a, b):
                for at in range(0, len(a), 100_000):
                    ax, bx = a[at:at + 100_000], b[at:at + 100_000]
                    x, y = c[ax], c[bx]
                    flip = x.view("S16") > y.view("S16")
                    more = keep(col, ax, bx) if keep else {}
                    yield pa.RecordBatch.from_arrays([_fixed(np.where(flip, y, x)), _fixed(np.where(flip, x, y)), *more.values()], names=["a", "b", *more])

            starts = np.append(np.flatnonzero(np.append(True, borders(cell))), len(c))
            sizes, starts = np.diff(starts), starts[:-1]
            whole = cell[1][starts] == cell[2][starts]
            short = whole & (sizes > 1) & (sizes <= SHORT)
            for a, b in short_pairs(starts[short], sizes[short], col, test):
                yield from rows(a, b)
            for s, m in zip(starts[~short], sizes[~short]):
                if m > 1:
                    v = slice(s, s + m)
                    a, b = find({k: x[v] for k, x in col.items()}, part[v], cell[1][s], cell[2][s])
                    yield from rows(a + s, b + s)

        def borders(cell):
            return np.logical_or.reduce([x[1:] != x[:-1] for x in cell])

        last = None
        for batch in batches:
            # cut at the last cell's border: a cell may go on in the next batch
            if not len(batch):
                continue
            cell = [batch.column(k).to_numpy() for k in ("list", "i", "j")]
            at = np.flatnonzero(borders(cell))
            cut = int(at[-1]) + 1 if len(at) else 0
            if last is not None and tuple(x[0] for x in cell) != last or cut:
                ready = held + ([batch.slice(0, cut)] if cut else [])
                if ready:
                    yield from flush(pa.Table.from_batches(ready))
                held = []
            held.append(batch.slice(cut))
            last = tuple(x[-1] for x in cell)
        if held:
            yield from flush(pa.Table.from_batches(held))

    return p.mapInArrow(run, "a binary, b binary" + schema)


def may_link(x, y, passed=SHARED - 1):
    """The condition of ``list_pairs`` on pairs of postings."""
    more, less = np.maximum(x["n"], y["n"]), np.minimum(x["n"], y["n"])
    return ((np.minimum(x["n"] - x["pos"], y["n"] - y["pos"]) + passed >= need(more)) & (100 * less >= PERCENT * more)
            & (x["comp"] != y["comp"]) & (x["pivot"] != y["pivot"]))


def remaining_pairs(posts: DataFrame, pivots: DataFrame, comps: DataFrame | None) -> DataFrame:
    """Pairs (a, b) of classes of different pivots that share enough indexed tokens; with ``comps``, across components only.

    A pivot counts as its own where it has no other.  A linked pair meets in the
    lists of its first SHARED common tokens, so each of these has to count; the
    bound without tokens passed holds in the first.
    """
    p = posts.join(pivots.select("c", "pivot"), "c", "left").withColumn("pivot", F.coalesce("pivot", "c"))
    p = p.withColumn("comp", F.col("c"))
    if comps is not None:
        p = p.drop("comp").join(comps.select("c", "comp"), "c", "left").withColumn("comp", F.coalesce("comp", "c"))
    p = p.select(F.col("token").alias("list"), "c", "n", "pos", F.xxhash64("comp").alias("comp"), F.xxhash64("pivot").alias("pivot"))
    mixed = parts_of(p, *(f(x).alias(f"{n}_{x}") for x in ("comp", "pivot") for n, f in (("lo", F.min), ("hi", F.max))))
    mixed = mixed.where("lo_comp <> hi_comp AND lo_pivot <> hi_pivot").select("list", "parts")

    def find(x, part, i, j):
        return list_pairs(x["n"], x["pos"], x["comp"], x["pivot"], part, i, j, passed=SHARED - 1)

    def keep(x, a, b):
        n, rest = x["n"], x["n"] - x["pos"]
        first = np.minimum(rest[a], rest[b]) >= need(np.maximum(n[a], n[b]))
        return {"n": pa.array(n[a].astype(np.int32)), "first": pa.array(first)}

    columns = ["n", "pos", "comp", "pivot"]
    found = pairs_in_cells(cells(p, mixed, columns), columns, find, may_link, keep, ", n int, first boolean")
    return (found.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"), F.min("n").alias("n"), F.max("first").alias("first"))
            .where(F.expr(f"first AND shared >= least({SHARED}, ceil({PERCENT} * n / 100))")).select("a", "b"))


# Two sets of one pivot of p tokens, that lack m and add q of them and have o
# differences in common: the overlap is p - m - m' + o, so they link when
#     (100 + PERCENT) o >= w + w' - slack,   w = 100 m + PERCENT q,   slack = (100 - PERCENT) p.
# With w + w' <= slack they surely link; else they need a common difference.

WEIGHT = f"CAST((100 * length(minus) + {PERCENT} * length(plus)) / 8 AS long)"
SLACK = f"{100 - PERCENT} * pivot_n"


def band_pairs(over, rest, link, part, i, j, within=True, block=BLOCK):
    """Index pairs of one list of differences that may link and do not do so surely.

    ``over``: 2 w - slack of a set; ``rest``: its differences from this one on.
    At a pair's first common difference, at most the lesser rest is common.
    Not ``within``: pairs of two sets that link to the pivot are left out.
    """
    order = np.argsort(over, kind="stable")
    over, rest, link, part = over[order], rest[order], link[order], part[order]
    blocks = [slice(s, min(s + block, len(over))) for s in range(0, len(over), block)]
    most = np.array([rest[b].max() for b in blocks])
    low, top = np.array([over[b][0] for b in blocks]), np.array([over[b][-1] for b in blocks])
    out_a, out_b = [], []
    for x in range(len(blocks)):
        y = np.arange(x, len(blocks))
        y = y[(top[x] + top[y] > 0) & (2 * (100 + PERCENT) * np.minimum(most[x], most[y]) >= low[x] + low[y])]
        for k in y:
            bx, by = blocks[x], blocks[k]
            both = over[bx][:, None] + over[by][None]
            ok = (both > 0) & (2 * (100 + PERCENT) * np.minimum(rest[bx][:, None], rest[by][None]) >= both)
            if not within:
                ok &= ~(link[bx][:, None] & link[by][None])
            if i != j:
                ok &= part[bx][:, None] != part[by][None]
            if k == x:
                ok &= np.triu(np.ones(ok.shape, bool), 1)
            a, b = np.nonzero(ok)
            out_a.append(order[a + bx.start])
            out_b.append(order[b + by.start])
    none = np.empty(0, int)
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (none, none)


def may_link_within(x, y, within):
    """The condition of ``band_pairs`` on pairs of postings."""
    both = x["over"] + y["over"]
    ok = (both > 0) & (2 * (100 + PERCENT) * np.minimum(x["rest"], y["rest"]) >= both)
    return ok if within else ok & ~((x["link"] > 0) & (y["link"] > 0))


def difference_lists(pivots: DataFrame) -> DataFrame:
    """(list, c, over, rest, link): postings of each set's differences to its pivot, added tokens first.

    A partner in need of a common difference has w >= PERCENT o itself, so a set
    needs o >= (w - slack) / 100 with any; its last differences are not posted.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for c, g, n, link, plus, minus in zip(*(batch.column(i).to_pylist() for i in range(6))):
                plus, minus = _ints(plus), _ints(minus)
                w, slack, d = 100 * len(minus) + PERCENT * len(plus), (100 - PERCENT) * n, len(plus) + len(minus)
                posted = d - max(1, -(-(w - slack) // 100)) + 1
                if posted > 0:
                    token = np.concatenate([plus, minus])[:posted] ^ np.uint64(g & (1 << 64) - 1)
                    parts.append((_mix(token), np.frombuffer(c * posted, "V16"), np.full(posted, 2 * w - slack), d - np.arange(posted), np.full(posted, link)))
            if parts:
                token, c, over, rest, link = (np.concatenate(x) for x in zip(*parts))
                yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), _fixed(c), pa.array(over.astype(np.int64)), pa.array(rest.astype(np.int32)),
                                                  pa.array(link.astype(np.int32))], names=["list", "c", "over", "rest", "link"])
    # a list is a token of one pivot: their 64-bit hash; a chance meeting is undone where the pairs are verified
    return pivots.select("c", F.xxhash64("pivot"), "pivot_n", "link", "plus", "minus").mapInArrow(
        run, "list long, c binary, over long, rest int, link int")


def pivot_pairs(pivots: DataFrame, within: bool, name: str) -> DataFrame:
    """Pairs (a, b) of classes with one pivot whose links the sizes of their differences leave open."""
    lists = written(pivots.sparkSession, difference_lists(pivots), name)
    shared = parts_of(lists, F.max("over").alias("top"), F.min("link").alias("all"))
    shared = shared.where("m > 1 AND top > 0" if within else "m > 1 AND top > 0 AND all = 0").select("list", "parts")
    columns = ["over", "rest", "link"]

    def find(x, part, i, j):
        return band_pairs(x["over"], x["rest"], x["link"] > 0, part, i, j, within)
    return pairs_in_cells(cells(lists, shared, columns), columns, find, lambda x, y: may_link_within(x, y, within)).distinct()


def sure_links(pivots: DataFrame, sizes: DataFrame) -> DataFrame:
    """(c, sure): how many other rows have the class's pivot and surely link with it: counted by weight, not listed.

    Rows with w <= slack - w', per (pivot, w'), from a running sum over the
    distinct weights of a pivot; these are ``slack`` at most.
    """
    p = pivots.where("link").select("c", "pivot", F.expr(SLACK).alias("slack"), F.expr(WEIGHT).alias("w")).join(sizes, "c")
    by = p.groupBy("pivot", "slack", "w").agg(F.sum("m").alias("m"))
    points = by.select("pivot", F.col("w").alias("at"), F.lit(0).alias("asks"), "m", "w")
    asks = by.select("pivot", (F.col("slack") - F.col("w")).alias("at"), F.lit(1).alias("asks"), F.lit(0).cast("long").alias("m"), "w")
    upto = Window.partitionBy("pivot").orderBy("at", "asks").rowsBetween(Window.unboundedPreceding, 0)
    below = points.unionByName(asks).withColumn("below", F.sum("m").over(upto)).where("asks = 1").select("pivot", "w", "below")
    return p.join(below, ["pivot", "w"]).select("c", F.expr("below - IF(2 * w <= slack, m, 0)").alias("sure"))


def components(edges: DataFrame, name: str) -> DataFrame:
    """(c, comp): the least class reachable, for every class in ``edges`` (a, b).  Large-star, small-star."""
    spark = edges.sparkSession

    def state(e):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    e = written(spark, edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-edges")
    before = state(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("m", "a").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(spark, large.where("a <> b").distinct(), f"{name}-large")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        e = written(spark, small.where("a <> b").distinct(), f"{name}-small")
        now = state(e)
        if tuple(now) == tuple(before):
            break
        before = now
    return e.select(F.col("a").alias("c"), F.col("b").alias("comp")).unionByName(
        e.select(F.col("b").alias("c"), F.col("b").alias("comp")).distinct())


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def link_counts(rows: DataFrame, links: DataFrame, pivots: DataFrame) -> DataFrame:
    """(c, n_links): the other rows that a row of the class is linked with, those of its own class included.

    ``links`` are the links listed; those sure by the differences to one pivot are counted from ``pivots``.
    """
    sizes = rows.where("n > 0").groupBy("c").agg(F.count(F.lit(1)).alias("m"))
    both = ordered(links).distinct()
    both = both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(sizes.select(F.col("c").alias("b"), "m"), "b").groupBy(F.col("a").alias("c")).agg(F.sum("m").alias("others"))
    zero = F.lit(0)
    return (sizes.join(others, "c", "left").join(sure_links(pivots, sizes), "c", "left")
            .select("c", (F.col("m") - 1 + F.coalesce("others", zero) + F.coalesce("sure", zero)).alias("n_links")))


def similar_documents(docs: DataFrame, count_links: bool = False) -> DataFrame:
    """key, doc_id, n_shingles, comp (the component itself), component_id (its least id) of every row.

    ``count_links``: n_links too, the number of other rows linked with the row;
    for that pairs within a component are decided too.
    """
    spark = docs.sparkSession
    read = written(spark, read_sets(docs), "ngram-read")
    rows = read.where("kind = 0").drop("kind", "token")
    posts = written(spark, postings(docs, frequent_tokens(read.where("kind = 1"))), "ngram-postings")
    posts = written(spark, shared_lists(posts), "ngram-shared")

    # pivots: of each set, the leader that most sets could have; then the one it shares most lists with
    leaders = (posts.groupBy("token").agg(F.min(F.struct("rare", "n", "c")).alias("top"))
               .select("token", F.col("top.c").alias("pivot"), F.col("top.n").alias("pivot_n")))
    led = (posts.join(leaders, "token").where(f"c <> pivot AND 100 * least(n, pivot_n) >= {PIVOT_PERCENT} * greatest(n, pivot_n)")
           .groupBy("c", "pivot").agg(F.count(F.lit(1)).alias("shared"), F.first("n").alias("n"))
           .where(F.expr(f"shared >= least({SHARED}, ceil({PERCENT} * n / 100))")).drop("n"))
    led = written(spark, led, "ngram-may-lead")
    fame = led.groupBy("pivot").agg(F.count(F.lit(1)).alias("fame"))
    led = led.join(fame, "pivot").groupBy("c").agg(F.max_by("pivot", F.struct("fame", "shared", "pivot")).alias("pivot"))
    led = written(spark, led, "ngram-led")
    reps = rows.where("n > 0").groupBy("c").agg(F.min("key").alias("key"))
    wanted = led.select("c").unionByName(led.select(F.col("pivot").alias("c"))).distinct()
    sets = written(spark, token_sets(docs, wanted.join(reps, "c")), "ngram-sets")
    pivots = written(spark, verify_pivots(led, sets), "ngram-pivots")
    links = pivots.where("link").select(F.col("c").alias("a"), F.col("pivot").alias("b"))

    # remaining pairs of one pivot, by the differences to it, and of different pivots
    near = written(spark, pivot_pairs(pivots, count_links, "ngram-differences"), "ngram-near")
    if count_links:
        pairs = remaining_pairs(posts, pivots, None).join(ordered(pivots.select(F.col("c").alias("a"), F.col("pivot").alias("b"))), ["a", "b"], "left_anti")
    else:
        pairs = remaining_pairs(posts, pivots, components(links, "ngram-first"))
    pairs = written(spark, pairs, "ngram-pairs")

    def side(s):
        return pivots.select(F.col("c").alias(s), *[F.col(x).alias(f"{s}_{x}") for x in ("pivot", "n", "plus", "minus")], F.col("pivot_n").alias(f"{s}_pivot_n"))
    derived = derived_links(near.join(side("a"), "a").join(side("b"), "b").where("a_pivot = b_pivot")
                            .withColumnRenamed("a_pivot_n", "pivot_n"))
    more = pairs.select(F.col("a").alias("c")).unionByName(pairs.select(F.col("b").alias("c"))).distinct()
    more = more.join(sets, "c", "left_anti")
    every = sets.unionByName(written(spark, token_sets(docs, more.join(reps, "c")), "ngram-more-sets"))
    full = full_links(pairs.join(every.select(F.col("c").alias("a"), F.col("tokens").alias("ta")), "a")
                      .join(every.select(F.col("c").alias("b"), F.col("tokens").alias("tb")), "b"))
    found = written(spark, derived.unionByName(full), "ngram-links")
    links = links.unionByName(found)
    comps = components(links, "ngram-last")

    of = rows.join(comps, "c", "left").withColumn("comp", F.coalesce("comp", "c"))
    least = of.where("n > 0").groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    out = of.join(least, "comp", "left")
    counts = []
    if count_links:
        out = out.join(link_counts(rows, links, pivots), "c", "left")
        counts = [F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")]
    return out.select(
        "key", "doc_id", F.col("n").alias("n_shingles"), "comp",
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), *counts)


def one_per_component(docs: DataFrame) -> DataFrame:
    """The input rows, of each component the one with the least id (then key); all rows without words stay."""
    name = fresh(docs, "join_key")
    found = written(docs.sparkSession, similar_documents(docs), "ngram-components")
    # by the component itself: ids may be NULL in several components, or the same
    keep = (found.where("n_shingles > 0")
            .groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("best"))
            .select(F.col("best.key").alias(name)))
    keyed = docs.withColumn(name, row_key(docs))
    words = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    one = keyed.where(words).join(keep, name, "left_semi").dropDuplicates([name])
    return one.unionByName(keyed.where(~words)).select(*docs.columns)


def op2_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Contract digest over all ``documents``, and the number of links of each."""
    return similar_documents(table(spark, sf_dir, "documents"), count_links=True).select(
        "doc_id", "n_shingles", "component_id", "n_links")
