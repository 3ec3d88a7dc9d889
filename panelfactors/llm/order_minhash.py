"""Order MinHash fingerprints, sensitive to edit distance.

A text's symbols are its words; every k-mer of symbols is numbered by its
occurrence (first, second, ... in the text) and the pair is hashed.  The hash
space is cut into ``BINS`` equal bins (one-permutation form of the m hash
functions).  In each bin the ``TUPLE`` smallest pairs are taken, put back in
text order, and hashed as a tuple: a component changes both when a k-mer goes
and when the chosen k-mers change their order.  The fingerprint lists
the filled bins' components, joined by ``-``; the likeness of two is the share
of equal components among the bins filled on either side (equal fingerprints:
1, one of them empty: 0).

Long texts are thinned first: only pairs whose hash lies in the lowest part of
its bin are sorted, sized for ``SPARE`` pairs a bin; where that leaves a bin
short, all pairs of the text are sorted, so the minima are always those of the
whole text.

NULL text counts as empty: its fingerprint is empty.  Fewer
than ``K`` words form one k-mer.  Repeated rows get equal fingerprints; each is
the next document of the one before it, as is the first of several texts with
one id or none.  A very long text is worked on in one row: its k-mer hashes and
positions are held in memory, some 16 bytes a word.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, table, text_of, written

K, BINS, TUPLE, SPARE = 3, 32, 2, 10
BIN_BITS = 5            # log2(BINS): the top bits of a hash


def fingerprint(d: DataFrame, text: str, out: str) -> DataFrame:
    """``d`` with the fingerprint of column ``text`` as column ``out``."""
    rest = list(d.columns)
    d = d.withColumn("_w", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    d = d.withColumn("_h", F.expr(f"""CASE WHEN size(_w) = 0 THEN CAST(array() AS array<bigint>)
        ELSE transform(sequence(0, greatest(size(_w) - {K}, 0)), i -> xxhash64(slice(_w, i + 1, {K}))) END""")).drop("_w")
    # numbered pairs (hash, position): only where some k-mer repeats must the k-mers be sorted to count occurrences
    d = d.withColumn("_by", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), F.expr(
        "sort_array(transform(_h, (h, i) -> named_struct('h', h, 'i', i)))")))
    d = d.withColumn("_run", F.expr(
        "filter(sequence(0, size(_by) - 1), j -> j = 0 OR _by[j].h != _by[j - 1].h)"))
    d = d.withColumn("_p", F.when(F.col("_by").isNull(), F.expr(
        "transform(_h, (h, i) -> named_struct('h', xxhash64(h, 0), 'i', i))")).otherwise(F.expr("""
        flatten(transform(_run, (r, n) -> transform(sequence(r, coalesce(get(_run, n + 1), size(_by)) - 1),
            j -> named_struct('h', xxhash64(_by[j].h, j - r), 'i', _by[j].i))))"""))).drop("_h", "_by", "_run")
    # share of each bin's range that is sorted; 59 = 64 - BIN_BITS
    low = f"shiftrightunsigned(shiftleft(x.h, {BIN_BITS}), {BIN_BITS + 1})"
    d = d.withColumn("_low", F.expr(
        f"CASE WHEN size(_p) > {2 * SPARE * BINS} THEN filter(_p, x -> {low} < {float(2 ** (63 - BIN_BITS))}D * {SPARE * BINS} / size(_p)) ELSE _p END"))
    d = d.withColumn("_low", F.sort_array("_low"))
    d = d.withColumn("_min", F.expr(_smallest("_low")))
    # a bin that the thinned list leaves short: sort everything
    d = d.withColumn("_min", F.when(
        (F.size("_min") < BINS * TUPLE) & (F.size("_low") < F.size("_p")),
        F.expr(_smallest("sort_array(_p)"))).otherwise(F.col("_min")))
    # one component per filled bin: two digits of the bin, then the hash of its tuple in text order
    d = d.withColumn(out, F.expr(f"""array_join(transform(
        filter(sequence(0, size(_min) - 1), j -> j >= 0 AND size(_min) > 0
               AND (j = 0 OR {_bin('_min[j]')} != {_bin('_min[j - 1]')})),
        j -> concat(lpad(lower(hex({_bin('_min[j]')})), 2, '0'), lpad(lower(hex(xxhash64(transform(
            array_sort(filter(slice(_min, j + 1, {TUPLE}), x -> {_bin('x')} = {_bin('_min[j]')}),
                       (l, r) -> l.i - r.i), x -> x.h)))), 16, '0'))), '-')"""))
    return d.select(*rest, out)


def _bin(x: str) -> str:
    return f"shiftrightunsigned({x}.h, {64 - BIN_BITS})"


def _smallest(pairs: str) -> str:
    """The TUPLE smallest pairs of each bin of a list sorted by hash (a bin is a contiguous stretch of it)."""
    return f"""element_at(transform(array({pairs}), s -> filter(s, (x, j) ->
        j < {TUPLE} OR {_bin('x')} != {_bin(f's[j - {TUPLE}]')})), 1)"""


def likeness(a: str, b: str) -> Column:
    """Share of equal components among the bins that are filled on either side."""
    bins = f"array_distinct(transform(concat(split({a}, '-'), split({b}, '-')), c -> left(c, 2)))"
    return F.expr(f"""CASE WHEN {a} = {b} THEN 1.0D WHEN {a} = '' OR {b} = '' THEN 0.0D
        ELSE size(array_intersect(split({a}, '-'), split({b}, '-'))) / size({bins}) END""")


def _order(doc_id: Column, text: Column) -> Column:
    """Text that sorts rows by descending id, rows without id last, ties by the digest of the text."""
    falling = F.lpad(F.hex(doc_id.cast("long").bitwiseXOR(F.lit(2 ** 63 - 1))), 16, "0")
    return F.concat(F.coalesce(falling, F.lit("G" * 16)), F.md5(text))


def with_next(d: DataFrame, columns: list[str]) -> DataFrame:
    """``d`` (doc_id, text, ...) with ``next_<c>`` of the next row in descending doc_id, the last's being the first.

    The order keys alone are dealt by range; the first key of each slice (as
    many as shuffle partitions) cuts the order, so slices are even however the
    ids are spread, repeated or missing.  Then the texts move once, each to its
    slice; the first row of a slice is also dealt, as a guest, to the slice
    before it, and a window finds the next row inside a slice.  Ties of doc_id
    are ordered by the text's digest, rows without id come last; only rows equal
    in id and text always share a slice.
    """
    spark = d.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = d.withColumn("_o", _order(d["doc_id"], d["text"]))
    keys = written(spark, d.select("_o"), "omh-order").repartitionByRange(n, "_o")
    heads = keys.groupBy(F.spark_partition_id().alias("p")).agg(F.min("_o").alias("_o"))
    heads = sorted(r["_o"] for r in heads.collect())     # one key per slice
    last = max(len(heads) - 1, 0)
    d = d.withColumn("_heads", F.split(F.lit(",".join(heads)), ","))
    # the slice by binary descent: the last head that is not above the row's key
    steps = [2 ** i for i in reversed(range(max(last, 1).bit_length()))]
    d = d.withColumn("_s", F.expr(f"""aggregate(array({', '.join(map(str, steps))}), 0, (at, step) ->
        CASE WHEN at + step <= {last} AND _heads[least(at + step, {last})] <= _o THEN at + step ELSE at END)"""))
    home = F.struct(F.col("_s").alias("at"), F.lit(0).alias("guest"))
    guest = F.struct(F.when(F.col("_s") == 0, last).otherwise(F.col("_s") - 1).alias("at"), F.lit(1).alias("guest"))
    d = d.withColumn("_d", F.explode(F.when(F.expr("_heads[_s] = _o"), F.array(home, guest)).otherwise(F.array(home))))
    d = d.withColumn("_at", F.col("_d.at")).withColumn("_guest", F.col("_d.guest")).drop("_heads", "_s", "_d")
    order = Window.partitionBy("_at").orderBy("_guest", "_o")
    out = d.repartitionById(n, "_at").select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])
    return out.where("_guest = 0").drop("_o", "_at", "_guest")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next; one row per input row.

    The edited text keeps the first half and takes its last floor(n / 2) code
    points from the start of the next document.
    """
    d = docs.select("doc_id", text_of(docs).alias("text"))
    d = with_next(fingerprint(d, "text", "fingerprint"), ["text", "fingerprint"])
    d = d.withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    d = d.select("doc_id", "n_chars", "fingerprint", "next_fingerprint", F.concat(
        F.substring(F.col("text"), F.lit(1), F.length("text") - half),
        F.substring(F.col("next_text"), F.lit(1), half)).alias("edited"))
    d = fingerprint(d, "edited", "edited_fingerprint")
    return d.select("doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint",
                    likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
                    likeness("fingerprint", "next_fingerprint").alias("near_next"))


def op5_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Contract digest over all ``documents``."""
    d = fingerprints(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
                    "edited_fingerprint", "near_edited", "near_next")
