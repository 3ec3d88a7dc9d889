"""Quality rules: per-text rules, and cross-document line frequency per host.

Base rules are computed row by row.  The cross-document part hashes every
normalised line (lower case, digits folded to 0, white space collapsed) and
counts, per host (``source``), the distinct documents that carry it; documents
with the same whole text count as one, and so do near copies.  A line is
boilerplate in its host when more than
``max(min_docs, max_share * distinct documents of the host)`` carry it.
Boilerplate lines are removed, and a document left with less than ``min_left``
of its words is depleted and rejected.  The limit is a share of the host, so it
behaves alike at every size.

Near copies (removing them is not this operator's job): of the documents that
carry a line, byte for byte, the one with the least digest leads it.  A document
that has at least half of its words in lines with one leader is a near copy of
it, and counts as the leader does.  Only lines above the limit by plain counts
are looked at; counting near copies as one lowers a count, never raises it.

The count is two-phase (distinct, then partial sums), and the look-ups of lines
are plain equi-joins on (host, line): Spark sizes them at run time and splits a
hot key.  The lines above the plain limit are written to the shared folder.

NULL text: no words, so it fails the base rule.  NULL source is a host of its
own.  Repeated rows are one document and get the same verdict.  Extra columns
are ignored here; ``keep_good`` passes them on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, fresh, row_key, table, text_of, written

#: fixed values of the base rules
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
SYMBOLS = "#*$%&|<>"


def text_rules(docs: DataFrame) -> DataFrame:
    """Per row: key, doc_id, host, whole (the text), n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    d = docs.select(row_key(docs).alias("key"), "doc_id", docs["source"].alias("host"), docs["text"].alias("whole"), text_of(docs).alias("text"))
    d = d.select("*", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"),
                 F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD)).alias("lines"))
    d = d.select("key", "doc_id", "host", "whole", "words", F.size("words").cast("long").alias("n_words"),
                 (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
                 F.length(F.translate("text", " \t\n\u000b\u000c\r", "")).cast("long").alias("word_chars"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"))
    # 64-bit hashes of the 8-word windows: compared within one text only
    d = d.withColumn("win", F.when(F.col("n_words") > WINDOW, F.expr(
        f"transform(sequence(0, size(words) - {WINDOW}), i -> xxhash64(slice(words, i + 1, {WINDOW})))")))
    d = d.drop("words")
    # texts with a repeated window: sort (hash, position), keep the positions whose hash has a neighbour
    d = d.withColumn("by_hash", F.when(F.size(F.array_distinct("win")) < F.size("win"), F.expr(
        "sort_array(transform(win, (h, i) -> named_struct('h', h, 'i', i)))")))
    d = d.drop("win").withColumn("at", F.expr("""sort_array(transform(
        filter(by_hash, (x, j) -> get(by_hash, j - 1).h <=> x.h OR get(by_hash, j + 1).h <=> x.h), x -> x.i))"""))
    d = d.drop("by_hash").withColumn("n_repeat_words", F.coalesce(F.expr(
        f"""aggregate(transform(at, (x, j) -> least({WINDOW}, coalesce(get(at, j + 1) - x, {WINDOW}))),
                      0, (a, x) -> a + x)"""), F.lit(0)).cast("long")).drop("at")
    return d.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def word_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("long")


def text_lines(docs: DataFrame) -> DataFrame:
    """One row per line with a word, and per line 0.

    key, host, doc (digest of the whole text), total (its words), no, raw (hash of the line), words, line (hash, normalised).
    """
    d = docs.select(row_key(docs).alias("key"), docs["source"].alias("host"),
                    F.xxhash64(text_of(docs)).alias("doc"), word_count(text_of(docs)).alias("total"), text_of(docs).alias("text"))
    d = d.select("key", "host", "doc", "total", F.posexplode(F.split("text", "\n", -1)).alias("no", "raw"))
    d = d.select("key", "host", "doc", "total", "no", F.xxhash64("raw").alias("raw"), word_count(F.col("raw")).alias("words"), F.xxhash64(
        F.trim(F.regexp_replace(F.regexp_replace(F.lower("raw"), "[0-9]", "0"), "[ \\t-\\r]+", " "))).alias("line"))
    return d.where((F.col("words") > 0) | (F.col("no") == 0))


def frequent_lines(lines: DataFrame, max_share: float, min_docs: int) -> DataFrame:
    """(b_host, b_line, least) of the lines that more distinct documents of the host carry than the limit ``least``."""
    per_line = (lines.where("words > 0").select("host", "line", "doc").distinct()
                .groupBy("host", "line").agg(F.count(F.lit(1)).alias("carriers")))
    per_host = (lines.select("host", "doc").distinct()
                .groupBy("host").agg(F.count(F.lit(1)).alias("docs")))
    # a line under min_docs is never boilerplate: most lines go before the join
    many = per_line.where(F.col("carriers") > min_docs).alias("l").join(
        per_host.alias("h"), F.expr("l.host <=> h.host"))
    return (many.withColumn("least", F.greatest(F.lit(float(min_docs)), max_share * F.col("docs")))
            .where("carriers > least").select(F.col("l.host").alias("b_host"), F.col("line").alias("b_line"), "least"))


def near_copies(found: DataFrame) -> DataFrame:
    """(r_host, r_doc, leader) of the documents that are near copies of a leader; ``found``: lines above the plain limit."""
    f = found.select("host", "doc", "no", "raw", "words", "total").distinct()
    leaders = (f.groupBy("host", "raw").agg(F.min("doc").alias("leader"), F.max("doc").alias("last")).where("leader < last")
               .select(F.col("host").alias("l_host"), F.col("raw").alias("l_raw"), "leader"))
    shared = (f.join(leaders, F.expr("host <=> l_host AND raw = l_raw")).where("leader < doc")
              .groupBy("host", "doc", "leader").agg(F.sum("words").alias("words"), F.first("total").alias("total"))
              .where("2 * words >= total"))
    return (shared.groupBy("host", "doc").agg(F.max_by("leader", F.struct("words", "leader")).alias("leader"))
            .select(F.col("host").alias("r_host"), F.col("doc").alias("r_doc"), "leader"))


def boilerplate(docs: DataFrame, max_share: float, min_docs: int) -> DataFrame:
    """(key, no, words, line) of every boilerplate line, once for repeated rows."""
    spark = docs.sparkSession
    lines = text_lines(docs)
    found = written(spark, lines.join(frequent_lines(lines, max_share, min_docs),
                                      F.expr("host <=> b_host AND line = b_line AND words > 0"))
                    .select("key", "host", "doc", "total", "no", "raw", "words", "line", "least")
                    .dropDuplicates(["key", "no"]), "quality-lines")
    copies = near_copies(found)
    counted = (found.join(copies, F.expr("host <=> r_host AND doc = r_doc"), "left")
               .select("host", "line", "least", F.coalesce("leader", "doc").alias("carrier")).distinct()
               .groupBy("host", "line").agg(F.count(F.lit(1)).alias("carriers"), F.first("least").alias("least"))
               .where("carriers > least").select(F.col("host").alias("b_host"), F.col("line").alias("b_line")))
    return found.join(counted, F.expr("host <=> b_host AND line = b_line")).select("key", "no", "words", "line")


def without_lines(text: Column, removed_at: Column) -> Column:
    """The text without the lines of these numbers; the others stay byte for byte."""
    return F.when(removed_at.isNull(), text).otherwise(F.array_join(
        F.filter(F.split(text, "\n", -1), lambda x, i: ~F.array_contains(removed_at, i)), "\n"))


def quality(docs: DataFrame, max_share: float = 0.08, min_docs: int = 5, min_left: float = 0.3) -> DataFrame:
    """``text_rules`` plus removed_words, removed_lines, removed_at (their numbers), clean_text, depleted, kept; one row per input row."""
    removed = (boilerplate(docs, max_share, min_docs).groupBy("key")   # bounded by the text
               .agg(F.sum("words").alias("removed_words"), F.count(F.lit(1)).alias("removed_lines"), F.collect_set("no").alias("removed_at")))
    d = text_rules(docs).join(removed, "key", "left")
    d = d.withColumn("removed_words", F.coalesce("removed_words", F.lit(0).cast("long")))
    d = d.withColumn("removed_lines", F.coalesce("removed_lines", F.lit(0).cast("long")))
    d = d.withColumn("clean_text", without_lines(F.col("whole"), F.col("removed_at"))).drop("whole")
    d = d.withColumn("depleted", F.col("n_words") - F.col("removed_words") < min_left * F.col("n_words"))
    return d.withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))


def keep_good(docs: DataFrame, **limits) -> DataFrame:
    """The input rows that pass, with all their columns, boilerplate lines removed from the text.

    ``n_chars``, if there, is set to the new length where the text changed.
    The verdicts are written first: a filter on them would be pushed down into
    the text rules and repeat their whole expressions.
    """
    name, at = fresh(docs, "quality_key"), fresh(docs, "quality_at")
    verdicts = written(docs.sparkSession, quality(docs, **limits).select("key", "kept", "removed_at"), "quality-verdicts")
    good = verdicts.where("kept").dropDuplicates(["key"]).select(F.col("key").alias(name), F.col("removed_at").alias(at))
    d = docs.withColumn(name, row_key(docs)).join(good, name).withColumn("text", without_lines(F.col("text"), F.col(at)))
    if "n_chars" in docs.columns:
        d = d.withColumn("n_chars", F.when(F.col(at).isNull(), F.col("n_chars"))
                         .otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return d.select(*docs.columns)


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Contract digest over all ``documents``."""
    return quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "removed_lines", "removed_words", "clean_text")
