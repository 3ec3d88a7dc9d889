"""Shared pieces of the corpus operators: inputs, row identity, match positions, shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: a word of the contracts: a run of anything but space and the controls TAB..CR
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the cluster's shared folder and read back (cuts the lineage)."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(df: DataFrame) -> Column:
    return F.coalesce(df["text"], F.lit(""))


def row_key(df: DataFrame) -> Column:
    """128-bit identity of a document row from its id, source and whole text.

    Rows that agree in all three are the same row repeated and get the same
    verdict; a NULL and an empty value differ.  Joins on this key therefore
    need no unique or non-null ``doc_id``.
    """
    def part(name):
        return F.coalesce(F.concat(F.lit("="), df[name].cast("string")), F.lit("-"))
    return F.md5(F.concat_ws("\u001f", part("doc_id"), part("source"), F.md5(text_of(df)), part("text").substr(1, 1)))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (case-insensitively), for internal use."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def match_positions(matches: str, pieces: str) -> Column:
    """Offsets of every regex match, from the matches and the pieces between them.

    ``matches`` is ``regexp_extract_all(text, p, 0)`` and ``pieces`` is
    ``split(text, p, -1)`` over the same pattern, so they alternate.  The
    offsets are code points, the end is exclusive.  ``before`` and ``after``
    are the neighbouring pieces.
    """
    lengths = f"transform({matches}, (m, i) -> length({pieces}[i]) + length(m))"
    ends = let("len", lengths, let("step", "greatest(1, cast(ceil(sqrt(size(len))) as int))", let(
        "sums", "transform(sequence(0, cast((size(len) - 1) div step as int)), b -> aggregate(slice(len, b * step + 1, step), 0, (s, x) -> s + x))",
        let("starts", _running("sums", "0", "acc.at"), f"""flatten(transform(starts, (start, b) -> {
            _running("slice(len, b * step + 1, step)", "start", "acc.at + x")}))"""))))
    return F.expr(f"""
        if(size({matches}) = 0, CAST(array() AS array<struct<start:int,end:int,match:string,before:string,after:string>>),
           transform({ends}, (e, i) -> named_struct(
               'start', e - length({matches}[i]), 'end', e, 'match', {matches}[i],
               'before', {pieces}[i], 'after', {pieces}[i + 1])))
    """)


def let(name: str, value: str, body: str) -> str:
    """SQL of ``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _running(values: str, start: str, each: str, step: str = "acc.at + x") -> str:
    """SQL of an array: for every value x the state so far (``acc.at``) from ``start``, as ``each`` takes it.

    An append copies the array, so this is for short ones: the callers run it
    over blocks of about the square root of the values.
    """
    return (f"aggregate({values}, named_struct('at', {start}, 'out', CAST(array() AS array<int>)), "
            f"(acc, x) -> named_struct('at', {step}, 'out', array_append(acc.out, {each})), acc -> acc.out)")


def greatest_before(values: str) -> str:
    """SQL of an array: the greatest of the non-negative values before each one (0 before the first)."""
    step = "greatest(acc.at, x)"
    return let("step", f"greatest(1, cast(ceil(sqrt(size({values}))) as int))", let(
        "tops", f"transform(sequence(0, cast((size({values}) - 1) div step as int)), b -> array_max(slice({values}, b * step + 1, step)))",
        let("starts", _running("tops", "0", "acc.at", step), f"""flatten(transform(starts, (start, b) -> {
            _running(f"slice({values}, b * step + 1, step)", "start", "acc.at", step)}))""")))


def span_digest(spans: str) -> Column:
    """``kind:start:end`` of each span, comma-joined; the spans are already in order."""
    return F.expr(f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')")
