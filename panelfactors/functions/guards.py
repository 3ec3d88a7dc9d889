"""Checks that fail the job instead of letting a repeated key pass silently."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fail_when(bad: Column, message: str) -> Column:
    """A filter condition that keeps every row and raises on a bad one."""
    return F.when(bad, F.raise_error(F.lit(message))).otherwise(F.lit(True))


def require_unique(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """``df`` unchanged if ``keys`` are unique in it; the job fails otherwise.

    One hash aggregate on the keys: no shuffle of its own where ``df`` is
    already dealt by them, or where a join on them follows.
    """
    rest = [c for c in df.columns if c not in keys]
    one = df.groupBy(*keys).agg(*[F.first(c).alias(c) for c in rest], F.count(F.lit(1)).alias("_rows"))
    return (one.filter(fail_when(F.col("_rows") > 1, f"{what}: repeated key ({', '.join(keys)})"))
            .select(*df.columns))
