"""Profiling and cleaning (U32-U35) plus ordered head."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.stats import percentiles

DESCRIBE_STATS = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]
QUARTILES = [0.25, 0.5, 0.75]


def item_counts(statement: DataFrame) -> DataFrame:
    """Non-null ``origin_name`` count per name, largest first (U32)."""
    return (statement.groupBy("origin_name").agg(F.count("origin_name").alias("counts"))
            .select("counts", "origin_name").orderBy(F.col("counts").desc(), F.col("origin_name")))


def profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """count / mean / std / min / quartiles / max per numeric column.

    Quartiles are linearly interpolated and exact (not the approximate
    quartiles of ``summary()``), computed by distributed order-statistic
    selection, so no column is gathered into one task.  One row per statistic,
    one column per input column.
    """
    moments = df.agg(*[a for c in cols for a in (
        F.count(c).cast("double").alias(f"{c}__count"),
        F.avg(c).alias(f"{c}__mean"),
        F.stddev_samp(c).alias(f"{c}__std"),
        F.min(F.col(c).cast("double")).alias(f"{c}__min"),
        F.max(F.col(c).cast("double")).alias(f"{c}__max"),
    )])
    q = percentiles(df, [], {c: c for c in cols}, QUARTILES)
    wide = moments.crossJoin(q)  # one row x one row
    stat_cols = {"count": "count", "mean": "mean", "std": "std", "min": "min",
                 "25%": "p0", "50%": "p1", "75%": "p2", "max": "max"}
    rows = F.array(*[
        F.struct(F.lit(label).alias("summary"),
                 *[F.col(f"{c}__{key}").alias(c) for c in cols])
        for label, key in stat_cols.items()
    ])
    return wide.select(F.inline(rows))


def null_counts(df: DataFrame) -> DataFrame:
    """NULL count per column, one row per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "null_count")


def null_sentinel(df: DataFrame, col: str = "ret", sentinel: float = S.MISSING_RETURN_SENTINEL) -> DataFrame:
    """Value ``sentinel`` -> NULL."""
    return df.withColumn(col, F.nullif(F.col(col), F.lit(sentinel)))


def fill_sentinel(df: DataFrame, col: str = "ret", sentinel: float = S.MISSING_RETURN_SENTINEL) -> DataFrame:
    """NULL -> ``sentinel`` (the CSV staging step the sentinel undoes)."""
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(sentinel)))


def clip_negative(df: DataFrame, col: str) -> DataFrame:
    """Negative values -> 0, NULL kept (U35).  Not ``greatest``: it would turn NULL into 0."""
    c = F.col(col)
    return df.withColumn(col, F.when(c < 0, F.lit(0).cast(df.schema[col].dataType)).otherwise(c))


def top_rows(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in an explicit order (a top-k: per-partition top-n, then merged)."""
    return df.orderBy(*order).limit(n)
