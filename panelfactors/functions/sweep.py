"""Ordered computations over range partitions: a sorted sweep with a carry between slices.

A running value over one long series (or over all rows) as a plain window sorts
the whole series in one task.  Here the rows are dealt by range into slices, the
running value is taken inside each (slice, series), each slice's end value is one
small row, and a window over these rows gives the value every slice starts with.
A slice is bounded by the range partitioning, whatever one series, date or value
holds: ties go on by a hash of the row, so they may be split as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

SLICE = "_slice"


def dealt(df: DataFrame, order: list, slices: int | None = None) -> DataFrame:
    """``df`` range-partitioned by ``order`` with its slice number, checkpointed (the ranges are sampled once)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *order).withColumn(SLICE, F.spark_partition_id()).checkpoint()


def inside(by: list[str], *order) -> Window:
    """Rows of one series in one slice, from the first to the current one."""
    return (Window.partitionBy(SLICE, *by).orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))


def before(by: list[str]) -> Window:
    """The slices of one series before the current one (as many rows as slices at most)."""
    return (Window.partitionBy(*[F.col(b) for b in by]).orderBy(SLICE)
            .rowsBetween(Window.unboundedPreceding, -1))


def with_carry(swept: DataFrame, carry: DataFrame, by: list[str], outer: bool = True) -> DataFrame:
    """``swept`` with the values its (slice, series) starts with; NULL keys meet each other."""
    right = carry.select(*[F.col(c).alias(f"_c_{c}") if c in (SLICE, *by) else F.col(c) for c in carry.columns])
    on = F.col(SLICE) == F.col(f"_c_{SLICE}")
    for b in by:
        on = on & F.col(b).eqNullSafe(F.col(f"_c_{b}"))
    return swept.join(right, on, "left" if outer else "inner").drop(f"_c_{SLICE}", *[f"_c_{b}" for b in by])


def asof_fill(left: DataFrame, right: DataFrame, on: str, by: list[str] | tuple = (),
              max_age_days: int | None = None, slices: int | None = None) -> DataFrame:
    """Each row of ``left`` with the last known values of ``right`` at or before its ``on``, per series ``by``.

    Every other column of ``right`` is a value, filled forward on its own: the
    last non-NULL one counts.  ``max_age_days`` (``on`` a date): an older value
    is not taken.  Rows of ``right`` with one key more than once: they count in
    the order of their values.  A NULL key or ``on`` finds nothing; no row of
    ``left`` is lost or repeated.
    """
    by, values = list(by), [c for c in right.columns if c != on and c not in by]
    if not values:
        raise ValueError("no value column on the right side")
    if clash := set(values) & set(left.columns):
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    known = right.where(F.col(on).isNotNull())
    for b in by:
        known = known.where(F.col(b).isNotNull())
    types = {f.name: f.dataType for f in known.schema.fields}
    rows = left.select(*by, on, F.lit(1).alias("_side"), *[F.lit(None).cast(types[v]).alias(v) for v in values],
                       F.struct(*[F.col(c) for c in left.columns]).alias("_row"))
    both = rows.unionByName(known.select(*by, on, F.lit(0).alias("_side"), *values), allowMissingColumns=True)
    both = dealt(both, [*by, on, "_side", *values, F.xxhash64("_row")], slices)

    # the right row that last had each value, as a struct ordered as the rows are
    state = {v: F.when(F.col(v).isNotNull(), F.struct(F.col(on).alias("at"), *[F.col(x).alias(f"v_{x}") for x in values]))
             for v in values}
    running = inside(by, on, "_side", *values)
    swept = both.select("*", *[F.last(s, ignorenulls=True).over(running).alias(f"_s_{v}") for v, s in state.items()])
    ends = both.groupBy(SLICE, *by).agg(*[F.max(s).alias(f"_e_{v}") for v, s in state.items()])
    carry = ends.select(SLICE, *by, *[F.last(f"_e_{v}", ignorenulls=True).over(before(by)).alias(f"_p_{v}") for v in values])
    out = with_carry(swept.where("_side = 1").select(SLICE, *by, on, "_row", *[f"_s_{v}" for v in values]), carry, by)

    def taken(v: str) -> Column:
        s = F.coalesce(F.col(f"_s_{v}"), F.col(f"_p_{v}"))
        got = s.getField(f"v_{v}")
        return got if max_age_days is None else F.when(F.datediff(F.col(on), s.getField("at")) <= max_age_days, got)
    return out.select(*[F.col("_row").getField(c).alias(c) for c in left.columns], *[taken(v).alias(v) for v in values])


def average_rank(df: DataFrame, value: str, by: list[str] | tuple = (), out: str = "rank",
                 descending: bool = True, slices: int | None = None) -> DataFrame:
    """``df`` with the rank of ``value`` inside ``by`` (or over all rows), equal values sharing their mean rank.

    NULL and NaN are not ranked.  The rows are dealt by value; each slice counts
    its values, the counts before a slice are one row a slice, and a value on
    both sides of a border belongs to its first slice.
    """
    by = list(by)
    v = F.col(value)
    if dict(df.dtypes)[value] in ("double", "float"):
        v = F.when(~F.isnan(v), v + F.lit(0.0).cast(dict(df.dtypes)[value]))   # -0.0 equals 0.0
    rows = df.select(*by, v.alias("_v"), F.struct(*[F.col(c) for c in df.columns]).alias("_row"))
    key = F.col("_v").desc() if descending else F.col("_v").asc()
    rows = dealt(rows, [*by, key, F.xxhash64("_row")], slices)
    held = rows.where(F.col("_v").isNotNull()).groupBy(SLICE, *by, "_v").agg(F.count(F.lit(1)).alias("_n"))
    each = held.groupBy(*by, "_v").agg(F.sum("_n").alias("_n"), F.min(SLICE).alias(SLICE))
    upto = F.sum("_n").over(inside(by, key))
    total = each.groupBy(SLICE, *by).agg(F.sum("_n").alias("_t"))
    start = total.select(SLICE, *by, F.coalesce(F.sum("_t").over(before(by)), F.lit(0)).alias("_start"))
    ranked = with_carry(each.select(SLICE, *by, "_v", "_n", upto.alias("_upto")), start, by)
    ranked = ranked.select(*by, "_v", (F.col("_start") + F.col("_upto") - (F.col("_n") - 1) / F.lit(2.0)).alias("_rank"))
    # back to the rows by (slice, value): a frequent value stays split over its slices
    keys = [*by, "_v"]
    here = held.select(SLICE, *keys).join(
        ranked.select(*[F.col(k).alias(f"_r_{k}") for k in keys], "_rank"),
        [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]).select(SLICE, *keys, "_rank")
    full = with_carry(rows, here, keys)
    return full.select(*[F.col("_row").getField(c).alias(c) for c in df.columns], F.col("_rank").alias(out))


def running_product(df: DataFrame, value: str, on: str, by: list[str] | tuple = (), out: str = "product",
                    base: float = 1.0, slices: int | None = None) -> DataFrame:
    """``df`` with ``base`` times the product of (1 + value) up to each row, per series, in two levels.

    A NULL value leaves its own row NULL and the product goes on after it.  Rows
    of one series at the same ``on`` count in the order of their values.
    """
    by = list(by)
    rows = df.select(*by, on, F.col(value).alias("_v"), F.struct(*[F.col(c) for c in df.columns]).alias("_row"))
    rows = dealt(rows, [*by, on, "_v", F.xxhash64("_row")], slices)
    factor = F.lit(1.0) + F.col("_v")
    swept = rows.select(SLICE, *by, "_v", "_row", F.product(factor).over(inside(by, on, "_v")).alias("_in"))
    ends = rows.groupBy(SLICE, *by).agg(F.product(factor).alias("_end"))
    carry = ends.select(SLICE, *by, F.product("_end").over(before(by)).alias("_start"))
    full = with_carry(swept, carry, by)
    got = F.when(F.col("_v").isNotNull(), F.coalesce("_start", F.lit(1.0)) * F.col("_in") * F.lit(base))
    return full.select(*[F.col("_row").getField(c).alias(c) for c in df.columns], got.alias(out))
