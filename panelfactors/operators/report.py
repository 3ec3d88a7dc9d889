"""Long form, cumulative index, ranking and report table.

Inputs here are factor tables: one row per date and series (31 series), so
per-series windows hold one series' dates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..session import ensure_checkpoint_dir


def to_long(wide: DataFrame, id_col: str = "ret_date") -> DataFrame:
    """Wide factor table -> (ret_date, Port, Portret), NULL cells kept."""
    values = [c for c in wide.columns if c != id_col]
    return wide.unpivot([id_col], values, "Port", "Portret")


def cumulative_index(long: DataFrame, base: float = 100.0) -> DataFrame:
    """Per series: base x running product of (1 + r) by date.

    A NULL return leaves its own row NULL and the product continues after it.
    """
    w = (Window.partitionBy("Port").orderBy("ret_date")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    run = F.product(F.lit(1.0) + F.col("Portret")).over(w) * F.lit(base)
    return long.withColumn("cumret", F.when(F.col("Portret").isNotNull(), run))


def final_rank(cum: DataFrame) -> DataFrame:
    """Rank series by their last cumulative value, descending, ties averaged.

    The last row of a series decides; if its value is NULL the series is
    unranked.  One row per series, so the ranking window is over a handful of
    rows.
    """
    last = cum.groupBy("Port").agg(F.max_by("cumret", "ret_date").alias("_last"))
    ranked = last.filter(F.col("_last").isNotNull())
    w_all = Window.orderBy(F.col("_last").desc())
    w_tie = Window.partitionBy("_last")
    avg_rank = F.rank().over(w_all).cast("double") + (F.count(F.lit(1)).over(w_tie) - 1) / F.lit(2.0)
    ranked = ranked.select("Port", avg_rank.alias("Portrank"))
    return last.select("Port").join(ranked, "Port", "left")


def attach_benchmark(cum: DataFrame, port: str = S.BENCHMARK_PORT) -> DataFrame:
    """The benchmark series' cumulative value beside every row of the same date."""
    bench = cum.filter(F.col("Port") == port).select("ret_date", F.col("cumret").alias("MKT_cumret"))
    return cum.join(bench, "ret_date", "left")


def report(long: DataFrame) -> DataFrame:
    """Report table: Portret in percent, cumret, Portrank, MKT_cumret.

    The cumulative table (one row per date and series, bounded by the
    calendar) feeds three branches - rows, final ranks, benchmark - so it is
    checkpointed once to the shared checkpoint folder (reliable, cuts the
    lineage) instead of re-running the factor pipeline per branch.
    """
    ensure_checkpoint_dir(long.sparkSession)
    cum = cumulative_index(long).checkpoint(eager=True)
    ranks = final_rank(cum)
    out = attach_benchmark(cum).join(ranks, "Port", "left")
    return out.select("ret_date", "Port", (F.col("Portret") * 100).alias("Portret"),
                      "cumret", "Portrank", "MKT_cumret")


def chart_feed(long: DataFrame, factors: list[str] = S.CHART_FACTORS) -> DataFrame:
    """The named factors in percent."""
    return (long.filter(F.col("Port").isin(factors))
            .select(F.col("ret_date").cast("date").alias("ret_date"), "Port",
                    (F.col("Portret") * 100).alias("Portret")))


def chart_bounds(feed: DataFrame, pad_months: int = 2) -> DataFrame:
    """Period text and axis range (first / last date -/+ ``pad_months``)."""
    agg = feed.agg(F.min("ret_date").alias("_lo"), F.max("ret_date").alias("_hi"))
    return agg.select(
        F.date_format("_lo", "yyyy-MM-dd").alias("period_start"),
        F.date_format("_hi", "yyyy-MM-dd").alias("period_end"),
        F.add_months("_lo", -pad_months).alias("axis_start"),
        F.add_months("_hi", pad_months).alias("axis_end"),
    )
