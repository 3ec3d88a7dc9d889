"""Value-weighted portfolios and long-short spreads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.guards import require_unique


def attach_groups(returns: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Returns joined to their sort groups; complete rows only.

    The reference's left join + drop-incomplete is an inner join.  Both sides
    are hash-partitioned on the keys (or the group side broadcast when the
    runtime size allows); a key (stock, period) holds at most one period of
    returns, so no key is hot.  The join is many-to-one: a repeated key among
    the groups fails the job.
    """
    return returns.join(require_unique(groups, keys, "sort groups"), keys, "inner").na.drop()


def vw_return(panel: DataFrame, size_col: str, other_cols: list[str], sep: str = "",
              date_col: str = "ret_date") -> DataFrame:
    """Value-weighted return of every (date, size group, other group) cell.

    ``sum(MC * ret) / sum(MC)``.  The panel is aggregated once to the finest
    cells (date, size, every label: at most 54 a date), with partial sums
    combined map-side, so a date holding many stocks never meets in one task.
    Only those few cells are exploded to one row per sort and summed again; the
    labels differ by prefix, so the portfolio name tells the sort.
    """
    mc = F.col("MC").cast("double")
    cells = (panel.groupBy(date_col, size_col, *other_cols)
             .agg(F.sum(mc * F.col("ret")).alias("_mr"), F.sum(mc).alias("_mc")))
    return (cells.select(date_col, size_col, "_mr", "_mc", F.explode(F.array(*other_cols)).alias("_other"))
            .groupBy(date_col, F.concat(F.col(size_col), F.lit(sep), F.col("_other")).alias("Port"))
            .agg(F.try_divide(F.sum("_mr"), F.sum("_mc")).alias("Portret"))
            .withColumnRenamed(date_col, "ret_date"))


def vw_weights(panel: DataFrame, group_cols: list[str], date_col: str = "ret_date") -> DataFrame:
    """Each stock's weight in its portfolio and its weighted return.

    Group totals come from an aggregation joined back on the group key (one
    row per date and cell), not from a window, so no date is sorted in one task.
    """
    keys = [date_col, *group_cols]
    totals = panel.groupBy(*keys).agg(F.sum(F.col("MC").cast("double")).alias("GMktCap"))
    return (panel.join(totals, keys)
            .withColumn("weight", F.try_divide(F.col("MC").cast("double"), F.col("GMktCap")))
            .withColumn("weight_ret", F.col("weight") * F.col("ret")))


def to_wide(long: DataFrame, ports: list[str]) -> DataFrame:
    """Long portfolio returns -> one column per portfolio.

    The explicit name list fixes the schema and skips the value-discovery job.
    A repeated cell (ret_date, Port) fails the job.
    """
    cells = require_unique(long.select("ret_date", "Port", "Portret"), ["ret_date", "Port"], "portfolio returns")
    return cells.groupBy("ret_date").pivot("Port", ports).agg(F.first("Portret"))


def _avg_diff(plus: list[str], minus: list[str], div: int) -> Column:
    s = F.lit(0.0)
    for p in plus:
        s = s + F.col(p)
    for m in minus:
        s = s - F.col(m)
    return s / F.lit(float(div))


def factor_spreads(wide: DataFrame) -> DataFrame:
    """HML, RMW, CMA, SMB3 and SMB5 from the 18 portfolios."""
    s1 = lambda k: [f"s1{x}" for x in k]
    s2 = lambda k: [f"s2{x}" for x in k]
    return wide.withColumns({
        "HML": _avg_diff(["s1bm3", "s2bm3"], ["s1bm1", "s2bm1"], 2),
        "RMW": _avg_diff(["s1op3", "s2op3"], ["s1op1", "s2op1"], 2),
        "CMA": _avg_diff(["s1inv1", "s2inv1"], ["s1inv3", "s2inv3"], 2),
        "SMB3": _avg_diff(s1(S.BM_LABELS), s2(S.BM_LABELS), 3),
        "SMB5": _avg_diff(s1(S.BM_LABELS + S.OP_LABELS + S.INV_LABELS),
                          s2(S.BM_LABELS + S.OP_LABELS + S.INV_LABELS), 9),
    })


def momentum_spread(wide: DataFrame) -> DataFrame:
    """UMD = (s1_mom3 + s2_mom3 - s1_mom1 - s2_mom1) / 2."""
    return wide.withColumn("UMD", _avg_diff(["s1_mom3", "s2_mom3"], ["s1_mom1", "s2_mom1"], 2))
