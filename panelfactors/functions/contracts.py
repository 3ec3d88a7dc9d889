"""Declared table contracts, checked in one pass over the table.

A contract names a table's columns with their types, its key, and rules on values.
The rules are counted by one aggregate grouped by the key (combined before the
shuffle), so a repeated key and a bad value are found in the same job.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T



@dataclass(frozen=True)
class Contract:
    """``least`` and ``most`` are inclusive bounds, ``longest`` the length of a text, ``allowed`` the values of a column."""

    name: str
    schema: T.StructType
    key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    least: dict = field(default_factory=dict)
    most: dict = field(default_factory=dict)
    longest: dict = field(default_factory=dict)
    allowed: dict = field(default_factory=dict)

    def rules(self) -> list[tuple[str, Column]]:
        """(rule, whether a row breaks it); NULL only breaks ``not null``, NaN breaks bounds."""
        out = [(f"{c} not null", F.col(c).isNull()) for c in self.not_null]
        out += [(f"{c} >= {v}", (F.col(c) < v) | _nan(self, c)) for c, v in self.least.items()]
        out += [(f"{c} <= {v}", (F.col(c) > v) | _nan(self, c)) for c, v in self.most.items()]
        out += [(f"{c} up to {n} characters", F.char_length(c) > n) for c, n in self.longest.items()]
        out += [(f"{c} in {', '.join(map(str, v))}", ~F.col(c).isin(*v)) for c, v in self.allowed.items()]
        return [(name, F.coalesce(bad, F.lit(False))) for name, bad in out]


def _nan(contract: Contract, column: str) -> Column:
    double = isinstance(contract.schema[column].dataType, (T.DoubleType, T.FloatType))
    return F.isnan(column) if double else F.lit(False)


def type_faults(df: DataFrame, contract: Contract) -> list[str]:
    """Columns that are missing or of another type than declared."""
    has = {f.name: f.dataType for f in df.schema.fields}
    return [f"{f.name} is {f.dataType.simpleString()}" for f in contract.schema.fields if has.get(f.name) != f.dataType]


def _counts(df: DataFrame, contract: Contract) -> tuple[DataFrame, list[str]]:
    """One row: n rows, and v0, v1 ... violations of each rule."""
    if faults := type_faults(df, contract):
        raise ValueError(f"{contract.name}: not so: {'; '.join(faults)}")
    rules = contract.rules()
    aggs = [F.count(F.lit(1)).alias("n"), *[F.count_if(bad).alias(f"v{i}") for i, (_, bad) in enumerate(rules)]]
    names = [name for name, _ in rules]
    if not contract.key:
        return df.agg(*aggs), names
    each = df.groupBy(*contract.key).agg(*aggs)
    total = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", *[f"v{i}" for i in range(len(names))])]
    spare = F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias(f"v{len(names)}")
    return each.agg(*total, spare), [*names, f"key {', '.join(contract.key)}"]


def contract_report(df: DataFrame, contract: Contract) -> DataFrame:
    """table, rule, violations, rows: one row per rule.  A repeated key counts its rows beyond the first."""
    counts, names = _counts(df, contract)
    each = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"v{i}").alias("violations")) for i, n in enumerate(names)])
    return counts.select(F.lit(contract.name).alias("table"), F.col("n").alias("rows"), F.explode(each).alias("_r")).select(
        "table", "_r.rule", "_r.violations", "rows")


def enforce(df: DataFrame, contract: Contract) -> DataFrame:
    """``df`` unchanged; reading it fails when a rule is broken."""
    counts, names = _counts(df, contract)
    broken = F.concat_ws("; ", *[F.when(F.col(f"v{i}") > 0, F.concat(F.lit(f"{n}: "), F.col(f"v{i}"))) for i, n in enumerate(names)])
    # one row, joined to all rows
    verdict = counts.select(broken.alias("_broken"))
    bad = F.col("_broken") != ""
    return (df.crossJoin(F.broadcast(verdict)).where(F.when(bad, F.raise_error(F.concat(F.lit(f"{contract.name}: "), F.col("_broken"))))
                                                     .otherwise(F.lit(True))).select(*df.columns))


