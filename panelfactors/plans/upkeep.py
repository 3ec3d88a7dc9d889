"""Upkeep of the monthly momentum factor table: a newer extract recomputes only what it touches.

The store holds four tables, each partitioned by ``period`` (a month): returns,
daily caps, momentum signals and factors, besides one row per stock with its first
and last month.  ``apply_extract`` compares a newer extract with the stored rows of
its months, and from the rows that differ derives

* the (stock, month) signals to form again: those of the changed row and of the
  stock's next 12 rows, as lags count rows and not months;
* the dirty months: of these signals, of changed returns, and the months after
  changed caps.

It reads only the months around the changes and the dirty ones, forms the signals of
the touched stocks and the cross-sections of the dirty months, and overwrites their
partitions.  Signals and factors are written before the rows they come from, so a
run that is cut off finds the same differences when it is run again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.dates import month_key
from ..operators.signals import momentum
from ..operators.snapshots import month_end_cap
from ..session import scratch_path
from . import pipelines as P

PERIOD = "period"
FACTORS = T.StructType([T.StructField("ret_date", T.DateType()),
                        *[T.StructField(c, T.DoubleType()) for c in (*S.MOM_PORTS, "UMD")]])
SIGNALS = T.StructType([T.StructField("stock_id", T.StringType()), T.StructField("mom_month", T.DateType()),
                        T.StructField("mom", T.DoubleType())])
STOCKS = T.StructType([T.StructField("stock_id", T.StringType()), T.StructField("first_month", T.DateType()),
                       T.StructField("last_month", T.DateType())])
TABLES = {"returns": S.MONTHRET, "caps": S.MARKETCAP, "signals": SIGNALS, "factors": FACTORS}


@dataclass
class Upkeep:
    """What an extract led to: the months recomputed, and the range of months read around the changes."""

    dirty: list
    read_from: object = None
    read_to: object = None


def _staged(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _overlay(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` with the rows of ``new`` in place of those with the same key."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)


class FactorStore:
    """The stored tables below one folder (shared by all executors)."""

    def __init__(self, spark: SparkSession, path: str, first_lag: int = S.MOM_FIRST_LAG, method: str | None = None):
        self.spark, self.path, self.lag, self.method = spark, path.rstrip("/"), first_lag, method

    def read(self, table: str, months: Column | None = None) -> DataFrame:
        """A stored table, or its partitions for which ``months`` (a condition on ``period``) holds."""
        schema = TABLES[table]
        full = T.StructType([*schema.fields, T.StructField("present", T.BooleanType()), T.StructField(PERIOD, T.DateType())])
        df = self.spark.read.schema(full).parquet(f"{self.path}/{table}")
        if months is not None:
            df = df.where(months)
        return df.where("present").select(*schema.fieldNames())

    def factors(self) -> DataFrame:
        return self.read("factors")

    def stocks(self) -> DataFrame:
        return self.spark.read.schema(STOCKS).parquet(f"{self.path}/stocks")

    def _write(self, table: str, df: DataFrame, period: Column, empty: DataFrame | None = None) -> None:
        """Overwrites the partitions that ``df`` has rows of; months of ``empty`` without rows keep a mark of absence."""
        out = df.select(*TABLES[table].fieldNames(), F.lit(True).alias("present"), period.alias(PERIOD))
        if empty is not None:
            gone = empty.join(out.select(PERIOD).distinct(), PERIOD, "left_anti").withColumn("present", F.lit(False))
            out = out.unionByName(gone, allowMissingColumns=True)
        (out.hint("rebalance", F.col(PERIOD)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(PERIOD).parquet(f"{self.path}/{table}"))

    def _write_stocks(self, returns: DataFrame, old: DataFrame | None) -> None:
        r = returns.groupBy("stock_id").agg(F.min("month").alias("first_month"), F.max("month").alias("last_month"))
        if old is not None:
            r = (r.unionByName(old).groupBy("stock_id")
                 .agg(F.min("first_month").alias("first_month"), F.max("last_month").alias("last_month")))
        _staged(r, "upkeep-stocks").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/stocks")

    def build(self, monthret: DataFrame, marketcap: DataFrame) -> "FactorStore":
        """Fills an empty store from whole tables."""
        signals = _staged(momentum(monthret, self.lag), "upkeep-signals")
        self._write("signals", signals, F.col("mom_month"))
        groups = P.momentum_sorts(signals, month_end_cap(marketcap), self.method)
        ret = monthret.select("stock_id", F.col("month").alias("ret_date"), "ret").na.drop()
        self._write("factors", P.momentum_wide(ret, groups), F.col("ret_date"))
        self._write("returns", monthret.select(*S.MONTHRET.fieldNames()), month_key("month"))
        self._write("caps", marketcap.select(*S.MARKETCAP.fieldNames()), month_key("date"))
        self._write_stocks(monthret, None)
        return self

    def _changed(self, table: str, extract: DataFrame, keys: list[str], value: str, day: str) -> DataFrame:
        """Rows of ``extract`` that are new or differ from the stored ones; only months of the extract are read."""
        low, high = extract.agg(F.min(month_key(day)), F.max(month_key(day))).first()
        extract = extract.select(*TABLES[table].fieldNames())
        old = self.read(table, F.col(PERIOD).between(F.lit(low), F.lit(high))).select(
            *keys, F.col(value).alias("_old"), F.lit(True).alias("_known"))
        changed = extract.join(old, keys, "left").where(F.col("_known").isNull() | ~F.col(value).eqNullSafe(F.col("_old")))
        return _staged(changed.select(*extract.columns), f"upkeep-changed-{table}")

    def _range(self, changed: DataFrame) -> tuple:
        """Months to read: until every touched stock has ``lag`` rows before its first and after its last change.

        Most stocks have a row each month, so the first try does; the range grows by half
        while gaps leave some stock short and the store has more of it.
        """
        low, high = changed.agg(F.min("month"), F.max("month")).first()
        touched = _staged(changed.groupBy("stock_id").agg(F.min("month").alias("from"), F.max("month").alias("to"))
                          .join(self.stocks(), "stock_id", "left"), "upkeep-touched")
        reach = self.lag
        while True:
            a, b = self.spark.range(1).select(F.add_months(F.lit(low), -reach), F.add_months(F.lit(high), reach)).first()
            rows = (self.read("returns", F.col(PERIOD).between(F.lit(a), F.lit(b))).where("ret IS NOT NULL")
                    .join(touched, "stock_id")
                    .groupBy("stock_id").agg(F.count_if(F.col("month") < F.col("from")).alias("n_before"),
                                             F.count_if(F.col("month") > F.col("to")).alias("n_after")))
            short = touched.join(rows, "stock_id", "left").where(
                ((F.coalesce("n_before", F.lit(0)) < self.lag) & (F.col("first_month") < F.lit(a)))
                | ((F.coalesce("n_after", F.lit(0)) < self.lag) & (F.col("last_month") > F.lit(b))))
            if short.isEmpty():
                return a, b
            reach += reach // 2

    def apply_extract(self, monthret: DataFrame, marketcap: DataFrame) -> Upkeep:
        """Takes over a newer extract (its rows replace stored ones of the same key) and recomputes what it touches."""
        new_r = self._changed("returns", monthret, ["stock_id", "month"], "ret", "month")
        new_c = self._changed("caps", marketcap, ["date", "stock_id"], "market_value", "date")
        cap_months = new_c.select(month_key("date").alias(PERIOD)).distinct()
        dirty = cap_months.select(F.add_months(PERIOD, 1).alias(PERIOD))
        report = Upkeep([])
        formed = None
        if not new_r.isEmpty():
            report.read_from, report.read_to = self._range(new_r)
            near = self.read("returns", F.col(PERIOD).between(F.lit(report.read_from), F.lit(report.read_to)))
            near = near.join(new_r.select("stock_id").distinct(), "stock_id", "left_semi")
            rows = _staged(_overlay(near, new_r, ["stock_id", "month"]).join(
                new_r.select("stock_id", "month", F.lit(True).alias("changed")), ["stock_id", "month"], "left"), "upkeep-near")
            history = Window.partitionBy("stock_id").orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
            at = F.sum(F.col("ret").isNotNull().cast("int")).over(history)
            again = (rows.withColumn("at", at).withColumn("last", F.last(F.when(F.col("changed"), F.col("at")), True).over(history))
                     .where(F.col("changed") | (F.col("ret").isNotNull() & (F.col("at") - F.col("last") <= self.lag)))
                     .select("stock_id", F.col("month").alias("mom_month")))
            formed = _staged(again.join(momentum(rows.drop("changed"), self.lag), ["stock_id", "mom_month"], "left"), "upkeep-formed")
            dirty = dirty.unionByName(formed.select(F.col("mom_month").alias(PERIOD)))
        dirty = _staged(dirty.distinct(), "upkeep-dirty")
        report.dirty = sorted(r[0] for r in dirty.collect())   # months: bounded by the calendar
        if not report.dirty:
            return report

        here = F.col(PERIOD).isin(report.dirty)
        signals = self.read("signals", here)
        if formed is not None:
            signals = _overlay(signals, formed, ["stock_id", "mom_month"]).where("mom IS NOT NULL")
        signals = _staged(signals, "upkeep-signals")
        sorted_by = [r[0] for r in dirty.select(F.add_months(PERIOD, -1)).collect()]   # the months of their caps
        caps = _overlay(self.read("caps", F.col(PERIOD).isin(sorted_by)), new_c.where(month_key("date").isin(sorted_by)),
                        ["date", "stock_id"])
        ret = _overlay(self.read("returns", here), new_r.where(F.col("month").isin(report.dirty)), ["stock_id", "month"])
        groups = P.momentum_sorts(signals, month_end_cap(caps), self.method)
        factors = _staged(P.momentum_wide(ret.select("stock_id", F.col("month").alias("ret_date"), "ret").na.drop(), groups),
                          "upkeep-factors")
        ret_months = new_r.select(month_key("month").alias(PERIOD)).distinct()
        returns = _staged(_overlay(self.read("returns", F.col(PERIOD).isin([r[0] for r in ret_months.collect()])), new_r,
                                   ["stock_id", "month"]), "upkeep-returns")
        caps_all = _staged(_overlay(self.read("caps", F.col(PERIOD).isin([r[0] for r in cap_months.collect()])), new_c,
                                    ["date", "stock_id"]), "upkeep-caps")

        self._write("signals", signals, F.col("mom_month"), dirty)
        self._write("factors", factors, F.col("ret_date"), dirty)
        self._write_stocks(new_r, self.stocks())
        self._write("caps", caps_all, month_key("date"))
        self._write("returns", returns, month_key("month"))
        return report
