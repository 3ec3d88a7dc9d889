"""Return panels stored by the grouping year that the yearly sorts join them on.

A return dated July y to June y+1 belongs to the groups of December y-1.  Stored
under that year, a run over some years reads only their files: the calendar's range,
and any filter on the group table's year that the join passes on, become partition
filters of the scan; a filter on other columns of the group table prunes at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import rebalance_year

GROUP_YEAR = "group_year"


def write_facts(df: DataFrame, path: str, date_col: str, mode: str = "overwrite") -> None:
    """Stores returns by grouping year; with ``mode="overwrite"`` only the years in ``df`` are replaced."""
    (df.withColumn(GROUP_YEAR, rebalance_year(date_col)).hint("rebalance", F.col(GROUP_YEAR))
     .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(GROUP_YEAR).parquet(path))


def read_facts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The stored returns with their grouping year (the partition column)."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(GROUP_YEAR, T.DateType())])).parquet(path)
