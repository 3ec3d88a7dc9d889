"""Sinks for factor and report tables (the reference writes CSV / Excel).

Parquet partitioned by year, so a reader of one period prunes the others, and
header CSV for spreadsheet and dashboard tools.  Both write from the executors;
nothing is gathered on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .landing import write_csv


def write_parquet_by_year(df: DataFrame, path: str, date_col: str = "ret_date", mode: str = "overwrite") -> None:
    """Parquet with a ``year`` partition column derived from ``date_col``."""
    (df.withColumn("year", F.year(F.col(date_col)))
       .write.mode(mode).partitionBy("year").parquet(path))


def read_year_range(spark, path: str, first_year: int, last_year: int) -> DataFrame:
    """Read back a year range; the filter on the partition column prunes files."""
    return spark.read.parquet(path).filter((F.col("year") >= first_year) & (F.col("year") <= last_year))


__all__ = ["write_parquet_by_year", "read_year_range", "write_csv"]
