"""Typed readers for the reference's on-disk inputs (parquet, CSV, JSON envelopes).

Schemas are explicit; NaN becomes NULL on read so that every later step has one
missing marker.  The CSV readers rename the non-ASCII headers of the listing and
bond-yield files to the canonical names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..operators.profiling import clip_negative, null_sentinel

# Fixed header names of the source CSV files.
LISTING_HEADERS = {"公司代號": "stock_id", "產業類別": "industry"}
BOND_HEADERS = {"日期": "date", "收市": "close"}


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every floating column."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.col(f.name)
            out.append(F.when(~F.isnan(c), c).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType,
                 renames: dict[str, str] | None = None) -> DataFrame:
    """Parquet scan projected to ``schema`` (after renames), NaN -> NULL."""
    df = spark.read.parquet(path)
    if renames:
        df = df.withColumnsRenamed(renames)
    df = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    return nan_to_null(df)


def read_marketcap(spark, path):
    """Caps, negative ones as 0 (a negative cap would become a weight)."""
    return clip_negative(read_parquet(spark, path, S.MARKETCAP), "market_value")


def read_monthret(spark, path):
    # one extract names the return Mtrue_ret
    df = spark.read.parquet(path)
    if "Mtrue_ret" in df.columns:
        df = df.withColumnRenamed("Mtrue_ret", "ret")
    return nan_to_null(df.select(*[F.col(f.name).cast(f.dataType) for f in S.MONTHRET.fields]))


def read_dayret(spark, path):
    return read_parquet(spark, path, S.DAYRET)


def read_statement(spark, path):
    return read_parquet(spark, path, S.STATEMENT)


def read_index(spark, path):
    return read_parquet(spark, path, S.INDEX_PRICE)


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             headers: dict[str, str] | None = None, **options) -> DataFrame:
    """Header CSV read with an explicit schema; source headers renamed first."""
    opts = {"header": "true", "sep": ",", "quote": '"', "encoding": "UTF-8"}
    opts.update({k: str(v) for k, v in options.items()})
    if headers:
        # positional read of the named source columns, then rename
        raw = spark.read.options(**opts).csv(path)
        raw = raw.withColumnsRenamed({k: v for k, v in headers.items() if k in raw.columns})
        return raw.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    return spark.read.options(**opts).schema(schema).csv(path)


def read_return_csv(spark: SparkSession, path: str, schema: T.StructType = S.MONTHRET) -> DataFrame:
    """Staged returns; the marker of a missing return becomes NULL."""
    return null_sentinel(read_csv(spark, path, schema))


def read_listing(spark, path):
    return read_csv(spark, path, S.LISTING, LISTING_HEADERS)


def read_bond_yield(spark, path):
    return read_csv(spark, path, S.BOND_YIELD, BOND_HEADERS)


def read_delisted(spark, path):
    return read_csv(spark, path, S.DELISTED)


def read_json_envelopes(spark: SparkSession, path: str, row_schema: T.StructType,
                        multiline: bool = False) -> DataFrame:
    """``{"data": [...]}`` response files -> one row per element (typed)."""
    env = spark.read.schema(S.envelope(row_schema)).option("multiLine", str(multiline).lower()).json(path)
    return env.select(F.inline("data"))


def read_sql_query(spark: SparkSession, url: str, query: str, properties: dict[str, str] | None = None,
                   partition_column: str | None = None, lower_bound=None, upper_bound=None,
                   num_partitions: int | None = None) -> DataFrame:
    """A database query as a DataFrame (the reference reads its tables from MySQL).

    With ``partition_column`` and bounds, the read is split into
    ``num_partitions`` range queries that run in parallel; without them it is
    one task, so give them for any large table.  Not exercised in the tests:
    no database server is available there.
    """
    reader = spark.read.format("jdbc").option("url", url)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (reader.option("dbtable", f"({query}) AS q")
                  .option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions or 8)))
    else:
        reader = reader.option("query", query)
    return reader.load()
