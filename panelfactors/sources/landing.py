"""Landing of response files, extract merge, code universe, CSV staging.

The reference downloads one JSON response per company and grows a table by
repeated concatenation.  Here the landed responses are one directory read with
an explicit schema: every file is a task's input, nothing loops on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .readers import read_json_envelopes


def land_json(spark: SparkSession, path: str, row_schema: T.StructType,
              out_path: str | None = None, partition_by: list[str] | None = None,
              multiline: bool = False) -> DataFrame:
    """Read landed ``{"data": [...]}`` responses as typed rows; optionally write parquet."""
    rows = read_json_envelopes(spark, path, row_schema, multiline=multiline)
    if out_path is None:
        return rows
    writer = rows.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(out_path)
    return spark.read.schema(rows.schema).parquet(out_path) if not partition_by else spark.read.parquet(out_path)


def write_envelopes(df: DataFrame, entity: str, path: str) -> None:
    """Write one ``{"data": [...]}`` line per entity (the shape of an API response).

    One entity's rows (a company's statements) are bounded by its history.
    """
    fields = [c for c in df.columns]
    env = (df.groupBy(entity)
           .agg(F.collect_list(F.struct(*[F.col(c) for c in fields])).alias("data"))
           .select(F.to_json(F.struct("data")).alias("value")))
    env.write.mode("overwrite").text(path)


def merge_extracts(extracts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Overlapping extracts -> one history; the later extract in the list wins.

    One ``max_by`` over the extract number for each column: an aggregate,
    combined map-side.  A key has at most one row per extract, so all columns
    come from the same row.
    """
    tagged = None
    for i, df in enumerate(extracts):
        t = df.withColumn("_extract", F.lit(i))
        tagged = t if tagged is None else tagged.unionByName(t)
    values = [c for c in extracts[0].columns if c not in keys]
    merged = tagged.groupBy(*keys).agg(*[F.max_by(c, "_extract").alias(c) for c in values])
    return merged.select(*extracts[0].columns)


def universe(tse: DataFrame, otc: DataFrame, delisted: DataFrame, code_length: int = 4) -> DataFrame:
    """Listed codes of both markets plus delisted codes of the given length.

    The reference builds the delisted list and then drops it (survivorship
    bias); here both lists are returned with a flag.
    """
    code = F.col("stock_id").cast("string")
    listed = (tse.select(code.alias("stock_id"), F.lit("TSE").alias("market"))
              .unionByName(otc.select(code.alias("stock_id"), F.lit("OTC").alias("market"))))
    gone = (delisted.select(code.alias("stock_id"))
            .filter(F.length("stock_id") == code_length)
            .select("stock_id", F.lit("DELISTED").alias("market")))
    return listed.unionByName(gone).withColumn("delisted", F.col("market") == "DELISTED")


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV with quoted text (the bulk-load staging format)."""
    df.write.mode("overwrite").options(header="true", sep=",", quote='"').csv(path)
