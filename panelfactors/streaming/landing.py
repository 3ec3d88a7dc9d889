"""Incremental landing of response files with Structured Streaming.

New ``{"data": [...]}`` response files (a newer download of statements, caps
or prices) arrive in a folder.  A file-source stream picks up only files it
has not seen (tracked in the checkpoint), unpacks the envelopes and appends
each micro-batch to a parquet table partitioned by ``_epoch``.  Re-running a
batch after a failure overwrites just that epoch's partition, so the sink is
idempotent.  Readers get one row per key with the newest epoch winning - the
merge of overlapping extracts the reference leaves undone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..schemas import envelope
from ..sources.landing import merge_extracts


def _append_epoch(table_path: str):
    def write(batch: DataFrame, epoch_id: int) -> None:
        (batch.withColumn("_epoch", F.lit(epoch_id).cast("long"))
         .write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy("_epoch")
         .parquet(table_path))
    return write


def start_landing(spark: SparkSession, source_dir: str, row_schema: T.StructType,
                  table_path: str, checkpoint_path: str,
                  available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the landing stream; with ``available_now`` it processes what is there and stops."""
    reader = spark.readStream.schema(envelope(row_schema))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    rows = reader.json(source_dir).select(F.inline("data"))
    writer = (rows.writeStream.foreachBatch(_append_epoch(table_path))
              .option("checkpointLocation", checkpoint_path))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_landed(spark: SparkSession, table_path: str, keys: list[str]) -> DataFrame:
    """The landed table with one row per key, the newest epoch winning."""
    landed = spark.read.parquet(table_path)
    cols = [c for c in landed.columns if c != "_epoch"]
    tagged = landed.select(*cols, "_epoch")
    merged = tagged.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in cols if c not in keys]), F.col("_epoch")).alias("_row"))
    return merged.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in cols if c not in keys]).select(*cols)


__all__ = ["start_landing", "read_landed", "merge_extracts"]
