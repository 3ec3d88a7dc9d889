"""Landing stream into a keyed table: one current row per key, kept by a state store.

A file-source stream unpacks ``{"data": [...]}`` responses.  The newest version
of each key is a streaming aggregate, so it lives in the state store and a late or
repeated older file changes nothing.  Every micro-batch emits the keys it touched;
the sink rewrites only the key buckets they fall in, under the batch's number.
The buckets of earlier batches stay until ``vacuum``, so a batch that is cut off
and replayed reads what it read before and overwrites only its own files.

Readers take each bucket's newest files: a choice of partitions, no aggregate over
the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..schemas import envelope
from ..session import scratch_path

BUCKET, EPOCH = "_bucket", "_epoch"


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _stored(spark: SparkSession, path: str, row_schema: T.StructType) -> DataFrame:
    schema = T.StructType([*row_schema.fields, T.StructField(EPOCH, T.LongType()), T.StructField(BUCKET, T.IntegerType())])
    return spark.read.schema(schema).parquet(path)


def _newest(stored: DataFrame) -> DataFrame:
    """The rows of each bucket's newest batch; the pairs come from partition values alone."""
    last = stored.groupBy(BUCKET).agg(F.max(EPOCH).alias(EPOCH))   # one row a bucket
    return stored.join(F.broadcast(last), [BUCKET, EPOCH])


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _merge(path: str, row_schema: T.StructType, keys: list[str], buckets: int):
    names = [f.name for f in row_schema.fields]

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        staged = scratch_path(spark, "upsert")
        batch.select(*names, bucket_of(keys, buckets).alias(BUCKET)).write.parquet(staged)
        changed = spark.read.parquet(staged)
        new = changed
        if exists(spark, path):
            touched = changed.select(BUCKET).distinct()   # at most ``buckets`` rows
            old = _newest(_stored(spark, path, row_schema).where(F.col(EPOCH) < epoch)).join(F.broadcast(touched), BUCKET, "left_semi")
            same = F.lit(True)
            for k in keys:
                same = same & old[k].eqNullSafe(changed[k])
            new = changed.unionByName(old.join(changed, (old[BUCKET] == changed[BUCKET]) & same, "left_anti").select(*names, BUCKET))
        (new.withColumn(EPOCH, F.lit(epoch).cast("long")).repartition(BUCKET)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(EPOCH, BUCKET).parquet(path))
    return write


def start_upsert(spark: SparkSession, source_dir: str, row_schema: T.StructType, keys: list[str], path: str,
                 checkpoint_path: str, version: Column | None = None, buckets: int = 16,
                 max_files_per_trigger: int | None = None, available_now: bool = True) -> StreamingQuery:
    """Starts the stream; with ``available_now`` it takes the files that are there and stops.

    ``version``: orders the downloads (default: the file's modification time);
    within one version the greater row counts.  The same ``checkpoint_path``
    must go with the same ``path``.
    """
    values = [f.name for f in row_schema.fields if f.name not in keys]
    reader = spark.readStream.schema(envelope(row_schema)).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    version = F.col("_metadata.file_modification_time") if version is None else version
    rows = reader.json(source_dir).select(version.alias("_version"), F.explode("data").alias("_r")).select("_version", "_r.*")
    newest = (rows.groupBy(*keys).agg(F.max(F.struct("_version", *values)).alias("_n"))
              .select(*keys, *[F.col("_n").getField(v).alias(v) for v in values]))
    writer = (newest.writeStream.outputMode("update").foreachBatch(_merge(path, row_schema, keys, buckets))
              .option("checkpointLocation", checkpoint_path))
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()


def read_current(spark: SparkSession, path: str, row_schema: T.StructType) -> DataFrame:
    """The table as it stands: one row per key."""
    return _newest(_stored(spark, path, row_schema)).select(*[f.name for f in row_schema.fields])


def stale(spark: SparkSession, path: str, row_schema: T.StructType) -> DataFrame:
    """_epoch, _bucket: the partitions that a newer batch has replaced (for ``vacuum``)."""
    parts = _stored(spark, path, row_schema).select(EPOCH, BUCKET).distinct()
    last = parts.groupBy(BUCKET).agg(F.max(EPOCH).alias("_last"))
    return parts.join(last, BUCKET).where(F.col(EPOCH) < F.col("_last")).select(EPOCH, BUCKET)


def vacuum(spark: SparkSession, path: str, row_schema: T.StructType) -> int:
    """Removes replaced partitions (between runs of the stream, with no reader at work); their number."""
    jvm = spark.sparkContext._jvm
    gone = stale(spark, path, row_schema).collect()   # partitions, not rows
    for r in gone:
        p = jvm.org.apache.hadoop.fs.Path(f"{path}/{EPOCH}={r[EPOCH]}/{BUCKET}={r[BUCKET]}")
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    return len(gone)
