"""Bulk load of delimited files with a table of rejects.

One pass over the files: every record is either a typed row or a reject with its
file, its text and the reason.  Quoted fields may hold the separator, doubled
quotes and line ends.  Files with quoted line ends cannot be split, so a file is
one task's input (``quoted_newlines=False`` splits large files by lines).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.guards import fail_when
from ..session import scratch_path

RECORD = "_record"


def _reason(schema: T.StructType, options: dict[str, str]) -> Column:
    """Why a record could not be typed: the number of its fields, or the first field that does not fit its type."""
    text = ", ".join(f"`{f.name}` string" for f in schema.fields) + f", `{RECORD}_bad` string"
    fields = F.from_csv(F.col(RECORD), text, options | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": f"{RECORD}_bad"})
    reason = F.lit("not readable")
    for f in reversed(schema.fields):
        if not isinstance(f.dataType, T.StringType):
            field = fields.getField(f.name)
            reason = F.when(field.isNotNull() & field.try_cast(f.dataType).isNull(),
                            F.lit(f"{f.name}: not a {f.dataType.simpleString()}")).otherwise(reason)
    return F.when(fields.getField(f"{RECORD}_bad").isNotNull(), F.lit("number of fields")).otherwise(reason)


def bulk_load(spark: SparkSession, path: str, schema: T.StructType, header: bool = True, sep: str = ",",
              quoted_newlines: bool = True, max_reject_share: float | None = None,
              null_value: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of the files at ``path``.

    ``rows`` has ``schema``; ``rejects`` is file, record (its text), reason.
    Both come from one stored parse, so the files are read once.  A missing
    field (empty, or ``null_value``) is NULL, not a reject.  With
    ``max_reject_share``, reading the rows fails when more of the records are
    rejects.
    """
    options = {"sep": sep, "quote": '"', "escape": '"', "encoding": "UTF-8"}
    if null_value is not None:
        options["nullValue"] = null_value
    read = T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())])
    parsed = (spark.read.options(**options, header=str(header).lower(), multiLine=str(quoted_newlines).lower(), mode="PERMISSIVE",
                                 columnNameOfCorruptRecord=RECORD, enforceSchema="true")
              .schema(read).csv(path)
              .select(*[F.col(f.name) for f in schema.fields], RECORD, F.col("_metadata.file_path").alias("_file"),
                      F.col(RECORD).isNotNull().alias("_reject")))
    out = scratch_path(spark, "bulk-load")
    parsed.write.partitionBy("_reject").parquet(out)
    stored = spark.read.schema(T.StructType([*read.fields, T.StructField("_file", T.StringType()),
                                             T.StructField("_reject", T.BooleanType())])).parquet(out)
    rows = stored.where(~F.col("_reject"))
    rejects = stored.where("_reject").select(F.col("_file").alias("file"), F.col(RECORD).alias("record"),
                                             _reason(schema, options).alias("reason"))
    if max_reject_share is not None:
        # two counts, one row, from the stored parse; every row meets this one row
        share = stored.agg((F.count_if("_reject") / F.count(F.lit(1))).alias("_share"))
        rows = rows.crossJoin(F.broadcast(share)).where(fail_when(
            F.col("_share") > max_reject_share, f"more than {max_reject_share:.2%} of the records are rejects"))
    return rows.select(*[f.name for f in schema.fields]), rejects
