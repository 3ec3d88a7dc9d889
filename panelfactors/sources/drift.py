"""Union of extracts whose columns drifted: renamed, missing, extra or retyped.

Each extract is a folder of Parquet files with one schema, read from its footers.
Extracts of equal schema share one scan, so the plan grows with the number of
schemas and not of extracts.  A column's type is the narrowest that holds it in all
extracts; where there is none the union fails and names the column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXTRACT = "extract"
WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
#: decimal digits that each whole type needs
DIGITS = [3, 5, 10, 19]


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds the values of both; None if there is none."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StringType) or isinstance(b, T.StringType):
        return T.StringType() if all(isinstance(x, T.AtomicType) and not isinstance(x, T.BinaryType) for x in (a, b)) else None
    if a in WHOLE and b in WHOLE:
        return max(a, b, key=WHOLE.index)
    if isinstance(a, T.DecimalType) or isinstance(b, T.DecimalType):
        parts = []
        for x in (a, b):
            if isinstance(x, T.DecimalType):
                parts.append((x.precision - x.scale, x.scale))
            elif x in WHOLE:
                parts.append((DIGITS[WHOLE.index(x)], 0))
            else:
                return T.DoubleType() if isinstance(x, (T.DoubleType, T.FloatType)) else None
        left, scale = max(p[0] for p in parts), max(p[1] for p in parts)
        return T.DecimalType(left + scale, scale) if left + scale <= 38 else None
    floats = (T.FloatType, T.DoubleType)
    if isinstance(a, floats) or isinstance(b, floats):
        other = b if isinstance(a, floats) else a
        if isinstance(other, floats) or other in WHOLE[:3]:
            return T.DoubleType()
        return None   # a long is not exact in a double
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return None


def common_schema(schemas: dict[str, T.StructType], renames: dict[str, str] | None = None) -> T.StructType:
    """The columns of all extracts in order of appearance, each with its common type."""
    types: dict[str, T.DataType] = {}
    faults = []
    for name, schema in schemas.items():
        seen = set()
        for f in schema.fields:
            col = (renames or {}).get(f.name, f.name)
            if col in seen:
                faults.append(f"{name}: two columns for {col}")
            seen.add(col)
            got = wider(types[col], f.dataType) if col in types else f.dataType
            if got is None:
                faults.append(f"{col}: {types[col].simpleString()} and {f.dataType.simpleString()} (in {name})")
            else:
                types[col] = got
    if faults:
        raise ValueError("no common schema: " + "; ".join(faults))
    return T.StructType([T.StructField(c, t) for c, t in types.items()])


def read_drifting(spark: SparkSession, extracts: dict[str, str], renames: dict[str, str] | None = None,
                  columns: list[str] | None = None) -> DataFrame:
    """All rows of ``extracts`` (name -> folder) under one schema, with the name of their extract.

    ``renames``: source column -> column.  A column that an extract lacks is NULL
    there.  ``columns`` keeps only these (the others do not count for types).
    """
    schemas = {name: spark.read.parquet(path).schema for name, path in extracts.items()}
    if columns is not None:
        schemas = {n: T.StructType([f for f in s.fields if (renames or {}).get(f.name, f.name) in columns]) for n, s in schemas.items()}
    out = common_schema(schemas, renames)
    if columns is not None and (missing := set(columns) - set(out.fieldNames())):
        raise ValueError(f"columns in no extract: {sorted(missing)}")
    fields = [out[c] for c in columns] if columns is not None else out.fields
    alike: dict[str, list[str]] = {}
    for name, schema in schemas.items():
        alike.setdefault(T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields]).json(), []).append(name)
    scans = []
    for names in alike.values():
        schema = schemas[names[0]]
        source = {(renames or {}).get(f.name, f.name): f.name for f in schema.fields}
        for_name = F.lit(names[0])
        if len(names) > 1:
            # files lie below the folder of their extract; the longest folder name that fits
            file, for_name = F.col("_metadata.file_path"), F.lit(None).cast("string")
            for n in sorted(names, key=lambda n: len(extracts[n])):
                for_name = F.when(F.contains(file, F.lit(_folder(extracts[n]))), F.lit(n)).otherwise(for_name)
        df = spark.read.schema(schema).parquet(*[extracts[n] for n in names])
        scans.append(df.select(*[(F.col(f"`{source[f.name]}`") if f.name in source else F.lit(None)).cast(f.dataType).alias(f.name)
                                 for f in fields], for_name.alias(EXTRACT)))
    return reduce(DataFrame.unionByName, scans)


def _folder(path: str) -> str:
    """The path without its scheme, ending in a slash, as it occurs in its files' paths."""
    return path.split(":", 1)[-1].rstrip("/").replace("//", "/") + "/"
