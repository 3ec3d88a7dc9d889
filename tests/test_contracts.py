import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from panelfactors.functions.contracts import Contract, contract_report, enforce

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("d", T.IntegerType()), T.StructField("v", T.DoubleType())])
RULES = Contract("t", SCHEMA, ("k", "d"), ("k", "v"), least={"v": 0}, most={"v": 10}, longest={"k": 2}, allowed={"d": (1, 2)})


def counts(df, contract=RULES):
    return {r.rule: (r.violations, r.rows) for r in contract_report(df, contract).collect()}


def test_report_counts_each_rule(spark):
    nan = float("nan")
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 1, 2.0), ("a", 1, None), (None, 2, -1.0), (None, 2, 11.0), ("abc", 3, nan),
                                ("b", None, 10.0)], SCHEMA)
    assert counts(df) == {"k not null": (2, 7), "v not null": (1, 7), "v >= 0": (2, 7), "v <= 10": (2, 7),
                          "k up to 2 characters": (1, 7), "d in 1, 2": (1, 7), "key k, d": (3, 7)}
    assert set(counts(df.limit(0)).values()) == {(0, 0)}
    assert counts(df, Contract("u", SCHEMA, not_null=("k",))) == {"k not null": (2, 7)}


def test_enforce_and_types(spark):
    good = spark.createDataFrame([("a", 1, 1.0), ("b", 1, 2.0)], SCHEMA)
    assert enforce(good, RULES).count() == 2
    with pytest.raises(PySparkException, match="t: v >= 0: 1; key k, d: 1"):
        enforce(good.unionByName(spark.createDataFrame([("a", 1, -1.0)], SCHEMA)), RULES).collect()
    with pytest.raises(ValueError, match="d is int"):
        contract_report(good.withColumn("d", good.d.cast("long")), RULES)
