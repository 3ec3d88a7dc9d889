"""The corpus pipeline: each stage reads the Parquet table that the one before wrote.

quality rules -> one document of each group of near copies -> secrets redacted
-> sources mixed to their target weights -> texts encoded and decoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelfactors.llm.bpe_codec import bpe, tokenizer_path
from panelfactors.llm.common import table, written
from panelfactors.llm.ngram_join import one_per_component
from panelfactors.llm.quality_rules import keep_good
from panelfactors.llm.secret_scan import redact
from panelfactors.llm.source_mix import mix


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their boilerplate lines."""
    return keep_good(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the least id."""
    return one_per_component(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, secrets replaced by a mark."""
    return redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (0 to 2 times)."""
    return mix(docs)


def bpe_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document of the mix."""
    return bpe(docs, tokenizer_path())


STAGES = [("quality_rules", quality_rules), ("ngram_join", ngram_join), ("secret_scan", secret_scan),
          ("source_mix", source_mix), ("bpe_codec", bpe_codec)]

#: SQL can express neither the mix nor the encoding; the stages are tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
