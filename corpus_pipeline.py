"""A corpus pipeline: each stage works on all its predecessor kept, and its decisions take effect."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strata.llm import jaccard_join, line_dedup, packing, quality_rules, secrets
from strata.tables import SCHEMAS, table
from strata.workspace import new_dir

#: No SQL: the stages use labelled holdouts, randomness tests and a tokenizer.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the risk-controlled rules."""
    return quality_rules.keep_documents(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the multi-line chunks that came before; documents of which no word is left go."""
    return line_dedup.drop_repeats(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose sets of five-word shingles have a similarity of 0.8 or more."""
    return jaccard_join.keep_first(docs, n=5, percent=80)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    return secrets.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 2048 tokens."""
    # Workers outlive a stage, so what packing remembers is taken from the memory of others.
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), remembered=300_000)


STAGES = [("quality_rules", quality_stage), ("line_dedup", line_stage), ("jaccard_join", near_duplicate_stage),
          ("secret_scan", secret_stage), ("packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are stored in the shared folder and read again by the next."""
    docs = spark.read.schema(SCHEMAS["documents"]).parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
