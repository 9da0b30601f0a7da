"""From raw documents to token ids, stage by stage.

Each stage works on all rows that the one before it kept, written as Parquet and read back. The last
returns ids; the others return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import stored
from tidemark.llm.decontaminate import drop_leaks
from tidemark.llm.quality_rules import keep_good
from tidemark.llm.secret_scan import redact_secrets
from tidemark.llm.sentencepiece_codec import encode_pieces
from tidemark.llm.simhash_dedup import keep_first


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (3 words a shingle, 2 bits), that with the smallest id."""
    return keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with live secrets replaced in the text."""
    return redact_secrets(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document."""
    return encode_pieces(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("tokens", tokens),
]

# Fingerprints and pieces are beyond SQL; tests/llm/test_pipeline.py compares run() with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of the documents that come through all stages."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
