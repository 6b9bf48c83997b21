"""The corpus pipeline: each stage calls one operator of tagweave.llm on all that the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tagweave.llm import decontam, langid, mixing, neardup, pii
from tagweave.llm.common import table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised stay."""
    return langid.keep_known(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles) stays."""
    return neardup.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item go."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with how often each is taken."""
    return mixing.take(docs)


STAGES = [
    ("language ID", language),
    ("SimHash near-dedup", near_copies),
    ("benchmark decontamination", benchmark),
    ("PII", personal_data),
    ("mixing sources", mixture),
]

#: SimHash and trained models have no SQL form; tests/llm holds run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs, _ = table(docs, f"stage{k}")
    return docs
