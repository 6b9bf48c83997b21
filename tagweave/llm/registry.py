"""Queries of this subpackage and the SQL that gives the same rows, where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tagweave.llm import ann, chaining, decontam, html_extract, langid, mixing, pii, simhash, tokencount, toxicity
from tagweave.session import ship


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.op1(_read(spark, sf_dir, "embeddings"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.op2(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op4(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.op5(_read(spark, sf_dir, "documents"))


def op6_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.op6(_read(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.op7(_read(spark, sf_dir, "documents"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.op8(_read(spark, sf_dir, "pages"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.op9(_read(spark, sf_dir, "documents"))


def op10_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.op10(_read(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_ann, op2_decontaminate, op3_mix_sources, op4_toxicity, op5_token_counts, op6_pii_spans, op7_simhash, op8_html, op9_language, op10_passages, pipeline]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op2_decontaminate": decontam.ORACLE, "op3_mix_sources": mixing.ORACLE}
