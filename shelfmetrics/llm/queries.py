"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfmetrics.llm import (
    bpe,
    decontaminate,
    fingerprints,
    language,
    licences,
    line_dedup,
    merkle,
    neighbours,
    ngram_join,
    resampling,
    substring_dedup,
    suffix_dedup,
    warc,
)
from shelfmetrics.llm.common import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(table(spark, sf_dir, "pages"))


def op3_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.digest(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(table(spark, sf_dir, "documents"))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(table(spark, sf_dir, "documents"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.digest(table(spark, sf_dir, "documents"))


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.digest(table(spark, sf_dir, "documents"))


def op8_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.digest(table(spark, sf_dir, "documents"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest(table(spark, sf_dir, "documents"))


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.digest(table(spark, sf_dir, "embeddings"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_line_dedup,
        op2_warc,
        op3_license_scans,
        op4_substring_dedup,
        op5_suffix_array_dedup,
        op6_ngram_jaccard_join,
        op7_document_fingerprints,
        op8_byte_level_bpe,
        op9_language_id,
        op10_benchmark_decontamination,
        op11_merkle_manifest,
        op12_nearest_neighbours,
        op13_importance_resampling,
    )}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": line_dedup.ORACLE_SQL,
        "op2_warc": warc.ORACLE_SQL,
        "op4_substring_dedup": substring_dedup.ORACLE_SQL,
        "op5_suffix_array_dedup": suffix_dedup.ORACLE_SQL,
        "op6_ngram_jaccard_join": ngram_join.ORACLE_SQL,
        "op10_benchmark_decontamination": decontaminate.ORACLE_SQL,
        "op11_merkle_manifest": merkle.ORACLE_SQL,
        "op13_importance_resampling": resampling.ORACLE_SQL,
    }
