"""Registered queries of the subpackage: ``QUERIES`` and their DuckDB twins ``SQL``.

Each query applies one operator, with production parameters, to its whole table.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (compression, importance, langid, licenses, lines, mixing, near, packing, phrases, repetition, spots,
               substring, toxicity)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """A vocabulary file of the installed tokenizers; BROWSEKIT_TOKENIZER names another one."""
    import public_tokenizers

    return os.environ.get("BROWSEKIT_TOKENIZER") or str(public_tokenizers.path(name))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition_stats(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "dup_line_chars")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), tokenizer_path())


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(documents(spark, sf_dir))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicate_classes(documents(spark, sf_dir))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = compression.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return compression.score_quality(docs, model)


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spots.neighbour_likeness(documents(spark, sf_dir))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.remove_boilerplate(documents(spark, sf_dir)).select(
        F.col("_row.doc_id").alias("doc_id"), F.col("_n_lines").alias("n_lines"),
        F.col("_n_removed").alias("n_removed"), F.col("_text").alias("text"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir)).drop("expressions")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_probabilities(documents(spark, sf_dir)).select(
        F.col("_row.doc_id").alias("doc_id"), F.col("_cell_source").alias("cell_source"),
        F.col("_cell_lang").alias("cell_lang"), F.col("_cell_topic").alias("cell_topic"),
        F.col("_tokens").alias("tokens"), F.round("_p", 6).alias("p"), F.col("_kept").alias("kept"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return langid.predict_languages(docs, langid.fit_languages(docs))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score_toxicity(docs, model)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_near_dedup": op3_near_dedup,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_quality_rules": op5_quality_rules,
    "op6_fingerprints": op6_fingerprints,
    "op7_line_dedup": op7_line_dedup,
    "op8_license_scan": op8_license_scan,
    "op9_mixing": op9_mixing,
    "op10_language_id": op10_language_id,
    "op11_toxicity": op11_toxicity,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_collocations": op13_collocations,
}
SQL: dict[str, str] = {
    "op7_line_dedup": lines.line_dedup_sql(),
    "op9_mixing": mixing.mixing_sql(),
    "op12_importance_resampling": importance.resample_sql(),
    "op13_collocations": phrases.collocations_sql(),
}
