"""Registered queries: near copies, quality rules and benchmark passages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridtide.llm.decontamination import contaminated
from gridtide.llm.near_dedup import near_classes
from gridtide.llm.quality_rules import fit_field, judge_quality


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_classes(docs).selectExpr("doc as doc_id", "class_id", "kept")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge_quality(docs, fit_field(docs, labels)).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "content_words", "base_failed", "kept",
    )


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contaminated(docs, benchmark).selectExpr("doc as doc_id", "item_id", "n_windows", "share")
