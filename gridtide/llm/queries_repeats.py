"""Registered queries: repeated strings and passages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridtide.llm.suffix_array import drop_repeated_bytes
from gridtide.llm.substring import drop_repeated_words


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return drop_repeated_bytes(docs, width=50).select(
        "row.doc_id",
        F.col("cut.n_tokens").alias("n_bytes"),
        "cut.n_removed",
        "cut.n_spans",
        F.sha2("cut.kept", 256).alias("kept_sha256"),
    )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return drop_repeated_words(docs, width=50).select(
        "row.doc_id",
        F.col("cut.n_tokens").alias("n_words"),
        "cut.n_removed",
        F.sha2("cut.kept", 256).alias("kept_sha256"),
    )
