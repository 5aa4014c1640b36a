"""Registered query: packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridtide.llm.packing import pack_documents


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack_documents(docs, tokenizer_path()).withColumnRenamed("doc", "doc_id")
