"""Registered queries: language model scores, quality scores, urls and main texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridtide.llm.brown_scoring import score_texts
from gridtide.llm.extraction import extract_main_text
from gridtide.llm.ranking import fit_ranking, rank_quality
from gridtide.llm.url_filter import filter_urls


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held_out = F.crc32(F.col("doc").cast("string")) % 5 == 1
    return score_texts(docs, held_out).withColumnRenamed("doc", "doc_id")


#: verdict, host, path: what op5 is asked to apply
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return filter_urls(pages, URL_RULES).select("row.page_id", "host", "path", "rule", "verdict")


OP5_SQL = """
WITH rested AS (
    SELECT page_id,
           CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), hosted AS (
    SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw_host FROM rested
), parted AS (
    SELECT page_id,
           translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path
    FROM hosted
), judged AS (
    SELECT page_id, host, path,
           CASE
               WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/en/1%' THEN 'example.org/en/1'
               WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/es/%' THEN 'example.org/es/'
               WHEN ('.' || host) LIKE '%.org' AND path LIKE '/%' THEN 'org/'
               WHEN ('.' || host) LIKE '%.com' AND path LIKE '/fr/%' THEN 'com/fr/'
               WHEN ('.' || host) LIKE '%.com' AND path LIKE '/de/%' THEN 'com/de/'
           END AS rule
    FROM parted
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block'
            ELSE 'allow' END AS verdict
FROM judged
"""


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = F.crc32(F.col("doc").cast("string")) % 5 == 0
    ranked = rank_quality(docs, fit_ranking(docs, labels, ~held_out))
    return ranked.withColumn("doc", F.col("row.doc_id").cast("long")).select(
        F.col("doc").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score", "predicted",
    )


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract_main_text(pages).select(
        "row.page_id", "row.url", F.col("main_text").alias("text"),
        F.length("main_text").cast("long").alias("n_chars"),
    )
