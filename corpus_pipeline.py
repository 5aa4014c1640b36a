"""A corpus from raw documents to packed sequences.

Stages, each over all that the one before kept: quality rules (documents that the rules reject
go), near copies (one document of each class stays), repeated strings (cut out of the texts),
benchmark items (documents that hold one go), packing (whole documents to sequences).

In every stage: null texts count as empty; texts of any length are read whole; repeated rows and
rows that share an id are judged each by its own text; rows without id are never copies of others
nor contaminated; other columns, whatever their names, come through unchanged but for the last
stage; a table without rows gives none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridtide.llm.decontamination import drop_contaminated
from gridtide.llm.near_dedup import drop_near_copies
from gridtide.llm.packing import pack_documents
from gridtide.llm.quality_rules import fit_field, judge_quality
from gridtide.llm.queries_packing import tokenizer_path
from gridtide.llm.suffix_array import drop_repeated_bytes
from gridtide.staging import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules (null and empty texts do) or are mostly boilerplate go.
    Without labels of both kinds only the base rules decide."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge_quality(docs, fit_field(docs, labels)).where("kept").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays, that of the least doc_id; of rows with
    equal id and text one. Texts without words and rows without id stay."""
    return drop_near_copies(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes that a document of a smaller doc_id holds are cut out, and with them
    what is left of a character cut in two. Documents stay, also with an empty text; n_chars
    becomes the new length where something was cut."""
    was = F.col("row.text")
    kept = F.when(F.col("cut.n_removed") > 0, F.col("cut.kept_text")).otherwise(was)
    size = F.when(F.col("cut.n_removed") > 0, F.length(kept).cast("long")).otherwise(F.col("row.n_chars"))
    new = {"text": kept, "n_chars": size}
    columns = [new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns]
    return drop_repeated_bytes(docs, width=50).select(*columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, also with other numbers and names, or a long run of
    its words go. Empty texts and rows without id stay; without items all rows do."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences of 2048 tokens; an empty text is its closing
    token."""
    return pack_documents(docs, tokenizer_path()).withColumnRenamed("doc", "doc_id")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]
#: line labelling, signatures and token ids are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
