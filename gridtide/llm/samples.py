"""Labelled documents to fit a model on: their marks, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LIMIT = 3000


def marks(labels: DataFrame, label: str, where: Column | None = None) -> DataFrame:
    """(doc, mark): the documents labelled 0 or 1 that fulfil ``where``, a condition on the column
    ``doc``; one labelled both ways counts as 0. Null labels and ids are left out."""
    known = labels.select(
        labels["doc_id"].cast("long").alias("doc"), labels[label].cast("int").alias("mark")
    ).where("doc is not null and mark in (0, 1)")
    if where is not None:
        known = known.where(where)
    return known.groupBy("doc").agg(F.min("mark").alias("mark"))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, limit: int = LIMIT,
    where: Column | None = None,
) -> DataFrame:
    """(doc, text as bytes, mark): up to ``limit`` labelled documents of each mark, 0 and 1,
    those whose hashed ids are smallest. ``where`` is a condition on the column ``doc``.

    Labels that are null or neither 0 nor 1, and null ids, are left out; a document labelled
    both ways counts as 0; one with several texts takes part with each.
    """
    known = marks(labels, label, where)
    text = F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary")
    rows = docs.select(docs["doc_id"].cast("long").alias("doc"), text.alias("text"))
    chosen = None
    for mark in (0, 1):
        few = known.where(F.col("mark") == mark).orderBy(F.xxhash64("doc"), "doc").limit(limit)
        chosen = few if chosen is None else chosen.unionByName(few)
    # at most 2 * limit ids
    return rows.join(F.broadcast(chosen), "doc").select("doc", "text", "mark")
