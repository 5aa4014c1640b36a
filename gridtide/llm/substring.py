"""Substring dedup: passages of words that an earlier document also holds.

Suffixes are split into memory-sized groups by prefixes of variable length: first by the words
their passages were sampled by (:mod:`windows`: a prefix of the sampled suffix), and a group
that is still too large by a prefix as long as the passage, a leaf of which only the least
document matters (an aggregate that no group size can burst). In a group, a suffix tree over all its suffixes is cut at the
depth of a passage: its nodes there, found as runs of neighbouring sorted suffixes that share
at least so many words, are the repeats; adjoining ones make the maximal repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gridtide.llm.repeats import MASK, cut_repeats, first_of_run, masks, sorted_windows
from gridtide.staging import stage

GRAM = 8
GROUP = 2000


def _trees(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [batch for batch in batches if batch.num_rows]
        if not found:
            return
        table = pa.Table.from_batches(found)
        # equal suffixes share their group, so groups may be sorted together
        row, offset, doc, new = sorted_windows(table, "words", width)
        later = doc > doc[first_of_run(new)]
        yield masks(table, row[later], offset[later])

    return run


def _prefix(words: int):
    head = F.substring("passage", 1, 8 * words)
    return F.struct(F.xxhash64(head).alias("a"), F.xxhash64(F.lit(1), head).alias("b"))


def resolve(width: int, group: int):
    def run(context: DataFrame) -> DataFrame:
        large = context.groupBy("key").count().where(F.col("count") > group).select("key")
        fits = context.join(large, "key", "left_anti")
        done = fits.repartition("key").mapInArrow(_trees(width), MASK)
        suffixes = stage(
            context.join(large, "key", "left_semi")
            .withColumn("at", F.explode(F.sequence(F.lit(0), F.col("place").bitwiseAND(63).cast("int"))))
            .select("doc", "mark", "place", "at",
                    F.expr(f"substring(context, at * 8 + 1, {8 * width})").alias("passage")),
            "large-groups",
        )
        # a prefix as long as the passage: a group is one leaf, its least document decides
        least = suffixes.groupBy(_prefix(width).alias("leaf")).agg(F.min("doc").alias("first_doc"))
        rest = (
            suffixes.withColumn("leaf", _prefix(width))
            .join(least, "leaf")
            .where("doc > first_doc")
            .select("doc", "mark", "place", F.expr("shiftleft(1L, at)").alias("mask"))
        )
        return done.unionByName(rest)

    return run


def drop_repeated_words(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 50,
    group: int = GROUP,
) -> DataFrame:
    """Every word under a passage of ``width`` words that also starts in a smaller id is cut.

    Returns ``row`` (struct of the input's columns) and ``cut`` (n_tokens = words, n_removed,
    n_spans, kept = words left, joined by a space). Words are runs of anything but ASCII white
    space, compared by 64-bit codes of their bytes. ``group`` is the number of sampled suffixes
    a task's group may hold; it changes the way, not the result. Null texts have no words;
    shorter texts stay whole; rows that repeat an id don't remove each other; rows without id
    stay whole; a table without rows gives none. Texts of any length are taken whole.
    """
    return cut_repeats(
        docs, id_column, text_column, "words", width, max(1, min(GRAM, width // 2)),
        resolve(width, group),
    )
