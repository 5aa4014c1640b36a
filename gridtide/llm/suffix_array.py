"""Suffix-array dedup: byte strings of a given length that an earlier document also holds.

Suffixes are range-partitioned by splitters that Spark samples, sorted in their bucket by a
multikey quicksort (eight bytes at a time, only what is still tied goes on) and compared with
their neighbours; what touches a bucket's edge is compared across buckets.

Not every suffix is shuffled: suffixes are sampled by content (:mod:`windows`), so that equal
strings sample equal suffixes, and each carries the bytes of all strings it stands for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gridtide.llm import repeats
from gridtide.staging import stage

GRAM = 20
EDGE_ROWS = 100_000
SORTED = "doc long, mark binary, place long, mask long, edge boolean, at int, string binary"


def _slices(contexts: pa.ChunkedArray, offset: np.ndarray, width: int) -> pa.Array:
    """``width`` bytes of each context, each from its own offset on."""
    joined = contexts.combine_chunks()
    if not len(joined):
        return pa.array([], pa.binary())
    begin = np.frombuffer(joined.buffers()[1], dtype=np.int32)[joined.offset: joined.offset + len(joined)]
    data = np.frombuffer(joined.buffers()[2], dtype=np.uint8)
    at = (begin + offset)[:, None] + np.arange(width)
    ends = np.arange(len(joined) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(
        pa.binary(), len(joined), [None, pa.py_buffer(ends), pa.py_buffer(data[at].tobytes())]
    )


def _bucket(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [batch for batch in batches if batch.num_rows]
        if not found:
            return
        table = pa.Table.from_batches(found)
        row, offset, doc, new = repeats.sorted_windows(table, "bytes", width)
        later = doc > doc[repeats.first_of_run(new)]
        inside = repeats.masks(table, row[later], offset[later])
        n = inside.num_rows
        yield pa.RecordBatch.from_arrays(
            [*inside.columns, pa.array(np.zeros(n, dtype=bool)), pa.nulls(n, pa.int32()),
             pa.nulls(n, pa.binary())],
            names=["doc", "mark", "place", "mask", "edge", "at", "string"],
        )
        # strings of the first and the last key may go on in the bucket before or after
        key = table.column("key").to_numpy()
        border = ((key == key.min()) | (key == key.max()))[row] & ~later
        at = np.flatnonzero(border)
        for some in np.array_split(at, max(1, len(at) // EDGE_ROWS)):
            of = pa.array(row[some])
            strings = _slices(table.column("context").take(of), offset[some], width)
            n = len(some)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[some]), table.column("mark").take(of).combine_chunks(),
                 table.column("place").take(of).combine_chunks(), pa.nulls(n, pa.int64()),
                 pa.array(np.ones(n, dtype=bool)), pa.array(offset[some].astype(np.int32)), strings],
                names=["doc", "mark", "place", "mask", "edge", "at", "string"],
            )

    return run


def resolve(width: int):
    """Sort the strings of open segments and compare neighbours, also across buckets."""

    def run(context: DataFrame) -> DataFrame:
        buckets = stage(
            repeats.dealt(context, "key", "doc").mapInArrow(_bucket(width), SORTED),
            "suffix-buckets",
        )
        edge = buckets.where("edge")
        first = edge.groupBy("string").agg(F.min("doc").alias("first_doc"))
        across = (
            edge.join(first, "string")
            .where("doc > first_doc")
            .select("doc", "mark", "place", F.expr("shiftleft(1L, at)").alias("mask"))
        )
        return buckets.where("not edge").select("doc", "mark", "place", "mask").unionByName(across)

    return run


def drop_repeated_bytes(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 50
) -> DataFrame:
    """Every byte under a ``width``-byte string that also starts in a smaller id is cut.

    Returns ``row`` (struct of the input's columns) and ``cut`` (n_tokens = bytes, n_removed,
    n_spans, kept = bytes left). Null texts are empty; texts shorter than ``width`` stay whole;
    rows that repeat an id don't remove each other, whatever their texts; rows without id stay whole; a table
    without rows gives none. Texts of any length are taken whole.
    """
    gram = max(1, min(GRAM, width // 2))
    return repeats.cut_repeats(
        docs, id_column, text_column, "bytes", width, gram, resolve(width)
    )
