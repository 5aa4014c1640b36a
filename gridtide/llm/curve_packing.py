"""Packing along a space-filling curve: a sequence holds documents that are alike.

1. ``with_points``: a document's words are hashed into a vector of ``BUCKETS`` weights (a word's
   weight grows with the logarithm of its count), scaled to length one and projected to ``DIMS``
   numbers by a fixed random matrix. Documents and their points are written once.
2. Mean and spread of each number over all documents place a point in a grid of
   ``2 ** BITS`` cells a side with about equally many points along each side; its key is the
   cell's place on the Hilbert curve, so that near keys are near points.
3. Documents are range-sorted by that key. The curve is cut into ``1 << CELL_BITS`` stretches whose
   bytes are summed over all documents; from these sums follow ranges of keys with equally many
   bytes, one per task. What lies on a cut, which may be a large group of copies with one key,
   is dealt to the ranges beside it in proportion, so no key is too hot for one task.
4. A task takes its stretch of the curve document by document and fills one sequence after the
   other; a document goes on in the next one where it must. Every sequence is full but the last
   of a stretch, and that one is split into sequences whose sizes are powers of two, which need
   no padding either.

A task holds one batch of documents and one open sequence.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import erf

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from gridtide.llm.rows import column, text_of
from gridtide.llm.tokens import encoder, kept
from gridtide.llm.windows import text_blocks, word_codes, words_of
from gridtide.staging import stage

LENGTH = 2048
BUCKETS = 1 << 12
DIMS = 4
BITS = 12
SEED = 20
CELL_BITS = 14
TASK_BYTES = 32 << 20
END = (1).to_bytes(4, "little")
ROWS = 200
PIECE = (
    "doc long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long"
)
KINDS = [pa.int64()] * 7
NAMES = [field.split()[0] for field in PIECE.split(", ")]
POINT = "array<float>"


def projection(dims: int = DIMS, buckets: int = BUCKETS) -> np.ndarray:
    """The same matrix everywhere: its numbers follow from a seed."""
    return np.random.default_rng(SEED).standard_normal((buckets, dims)).astype(np.float32)


def points_of_block(data: np.ndarray, begins: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """A point for each text of a block; a text without words is at the origin."""
    start, end, first = words_of(data, begins)
    n, (buckets, dims) = len(begins) - 1, matrix.shape
    out = np.zeros((n, dims), dtype=np.float32)
    if not len(start):
        return out
    bucket = (word_codes(data, start, end) % np.uint64(buckets)).astype(np.int64)
    doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(first))
    cell = doc * buckets + bucket
    if n * buckets <= 16 * len(cell):
        counts = np.bincount(cell, minlength=n * buckets)
        cell = np.flatnonzero(counts)
        count = counts[cell]
    else:
        cell, count = np.unique(cell, return_counts=True)
    doc, bucket = cell // buckets, cell % buckets
    weight = (1 + np.log(count)).astype(np.float32)
    heads = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    size = np.sqrt(np.add.reduceat(weight * weight, heads))
    out[doc[heads]] = np.add.reduceat(weight[:, None] * matrix[bucket], heads) / size[:, None]
    return out


def _points(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = projection(dims)
        for rows, data, begins in text_blocks(batches):
            points = points_of_block(data, begins, matrix)
            column = pa.ListArray.from_arrays(
                np.arange(len(points) + 1, dtype=np.int32) * dims, pa.array(points.ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1).cast(pa.string()), column, pa.array(np.diff(begins))],
                names=["doc", "text", "point", "size"],
            )

    return run


def with_points(docs: DataFrame, id_column: str, text_column: str, dims: int = DIMS) -> DataFrame:
    """(doc, text, point, size in bytes) of all documents."""
    rows = docs.select(
        column(docs, id_column).cast("long").alias("doc"),
        text_of(docs, text_column).cast("binary").alias("text"),
    )
    return rows.mapInArrow(_points(dims), f"doc long, text string, point {POINT}, size long")


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each cell (a row of coordinates below ``2 ** bits``) on the Hilbert curve."""
    x = cells.astype(np.uint64).T.copy()
    dims = len(x)
    one = np.uint64(1)
    q = 1 << (bits - 1)
    while q > 1:  # undo the turns of each level, from the largest cube down
        low = np.uint64(q - 1)
        for i in range(dims):
            high = (x[i] & np.uint64(q)) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], dtype=np.uint64)
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[dims - 1] & np.uint64(q)) != 0, np.uint64(q - 1), np.uint64(0))
        q >>= 1
    x ^= flip
    key = np.zeros(x.shape[1], dtype=np.uint64)
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << one) | ((x[i] >> np.uint64(bit)) & one)
    return key.astype(np.int64)


def cells_of(points: np.ndarray, mean: np.ndarray, spread: np.ndarray, bits: int) -> np.ndarray:
    """Grid cells: a normal number's share of smaller ones is evenly spread from 0 to 1."""
    z = (points - mean) / np.where(spread > 0, spread, 1.0)
    grid = np.linspace(-4, 4, 4097)
    share = np.interp(z, grid, [(1 + erf(v / 2 ** 0.5)) / 2 for v in grid])
    return np.minimum((share * (1 << bits)).astype(np.int64), (1 << bits) - 1)


def curve_key(mean: list[float], spread: list[float], bits: int):
    """A column function from points to keys; texts stay outside Python."""

    @F.arrow_udf("long")
    def key(points: pa.Array) -> pa.Array:
        flat = points.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        centre, width = np.array(mean), np.array(spread)
        return pa.array(hilbert(cells_of(flat.reshape(-1, len(centre)), centre, width, bits), bits))

    return key


def range_of(cells: np.ndarray, sizes: np.ndarray, shift: int, task_bytes: int):
    """A column function from a key and a number in [0, 1) to the range of equally many bytes that
    the key is in. ``cells`` (sorted) are the stretches with documents, ``sizes`` their bytes."""
    before = np.cumsum(sizes) - sizes
    tasks = max(1, -(-int(sizes.sum()) // task_bytes))
    wide = max(1.0, float(sizes.sum())) / tasks

    @F.arrow_udf("int")
    def part(key: pa.Array, dice: pa.Array) -> pa.Array:
        at = np.searchsorted(cells, key.to_numpy() >> shift)
        place = before[at] + dice.to_numpy() * sizes[at]
        return pa.array(np.minimum(place // wide, tasks - 1).astype(np.int32))

    return part, tasks


def along_curve(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", dims: int = DIMS,
    bits: int = BITS, task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """(doc, text, key) of all documents, range-partitioned and sorted by the key."""
    placed = stage(with_points(docs, id_column, text_column, dims), "curve-points")
    numbers = [F.col("point")[i] for i in range(dims)]
    facts = placed.agg(
        *(F.avg(x) for x in numbers), *(F.stddev_pop(x) for x in numbers)
    ).first()
    mean = [float(x or 0) for x in facts[:dims]]
    spread = [float(x or 0) for x in facts[dims:]]
    keyed = placed.withColumn("key", curve_key(mean, spread, bits)("point"))
    shift = max(0, dims * bits - CELL_BITS)
    # at most 1 << CELL_BITS rows, whatever the number of documents
    cells = keyed.groupBy(F.shiftright("key", shift).alias("cell")).agg(
        F.sum(F.col("size") + 1).alias("bytes")
    ).toPandas().sort_values("cell")
    part, tasks = range_of(
        cells["cell"].to_numpy(np.int64), cells["bytes"].to_numpy(np.int64), shift, task_bytes
    )
    numbered = keyed.withColumn("place", F.monotonically_increasing_id())
    dice = F.pmod(F.xxhash64("doc", "place"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    dealt = numbered.withColumn("part", part(F.col("key"), dice)).select("doc", "text", "key", "place", "part")
    return (
        dealt.repartitionById(tasks, "part")
        .sortWithinPartitions("key", "doc", "place")
        .select("doc", "text", "key")
    )


def powers_of_two(size: int) -> list[int]:
    """The powers of two that add up to ``size``, largest first."""
    return [1 << i for i in range(size.bit_length() - 1, -1, -1) if size >> i & 1]


class Stretch:
    """Documents one after the other, cut into sequences; keeps the open sequence only."""

    def __init__(self, length: int, base: int):
        self.length, self.number = length, base
        self.open: list[tuple[int, int, bytes, int]] = []
        self.used = 0
        self.out: list[list] = [[] for _ in NAMES]

    def _write(self, pieces: list[tuple[int, int, bytes, int]]) -> None:
        offset = 0
        for doc, start, ids, tokens in pieces:
            size = len(ids) // 4
            row = (doc, start, size, zlib.crc32(ids), tokens, self.number, offset)
            for column, value in zip(self.out, row):
                column.append(value)
            offset += size
        self.number += 1

    def add(self, doc: int, ids: bytes) -> None:
        tokens = len(ids) // 4
        start = 0
        while start < tokens:
            size = min(tokens - start, self.length - self.used)
            self.open.append((doc, start, ids[4 * start: 4 * (start + size)], tokens))
            self.used += size
            start += size
            if self.used == self.length:
                self._write(self.open)
                self.open, self.used = [], 0

    def close(self) -> None:
        """The last sequence in parts that are powers of two."""
        rest = self.open
        for size in powers_of_two(self.used):
            part: list[tuple[int, int, bytes, int]] = []
            left = size
            while left:
                doc, start, ids, tokens = rest[0]
                if len(ids) // 4 <= left:
                    part.append(rest.pop(0))
                    left -= len(ids) // 4
                else:
                    part.append((doc, start, ids[: 4 * left], tokens))
                    rest[0] = (doc, start + left, ids[4 * left:], tokens)
                    left = 0
            self._write(part)
        self.open, self.used = [], 0

    def take(self) -> pa.RecordBatch:
        rows = pa.RecordBatch.from_arrays(
            [pa.array(c, type=t) for c, t in zip(self.out, KINDS)], names=NAMES
        )
        self.out = [[] for _ in NAMES]
        return rows


def _fill(path: str, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = kept(encoder, path, False)
        stretch = Stretch(length, TaskContext.get().partitionId() << 40)
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                rows = batch.slice(begin, ROWS)
                for doc, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                    stretch.add(doc, encode(text) + END)
                yield stretch.take()
        stretch.close()
        yield stretch.take()

    return run


def pack_along_curve(
    docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text",
    length: int = LENGTH, dims: int = DIMS, bits: int = BITS, task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """All documents' ids, each document closed by id 1, in sequences of at most ``length``.

    One row per piece: doc, start (ids of the document before it), length, ids_crc32, doc_tokens,
    sequence_id, offset. No sequence needs padding: each has ``length`` ids or a power of two.
    Special tokens written out in a text are those tokens. Null and empty texts are the closing id
    alone; repeated rows and rows without id are packed like others; texts of any length are taken
    whole and cut where a sequence is full; other columns are not read; no rows give none.
    ``task_bytes`` is the text that a task should take; it moves the ends of stretches. ``dims`` x
    ``bits`` may be at most 63. ``tokenizer`` is a file that every executor can open.
    """
    if dims * bits > 63:
        raise ValueError("a key has at most 63 bits")
    rows = along_curve(docs, id_column, text_column, dims, bits, task_bytes)
    return rows.select("doc", "text").mapInArrow(_fill(tokenizer, length), PIECE)
