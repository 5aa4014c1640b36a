"""Best-fit packing of token pieces into sequences.

Bounded-space online best fit: a task places pieces one by one and never moves one again. It is
given its pieces longest first, so the result is that of best fit decreasing with a bounded
number of open sequences. Special tokens written out in a text are those tokens, as the
tokenizer's library has it by default. Open sequences
lie in lists by free space, and a bitset (an integer) has the bit of each free space that some
open sequence has, so the tightest fit is its lowest bit from the piece's length on. A fixed
number may be open; beyond that the fullest closes. Pieces are dealt evenly over as many tasks
as their number asks for, so each task sees a fair mix, and at most one thin sequence a task
is the price of working apart.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from gridtide.llm.rows import column, text_of
from gridtide.llm.tokens import encoder, kept
from gridtide.staging import stage

LENGTH = 2048
OPEN = 1 << 14
TASK_PIECES = 25_000
PIECE = "doc long, piece int, start long, length long, ids_crc32 long"
END = bytes(4)


def cut(size: int, length: int) -> list[tuple[int, int]]:
    """Start and size of the pieces of a document: the first takes what is over."""
    first = size % length or min(size, length)
    return [(0, first), *((at, length) for at in range(first, size, length))]


def _pieces(path: str, length: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = kept(encoder, path, False)
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                rows = batch.slice(begin, 500)
                out: list[list] = [[], [], [], [], [], []]
                for doc, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                    ids = encode(text) + END
                    for number, (start, size) in enumerate(cut(len(ids) // 4, length)):
                        part = ids[4 * start: 4 * (start + size)]
                        row = (doc, number, start, size, zlib.crc32(part), part)
                        for column, value in zip(out, row):
                            column.append(value)
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                names = ["doc", "piece", "start", "length", "ids_crc32", "ids"]
                n = 6 if with_ids else 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=t) for c, t in zip(out[:n], kinds)], names=names[:n]
                )

    return run


def pieces(
    docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text",
    length: int = LENGTH, with_ids: bool = False,
) -> DataFrame:
    """One row for each piece of each document: its ids and a final 0, cut to ``length``.
    ``with_ids`` adds the ids themselves (little-endian unsigned 32-bit)."""
    rows = docs.select(
        column(docs, id_column).cast("long").alias("doc"), text_of(docs, text_column).alias("text")
    )
    schema = PIECE + (", ids binary" if with_ids else "")
    return rows.mapInArrow(_pieces(tokenizer, length, with_ids), schema)


class OpenSequences:
    """Up to ``most`` open sequences of ``length``."""

    def __init__(self, length: int, most: int):
        self.length, self.most = length, most
        self.bits, self.count, self.started = 0, 0, 0
        self.by_space: dict[int, list[int]] = {}

    def _take(self, space: int) -> int:
        same = self.by_space[space]
        number = same.pop()
        if not same:
            self.bits &= ~(1 << space)
        self.count -= 1
        return number

    def place(self, size: int) -> tuple[int, int]:
        """The sequence that a piece goes to, and where in it."""
        fits = self.bits >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            number = self._take(space)
        else:
            space, number = self.length, self.started
            self.started += 1
        left = space - size
        if left:
            self.by_space.setdefault(left, []).append(number)
            self.bits |= 1 << left
            self.count += 1
            if self.count > self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
        return number, self.length - space


def _pack(length: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [batch for batch in batches if batch.num_rows]
        if not found:
            return
        table = pa.Table.from_batches(found).sort_by(
            [("length", "descending"), ("doc", "ascending"), ("piece", "ascending"),
             ("ids_crc32", "ascending")]
        )
        base = TaskContext.get().partitionId() << 40
        sequences = OpenSequences(length, most)
        placed = [sequences.place(size) for size in table.column("length").to_pylist()]
        table = table.append_column("sequence_id", pa.array([base + n for n, _ in placed], pa.int64()))
        table = table.append_column("offset", pa.array([at for _, at in placed], pa.int64()))
        yield from table.to_batches()

    return run


def best_fit(
    rows: DataFrame, length: int = LENGTH, most_open: int = OPEN, task_pieces: int = TASK_PIECES
) -> DataFrame:
    """Rows of :func:`pieces` (without ids) with sequence_id and offset. Pieces of a sequence
    follow each other without gaps from 0."""
    rows = stage(rows, "pieces")
    tasks = max(1, -(-rows.count() // task_pieces))
    return rows.repartition(tasks).mapInArrow(
        _pack(length, most_open), PIECE + ", sequence_id long, offset long"
    )


def pack_documents(
    docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text",
    length: int = LENGTH, most_open: int = OPEN, task_pieces: int = TASK_PIECES,
) -> DataFrame:
    """Cut and pack whole documents.

    Null and empty texts are the final 0 alone; repeated rows and rows without id are packed
    like others; texts of any length are cut, never dropped; no rows give none. ``tokenizer``
    is a file that every executor can open.
    """
    rows = pieces(docs, tokenizer, id_column, text_column, length)
    return best_fit(rows, length, most_open, task_pieces)
