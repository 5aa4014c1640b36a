"""Windows of a text that also start in an earlier document, found exactly and in bounded memory.

Shared by the suffix-array and the substring operator; they differ in tokens (bytes, words)
and in how the residual is resolved.

1. Each text is cut into segments of window starts (:mod:`windows`): one small row each.
2. Segments are range-partitioned by (key, document), so even a key that a third of the
   documents hold spreads over many tasks, and sorted there. A segment whose content also is a
   whole segment of a smaller document is removed as it stands. Of what is left, only the
   first document of each distinct content goes on, and only if its key has several contents
   (or touches a partition's edge, where the neighbour may hold more).
3. The contexts of those are resolved window by window (``resolve``).
4. Removed windows go back to their texts.

Rows with a null id or a null text: a null text is empty; a row without id is kept whole and
takes part in nothing. Rows that repeat an id are told apart by their texts (:mod:`rows`); they
never remove each other, since neither id is smaller.

Partitions that a task takes whole are dealt by the bytes of the texts and by the rows of written
tables, so they don't grow with the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gridtide.llm import windows as win
from gridtide.llm.rows import TextRows
from gridtide.staging import stage

SEGMENT = "key long, ctx long, doc long, mark binary, place long"
FLAG = "doc long, mark binary, place long, key long, open boolean"
MASK = "doc long, mark binary, place long, mask long"
TASK_BYTES = 16 << 20
TASK_ROWS = 20_000


def tasks_for(amount: int | None, per_task: int) -> int:
    return max(1, -(-(amount or 0) // per_task))


def tokens_of(data: np.ndarray, begins: np.ndarray, kind: str):
    """Codes of the tokens of a block, and the number of each text's first token."""
    if kind == "bytes":
        return win.BYTE_CODES[data], begins
    start, end, first = win.words_of(data, begins)
    return win.word_codes(data, start, end), first


def _segment_rows(kind: str, width: int, gram: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, begins in win.text_blocks(batches):
            codes, first = tokens_of(data, begins, kind)
            doc, start, count, key, ctx = win.segments(codes, first, width, gram)
            if not len(doc):
                continue
            ids = rows.column(0).to_numpy(zero_copy_only=False)[doc]
            place = ((start - first[doc]) << 6) | (count - 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((key >> np.uint64(16)).astype(np.int64)),
                    pa.array((ctx >> np.uint64(24)).astype(np.int64)),
                    pa.array(ids.astype(np.int64)),
                    rows.column(2).take(pa.array(doc)),
                    pa.array(place),
                ],
                names=["key", "ctx", "doc", "mark", "place"],
            )

    return run


def segment_start(place: np.ndarray) -> np.ndarray:
    return place >> 6


def segment_count(place: np.ndarray) -> np.ndarray:
    return (place & 63) + 1


def _whole(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    found = [batch for batch in batches if batch.num_rows]
    return pa.Table.from_batches(found) if found else None


def first_of_run(new: np.ndarray) -> np.ndarray:
    """For each row of a sorted table, the row where its run begins."""
    return np.flatnonzero(new)[np.cumsum(new) - 1]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = _whole(batches)
    if table is None:
        return
    key, ctx, doc = (table.column(i).to_numpy() for i in range(3))
    order = win.tied_order([key, ctx, doc])
    key, ctx, doc = key[order], ctx[order], doc[order]
    start = np.ones(1, dtype=bool)
    new_key = np.concatenate([start, key[1:] != key[:-1]])
    new_ctx = new_key | np.concatenate([start, ctx[1:] != ctx[:-1]])
    whole = doc > doc[first_of_run(new_ctx)]
    heads = np.flatnonzero(new_key)
    of_key = np.cumsum(new_key) - 1
    several = np.add.reduceat(new_ctx.astype(np.int64), heads) > 1
    several &= np.minimum.reduceat(doc, heads) != np.maximum.reduceat(doc, heads)
    several[0] = several[-1] = True
    left = ~whole & several[of_key]
    at = np.flatnonzero(whole | left)
    found = table.select(["doc", "mark", "place", "key"]).take(pa.array(order[at]))
    yield from found.append_column("open", pa.array(left[at])).combine_chunks().to_batches()


def flags(rows: DataFrame, kind: str, width: int, gram: int) -> DataFrame:
    """Segments to remove as a whole, and those left open."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0]
    found = rows.where("doc is not null").mapInArrow(_segment_rows(kind, width, gram), SEGMENT)
    dealt = found.repartitionByRange(tasks_for(size, TASK_BYTES), "key", "doc")
    return dealt.mapInArrow(_compare, FLAG)


def _context_rows(kind: str, width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, begins in win.text_blocks(batches):
            codes, first = tokens_of(data, begins, kind)
            source = data if kind == "bytes" else codes
            ids, marks = rows.column(0).to_numpy(), rows.column(2).to_pylist()
            out: list[list] = [[], [], [], [], []]
            for i, opened in enumerate(rows.column(3)):
                for item in opened.as_py():
                    place = item["place"]
                    at = first[i] + (place >> 6)
                    piece = source[at: at + (place & 63) + width]
                    values = (item["key"], ids[i], marks[i], place, piece.tobytes())
                    for column, value in zip(out, values):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(out, kinds)],
                names=["key", "doc", "mark", "place", "context"],
            )

    return run


def contexts(rows: DataFrame, opened: DataFrame, kind: str, width: int) -> DataFrame:
    """The tokens under the open segments: (key, doc, mark, place, context)."""
    # equal rows of one id have the same segments
    lists = opened.groupBy("doc", "mark").agg(
        F.collect_set(F.struct("place", "key")).alias("opened")
    )
    return (
        rows.join(lists, ["doc", "mark"])
        .select("doc", "text", "mark", "opened")
        .mapInArrow(
            _context_rows(kind, width), "key long, doc long, mark binary, place long, context binary"
        )
    )


def dealt(context: DataFrame, *by: str) -> DataFrame:
    """Contexts (a written table) in partitions of a bounded number of rows, by range."""
    return context.repartitionByRange(tasks_for(context.count(), TASK_ROWS), *by)


def window_columns(table: pa.Table, kind: str, width: int):
    """All windows of all contexts: row of the context, offset in it, and sort columns: the
    leading eight bytes, the next eight and so on, or one word each."""
    place = table.column("place").to_numpy()
    count = segment_count(place)
    row = np.repeat(np.arange(len(place)), count)
    begin = np.cumsum(count) - count
    offset = np.arange(len(row)) - begin[row]
    sizes = (count + width - 1).astype(np.int64)
    base = np.cumsum(sizes) - sizes
    joined = b"".join(table.column("context").to_pylist())
    if kind == "bytes":
        data = np.frombuffer(joined + bytes(8), dtype=np.uint8).astype(np.uint64)
        packed = data[:-7].copy()
        for i in range(1, 8):
            packed = (packed << np.uint64(8)) | data[i: len(data) - 7 + i]
        steps = list(range(0, width - 7, 8)) + ([width - 8] if width % 8 else [])
    else:
        packed, steps = np.frombuffer(joined, dtype=np.uint64), list(range(width))
    at = base[row] + offset
    return row, offset, at, packed, steps


def sorted_windows(table: pa.Table, kind: str, width: int):
    """Windows in suffix order (ties by document): row, offset, and whether each begins a run
    of equal windows, that is shares less than ``width`` tokens with the one before it."""
    row, offset, at, packed, steps = window_columns(table, kind, width)
    doc = table.column("doc").to_numpy()[row]
    order = np.argsort(packed[at], kind="stable")
    key = packed[at[order]]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    for step in [*steps[1:], None]:  # multikey: only what is still tied goes on
        alone = new & np.append(new[1:], True)
        tied = np.flatnonzero(~alone)
        if not len(tied):
            break
        group = np.cumsum(new)[tied]
        key = doc[order[tied]] if step is None else packed[at[order[tied]] + step]
        by = np.lexsort((key, group))
        order[tied] = order[tied][by]
        if step is not None:
            key = key[by]
            new[tied[1:]] |= (group[1:] == group[:-1]) & (key[1:] != key[:-1])
    return row[order], offset[order], doc[order], new


def masks(table: pa.Table, row: np.ndarray, offset: np.ndarray) -> pa.RecordBatch:
    """Windows gathered by context: a bit for each."""
    bits = np.zeros(len(table), dtype=np.uint64)
    np.bitwise_or.at(bits, row, np.uint64(1) << offset.astype(np.uint64))
    at = np.flatnonzero(bits)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(table.column("doc").to_numpy()[at]),
            table.column("mark").take(pa.array(at)).combine_chunks(),
            pa.array(table.column("place").to_numpy()[at]),
            pa.array(bits[at].view(np.int64)),
        ],
        names=["doc", "mark", "place", "mask"],
    )


def removed_starts(places: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The window starts that the masks name."""
    first, count = segment_start(places), segment_count(places)
    row = np.repeat(np.arange(len(places)), count)
    offset = np.arange(len(row)) - (np.cumsum(count) - count)[row]
    on = (bits.view(np.uint64)[row] >> offset.astype(np.uint64)) & np.uint64(1)
    return (first[row] + offset)[on.astype(bool)]


def _cutter(kind: str, width: int) -> Callable:
    def cut(text: pd.Series, places: pd.Series, bits: pd.Series) -> pd.DataFrame:
        out = []
        for data, at, mask in zip(text, places, bits):
            parts = data if kind == "bytes" else data.split()
            begins = ends = ()
            if at is not None:
                starts = removed_starts(np.asarray(at), np.asarray(mask))
                begins, ends = win.merged_spans(starts, width, len(parts))
            edges = [0, *(int(x) for span in zip(begins, ends) for x in span), len(parts)]
            keep = [parts[a:b] for a, b in zip(edges[::2], edges[1::2])]
            if kind == "bytes":
                kept = b"".join(keep)
            else:
                kept = b" ".join(word for some in keep for word in some)
            removed = int(np.sum(np.subtract(ends, begins)))
            # bytes of a character cut in two are no text
            out.append((len(parts), removed, len(begins), kept, kept.decode("utf-8", "ignore")))
        return pd.DataFrame(out, columns=["n_tokens", "n_removed", "n_spans", "kept", "kept_text"])

    return cut


def cut_repeats(
    docs: DataFrame, id_column: str, text_column: str, kind: str, width: int, gram: int,
    resolve: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """``row`` (struct of the columns of ``docs``) and ``cut``: struct of n_tokens, n_removed, n_spans (maximal
    removed runs), kept (bytes left; words joined by a space) and kept_text (those as a text)."""
    source = TextRows(docs, id_column, text_column)
    rows = source.texts()
    found = stage(flags(rows, kind, width, gram), f"{kind}-flags")
    context = stage(contexts(rows, found.where("open"), kind, width), f"{kind}-contexts")
    closed = found.where("not open").select(
        "doc", "mark", "place", F.lit(-1).cast("long").alias("mask")
    )
    removed = (
        closed.unionByName(resolve(context))
        .groupBy(F.col("doc").alias("cut_doc"), F.col("mark").alias("cut_mark"))
        .agg(F.collect_set(F.struct("place", "mask")).alias("cut_found"))
    )
    cut = F.pandas_udf(
        _cutter(kind, width),
        "n_tokens long, n_removed long, n_spans long, kept binary, kept_text string",
    )
    joined = source.packed().join(
        removed, (F.col("doc") == F.col("cut_doc")) & (F.col("mark") == F.col("cut_mark")), "left"
    )
    return joined.select(
        "row", cut(F.col("text").cast("binary"), "cut_found.place", "cut_found.mask").alias("cut")
    )
