"""Repeated windows of tokens: content-chosen segments of window starts.

Two equal windows of ``width`` tokens hold the same ``gram`` tokens with the smallest hash.
Consecutive window starts with the same smallest hash form a *segment* (at most ``CHUNK``
starts). Equal windows therefore always lie in segments with the same key, and a segment
stands for all its windows in what is shuffled: about ``2 / (width - gram + 2)`` rows a token
instead of one.

Everything here works on numpy arrays of one block of documents inside a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 64
BLOCK_BYTES = 1 << 18
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * BASE)


def text_blocks(
    batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows in blocks of about ``limit`` bytes of the binary column ``text``: the rows, the
    bytes of their texts in a row, and where each text begins (with the end as last)."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index("text"))
        n = len(column)
        if n == 0:
            continue
        wide = pa.types.is_large_binary(column.type)
        ends = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
        ends = ends[column.offset: column.offset + n + 1].astype(np.int64)
        data = column.buffers()[2]
        whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
        first = 0
        while first < n:
            last = int(np.searchsorted(ends, ends[first] + limit, side="right")) - 1
            last = min(max(last, first + 1), n)
            yield (
                batch.slice(first, last - first),
                whole[ends[first]: ends[last]],
                ends[first: last + 1] - ends[first],
            )
            first = last


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of BASE and of its inverse, at least ``n``."""
    if not _powers or len(_powers[0][0]) < n:
        size = max(n, 1 << 19)
        one = np.ones(1, dtype=np.uint64)
        _powers[0] = tuple(
            np.concatenate([one, np.cumprod(np.full(size, b, dtype=np.uint64), dtype=np.uint64)])
            for b in (BASE, BASE_INVERSE)
        )
    return _powers[0]


def range_hash(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of codes[start:end] for many ranges at once; equal contents hash alike."""
    up, down = powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(codes * up[: len(codes)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def _gram_hash(codes: np.ndarray, gram: int) -> np.ndarray:
    done, size, power, width = None, 0, codes, 1
    factor = BASE
    left = gram
    while True:
        if left & 1:
            if done is None:
                done, size = power, width
            else:
                n = len(codes) - size - width + 1
                done, size = done[:n] * factor + power[size: size + n], size + width
        left >>= 1
        if not left:
            return mix(done)
        n = len(power) - width
        power = power[:n] * factor + power[width: width + n]
        width *= 2
        factor = factor * factor


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def segments(
    codes: np.ndarray, begins: np.ndarray, width: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segments of all documents of a block: document, first window start (in the block),
    number of starts, key, hash of the content that all its windows cover together."""
    none = np.zeros(0, dtype=np.int64)
    empty = (none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    if len(codes) < width:
        return empty
    with np.errstate(over="ignore"):
        low = _sliding_min(_gram_hash(codes, gram), width - gram + 1)
        n = len(low)
        change = np.zeros(n + 1, dtype=np.int32)
        starts, ends = begins[:-1], begins[1:] - width + 1
        real = ends > starts
        np.add.at(change, starts[real], 1)
        np.add.at(change, ends[real], -1)
        inside = np.cumsum(change[:n]) > 0
        head = inside.copy()
        head[1:] &= low[1:] != low[:-1]
        head[starts[real]] = True
        heads = np.flatnonzero(head)
        if not len(heads):
            return empty
        run = np.zeros(n, dtype=np.int64)
        run[heads] = heads
        run = np.maximum.accumulate(run)
        head |= inside & ((np.arange(n) - run) % CHUNK == 0)
        first = np.flatnonzero(head)
        count = np.diff(np.append(np.cumsum(inside)[first] - 1, inside.sum()))
        doc = np.searchsorted(begins, first, side="right") - 1
        ctx = range_hash(codes, first, first + count + width - 1)
    return doc, first, count, low[first], ctx


def tied_order(columns: list[np.ndarray]) -> np.ndarray:
    """Multikey sort: order rows by the first column, then sort only the rows still tied by
    the next one, and so on; what is told apart early is never looked at again."""
    order = np.argsort(columns[0], kind="stable")
    n = len(order)
    if n < 2:
        return order
    sorted_key = columns[0][order]
    new = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    for column in columns[1:]:
        alone = new & np.append(new[1:], True)
        at = np.flatnonzero(~alone)
        if not len(at):
            break
        group = np.cumsum(new)[at]
        key = column[order[at]]
        by = np.lexsort((key, group))
        order[at] = order[at][by]
        key = key[by]
        new[at[1:]] |= (group[1:] == group[:-1]) & (key[1:] != key[:-1])
    return order


def words_of(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of a block (runs of bytes that are not ASCII white space): where each begins and
    ends in the block, and the number of the first word of each text (with the end as last)."""
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    before = np.zeros(len(data), dtype=bool)
    before[1:] = solid[:-1]
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = solid[1:]
    edges = begins[(begins > 0) & (begins < len(data))]
    before[edges] = False
    after[edges - 1] = False
    start = np.flatnonzero(solid & ~before)
    end = np.flatnonzero(solid & ~after) + 1
    return start, end, np.searchsorted(start, begins, side="left")


def word_codes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit code of each word's bytes."""
    with np.errstate(over="ignore"):
        return range_hash(BYTE_CODES[data], start, end)


def merged_spans(starts: np.ndarray, width: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the windows at ``starts``: their begins and ends."""
    cover = np.zeros(size + 1, dtype=np.int32)
    starts = np.unique(starts)
    np.add.at(cover, starts, 1)
    np.add.at(cover, np.minimum(starts + width, size), -1)
    on = np.concatenate([[0], (np.cumsum(cover[:size]) > 0).astype(np.int8), [0]])
    step = np.diff(on)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)
