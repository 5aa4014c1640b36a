"""Packing along the curve: an exact round trip, no padding, neighbours that are alike."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from gridtide.llm.curve_packing import (
    Stretch, along_curve, hilbert, pack_along_curve, points_of_block, powers_of_two, projection,
)
from gridtide.llm.queries_packing import tokenizer_path


@pytest.mark.parametrize("dims, bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_in_single_steps(dims, bits):
    side = 1 << bits
    cells = np.stack(np.meshgrid(*[np.arange(side)] * dims, indexing="ij"), -1).reshape(-1, dims)
    key = hilbert(cells, bits)
    assert sorted(key.tolist()) == list(range(side ** dims))
    walk = cells[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_powers_of_two():
    assert [powers_of_two(n) for n in (0, 1, 6, 7)] == [[], [1], [4, 2], [4, 2, 1]]
    for n in range(200):
        assert sum(powers_of_two(n)) == n


def test_stretch_cuts_only_where_a_sequence_is_full():
    stretch = Stretch(8, 5)
    for doc, n in enumerate([3, 6, 20, 1]):
        stretch.add(doc, bytes(4 * n))
    stretch.close()
    rows = [(r["doc"], r["start"], r["length"], r["sequence_id"], r["offset"]) for r in stretch.take().to_pylist()]
    assert rows == [(0, 0, 3, 5, 0), (1, 0, 5, 5, 3), (1, 5, 1, 6, 0), (2, 0, 7, 6, 1), (2, 7, 8, 7, 0),
                    (2, 15, 4, 8, 0), (2, 19, 1, 9, 0), (3, 0, 1, 9, 1)]


def reference():
    tokenizer = Tokenizer.from_file(tokenizer_path())
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("task_bytes", [1 << 20, 300])
def test_round_trip(spark, documents, task_bytes):
    rng = random.Random(2)
    words = ["alpha", "beta", "naïve", "世界", "<|endoftext|>", "12", "\n", "  "]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(90))) for _ in range(60)]
    rows = [(i, t, "x", "y") for i, t in enumerate([*texts, "", None, "word " * 900])]
    rows += [(3, texts[3], "x", "y")] * 2 + [(None, "lost", "x", "y"), (None, None, "x", "y")]
    docs = documents(rows, ("start", "a.b")).repartition(3)
    got = pack_along_curve(docs, tokenizer_path(), length=64, task_bytes=task_bytes).collect()
    by_sequence, by_doc, ids = {}, {}, reference()
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end == 64 or (end < 64 and end & (end - 1) == 0)
    for doc, text, *_ in rows:
        if doc in (None, 3):
            continue
        want, end = ids(text), 0
        for start, length, crc, total in sorted(by_doc[doc]):
            assert start == end and total == len(want)
            assert crc == zlib.crc32(np.array(want[start: start + length], "<u4").tobytes())
            end += length
        assert end == len(want)
    assert sum(x[1] for x in by_doc[3]) == 3 * len(ids(texts[3]))
    assert sum(x[1] for x in by_doc[None]) == len(ids("lost")) + 1
    assert pack_along_curve(documents([]), tokenizer_path()).collect() == []


def test_neighbours_along_the_curve_are_alike(spark, documents):
    rng = random.Random(5)
    topics = [[f"{letter}{i}" for i in range(60)] for letter in "abcdefgh"]
    rows = [(i, " ".join(rng.choices(topics[i % 8], k=80))) for i in range(400)]
    order = [r.doc for r in along_curve(documents(rows).repartition(4), task_bytes=8000).collect()]
    assert sorted(order) == list(range(400))
    same = sum(a % 8 == b % 8 for a, b in zip(order, order[1:])) / 399
    assert same > 3 / 8  # 1 in 8 by chance


def test_points():
    data = np.frombuffer(b"a b a" + b"" + b"b a a", dtype=np.uint8)
    points = points_of_block(data, np.array([0, 5, 5, 10]), projection())
    assert np.allclose(points[0], points[2]) and not points[1].any() and points[0].any()
