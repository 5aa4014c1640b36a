"""Packing: an exact round trip, ids of the tokenizer, tight sequences."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from gridtide.llm.packing import OpenSequences, cut, pack_documents, pieces
from gridtide.llm.queries_packing import tokenizer_path
from gridtide.llm.tokens import encoder

TEXTS = [
    "", " ", "\n", "a", " a", "a ", "a  b", "it's 5 o'clock, isn't it?", "tab\tand\nline \n two",
    "x y  z", "naïve Éclair 世界 12345 ½", "a\x1cb \x1c c", "<|endoftext|> is text",
    "word " * 3000, "no-space" * 2000, "emoji 🙂🙂 🙂", "\r\n\r\n end", "a b c",
]


def reference(plain=False):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    if plain:
        tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("plain", [True, False])
def test_ids_are_those_of_the_file(plain):
    ids, encode, rng = reference(plain), encoder(tokenizer_path(), plain), random.Random(1)
    parts = ["<|endoftext|>", " ", "  ", "\n", "the", "Éa", "'s", "12", "!?", "\t", "世", " ", "\x1d", "_", "²"]
    texts = TEXTS + ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(400)]
    for text in texts:
        assert np.frombuffer(encode(text), dtype="<u4").tolist() == ids(text), repr(text)


def test_cut():
    assert cut(1, 4) == [(0, 1)]
    assert cut(4, 4) == [(0, 4)]
    assert cut(5, 4) == [(0, 1), (1, 4)]
    assert cut(8, 4) == [(0, 4), (4, 4)]


@pytest.mark.parametrize("tasks", [10_000, 7])
def test_round_trip(spark, documents, tasks):
    rows = [(i, t, "x", "y") for i, t in enumerate(TEXTS)] + [(3, "a", "x", "y"), (None, None, "x", "y")]
    docs = documents(rows, ("length", "piece")).repartition(3)
    ids = reference()
    got = pack_documents(docs, tokenizer_path(), length=64, task_pieces=tasks).collect()
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 64
    for i, text in enumerate(TEXTS):
        if i == 3:
            continue
        want = [*ids(text), 0]
        mine = sorted((r for r in got if r.doc == i), key=lambda r: r.piece)
        assert [r.piece for r in mine] == list(range(len(mine)))
        assert sum(r.length for r in mine) == len(want)
        assert len(mine) == -(-len(want) // 64) and all(r.length == 64 for r in mine[1:])
        for r in mine:
            part = np.array(want[r.start: r.start + r.length], dtype="<u4").tobytes()
            assert zlib.crc32(part) == r.ids_crc32
    assert sum(r.doc == 3 for r in got) == 2 and sum(r.doc is None for r in got) == 1
    if tasks > 1000:
        assert len(by_sequence) <= -(-sum(r.length for r in got) // 64) + 1
    assert pack_documents(documents([]), tokenizer_path()).count() == 0
    row = pieces(docs.where("doc_id = 7"), tokenizer_path(), with_ids=True).first()
    assert np.frombuffer(row.ids, dtype="<u4").tolist() == [*ids(TEXTS[7]), 0]


def test_bounded_best_fit_is_best_fit():
    rng = random.Random(2)
    for most in (3, 1000):
        mine, space = OpenSequences(100, most), {}
        for _ in range(2000):
            size = rng.randrange(1, 101)
            number, at = mine.place(size)
            tight = [s for s in space.values() if s >= size]
            if tight:
                assert 100 - at == min(tight)
            else:
                assert at == 0
            space[number] = 100 - at - size
            if not space[number]:
                del space[number]
            if len(space) > most:
                left = min(space.values())
                closed = [n for n, s in space.items() if s == left and n not in mine.by_space.get(left, [])]
                assert len(closed) == 1
                del space[closed[0]]
            assert mine.count == len(space) <= most
