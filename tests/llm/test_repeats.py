"""Repeated byte strings and passages against a slow reading of their contract."""

from __future__ import annotations

import random

import pytest

from gridtide.llm.substring import drop_repeated_words
from gridtide.llm.suffix_array import drop_repeated_bytes


def covered(rows, split, width):
    """What the contract says, window by window."""
    first = {}
    for doc, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        tokens = split(text)
        for i in range(len(tokens) - width + 1):
            first.setdefault(tuple(tokens[i: i + width]), doc)
    out = []
    for doc, text in rows:
        tokens = split(text)
        gone = [False] * len(tokens)
        if doc is not None:
            for i in range(len(tokens) - width + 1):
                if first[tuple(tokens[i: i + width])] < doc:
                    gone[i: i + width] = [True] * width
        spans = sum(g and not before for g, before in zip(gone, [False, *gone]))
        kept = [t for t, g in zip(tokens, gone) if not g]
        out.append((doc, len(tokens), sum(gone), spans, kept))
    return out


def as_bytes(text):
    return list((text or "").encode())


def as_words(text):
    return (text or "").encode().split()


def corpus(seed, n, vocabulary, longest):
    """Random texts with planted copies, edits, shared passages and repeats inside a text."""
    rng = random.Random(seed)
    texts = []
    for _ in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(longest))]
        if texts and rng.random() < 0.6:
            source = rng.choice(texts)
            at, to = rng.randrange(len(words) + 1), rng.randrange(len(source) + 1)
            words = words[:at] + source[to: to + rng.randrange(60)] + words[at:]
        if rng.random() < 0.1 and texts:
            words = list(rng.choice(texts))
        texts.append(words)
    return [" ".join(w) for w in texts]


EDGES = [(None, "a b c d e f g h " * 4), (900, None), (901, ""), (902, " \t\n"),
         (903, "be " * 150), (904, "be " * 140), (905, "be " * 150), (905, "other"),
         (906, "éß世 " * 40), (907, "xéß世 " + "éß世 " * 40)]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("kind", ["bytes", "words", "words in large groups"])
def test_against_contract(spark, documents, seed, kind):
    texts = corpus(seed, 60, [f"w{i}" for i in range(30 if seed == 1 else 4)], 80)
    rows = [(i * 7 % 61, t) for i, t in enumerate(texts)] + EDGES
    docs = documents([(*r, "x", "y", "z") for r in rows], ("key", "place", "cut")).repartition(5)
    if kind == "bytes":
        found, split, join, width = drop_repeated_bytes(docs, width=20), as_bytes, bytes, 20
    else:
        group = 2000 if kind == "words" else 1
        found = drop_repeated_words(docs, width=6, group=group)
        split, join, width = as_words, b" ".join, 6
    got = [(r.row.doc_id, r.cut.n_tokens, r.cut.n_removed, r.cut.n_spans, bytes(r.cut.kept))
           for r in found.collect()]
    want = [(*r[:4], join(r[4])) for r in covered(rows, split, width)]
    order = lambda r: (r[0] is None, r)
    assert sorted(got, key=order) == sorted(want, key=order)
    assert found.select("row.*").columns == ["doc_id", "text", "key", "place", "cut"]


def test_repeated_rows_and_empty_table(spark, documents):
    rows = [(1, "one two three four"), (1, "one two three four"), (2, "one two three four")]
    got = sorted((r.row.doc_id, r.cut.n_removed) for r in drop_repeated_words(documents(rows), width=3).collect())
    assert got == [(1, 0), (1, 0), (2, 4)]
    assert drop_repeated_bytes(documents([])).count() == 0
    assert drop_repeated_words(documents([])).count() == 0
