"""Near copies against all pairs, on small tables."""

from __future__ import annotations

import random

import numpy as np
import pytest

from gridtide.llm import near_dedup
from gridtide.llm.components import components
from gridtide.llm.near_dedup import dart_signature, drop_near_copies, near_classes


def sets_of(text, size=5):
    words = (text or "").split()
    if not words:
        return set()
    return {tuple(words[i: i + size]) for i in range(max(1, len(words) - size + 1))}


def classes(rows, threshold=0.8):
    """Least id of each row's component, by all pairs."""
    sets = [sets_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and len(a & b) >= threshold * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted((doc, least[find(i)]) for i, (doc, _) in enumerate(rows))


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return out


@pytest.mark.parametrize("seed", [3, 4])
def test_against_all_pairs(spark, documents, seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(12):
        source = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(40, 400))]
        texts.append(source)
        for _ in range(rng.randrange(12)):  # a star of copies that need not be alike
            texts.append(edited(rng, source, rng.randrange(max(2, len(source) // 60))))
    passage = [f"p{i}" for i in range(60)]
    texts += [passage + [f"q{rng.randrange(10**6)}" for _ in range(50)] for _ in range(20)]
    texts += [["one"], ["one"], ["one", "two"], ["a"] * 500, ["a"] * 300]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    rows += [(1000, ""), (1001, None), (1002, " \n ")]
    docs = documents([(*r, "x", "y") for r in rows], ("node", "mark")).repartition(4)
    got = near_classes(docs).collect()
    assert sorted((r.doc, r.class_id) for r in got) == classes(rows)
    assert all(r.kept == (r.doc == r.class_id) for r in got)
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in classes(rows)})


def family(seed, n, values):
    """Texts of one template: 200 words, ten of them fields; five equal fields are too few."""
    rng = random.Random(seed)
    texts = [
        " ".join(f"f{i}x{rng.randrange(values)}" if i % 20 == 10 else f"w{i}" for i in range(200))
        for _ in range(n)
    ]
    return list(enumerate(texts))


@pytest.mark.parametrize("block", [64])
def test_template_family_against_all_pairs(spark, documents, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", block)
    rows = family(6, 900, 9)
    want = classes(rows)
    got = near_classes(documents(rows).repartition(4)).collect()
    assert len({c for _, c in want}) > 300  # many classes share the buckets
    assert sorted((r.doc, r.class_id) for r in got) == want


@pytest.mark.parametrize("weighted", [False, True])
@pytest.mark.parametrize("columns", [7, 4096])
def test_alike_pairs_against_each_pair(monkeypatch, weighted, columns):
    monkeypatch.setattr(near_dedup, "COLUMNS", columns)
    rng = np.random.default_rng(8)
    items = [np.sort(rng.integers(0, 12, rng.integers(4, 20)).astype("<u4")).tobytes() for _ in range(60)]
    root, side = rng.integers(0, 20, 60), rng.integers(3, 5, 60)
    for of in (side, np.zeros(60)):
        i, j = near_dedup.alike_pairs(items, root, of, 0.6, weighted)
        want = {
            (a, b) for a in range(60) for b in range(a)
            if root[a] != root[b] and (of is not side or of[a] != of[b])
            and near_dedup.similarity(items[a], items[b], weighted) >= 0.6
        }
        assert want and {(max(p), min(p)) for p in zip(i.tolist(), j.tolist())} == want


def test_repeated_rows_null_ids_empty_table(spark, documents):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(5, text), (5, text), (5, "another text of its own here"), (None, text), (9, text)]
    got = sorted((r.doc is None, r.doc, r.class_id, r.kept) for r in near_classes(documents(rows)).collect())
    assert got == [(False, 5, 5, True)] * 3 + [(False, 9, 5, False), (True, None, None, True)]
    assert drop_near_copies(documents(rows)).count() == 3
    assert near_classes(documents([])).count() == 0
    assert drop_near_copies(documents([])).count() == 0


def test_signatures_agree_as_often_as_texts_are_alike():
    rng = np.random.default_rng(5)
    found, true = [], []
    for _ in range(40):
        items = rng.integers(1, 2**62, 80).astype(np.uint64)
        a = rng.integers(1, 6, 80).astype(float)
        b = a.copy()
        b[:30] = rng.integers(1, 6, 30) + 0.5
        found.append((dart_signature(items, a, 128) == dart_signature(items, b, 128)).mean())
        true.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(found) - np.mean(true)) < 0.03


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 160)}}
