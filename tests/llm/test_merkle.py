"""Merkle manifest against a plain tree, over shapes, ties and nulls."""

from __future__ import annotations

import zlib
from hashlib import sha256

import pytest

from gridtide.llm.merkle import documents_manifest, tiers

KINDS = "doc_id long, source string, lang string, n_chars long, text string"


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf(row, more=0):
    fields = [row[0], row[1], row[2], None if row[3] is None else row[3] + more, row[4]]
    return digest("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def tree(digests, fanout):
    """Root, and of each leaf the (left, right) siblings of each level."""
    paths, owners = [[] for _ in digests], [[i] for i in range(len(digests))]
    while len(digests) > 1:
        above, above_owners = [], []
        for a in range(0, len(digests), fanout):
            run = digests[a: a + fanout]
            for i in range(len(run)):
                for own in owners[a + i]:
                    paths[own].append(("".join(run[:i]), "".join(run[i + 1:])))
            above.append(digest("".join(run)))
            above_owners.append([o for some in owners[a: a + fanout] for o in some])
        digests, owners = above, above_owners
    return digests[0], paths


def brute(rows, fanout):
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row[2], []).append(row)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    found = []
    for lang in langs:
        ordered = sorted(by_lang[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        found.append((ordered, *tree([leaf(r) for r in ordered], fanout)))
    root, crown = tree([subroot for _, subroot, _ in found], fanout)
    out = []
    for (ordered, subroot, paths), upper in zip(found, crown):
        for row, path in zip(ordered, paths):
            steps = path + upper
            proof = digest("".join(a + b for a, b in steps))
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            end = leaf(row, 1) if hit else leaf(row)
            for a, b in steps:
                end = digest(a + end + b)
            out.append((row[0], leaf(row), subroot, root, proof, end, end == root))
    return sorted(out, key=str)


def rows_of(sizes):
    out = []
    for lang, n in sizes.items():
        for i in range(n):
            key = len(out) * 3
            out.append((key, "s" if i % 2 else None, lang, None if i % 5 == 4 else i, None if i % 7 == 6 else f"tèxt {i}"))
    return out


@pytest.mark.parametrize("fanout, depth", [(2, 1), (2, 3), (3, 2), (2, 10)])
def test_against_a_plain_tree(spark, fanout, depth):
    rows = rows_of({"en": 37, None: 1, "": 2, "é": 9, "z": 8, "de": 16})
    rows += [(7, "a", "en", 1, ""), (7, "b", "en", 1, None), (None, None, None, None, None), rows[0], rows[0]]
    docs = spark.createDataFrame(rows, KINDS).repartition(5)
    got = documents_manifest(docs, fanout, depth).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, fanout)


def test_lone_trees_empty_table_and_other_columns(spark):
    one = [(1, "s", "en", 3, "x y")]
    got = documents_manifest(spark.createDataFrame(one, KINDS)).collect()
    assert [tuple(r) for r in got] == brute(one, 2)
    assert got[0].leaf == got[0].subroot == got[0].root and got[0].proof_sha256 == digest("")
    assert documents_manifest(spark.createDataFrame([], KINDS)).collect() == []
    odd = spark.createDataFrame([(*one[0], "q", 1, "t")], KINDS + ", root string, `a.b` int, tree string")
    assert [tuple(r) for r in documents_manifest(odd).collect()] == brute(one, 2)


def test_tampering_shows(spark):
    rows = [(i, "s", "en", 1, "t") for i in range(60)]
    got = documents_manifest(spark.createDataFrame(rows, KINDS), depth=2).collect()
    for r in got:
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 7 != 0)
    assert {r.verified for r in got} == {True, False}


def test_tiers():
    assert [tiers(n, 2, 3) for n in (1, 8, 9, 64, 65)] == [1, 1, 2, 2, 3]
