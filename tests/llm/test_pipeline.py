"""The stages over a small corpus: each decision is checked where it is taken."""

from __future__ import annotations

import os
import random

import pytest

import corpus_pipeline as cp
from gridtide.llm.packing import cut
from gridtide.llm.queries_packing import tokenizer_path
from gridtide.llm.tokens import encoder

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages(spark, tmp_path):
    rng = random.Random(6)

    def prose(lines):
        return "\n".join(
            " ".join(f"word{rng.randrange(2000)}" for _ in range(14)) + "." for _ in range(lines)
        )

    def junk():
        return "\n".join(" ".join(f"W{rng.randrange(900)}%% &&" for _ in range(10)) for _ in range(8))

    texts = [prose(10) if i % 3 else junk() for i in range(60)]
    passage = " ".join(f"shared{i}" for i in range(30))
    item = " ".join(f"exam{i}" for i in range(20))
    near = texts[1].split(" ")
    near[50] = "changed"
    extra = [texts[1], " ".join(near), prose(9) + " " + passage + ".", prose(9) + " " + passage + ".",
             prose(9) + " " + item + " end.", "too short", "", None]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts + extra)]
    first = len(texts)
    d = str(tmp_path)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(40)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")

    docs = spark.read.parquet(f"{d}/documents.parquet")
    names = [n for n, _ in cp.STAGES]
    assert names == ["quality_rules", "near_dedup", "suffix_array_dedup",
                     "benchmark_decontamination", "best_fit_packing"]
    kept = {}
    for name, function in cp.STAGES[:-1]:
        docs = function(spark, docs, d)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs.write.parquet(f"{d}/{name}")
        docs = spark.read.parquet(f"{d}/{name}")
        kept[name] = {r.doc_id: r for r in docs.collect()}
    clean = {i for i in range(60) if i % 3} | {first + i for i in range(5)}
    assert set(kept["quality_rules"]) == clean
    assert set(kept["near_dedup"]) == clean - {first, first + 1}
    cut_docs = kept["suffix_array_dedup"]
    assert set(cut_docs) == set(kept["near_dedup"])
    assert passage in cut_docs[first + 2].text and "shared9" not in cut_docs[first + 3].text
    assert all(r.n_chars == len(r.text) for r in cut_docs.values())
    assert set(kept["benchmark_decontamination"]) == set(cut_docs) - {first + 4}

    encode = encoder(tokenizer_path())
    got = sorted((r.doc_id, r.piece, r.length) for r in cp.run(spark, d).collect())
    want = sorted(
        (doc, n, size) for doc, r in kept["benchmark_decontamination"].items()
        for n, (_, size) in enumerate(cut(len(encode(r.text)) // 4 + 1, 2048))
    )
    assert got == want


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")
@pytest.mark.parametrize("name, stage_of", cp.STAGES[:-1])
def test_stages_take_odd_rows(spark, name, stage_of):
    rng = random.Random(8)

    def text():
        words = ["".join(rng.choices(["ba", "ren", "to", "lis", "mo", "der", "an"], k=3)) for _ in range(120)]
        return "\n".join(" ".join(words[i: i + 12]).capitalize() + "." for i in range(0, 120, 12))

    prose, other = text(), text()
    rows = [(1, prose), (1, other), (1, prose), (None, prose), (None, None), (2, None), (3, ""), (4, "two words")]
    kinds = "doc_id long, text string, lang string, source string, n_chars long, `a.b` string, mark string"
    docs = spark.createDataFrame(
        [(i, t, "en", "s", None if t is None else len(t), "x", "y") for i, t in rows], kinds)
    got = stage_of(spark, docs, SF_DIR)
    assert got.columns == docs.columns
    kept = {(r["doc_id"], r["text"]) for r in got.collect()}
    if name == "quality_rules":  # too short ones fail, whatever their id
        assert kept == {(1, prose), (1, other), (None, prose)}
    else:
        assert {(1, prose), (1, other), (None, prose)} <= kept and (4, "two words") in kept
        assert got.count() == len(rows) - (name == "near_dedup")  # equal rows of one id count once there
    assert stage_of(spark, docs.limit(0), SF_DIR).count() == 0
