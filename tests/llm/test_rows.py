"""Rows whose ids repeat or are missing, blocks of few words, columns with odd names."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridtide.llm.brown_scoring import score_texts
from gridtide.llm.decontamination import contaminated, drop_contaminated
from gridtide.llm.near_dedup import drop_near_copies, near_classes
from gridtide.llm.alignment import align_documents
from gridtide.llm.quality_rules import fit_field, judge_quality
from gridtide.llm.queries_manifest import piece_model_path
from gridtide.llm.queries_packing import tokenizer_path
from gridtide.llm.ranking import fit_ranking, rank_quality
from gridtide.llm.rows import TextRows
from gridtide.llm.shingles import shingles_of_block
from gridtide.llm.substring import drop_repeated_words
from gridtide.llm.suffix_array import drop_repeated_bytes

LONG = " ".join(f"word{i}" for i in range(120))


@pytest.mark.parametrize("n", range(8))
def test_blocks_of_few_words(spark, documents, n):
    text = " ".join(f"w{i}" for i in range(n)).encode()
    data = np.frombuffer(text, dtype=np.uint8)
    shingles, whole, words = shingles_of_block(data, np.array([0, len(data)]), 5)
    assert words.tolist() == [n] and len(shingles[0]) == (0 if n == 0 else max(1, n - 4))
    assert (whole[0] == 0) == (n == 0)
    if n in (0, 2, 3):
        got = near_classes(documents([(7, text.decode())])).collect()
        assert [(r.doc, r.class_id, r.kept) for r in got] == [(7, 7, True)]


def test_marks_only_where_ids_repeat_or_are_missing(spark, documents):
    rows = [(1, "a"), (2, "b"), (2, "c"), (2, "b"), (None, "a"), (None, None)]
    got = {(r.doc, bytes(r.text)): len(r.mark) for r in TextRows(documents(rows), "doc_id", "text").texts().collect()}
    assert got == {(1, b"a"): 0, (2, b"b"): 16, (2, b"c"): 16, (None, b"a"): 16, (None, b""): 16}


@pytest.mark.parametrize("drop", [drop_repeated_bytes, drop_repeated_words])
def test_texts_of_one_id_are_cut_each_by_itself(spark, documents, drop):
    rows = [(1, LONG), (5, "before " + LONG + " after"), (5, "short"), (5, LONG[:300]), (5, "short"), (None, LONG)]
    got = sorted(
        (r.row.doc_id if r.row.doc_id is not None else -1, r.row.text, bytes(r.cut.kept).decode().split())
        for r in drop(documents(rows, ()).repartition(4)).collect()
    )
    left = {text: kept for doc, text, kept in got if doc == 5}
    assert len(got) == 6 and left["short"] == ["short"]
    assert left["before " + LONG + " after"] == ["before", "after"]
    assert {text: kept for doc, text, kept in got if doc == 1} == {LONG: LONG.split()}
    assert {text: kept for doc, text, kept in got if doc == -1} == {LONG: LONG.split()}


def test_texts_of_one_id_are_classed_each_by_itself(spark, documents):
    other = " ".join(f"other{i}" for i in range(80))
    rows = [(5, LONG), (5, other), (5, LONG), (6, LONG + " more"), (None, LONG), (None, LONG)]
    kept = sorted(map(str, ((r.doc_id, r.text) for r in drop_near_copies(documents(rows)).collect())))
    assert kept == sorted(map(str, [(5, LONG), (5, other), (None, LONG), (None, LONG)]))


def test_a_clean_text_stays_whatever_else_has_its_id(spark, documents):
    item = "how many apples does the farmer have after he sold twelve of them at the market"
    rows = [(5, "so " + item + " then"), (5, "a clean text of some words"), (None, item)]
    bench = documents([(1, item)]).withColumnRenamed("doc_id", "item_id")
    assert [r.doc for r in contaminated(documents(rows), bench).collect()] == [5]
    kept = drop_contaminated(documents(rows), bench).collect()
    assert sorted(str(r.doc_id) + r.text[:3] for r in kept) == ["5a c", "Nonehow"]


def test_texts_without_id_are_scored_each_by_itself(spark, documents):
    rows = [(None, " ".join(["a"] * 74)), (None, "b c"), (None, "b c"), (None, None), (3, "a b"), (3, "a b c d")]
    got = score_texts(documents(rows), F.col("doc") == 3)
    assert sorted((str(r.doc), r.n_tokens) for r in got.collect()) == [
        ("3", 3), ("3", 5), ("None", 1), ("None", 3), ("None", 3), ("None", 75)]
    assert {r.score for r in got.where("n_tokens = 3 and doc is null").collect()} != set()


def test_columns_with_odd_names(spark, documents):
    docs = documents([(1, LONG, "x", "y"), (2, "few words", "x", "y")], ("a.b", "row"))
    for drop in (drop_repeated_bytes, drop_repeated_words):
        assert drop(docs).select("row.`a.b`").count() == 2
    assert drop_near_copies(docs).columns == docs.columns
    bench = documents([(1, "some item of eight words or even more")]).withColumnRenamed("doc_id", "item_id")
    assert drop_contaminated(docs, bench).columns == docs.columns
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert judge_quality(docs, fit_field(docs, labels)).select("row.`a.b`").count() == 2
    assert rank_quality(docs, fit_ranking(docs, labels, F.lit(True))).select("row.`a.b`").count() == 2
    assert align_documents(docs, tokenizer_path(), piece_model_path()).count() == 2
