"""Language model and quality scores against slow readings and held-out rows."""

from __future__ import annotations

import collections
import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from gridtide.llm.brown_scoring import exchange, score_texts
from gridtide.llm.ranking import fit_ranking, rank_quality

LOW = {i: i + 32 for i in range(65, 91)}


def held():
    return F.crc32(F.col("doc").cast("string")) % 5 == 1


def out(doc, remainder=1):
    return doc is not None and zlib.crc32(str(doc).encode()) % 5 == remainder


def two_languages(n, seed):
    """Texts of one of two vocabularies each: what class bigrams can learn."""
    rng = random.Random(seed)
    return [
        " ".join(f"{'ab'[i % 2]}{int(rng.paretovariate(0.7)) % 400}x" for _ in range(rng.randrange(80)))
        for i in range(n)
    ]


def test_base_counts_and_gain(spark, documents):
    texts = two_languages(200, 1) + [None, "", " \n", "A a Éa éA", "Unseen Words Only", "b1x " * 30_000]
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)] + [(3, texts[3], "x", "y"), (None, "A b1x", "x", "y")]
    docs = documents(rows, ("code", "score")).repartition(3)
    got = score_texts(docs, held(), units=40, n_classes=6).collect()
    tokens = [((r[1] or "").translate(LOW).encode().split()) + [b"\x00end"] for r in rows]
    counts = collections.Counter(w for r, t in zip(rows, tokens) if not out(r[0]) for w in t)
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        (r[0] is None, r[0], out(r[0]), len(t), sum(counts[w] > 0 for w in t), n,
         round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), 6))
        for r, t in zip(rows, tokens)
    )
    assert want == sorted(
        (r.doc is None, r.doc, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
        for r in got
    )
    kept_back = [r for r in got if r.held_out and r.doc < 200]
    assert sum(r.score for r in kept_back) > sum(r.base_score for r in kept_back)


def test_probabilities_sum_to_one(spark, documents):
    """Over all continuations of a text: known words, the end, and one unseen word a class."""
    docs = documents([(i, t) for i, t in enumerate(["a b a", "b c", "c a b a"])])
    rows = docs.selectExpr("doc_id as doc", "cast(text as binary) as text", "0L as mark")
    from gridtide.llm import brown_scoring as b

    model, counts = b.fit(rows, units=2, n_classes=3)
    words = {r.code: (r.ending, r.n) for r in counts.collect()}
    assert model.tokens == 12 and model.words == 4
    for before in range(3):
        total = 0.0
        for code, (ending, n) in words.items():
            codes = np.array([code]).view(np.uint64)
            unit, _ = model.units.of(codes, np.array([ending]))
            cls = model.classes[unit[0]]
            total += (n + 0.5) * 10 ** (model.steps[before, cls] - model.room[cls])
        unseen = sum(0.5 * 10 ** (model.steps[before, c] - model.room[c]) for c in range(3))
        assert abs(total + unseen - 1) < 1e-9


def test_exchange_finds_classes():
    rng = np.random.default_rng(1)
    true = np.arange(40) % 2
    classes = np.append(rng.integers(0, 2, 40), 2)
    pairs = np.zeros((41, 41))
    now = 0
    for _ in range(20_000):
        side = true[now] if rng.random() < 0.9 else 1 - true[now]
        then = int(rng.choice(np.flatnonzero(true == side)))
        pairs[now, then] += 1
        now = then
    for _ in range(6):
        of = np.eye(3)[classes]
        exchange(pairs.T @ of, pairs @ of, classes, 2)
    found = classes[:40]
    assert (found == true).all() or (found == 1 - true).all()


def test_empty_training(spark, documents):
    assert score_texts(documents([]), held()).count() == 0
    only = next(i for i in range(99) if out(i))
    got = score_texts(documents([(only, "a b")]), held()).collect()
    assert got[0].train_tokens == 0 and got[0].n_known == 0 and got[0].score < 0


def test_ranking_on_held_out(spark, documents):
    rng = random.Random(8)

    def clean():
        return "\n".join(" ".join(f"word{rng.randrange(900)}" for _ in range(12)) + "." for _ in range(rng.randrange(1, 9)))

    def junk():
        kind = rng.randrange(3)
        words = [f"w{rng.randrange(900)}" for _ in range(rng.randrange(20, 90))]
        if kind == 0:
            return " ".join(w + rng.choice(["%%%", "&&&", "***"]) for w in words)
        return " ".join(w.upper() + "!!" for w in words) if kind == 1 else " ".join(w for w in words[:9] for _ in range(9))

    rows = [(i, clean() if i % 4 else junk(), "x", "y") for i in range(600)]
    rows += [(9000, None, "x", "y"), (9001, "", "x", "y"), (None, "a", "x", "y"), (1, rows[1][1], "x", "y")]
    docs = documents(rows, ("quality", "mark"))
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(600)] + [(None, 1, 0), (5, None, 0)],
                                   "doc_id long, quality int, toxic int")
    ranking = fit_ranking(docs, labels, F.crc32(F.col("doc").cast("string")) % 5 != 0)
    ranked = rank_quality(docs, ranking)
    assert ranked.select("row.*").columns == docs.columns
    got = ranked.collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    apart = [r for r in got if out(r.row.doc_id, 0) and r.row.doc_id < 600]
    right = [r.predicted == (r.row.doc_id % 4 > 0) for r in apart]
    assert len(apart) > 80 and np.mean(right) > 0.97
    same = fit_ranking(docs, labels.limit(0), F.lit(True))
    assert {r.predicted for r in rank_quality(docs, same).collect()} == {1}
    assert rank_quality(documents([]), ranking).count() == 0


def test_ranking_learns_from_all_labelled_documents(spark, documents):
    """Mean, scale and threshold are those of all labelled documents, also of many."""
    from gridtide.llm.lines import count_block
    from gridtide.llm.ranking import CUT, features_of

    rng = random.Random(5)
    n, bad = 8000, 3500
    rows = []
    for i in range(n):
        words = [f"w{rng.randrange(700)}" for _ in range(rng.randrange(3, 40))]
        junk = i < bad and rng.random() < 0.9
        rows.append((i, " ".join(w + "%%" if junk and rng.random() < 0.5 else w for w in words) + f" {i}", "x", "y"))
    docs = documents(rows, ("quality", "mark"))
    labels = spark.createDataFrame([(i, int(i >= bad), 0) for i in range(n)], "doc_id long, quality int, toxic int")
    ranking = fit_ranking(docs, labels, F.lit(True))
    data = [row[1].encode() for row in rows]
    begins = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    features = features_of(count_block(np.frombuffer(b"".join(data), np.uint8), begins))
    assert np.allclose(ranking.mean, features.mean(axis=0), atol=1e-8)
    assert np.allclose(ranking.scale, features.std(axis=0) + 1e-3, atol=1e-5)
    scores = ranking.scores(features)
    ordered = np.sort(scores)
    last = ordered[bad - 1]
    assert last < CUT <= ordered[ordered > last + 1e-9][0]
    assert np.mean(scores[bad:] >= CUT) > 0.9
