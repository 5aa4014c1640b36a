"""Line labelling and counts against slow readings."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np

from gridtide.llm.quality_rules import ALL_CONTENT, _likelihood, fit_field, judge_quality, viterbi

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    seen, copies, windows = set(), 0, {}
    for line in text.split("\n"):
        if WORD.search(line):
            copies += line in seen
            seen.add(line)
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i: i + 3]), []).append(i)
    repeat = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    failed = len(words) < 50 or 100 * len(repeat) > 50 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, copies, len(repeat), failed


def test_counts(spark, documents):
    rng = random.Random(1)
    pieces = ["a", "b", "éß", "#", "x|y", " ", "  ", "\n", "\t", "\r\n", "\x0b", "世界", " ", "Z!"]
    texts = ["".join(rng.choice(pieces) + rng.choice(["", " "]) for _ in range(rng.randrange(300))) for _ in range(150)]
    texts += [None, "", "\n\n", "word " * 60, " ".join(f"w{i}" for i in range(80)), "long " * 200_000]
    docs = documents([(i, t, "x", "y") for i, t in enumerate(texts)], ("kept", "row"))
    got = judge_quality(docs, ALL_CONTENT)
    assert got.select("row.*").columns == docs.columns
    for r in got.collect():
        want = base(r.row.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        assert r.kept == (not want[-1])


def test_viterbi_and_gradient():
    rng = np.random.default_rng(2)
    pairs = ((0.4, -1.0), (-0.3, 0.9))
    for n in range(1, 8):
        scores = rng.normal(size=n)

        def total(marks):
            steps = sum(pairs[a][b] for a, b in zip(marks, marks[1:]))
            return scores @ np.array(marks) + steps

        best = max(map(total, itertools.product((0, 1), repeat=n)))
        assert abs(total(viterbi(scores, pairs)) - best) < 1e-9
    x, y, real = rng.normal(size=(3, 4, 2)), rng.integers(0, 2, (3, 4)).astype(float), np.ones((3, 4), bool)
    real[1, 2:] = False

    def likelihood(theta):
        out = 0.0
        for i in range(3):
            n = int(real[i].sum())

            def score(marks):
                steps = sum(theta[2:].reshape(2, 2)[a, b] for a, b in zip(marks, marks[1:]))
                return sum((x[i, t] @ theta[:2]) * marks[t] for t in range(n)) + steps

            every = [score(m) for m in itertools.product((0, 1), repeat=n)]
            out += score([int(v) for v in y[i, :n]]) - np.logaddexp.reduce(every)
        return out

    theta = rng.normal(size=6)
    slope = [(likelihood(theta + 1e-5 * e) - likelihood(theta - 1e-5 * e)) / 2e-5 for e in np.eye(6)]
    assert np.allclose(_likelihood(x, y, real, theta) * real.sum(), slope, atol=1e-5)


def test_fitted_field_tells_junk(spark, documents):
    rng = random.Random(3)

    def clean():
        return "\n".join(" ".join(f"word{rng.randrange(900)}" for _ in range(12)) + "." for _ in range(8))

    def junk():
        return "\n".join(" ".join(f"W{rng.randrange(900)}%% &&" for _ in range(10)) for _ in range(8))

    rows = [(i, clean() if i % 2 else junk()) for i in range(120)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(None, 1, 0), (3, None, 0)],
                                   "doc_id long, quality int, toxic int")
    field = fit_field(documents(rows), labels)
    got = {r.row.doc_id: r.kept for r in judge_quality(documents(rows), field).collect()}
    assert got == {i: bool(i % 2) for i in range(120)}
    assert fit_field(documents(rows), labels.limit(0)) == ALL_CONTENT
    assert judge_quality(documents([]), field).count() == 0
