"""Quality rules: a linear-chain conditional random field marks the lines of a text as content
or boilerplate; what share of its words is content decides about a text.

The field has a weight for each line feature and for each pair of neighbouring marks. It is
fitted by maximum likelihood on a bounded sample of labelled documents, whose lines take the
mark of their document; a text is decoded by Viterbi's algorithm over all its lines.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from gridtide.llm.lines import LINE_FEATURES, count_block
from gridtide.llm.rows import text_of, whole_row
from gridtide.llm.samples import labelled_sample
from gridtide.llm.windows import text_blocks

SAMPLE = 1500
#: a longer text is several chains for the fit; decoding takes it whole
CHAIN = 60
MIN_WORDS = 50
MIN_SHARE = 0.5
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content_words",
)


@dataclass(frozen=True)
class Field:
    """Score of mark 1 (content) over mark 0 by feature, and of each pair of marks."""

    weights: tuple[float, ...]
    pairs: tuple[tuple[float, float], tuple[float, float]]


#: without labelled lines of both kinds nothing is called boilerplate
ALL_CONTENT = Field((1.0, *[0.0] * (len(LINE_FEATURES) - 1)), ((0.0, 0.0), (0.0, 0.0)))


def viterbi(scores: np.ndarray, pairs) -> list[int]:
    """The best marks of a chain, given each line's score of content; ties go to content."""
    (stay0, up), (down, stay1) = pairs
    zero, one = 0.0, 0.0
    back = []
    for i, score in enumerate(scores.tolist()):
        if i:
            fell, held = zero + stay0 <= one + down, zero + up <= one + stay1
            back.append((fell, held))
            zero, one = (
                one + down if fell else zero + stay0,
                one + stay1 if held else zero + up,
            )
        one += score
    mark = int(one >= zero)
    marks = [mark]
    for step in reversed(back):
        mark = int(step[mark])
        marks.append(mark)
    return marks[::-1]


def _sample_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, begins in text_blocks(batches):
        counts = count_block(data, begins)
        marks = rows.column(2).to_numpy(zero_copy_only=False)
        edges = np.searchsorted(counts.line_text, np.arange(len(marks) + 1))
        chains = [
            (mark, counts.line_features[at: min(at + CHAIN, b)].ravel())
            for mark, a, b in zip(marks.tolist(), edges, edges[1:]) for at in range(a, b, CHAIN)
        ]
        yield pa.RecordBatch.from_arrays(
            [pa.array([mark for mark, _ in chains], type=pa.int32()),
             pa.array([lines for _, lines in chains], type=pa.list_(pa.float64()))],
            names=["mark", "lines"],
        )


def _likelihood(x: np.ndarray, y: np.ndarray, real: np.ndarray, theta: np.ndarray):
    """Gradient of the mean log likelihood of marks y (text, line) given x, lines as real."""
    k = x.shape[2]
    weights, pairs = theta[:k], theta[k:].reshape(2, 2)
    one = x @ weights
    emit = np.stack([np.zeros_like(one), one], axis=2)
    n, size, _ = emit.shape
    forward, backward = np.zeros((n, size, 2)), np.zeros((n, size, 2))
    forward[:, 0] = emit[:, 0]
    for t in range(1, size):
        step = np.logaddexp(
            forward[:, t - 1, 0, None] + pairs[0], forward[:, t - 1, 1, None] + pairs[1]
        ) + emit[:, t]
        forward[:, t] = np.where(real[:, t, None], step, forward[:, t - 1])
    for t in range(size - 2, -1, -1):
        ahead = emit[:, t + 1] + backward[:, t + 1]
        step = np.logaddexp(ahead[:, 0, None] + pairs[:, 0], ahead[:, 1, None] + pairs[:, 1])
        backward[:, t] = np.where(real[:, t + 1, None], step, 0.0)
    total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
    belief = np.exp(forward + backward - total[:, None, None])
    grad = np.einsum("ntk,nt->k", x, (y - belief[:, :, 1]) * real)
    grad_pairs = np.zeros((2, 2))
    both = real[:, 1:]
    for a in (0, 1):
        for b in (0, 1):
            p = np.exp(
                forward[:, :-1, a] + pairs[a, b] + emit[:, 1:, b] + backward[:, 1:, b]
                - total[:, None]
            )
            seen = (y[:, :-1] == a) & (y[:, 1:] == b)
            grad_pairs[a, b] = ((seen - p) * both).sum()
    return np.concatenate([grad, grad_pairs.ravel()]) / real.sum()


def fit_field(docs: DataFrame, labels: DataFrame, steps: int = 150) -> Field:
    """A field fitted on all lines of up to SAMPLE labelled documents of each mark
    (labels.quality), drawn by hashed id.

    Without documents of both marks, as in empty tables, all lines are content. Null labels and
    rows without id are left out, null and empty texts have no lines, repeated rows take part
    each, other columns are not read.
    """
    rows = labelled_sample(docs, labels, "quality", SAMPLE).mapInArrow(
        _sample_lines, "mark int, lines array<double>"
    ).collect()
    rows = sorted(((r.mark, r.lines) for r in rows if r.lines), key=lambda r: (r[0], r[1]))
    k = len(LINE_FEATURES)
    if len({mark for mark, _ in rows}) < 2:
        return ALL_CONTENT
    size = max(len(lines) // k for _, lines in rows)
    x = np.zeros((len(rows), size, k))
    real = np.zeros((len(rows), size), dtype=bool)
    for i, (_, lines) in enumerate(rows):
        n = len(lines) // k
        x[i, :n] = np.reshape(lines, (n, k))
        real[i, :n] = True
    y = np.repeat(np.array([[float(mark)] for mark, _ in rows]), size, axis=1)
    theta = np.zeros(k + 4)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):  # Adam, with a slight pull to zero
        grad = _likelihood(x, y, real, theta) - 1e-4 * theta
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad * grad
        theta = theta + 0.2 * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
    theta = [round(float(v), 6) for v in theta]
    return Field(tuple(theta[:k]), (tuple(theta[k: k + 2]), tuple(theta[k + 2:])))


def _judge(field: Field):
    weights = np.array(field.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, begins in text_blocks(batches):
            counts = count_block(data, begins)
            n = len(begins) - 1
            scores = counts.line_features @ weights
            edges = np.searchsorted(counts.line_text, np.arange(n + 1))
            content = np.zeros(n, dtype=np.int64)
            for i in range(n):
                a, b = edges[i], edges[i + 1]
                if b > a:
                    marks = viterbi(scores[a:b], field.pairs)
                    content[i] = counts.line_words[a:b] @ np.array(marks)
            values = (counts.words, counts.word_chars, counts.symbols, counts.dup_lines,
                      counts.repeat_words, content)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), *(pa.array(v.astype(np.int64)) for v in values)],
                names=["row", *COUNTS],
            )

    return run


def judge_quality(
    docs: DataFrame, field: Field, text_column: str = "text", min_share: float = MIN_SHARE
) -> DataFrame:
    """``row`` (struct of the input's columns), the counts, base_failed and kept.

    base_failed: fewer than 50 words, or more than half of them in repeated three-word
    windows. kept: not base_failed, and at least ``min_share`` of the words stand in lines
    decoded as content. Null texts have no words and fail; every row is judged by itself, so
    repeated rows and rows without id change nothing; no rows give none.
    """
    text = text_of(docs, text_column).cast("binary")
    rows = docs.select(whole_row(docs).alias("row"), text.alias("text"))
    schema = T.StructType([rows.schema["row"]])
    for name in COUNTS:
        schema = schema.add(name, "long")
    counted = rows.mapInArrow(_judge(field), schema)
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words")
    )
    share = F.col("content_words") >= min_share * F.col("n_words")
    return counted.withColumn("base_failed", failed).withColumn("kept", ~failed & share)
