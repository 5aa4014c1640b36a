"""Quality classifier: Bradley-Terry pairwise ranking.

Each document has a strength, linear in features of its text; of a good and a bad one, the good
one is preferred with the logistic probability of the difference of strengths. The weights
minimise that loss over pairs of all labelled documents, by Newton's method: tasks sum gradient and
curvature, the driver sees no documents. A quantile of all their strengths, the share of bad ones
among the labelled, becomes the decision threshold.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from gridtide.llm.lines import LINE_FEATURES, Counts, count_block
from gridtide.llm.rows import text_of, whole_row
from gridtide.llm.samples import marks
from gridtide.llm.windows import text_blocks
from gridtide.staging import stage

#: about how many documents of the rarer mark each of the other one is compared with
PAIRS_EACH = 20
#: about how many documents of the more frequent mark one cell of comparisons holds
CELL = 2000
PULL = 1e-3
BINS = 1024
CUT = 0.3
#: documents of fewer words than this are pulled towards the average
STEADY = 5.0


@dataclass(frozen=True)
class Ranking:
    """Mean and scale of features, weights, and the strength at which a score is CUT."""

    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    threshold: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        """Scores between 0 and 1, rising with strength; CUT at the threshold."""
        x = np.clip((features - self.mean) / self.scale, -8, 8)
        z = x @ np.array(self.weights) - self.threshold + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def features_of(counts: Counts) -> np.ndarray:
    """Features of whole texts: their lines' features weighted by words, and how words repeat."""
    n = len(counts.words)
    words = counts.words.astype(float)
    steady = words + STEADY
    columns = [
        np.bincount(counts.line_text, weights=counts.line_features[:, k] * counts.line_words,
                    minlength=n) / steady
        for k in range(1, len(LINE_FEATURES))
    ]
    lines = np.bincount(counts.line_text, minlength=n)
    # what share of different words a text of this length would have is about n ** -0.2
    variety = counts.distinct / np.maximum(words, 1) ** 0.8
    columns += [
        counts.repeat_words / steady, variety, counts.dup_lines / (lines + 1.0),
        np.log1p(words) / 10, lines / steady, counts.symbols / steady, (words == 0).astype(float),
    ]
    return np.stack(columns, axis=1)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, begins in text_blocks(batches):
        features = features_of(count_block(data, begins))
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array(list(features), type=pa.list_(pa.float64()))],
            names=["doc", "features"],
        )


def _matrix(column: pa.Array, k: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, k)


def _total(rows: DataFrame, measure: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """Sum of what ``measure`` gives for each batch: one array from each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            part = measure(batch)
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"part": pa.array([total], pa.list_(pa.float64()))})

    return np.sum([r.part for r in rows.mapInArrow(run, "part array<double>").collect()], axis=0)


def _moments(k: int):
    """Documents of either mark, sums of features and of their squares."""

    def measure(batch: pa.RecordBatch) -> np.ndarray:
        x, mark = _matrix(batch.column(1), k), batch.column(0).to_numpy()
        return np.concatenate([[np.sum(mark == 0), np.sum(mark == 1)], x.sum(axis=0), (x * x).sum(axis=0)])

    return measure


def _cells(rows: DataFrame, n_bad: int, n_good: int) -> DataFrame:
    """Cells of documents to compare, each good one of a cell with each bad one: (good, bad), the
    features of one after the other. Documents of the rarer mark are dealt by hash over buckets of
    about PAIRS_EACH, the others over cells that take the buckets in turn; so each document is
    compared, and no cell grows with the corpus."""
    least, most = sorted((n_bad, n_good))
    buckets = -(-least // PAIRS_EACH)
    copies = -(-most // (buckets * CELL))
    drawn = F.xxhash64("doc", "features")
    rare = F.col("mark") == (0 if n_bad <= n_good else 1)
    own = F.transform(
        F.sequence(F.lit(0), F.lit(copies - 1)), lambda i: i * buckets + F.pmod(drawn, F.lit(buckets))
    )
    cells = F.when(rare, own).otherwise(F.array(F.pmod(drawn, F.lit(buckets * copies))))
    dealt = rows.select("mark", "features", F.explode(cells).alias("cell"))

    def side(mark: int) -> Column:
        return F.flatten(F.collect_list(F.when(F.col("mark") == mark, F.col("features"))))

    return dealt.groupBy("cell").agg(side(1).alias("good"), side(0).alias("bad")).drop("cell")


def _slope(mean: np.ndarray, scale: np.ndarray, w: np.ndarray):
    """Over all comparisons: their number, loss, its gradient and curvature at the weights."""
    k = len(w)

    def measure(batch: pa.RecordBatch) -> np.ndarray:
        total = np.zeros(2 + k + k * k)
        for sides in zip(batch.column(0), batch.column(1)):
            good, bad = (
                np.clip((s.values.to_numpy().reshape(-1, k) - mean) / scale, -8, 8) for s in sides
            )
            apart = (good @ w)[:, None] - (bad @ w)
            p = 1 / (1 + np.exp(np.clip(apart, -500, 500)))
            bend = p * (1 - p)
            mixed = good.T @ bend @ bad
            curve = (good.T * bend.sum(axis=1)) @ good + (bad.T * bend.sum(axis=0)) @ bad - mixed - mixed.T
            slope = bad.T @ p.sum(axis=0) - good.T @ p.sum(axis=1)
            total += np.concatenate([[apart.size, np.logaddexp(0, -apart).sum()], slope, curve.ravel()])
        return total

    return measure


def _fit_weights(cells: DataFrame, mean: np.ndarray, scale: np.ndarray, steps: int) -> np.ndarray:
    """Newton's method on the mean loss and a slight pull to zero; steps that don't lower it are
    halved."""
    k = len(mean)

    def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        total = _total(cells, _slope(mean, scale, w))
        n, loss, slope, curve = total[0], total[1], total[2: 2 + k], total[2 + k:].reshape(k, k)
        return loss / n + PULL * (w @ w) / 2, slope / n + PULL * w, curve / n + PULL * np.eye(k)

    w = np.zeros(k)
    loss, slope, curve = at(w)
    move = -np.linalg.solve(curve, slope)
    for _ in range(steps):
        if np.abs(move).max() < 1e-7:
            break
        tried = at(w + move)
        if tried[0] > loss + 1e-12:
            move = move / 2
            continue
        w, (loss, slope, curve) = w + move, tried
        move = -np.linalg.solve(curve, slope)
    return np.round(w, 6)


class _Strength:
    """Strengths of a batch of (mark, features)."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray):
        self.mean, self.scale, self.weights = mean, scale, weights
        self.bound = 8 * float(np.abs(weights).sum())

    def __call__(self, batch: pa.RecordBatch) -> np.ndarray:
        x = _matrix(batch.column(1), len(self.mean))
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights


def _threshold(rows: DataFrame, strength: _Strength,
               n_bad: int, n_good: int, share: float) -> float:
    """Half way from the quantile of all strengths at ``share`` to the next strength above. Marks
    are weighted as they stand in the labels. Counts in bins, of the bin reached then in finer
    ones, find it."""

    def reached(edges: np.ndarray) -> np.ndarray:
        def measure(batch: pa.RecordBatch) -> np.ndarray:
            s, mark = strength(batch), batch.column(0).to_numpy()
            return np.concatenate(
                [np.searchsorted(np.sort(s[mark == m]), edges, side="right") for m in (0, 1)]
            ).astype(float)

        bad, good = np.split(_total(rows, measure), 2)
        return bad * (share / n_bad) + good * ((1 - share) / n_good)

    # clipped features bound the strengths
    high = 1e-6 + strength.bound
    low = -high
    for _ in range(5):
        edges = np.linspace(low, high, BINS + 1)
        up = max(int(np.searchsorted(reached(edges), share - 1e-9)), 1)
        low, high = edges[min(up, BINS) - 1], edges[min(up, BINS)]

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = strength(batch)
            yield pa.RecordBatch.from_pydict({
                "at": pa.array([s[s <= high].max(initial=-np.inf)]), "above": pa.array([s[s > high].min(initial=np.inf)]),
            })

    ends = rows.mapInArrow(around, "at double, above double").agg(F.max("at"), F.min("above")).first()
    at, above = float(ends[0]), float(ends[1])
    return (at + above) / 2 if np.isfinite(above) else at


def fit_ranking(
    docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", steps: int = 300
) -> Ranking:
    """Weights and threshold from all labelled documents that fulfil ``learn`` (a condition on the
    column ``doc``), each compared with about PAIRS_EACH of the rarer mark or more. One with several
    texts takes part with each. Without both marks all scores are the same, just above CUT.
    ``steps`` is the most that Newton's method takes."""
    ids = docs["doc_id"].cast("long").alias("doc")
    rows = docs.select(ids, text_of(docs, "text").cast("binary").alias("text")).where("doc is not null")
    # features are smaller than texts: they are what the join may move
    known = marks(labels, label, learn)
    found = rows.mapInArrow(_features, "doc long, features array<double>").join(known, "doc")
    found = stage(found.select("mark", "features", "doc"), "ranking-features")
    k = features_of(count_block(np.zeros(0, np.uint8), np.zeros(2, np.int64))).shape[1]
    measured = np.atleast_1d(_total(found, _moments(k)))
    if len(measured) < 2 or not measured[0] or not measured[1]:
        return Ranking((0.0,) * k, (1.0,) * k, (0.0,) * k, -1e-6)
    n_bad, n_good = int(measured[0]), int(measured[1])
    n = n_bad + n_good
    mean = np.round(measured[2: 2 + k] / n, 9)
    spread = np.sqrt(np.maximum(measured[2 + k:] / n - mean * mean, 0))
    scale = np.round(spread, 6) + 1e-3
    weights = _fit_weights(stage(_cells(found, n_bad, n_good), "ranking-cells"), mean, scale, steps)
    each = labels.select(
        labels["doc_id"].cast("long").alias("doc"), labels[label].cast("int").alias("mark")
    ).where("doc is not null and mark in (0, 1)").where(learn)
    share = each.agg(F.avg((F.col("mark") == 0).cast("double"))).first()[0]
    threshold = _threshold(found, _Strength(mean, scale, weights), n_bad, n_good, share)
    plain = lambda x: tuple(float(v) for v in x)
    return Ranking(plain(mean), plain(scale), plain(weights), threshold)


def _score(ranking: Ranking):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, begins in text_blocks(batches):
            score = ranking.scores(features_of(count_block(data, begins)))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(score)], names=["row", "score"]
            )

    return run


def rank_quality(docs: DataFrame, ranking: Ranking, text_column: str = "text") -> DataFrame:
    """``row`` (struct of the input's columns), score and predicted (1 from CUT on).

    Null and empty texts are scored like any text without words. Each row is scored by itself,
    so repeated rows and rows without id need nothing more; texts are read whole; no rows give
    none.
    """
    text = text_of(docs, text_column).cast("binary")
    rows = docs.select(whole_row(docs).alias("row"), text.alias("text"))
    schema = T.StructType([rows.schema["row"]]).add("score", "double")
    scored = rows.mapInArrow(_score(ranking), schema)
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
