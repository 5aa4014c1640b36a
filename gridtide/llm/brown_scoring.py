"""LM scoring with Brown class-based bigrams.

P(word | word before) = P(class | class before) * P(word | class). Exchange clustering assigns
words to classes: a word moves to the class where the likelihood of the training text gains
most, until few move. Units of clustering are the most frequent words by themselves and all
other words by how they end, so every word has a class, also one never seen; their number and
that of classes are parameters, so the tables that a task or the driver holds have a fixed
size. All counts (words, neighbours, classes) are made by Spark over all training texts.

Smoothing: every class keeps half a count for each of its words and for one unseen word, as the
unigram base does over all words; class transitions are mixed with the classes' own shares.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from gridtide.llm.rows import TextRows
from gridtide.llm.windows import mix, text_blocks, word_codes, words_of
from gridtide.staging import stage

UNITS = 4096
ENDINGS = 512
CLASSES = 48
ROUNDS = 6
FREQUENT = 1 << 17
GATHERED = 1 << 19
END_CODE = np.uint64(1)
PARTS = (
    "doc long, mark binary, code long, n long, main boolean, n_tokens long, n_known long, "
    "base double, score double"
)


def tokens_of_block(data: np.ndarray, begins: np.ndarray):
    """Codes of lower-cased words with an end after each text, their endings, and where each
    text begins."""
    low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    start, end, first = words_of(low, begins)
    n_texts, n_words = len(begins) - 1, len(start)
    last = [low[np.maximum(end - 1 - i, start)].astype(np.uint64) for i in range(3)]
    with np.errstate(over="ignore"):
        code = word_codes(low, start, end)
        # the last bytes, spelled out
        ending = mix(last[0] + last[1] * np.uint64(256) + last[2] * np.uint64(65536))
    size = n_words + n_texts
    place = np.arange(n_words) + np.repeat(np.arange(n_texts), np.diff(first))
    codes = np.full(size, END_CODE, dtype=np.uint64)
    endings = np.zeros(size, dtype=np.int64)
    codes[place] = code
    endings[place] = (ending % np.uint64(ENDINGS)).astype(np.int64)
    return codes, endings, first + np.arange(n_texts + 1)


@dataclass
class Units:
    """Sorted codes of the most frequent words, their unit and count."""

    codes: np.ndarray
    unit: np.ndarray
    count: np.ndarray
    n_units: int

    @property
    def end(self) -> int:
        return self.n_units + ENDINGS

    def of(self, codes: np.ndarray, endings: np.ndarray):
        """Unit of each token, and its count if it is among the frequent ones, else -1."""
        unit = self.n_units + endings
        count = np.full(len(codes), -1, dtype=np.int64)
        if len(self.codes):
            at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
            same = self.codes[at] == codes
            count[same] = self.count[at[same]]
            own = np.where(same, self.unit[at], -1)
            unit = np.where(own >= 0, own, unit)
        return np.where(codes == END_CODE, self.end, unit), count


def _tokens(batches: Iterator[pa.RecordBatch]):
    """Codes and endings of the tokens of whole texts, gathered over blocks to GATHERED tokens or
    more: enough to count before anything is sent, little enough to hold."""
    held: list[tuple] = []
    size = 0
    for _, data, begins in text_blocks(batches):
        codes, endings, _ = tokens_of_block(data, begins)
        held.append((codes, endings.astype(np.int32)))
        size += len(codes)
        if size >= GATHERED:
            yield tuple(np.concatenate(part) for part in zip(*held))
            held, size = [], 0
    if held:
        yield tuple(np.concatenate(part) for part in zip(*held))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for codes, endings in _tokens(batches):
        found, at, times = np.unique(codes, return_index=True, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.view(np.int64)), pa.array(endings[at]), pa.array(times)],
            names=["code", "ending", "n"],
        )


def _count_pairs(units):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Units(*units.value)
        size = known.end + 1
        for codes, endings in _tokens(batches):
            unit, _ = known.of(codes, endings)
            # what precedes a text's first token is the end of a text
            before = np.append(known.end, unit[:-1])
            found, times = np.unique(before * size + unit, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array((found // size).astype(np.int32)), pa.array((found % size).astype(np.int32)),
                 pa.array(times)],
                names=["a", "b", "n"],
            )

    return run


def _plogp(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def exchange(before: np.ndarray, after: np.ndarray, classes: np.ndarray, fixed: int) -> int:
    """One round: each unit moves to its best class, given counts of the classes before and
    after it (unit, class). Changes ``classes``; returns how many moved. Class ``fixed`` (of
    the end alone) takes and gives none. Transitions follow each move; the neighbours' classes
    are those of the round's beginning."""
    n_classes = before.shape[1]
    table = np.zeros((n_classes, n_classes))
    np.add.at(table, classes, after)
    total = table.sum(axis=1)
    size = after.sum(axis=1)
    moved = 0
    others = np.array([c for c in range(n_classes) if c != fixed])
    for u in np.argsort(-size, kind="stable"):
        own = classes[u]
        if own == fixed or not size[u]:
            continue
        table[own] -= after[u]
        table[:, own] -= before[u]
        total[own] -= size[u]
        safe = np.maximum(table, 0.0)
        old = _plogp(safe)
        gain = (_plogp(safe + after[u]) - old).sum(axis=1)
        gain += (_plogp(safe + before[u][:, None]) - old).sum(axis=0)
        gain -= 2 * (_plogp(np.maximum(total, 0) + size[u]) - _plogp(np.maximum(total, 0)))
        best = int(others[np.argmax(gain[others])])
        if gain[best] <= gain[own] + 1e-9:
            best = own
        moved += best != own
        classes[u] = best
        table[best] += after[u]
        table[:, best] += before[u]
        total[best] += size[u]
    return moved


@dataclass
class Model:
    """What scoring needs: counts of the training text and log10 probabilities."""

    units: Units
    classes: np.ndarray
    tokens: int
    words: int
    steps: np.ndarray
    room: np.ndarray
    end_count: int


def fit(train: DataFrame, units: int = UNITS, n_classes: int = CLASSES, rounds: int = ROUNDS):
    """(model, table of counts) of texts given as (doc, text, mark)."""
    spark = train.sparkSession
    counts = stage(
        train.mapInArrow(_count_words, "code long, ending int, n long")
        .groupBy("code").agg(F.min("ending").alias("ending"), F.sum("n").alias("n")),
        "word-counts",
    )
    row = counts.agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("words"),
                     F.sum(F.when(F.col("code") == int(END_CODE), F.col("n"))).alias("ends")).first()
    tokens, words, ends = row.tokens or 0, row.words, row.ends or 0
    word = counts.where(F.col("code") != int(END_CODE))
    # a fixed number of rows, whatever the size of the corpus
    top = word.orderBy(F.desc("n"), "code").limit(max(FREQUENT, units)).toPandas()
    code = top["code"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(code)
    unit = np.where(np.arange(len(code)) < units, np.arange(len(code)), -1)
    known = Units(code[order], unit[order], top["n"].to_numpy(dtype=np.int64)[order], min(units, len(code)))
    # plain values: a broadcast names classes by module, which executors may lack
    sent = spark.sparkContext.broadcast(tuple(vars(known).values()))
    pairs = stage(
        train.mapInArrow(_count_pairs(sent), "a int, b int, n long")
        .groupBy("a", "b").agg(F.sum("n").alias("n")),
        "pairs",
    )
    size, end_class = known.end + 1, n_classes - 1
    classes = np.arange(size) % (n_classes - 1)
    classes[known.end] = end_class

    def neighbours() -> tuple[np.ndarray, np.ndarray]:
        # units and classes are parameters: both tables have a fixed size
        of = F.broadcast(spark.createDataFrame(
            [(i, int(c)) for i, c in enumerate(classes)], "unit int, class int"
        ))
        out = []
        for own, other in (("b", "a"), ("a", "b")):
            rows = (
                pairs.join(of, pairs[other] == of["unit"]).groupBy(pairs[own], "class")
                .agg(F.sum("n").alias("n")).toPandas()
            )
            table = np.zeros((size, n_classes))
            table[rows[own].to_numpy(dtype=int), rows["class"].to_numpy(dtype=int)] = rows["n"]
            out.append(table)
        return out[0], out[1]

    for _ in range(rounds):
        before, after = neighbours()
        if exchange(before, after, classes, end_class) * 200 < size:
            break
    before, _ = neighbours()
    table = np.zeros((n_classes, n_classes))
    np.add.at(table.T, classes, before)
    in_class = table.sum(axis=0)
    # how many words each class has: frequent ones one by one, the others by their ending
    rest = word.groupBy("ending").agg(F.count(F.lit(1)).alias("n")).toPandas()
    by_unit = np.zeros(size)
    by_unit[known.n_units + rest["ending"].to_numpy(dtype=int)] = rest["n"]
    single = top["ending"].to_numpy(dtype=int)[: known.n_units]
    np.subtract.at(by_unit, known.n_units + single, 1)
    by_unit[: known.n_units] = 1
    by_unit[known.end] = float(ends > 0)
    words_in = np.bincount(classes, weights=by_unit, minlength=n_classes)
    room = in_class + 0.5 * (words_in + 1)
    share = room / room.sum()
    steps = (table + 5.0 * share) / (table.sum(axis=1, keepdims=True) + 5.0)
    return Model(known, classes, tokens, words, np.log10(steps), np.log10(room), ends), counts


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_units, *rest = model.value
        m = Model(Units(*known_units), *rest)
        base_room = np.log10(m.tokens + 0.5 * (m.words + 1))
        seen = TaskContext.get().partitionId() << 40
        for rows, data, begins in text_blocks(batches):
            codes, endings, first = tokens_of_block(data, begins)
            n = len(begins) - 1
            unit, count = m.units.of(codes, endings)
            count = np.where(codes == END_CODE, m.end_count, count)
            cls = m.classes[unit]
            text = np.repeat(np.arange(n), np.diff(first))
            before = np.append(m.classes[m.units.end], cls[:-1])
            here = count >= 0
            # what the count of a word adds is the same in both scores
            own = np.where(here, np.log10(np.maximum(count, 0) + 0.5), 0.0)
            score = np.bincount(text, weights=own + m.steps[before, cls] - m.room[cls], minlength=n)
            base = np.bincount(text, weights=own - base_room, minlength=n)
            known = np.bincount(text, weights=count > 0, minlength=n).astype(np.int64)
            # others are looked up in the table of counts
            away = np.flatnonzero(~here)
            by = np.lexsort((codes[away], text[away]))
            t, c = text[away][by], codes[away][by]
            new = np.ones(len(t), dtype=bool)
            new[1:] = (t[1:] != t[:-1]) | (c[1:] != c[:-1])
            at = np.flatnonzero(new)
            times = np.diff(np.append(at, len(t)))
            ids = rows.column(0)
            # rows of texts meet no count: a code of their own spreads them over the join
            with np.errstate(over="ignore"):
                salt = mix(np.arange(seen, seen + n, dtype=np.uint64))
            seen += n
            size = n + len(at)
            whom = np.concatenate([np.arange(n), t[at]])
            pad = np.zeros(len(at))
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(whom)),
                    rows.column(2).take(pa.array(whom)),
                    pa.array(np.concatenate([salt, c[at]]).view(np.int64)),
                    pa.array(np.concatenate([np.zeros(n, dtype=np.int64), times])),
                    pa.array(np.arange(size) < n),
                    pa.array(np.concatenate([np.diff(first), pad]).astype(np.int64)),
                    pa.array(np.concatenate([known, pad]).astype(np.int64)),
                    pa.array(np.concatenate([base, pad])),
                    pa.array(np.concatenate([score, pad])),
                ],
                names=["doc", "mark", "code", "n", "main", "n_tokens", "n_known", "base", "score"],
            )

    return run


def score_texts(
    docs: DataFrame, held_out: Column, id_column: str = "doc_id", text_column: str = "text",
    **options,
) -> DataFrame:
    """(doc, held_out, n_tokens, n_known, train_tokens, base_score, score): a row for each row
    of ``docs``. ``held_out`` is a condition on a column ``doc``; where it is true, rows are
    scored but not learned from.

    Null and empty texts are an end alone. Repeated rows are learned from as often as they
    stand there. Rows without id are learned from. Texts of any length are scored whole. With
    no training text nothing is known and all words share the room of one unseen word; a table
    without rows gives none.
    """
    every = TextRows(docs, id_column, text_column).texts()
    rows = every.withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    train = rows.where("not held_out").select("doc", "text", "mark")
    model, counts = fit(train, **options)
    plain = (tuple(vars(model.units).values()), *list(vars(model).values())[1:])
    sent = docs.sparkSession.sparkContext.broadcast(plain)
    parts = rows.select("doc", "text", "mark").mapInArrow(_score(sent), PARTS)
    looked_up = parts.join(
        counts.select(F.col("code").alias("known_code"), F.col("n").alias("c")),
        (F.col("code") == F.col("known_code")) & ~F.col("main"), "left",
    ).withColumn("c", F.coalesce("c", F.lit(0)))
    gain = F.col("n") * F.log10(F.col("c") + 0.5)
    summed = looked_up.groupBy("doc", "mark").agg(
        F.sum(F.col("main").cast("long")).alias("copies"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("n_known"),
        F.sum(F.col("base") + gain).alias("base"),
        F.sum(F.col("score") + gain).alias("score"),
    )
    # equal rows have been summed together: each gets its share
    each = summed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return each.select(
        "doc",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.expr("n_tokens div copies").alias("n_tokens"),
        F.expr("n_known div copies").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("copies")).alias("base_score"),
        (F.col("score") / F.col("copies")).alias("score"),
    )
