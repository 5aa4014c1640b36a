"""MinHash near-dedup with DartMinHash signatures.

Each element (a word shingle with a weight) throws darts: a Poisson process over weight and
rank that hashes of the element drive, so equal elements throw equal darts. A text keeps the
darts below its elements' weights, each hits a random coordinate, and the earliest dart (least
rank) of a coordinate is the signature there. Two texts agree in a coordinate with a
probability of their (weighted) Jaccard similarity.

Texts of equal word sequences are one node. Nodes that agree in a band of coordinates meet in
a bucket; each is compared with the bucket's centre, the node that meets most others in all
its bands, so a bucket of n gives n - 1 pairs, not n * n. Pairs are verified exactly on their
shingles. Where a bucket still holds several classes, its members are compared with members of
other classes, until a round adds no link.

What is then still open is decided exactly (:func:`_open_pairs`): in a bucket of several classes
every pair of two classes is compared, by products of 0/1 matrices over blocks of members that
are dealt over tasks. Members of the largest class of a bucket are not compared with each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gridtide.llm.components import components
from gridtide.llm.rows import TextRows, unpacked
from gridtide.llm.shingles import shingles_of_block
from gridtide.llm.windows import mix, text_blocks
from gridtide.staging import stage

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 4
SLICE = 1 << 15  # elements that throw at once, whatever the length of a text
BLOCK_ROWS, BLOCK_ITEMS = 256, 1 << 18  # nodes and shingles of a block of a bucket
COLUMNS = 1 << 12  # shingles of a matrix at once
SIGNED = "doc long, mark binary, node long, n_shingles int, bands array<long>"


def _unit(bits: np.ndarray) -> np.ndarray:
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _throw(elements: np.ndarray, weights: np.ndarray, limit: float):
    """Darts of rank below ``limit`` under the weights: ranks and identities."""
    ranks, darts = [], []
    low, level = 0.0, 0
    while True:  # weight levels [0, 1), [1, 2), [2, 4), ...
        some = np.flatnonzero(weights > low)
        if not len(some):
            break
        high = 2.0**level
        width = high - low
        expected = limit * width
        count = int(expected + 4 * np.sqrt(expected) + 4)
        last, begin = np.zeros(len(some)), 0
        with np.errstate(over="ignore"):
            while len(some):
                step = np.arange(begin, begin + count, dtype=np.uint64) * np.uint64(2)
                salt = mix(step + np.uint64(level) * np.uint64(1 << 40))
                bits = mix(elements[some][:, None] ^ salt[None, :])
                rank = last[:, None] + np.cumsum(-np.log(_unit(bits)) / width, axis=1)
                dart = mix(bits + np.uint64(1))
                hit = rank < limit
                if low > 0 or (weights[some] < high).any():
                    hit &= (low + width * _unit(mix(dart + np.uint64(2)))) < weights[some][:, None]
                ranks.append(rank[hit])
                darts.append(dart[hit])
                more = rank[:, -1] < limit
                some, last, begin = some[more], rank[more, -1], begin + count
        low, level = high, level + 1
    return np.concatenate(ranks), np.concatenate(darts)


def dart_signature(elements: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
    """The earliest dart of each of ``size`` coordinates for distinct elements."""
    limit = (size * np.log(size) + 2 * size) / weights.sum()
    while True:
        thrown = [
            _throw(elements[i: i + SLICE], weights[i: i + SLICE], limit)
            for i in range(0, len(elements), SLICE)
        ]
        rank, dart = (np.concatenate(part) for part in zip(*thrown))
        place = (mix(dart + np.uint64(3)) % np.uint64(size)).astype(np.int64)
        order = np.lexsort((rank, place))
        found, at = np.unique(place[order], return_index=True)
        if len(found) == size:
            return dart[order][at]
        limit *= 2  # a coordinate is still empty: throw on


def _signed(size: int, bands: int, rows: int, weighted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, begins in text_blocks(batches):
            shingles, whole, _ = shingles_of_block(data, begins, size)
            keys, counts = [], []
            for items in shingles:
                elements, times = np.unique(items, return_counts=True)
                counts.append(len(elements))
                if not len(elements):
                    keys.append(np.zeros(0, dtype=np.int64))
                    continue
                weights = times.astype(float) if weighted else np.ones(len(elements))
                signature = dart_signature(elements, weights, bands * rows)
                with np.errstate(over="ignore"):
                    key = np.arange(1, bands + 1, dtype=np.uint64)
                    for column in signature.reshape(bands, rows).T:
                        key = mix(key * np.uint64(3) + column)
                keys.append(key.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(np.array(whole, dtype=np.uint64).view(np.int64)),
                    pa.array(np.array(counts, dtype=np.int32)),
                    pa.array(keys, type=pa.list_(pa.int64())),
                ],
                names=["doc", "mark", "node", "n_shingles", "bands"],
            )

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, begins in text_blocks(batches):
            shingles, _, _ = shingles_of_block(data, begins, size)
            packed = [
                np.sort((items >> np.uint64(32)).astype("<u4")).tobytes() for items in shingles
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(packed, type=pa.binary())], names=["node", "items"]
            )

    return run


def similarity(a: bytes, b: bytes, weighted: bool) -> float:
    """Jaccard similarity of two sorted lists of shingles, of their sets or with counts."""
    x, times_x = np.unique(np.frombuffer(a, dtype="<u4"), return_counts=True)
    y, times_y = np.unique(np.frombuffer(b, dtype="<u4"), return_counts=True)
    common, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if not weighted:
        return len(common) / (len(x) + len(y) - len(common))
    shared = np.minimum(times_x[i], times_y[j]).sum()
    return shared / (times_x.sum() + times_y.sum() - shared)


def _verify(threshold: float, weighted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                similarity(x.as_py(), y.as_py(), weighted) >= threshold
                for x, y in zip(batch.column(2), batch.column(3))
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, type=pa.bool_()))

    return run


def _elements(items: bytes, weighted: bool) -> np.ndarray:
    """Distinct numbers for a sorted list of shingles; ``weighted``: each repeat is one more, so
    that common elements are the sum of the lesser counts."""
    values = np.frombuffer(items, dtype="<u4").astype(np.uint64)
    new = np.append(True, values[1:] != values[:-1])
    if not weighted:
        return values[new]
    begin = np.flatnonzero(new)
    return (values << np.uint64(32)) | (np.arange(len(values)) - begin[np.cumsum(new) - 1]).astype(np.uint64)


def alike_pairs(
    items: list[bytes], root: np.ndarray, side: np.ndarray, threshold: float, weighted: bool
) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of texts of two classes (``root``) with a similarity of at least ``threshold``:
    between two sides, or where there is one side only, within it."""
    sets = [_elements(x, weighted) for x in items]
    size = np.array([len(x) for x in sets], dtype=np.int64)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), size)
    shared = times[column] > 1  # an element of one text only is in no overlap
    number = np.cumsum(times > 1) - 1
    row, column = row[shared], number[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    first = np.flatnonzero(side == side[0])
    second = np.flatnonzero(side != side[0])
    if not len(second):
        second = first
    common = np.zeros((len(first), len(second)), dtype=np.int64)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        held = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        held[row[a:b], column[a:b] - low] = 1
        common += (held[first] @ held[second].T).astype(np.int64)
    union = size[first][:, None] + size[second][None, :] - common
    near = (common / union >= threshold) & (root[first][:, None] != root[second][None, :])
    i, j = np.nonzero(near)
    return first[i], second[j]


def _decided(threshold: float, weighted: bool):
    """Of rows sorted by block pair (bucket, low, high): the links of each."""

    def links(rows: list[pa.RecordBatch]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        table = pa.Table.from_batches(rows)
        key = [table.column(i).to_numpy() for i in range(3)]
        node, root, side = (table.column(i).to_numpy() for i in (3, 4, 5))
        new = np.append(True, np.any([k[1:] != k[:-1] for k in key], axis=0))
        edges = np.append(np.flatnonzero(new), len(node))
        items, a, b = table.column(6), [], []
        for x, y in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if y - x > 1 and (root[x:y] != root[x]).any():
                i, j = alike_pairs(
                    items.slice(x, y - x).to_pylist(), root[x:y], side[x:y], threshold, weighted
                )
                a.append(node[x + i])
                b.append(node[x + j])
        return a, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in _with_end(batches):
            ready = waiting if batch is None else []
            if batch is not None and batch.num_rows:
                # the last block pair may go on in the next batch
                key = [batch.column(i).to_numpy() for i in range(3)]
                last = np.all([k == k[-1] for k in key], axis=0)
                at = batch.num_rows - int(np.argmin(last[::-1])) if not last.all() else 0
                if at or (waiting and any(
                    w.as_py() != b.as_py()
                    for w, b in ((waiting[-1].column(i)[-1], batch.column(i)[0]) for i in range(3))
                )):
                    ready, waiting = [*waiting, batch.slice(0, at)], []
                waiting.append(batch.slice(at))
            if ready:
                a, b = links(ready)
                if a:
                    a, b = np.concatenate(a), np.concatenate(b)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"]
                    )

    return run


def _with_end(batches):
    yield from batches
    yield None


def _open_pairs(of: DataFrame, sets: DataFrame, threshold: float, weighted: bool) -> DataFrame:
    """(a, b): all links between classes that meet in a bucket. ``of``: (bucket, node, root)."""
    several = of.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y"))
    left = stage(of.join(several.where("x != y").select("bucket"), "bucket"), "open")
    left = left.join(sets.select("node", F.octet_length("items").alias("n_bytes")), "node")
    # the largest class of a bucket, and how many blocks it and the others make
    count = [F.count(F.lit(1)).alias("n"), F.sum("n_bytes").alias("s")]
    sizes = left.groupBy("bucket", "root").agg(*count)
    total = sizes.groupBy("bucket").agg(
        F.max(F.struct("n", "s", "root")).alias("main"), F.sum("n").alias("n"), F.sum("s").alias("s")
    )

    def blocks(n, s):
        return F.ceil(F.greatest(n / BLOCK_ROWS, s / (4 * BLOCK_ITEMS)))

    total = total.select(
        "bucket", F.col("main.root").alias("main"),
        blocks(F.col("main.n"), F.col("main.s")).alias("k_main"),
        blocks(F.col("n") - F.col("main.n"), F.col("s") - F.col("main.s")).alias("k_rest"),
    )
    salt = F.xxhash64("node", "bucket")
    is_main = F.col("root") == F.col("main")
    dealt = left.join(total, "bucket").select(
        "bucket", "node", "root",
        F.when(is_main, F.col("k_rest") + F.pmod(salt, "k_main"))
        .otherwise(F.pmod(salt, "k_rest")).alias("side"),
        F.explode(F.sequence(
            F.lit(0).cast("long"),
            F.when(is_main, F.col("k_rest")).otherwise(F.col("k_rest") + F.col("k_main")) - 1,
        )).alias("with"),
    ).select(
        "bucket", F.least("side", "with").alias("low"), F.greatest("side", "with").alias("high"),
        "node", "root", "side",
    )
    key = ["bucket", "low", "high"]
    rows = dealt.join(sets.select("node", "items"), "node").select(*key, "node", "root", "side", "items")
    rows = rows.repartition(*key).sortWithinPartitions(*key)
    return stage(rows.mapInArrow(_decided(threshold, weighted), "a long, b long").distinct(), "held")


def near_classes(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    threshold: float = SIMILARITY, shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS,
    weighted: bool = False,
) -> DataFrame:
    """(doc, mark, class_id, kept): one row for each row of ``docs``.

    Texts are linked if the Jaccard similarity of their shingles (``weighted``: with counts) is
    at least ``threshold``; classes are the components of links, named by their least id;
    ``kept`` is true for rows of that id whose text has the least hash among them. ``mark`` tells
    rows with the same id apart (:mod:`rows`). A pair of similarity s meets
    with probability 1 - (1 - s**rows)**bands: all but certain at 0.8 with the defaults. Texts
    without words (null, empty) are classes of their own id. Rows without id get no class and
    are kept. Equal rows get equal results. A table without rows gives none.
    """
    every = TextRows(docs, id_column, text_column).texts()
    signed = stage(
        every.mapInArrow(_signed(shingle, bands, rows, weighted), SIGNED), "signatures"
    )
    real = signed.where("doc is not null and node != 0")
    nodes = stage(
        real.groupBy("node").agg(
            F.min(F.struct("doc", "mark")).alias("source"), F.any_value("bands").alias("bands")
        ).select("node", "source.doc", "source.mark", "bands"),
        "nodes",
    )
    member = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = stage(
        member.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets"
    )
    member = stage(member.join(shared, "bucket"), "members")
    # how many others a node meets in all its buckets
    crowd = member.groupBy("node").agg(F.sum("n").alias("crowd"))
    member = member.join(crowd, "node").select("bucket", "node", "crowd")
    centre = member.groupBy("bucket").agg(F.max(F.struct("crowd", "node")).alias("c"))
    pairs = member.join(centre, "bucket").select("node", F.col("c.node").alias("other"))
    sets = stage(
        every.join(
            nodes.join(crowd, "node", "left_semi").select("doc", "mark", "node"), ["doc", "mark"]
        ).dropDuplicates(["node"]).select("node", "text", "doc").mapInArrow(
            _sets(shingle), "node long, items binary"
        ),
        "sets",
    )

    def linked(pairs: DataFrame, tried: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        new = pairs.where("node != other").select(
            F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")
        ).distinct()
        if tried is not None:
            new = new.join(tried, ["a", "b"], "left_anti")
        new = stage(new, "pairs")
        first = sets.select(F.col("node").alias("a"), F.col("items").alias("a_items"))
        second = sets.select(F.col("node").alias("b"), F.col("items").alias("b_items"))
        held = new.join(first, "a").join(second, "b").select("a", "b", "a_items", "b_items")
        return new, stage(held.mapInArrow(_verify(threshold, weighted), "a long, b long"), "held")

    tried, links = linked(pairs, None)
    while True:
        root = components(links)
        of = member.select("bucket", "node").join(root, "node", "left").select(
            "bucket", "node", F.coalesce("root", "node").alias("root")
        )
        # a member of each of two classes of a bucket, for the members of the others
        some = of.groupBy("bucket", "root").agg(
            F.min(F.struct(F.xxhash64("node", "bucket"), "node")).alias("pick")
        )
        two = some.groupBy("bucket").agg(
            F.min(F.struct("root", "pick")).alias("one"), F.max(F.struct("root", "pick")).alias("two")
        ).where("one.root != two.root")
        across = of.join(two, "bucket").select(
            "node", "root", F.explode(F.array("one", "two")).alias("to")
        ).where("root != to.root").select("node", F.col("to.pick.node").alias("other"))
        more, found = linked(across, tried)
        if found.isEmpty():
            break
        tried, links = tried.unionByName(more), links.unionByName(found)
    found = _open_pairs(of, sets, threshold, weighted)
    if not found.isEmpty():
        root = components(links.unionByName(found))
    labelled = signed.join(root, "node", "left").select(
        "doc", "mark", F.when(F.col("node") != 0, F.coalesce("root", "node")).alias("root")
    )
    least = labelled.where("doc is not null and root is not null").groupBy("root").agg(
        F.min(F.struct("doc", "mark")).alias("least")
    )
    joined = labelled.join(least, "root", "left")
    first = F.struct("doc", "mark") == F.col("least")
    return joined.select(
        "doc", "mark",
        F.when(F.col("doc").isNotNull(), F.coalesce("least.doc", "doc")).alias("class_id"),
        (F.col("doc").isNull() | F.coalesce(first, F.lit(True))).alias("kept"),
    )


def drop_near_copies(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """``docs`` with one row of each class of :func:`near_classes`.

    Of rows with equal id and text one stays, whatever their other columns; different texts under
    one id are classes apart unless they are alike. Null and empty texts and rows without id
    stay; texts of any length are compared whole; a table without rows gives none.
    """
    kept = near_classes(docs, id_column, text_column, **options).where("kept")
    kept = kept.groupBy(F.col("doc").alias("keep_doc"), F.col("mark").alias("keep_mark")).agg(
        F.lit(True).alias("keep")
    )
    rows = TextRows(docs, id_column, text_column).packed()
    with_id = rows.where("doc is not null").join(
        kept, (F.col("doc") == F.col("keep_doc")) & (F.col("mark") == F.col("keep_mark"))
    ).dropDuplicates(["doc", "mark"])
    every = with_id.select("row").unionByName(rows.where("doc is null").select("row"))
    return every.select(*unpacked("row", docs))
