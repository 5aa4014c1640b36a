"""Alignment of two tokenizers over whole texts, on Arrow columns.

A block of texts is encoded by both tokenizers into list columns. From there on everything is
Arrow: the lists are flattened, parent indices tell which document a token is of, cumulative sums
of token sizes that start anew at each document give byte ends, and a hash join (Acero) on
(document, end) finds the tokens of A and B that end together. Those ends cut both token rows into
groups, whose ids are joined to texts list by list.

The pairs linked are counted by ``Table.group_by`` in each task; Spark merges the partial counts.
Two tokens can only end together if one's bytes are a suffix of the other's, so the merged table
has at most one row per such pair of the two vocabularies, however large the corpus: that bound is
computed from the vocabulary files, and the counts are sent to all tasks only under it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from gridtide.llm.rows import column, text_of
from gridtide.llm.tokens import encoder, token_bytes
from gridtide.llm.windows import text_blocks
from gridtide.staging import stage

BLOCK_BYTES = 1 << 19
CACHE = 100_000
BITS = 24
PAIR_BOUND = 1 << 24
#: pairs looked at together; Spark hands over thousands of texts at once
PAIRS_AT_ONCE = 1 << 17
SPACE = "▁"
#: spaces, and the sign that stands for them in pieces, belong to what follows them
UNIT = re.compile(f"[ {SPACE}]*[^ {SPACE}]+|[ {SPACE}]+")
ALIGNED = (
    "doc long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<long>"
)
FACTS = "n_best long, count_sum long"


def piece_bytes(path: str) -> list[bytes]:
    """The bytes of each id of a sentencepiece model: U+2581 is a space, ``<0xHH>`` a byte."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            out.append(bytes([int(piece[3:5], 16)]))
        else:
            out.append(piece.replace(SPACE, " ").encode())
    return out


def piece_encoder(path: str) -> Callable[[str], bytes]:
    """Text to the ids of a sentencepiece model, as :func:`tokens.encoder` gives them; strings of
    special tokens are ordinary text.

    Where no piece has a space after something else, a text falls apart before its spaces, and
    frequent parts are encoded once. Other models encode whole texts.
    """
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    apart = not any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in pieces)
    # a part is encoded as it is in a text: behind the space that the model puts in front
    apart = apart and model.encode("a  b") == [*model.encode("a"), *model.encode(" b")]

    def ids_of(text: str) -> bytes:
        return np.asarray(model.encode(text), dtype=np.uint32).tobytes()

    # a space alone at the end is the one part that can't be encoded without what is before it
    known: dict[str, bytes] = dict.fromkeys((" ", SPACE), ids_of("a ")[len(ids_of("a")):])
    space = dict(known)

    def run(text: str) -> bytes:
        if not apart:
            return ids_of(text)
        if len(known) > CACHE:
            known.clear()
            known.update(space)
        units = UNIT.findall(" " + text)
        found = list(map(known.get, units))
        if None in found:
            new = list({unit for unit, ids in zip(units, found) if ids is None})
            # the model adds the first space of a part again
            for unit, ids in zip(new, model.encode([unit[1:] for unit in new], num_threads=1)):
                known[unit] = np.asarray(ids, dtype=np.uint32).tobytes()
            found = [known[unit] for unit in units]
        return b"".join(found)

    return run


def pair_bound(a_bytes: list[bytes], b_bytes: list[bytes]) -> int:
    """How many pairs of ids can end together: one's bytes are a suffix of the other's."""
    by_bytes: dict[bytes, int] = {}
    for piece in b_bytes:
        by_bytes[piece] = by_bytes.get(piece, 0) + 1
    suffixes: dict[bytes, int] = {}
    for piece, n in by_bytes.items():
        for i in range(1, len(piece)):
            suffixes[piece[i:]] = suffixes.get(piece[i:], 0) + n
    total = 0
    for piece in a_bytes:
        total += suffixes.get(piece, 0)
        total += sum(by_bytes.get(piece[i:], 0) for i in range(len(piece)))
    return total


def _lists(blobs: list[bytes]) -> pa.ListArray:
    """Ids of many texts as one list column."""
    sizes = np.fromiter((len(b) // 4 for b in blobs), dtype=np.int64, count=len(blobs))
    offsets = np.zeros(len(blobs) + 1, dtype=np.int32)
    offsets[1:] = np.cumsum(sizes)
    values = np.frombuffer(b"".join(blobs), dtype=np.uint32).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _ends(lists: pa.ListArray, parents: pa.Array, sizes: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Where each token ends in its text (a cumulative sum of token sizes that starts anew at
    each document), and the bytes of each document's tokens together."""
    total = pc.cumulative_sum(sizes)
    before = np.concatenate([[0], total.to_numpy()])[lists.offsets.to_numpy()]
    return pc.subtract(total, pc.take(pa.array(before), parents)), np.diff(before)


def _spelled(ids: pa.Array, table: pa.Array) -> bytes:
    """The bytes of all tokens one after the other."""
    taken = pc.take(table, ids)
    if not len(taken):
        return b""
    ends = np.frombuffer(taken.buffers()[1], dtype=np.int32)[taken.offset:]
    return taken.buffers()[2][ends[0]: ends[len(taken)]].to_pybytes()


def _cut_lists(ids: pa.Array, cuts: np.ndarray) -> pa.Array:
    """Ids in decimal, joined by commas between cuts."""
    offsets = np.concatenate([[0], cuts]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), ids.cast(pa.string())), ",")


class Aligner:
    """Both vocabularies of a task."""

    def __init__(self, a_path: str, b_path: str):
        self.encode_a, self.encode_b = encoder(a_path, cache=0), piece_encoder(b_path)
        self.a_table = pa.array(token_bytes(a_path), pa.binary())
        self.b_table = pa.array(piece_bytes(b_path), pa.binary())
        self.a_sizes = pc.binary_length(self.a_table).cast(pa.int64())
        self.b_sizes = pc.binary_length(self.b_table).cast(pa.int64())

    def _side(self, blobs: list[bytes], sizes: pa.Array) -> tuple:
        """Of one tokenizer: list column, ids, parent indices, byte ends, bytes per text."""
        lists = _lists(blobs)
        ids, parents = pc.list_flatten(lists), pc.list_parent_indices(lists).cast(pa.int64())
        return lists, ids, parents, *_ends(lists, parents, pc.take(sizes, ids))

    def _sides(self, texts: list[str]) -> tuple[tuple, tuple]:
        """Both tokenizers; no tokens where either's don't spell the text."""
        data = [(" " + text).encode() if text else b"" for text in texts]
        a = [self.encode_a(" " + text) if text else b"" for text in texts]
        b = [self.encode_b(text) if text else b"" for text in texts]
        want, lengths = b"".join(data), [len(d) for d in data]
        sides = self._side(a, self.a_sizes), self._side(b, self.b_sizes)
        if all(
            side[4].tolist() == lengths and _spelled(side[1], table) == want
            for side, table in zip(sides, (self.a_table, self.b_table))
        ):
            return sides
        for i, text in enumerate(data):  # some text of the block is odd: look at each
            for blob, table in ((a[i], self.a_table), (b[i], self.b_table)):
                if _spelled(_lists([blob]).flatten(), table) != text:
                    a[i] = b[i] = b""
                    break
        return self._side(a, self.a_sizes), self._side(b, self.b_sizes)

    def align(self, texts: list[str]) -> pa.Table:
        """Columns of ``ALIGNED`` without doc."""
        n = len(texts)
        (lists_a, a, doc_a, end_a, _), (lists_b, b, doc_b, end_b, _) = self._sides(texts)
        left = pa.table({"doc": doc_a, "end": end_a, "a": a, "at_a": pa.array(np.arange(len(a)))})
        right = pa.table({"doc": doc_b, "end": end_b, "b": b, "at_b": pa.array(np.arange(len(b)))})
        links = left.join(right, ["doc", "end"], join_type="inner", use_threads=False)
        links = links.take(pc.sort_indices(links.column("at_a")))
        doc = links.column("doc").to_numpy()
        groups = pc.binary_join_element_wise(
            _cut_lists(a, links.column("at_a").to_numpy() + 1),
            _cut_lists(b, links.column("at_b").to_numpy() + 1),
            "|",
        )
        edges = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
        texts_of_groups = pc.binary_join(pa.ListArray.from_arrays(pa.array(edges), groups), ";").to_pylist()
        code = pc.add(pc.shift_left(links.column("a").cast(pa.int64()), BITS), links.column("b").cast(pa.int64()))
        n_links = pa.array(np.diff(edges).astype(np.int64))
        return pa.table(
            {
                "n_a": pc.list_value_length(lists_a).cast(pa.int64()),
                "n_b": pc.list_value_length(lists_b).cast(pa.int64()),
                "n_groups": n_links,
                "n_links": n_links,
                "groups_sha256": pa.array([sha256(t.encode()).hexdigest() if t else "" for t in texts_of_groups]),
                "pairs": pa.ListArray.from_arrays(pa.array(edges), code.combine_chunks()),
            }
        )


def _align(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_path, b_path)
        for rows, _, _ in text_blocks(batches, BLOCK_BYTES):
            texts = rows.column(1).cast(pa.string()).to_pylist()
            out = aligner.align(texts).add_column(0, "doc", [rows.column(0)])
            yield from out.combine_chunks().to_batches()

    return run


def aligned(
    docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Counts, groups and linked pairs (``a << 24 | b``, in order) of each text."""
    rows = docs.select(
        column(docs, id_column).cast("long").alias("doc"),
        text_of(docs, text_column).cast("binary").alias("text"),
    )
    return rows.mapInArrow(_align(a_path, b_path), ALIGNED)


def _slices(batch: pa.RecordBatch, name: str) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices of about ``PAIRS_AT_ONCE`` entries of a list column."""
    lists = batch.column(batch.schema.get_field_index(name))
    ends = lists.offsets.to_numpy()
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(ends, ends[first] + PAIRS_AT_ONCE, side="right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        yield batch.slice(first, last - first)
        first = last


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's pairs, merged slice by slice."""
    total = None
    for batch in (part for batch in batches for part in _slices(batch, "pairs")):
        pairs = pa.table({"pair": pc.list_flatten(batch.column(0))})
        some = pairs.group_by("pair", use_threads=False).aggregate([([], "count_all")])
        some = some.select(["pair", "count_all"]).rename_columns(["pair", "n"])
        if total is not None:
            both = pa.concat_tables([total, some]).group_by("pair", use_threads=False)
            some = both.aggregate([("n", "sum")]).select(["pair", "n_sum"]).rename_columns(["pair", "n"])
        total = some
    if total is not None:
        yield from total.combine_chunks().to_batches()


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n): links of each pair over all rows of :func:`aligned`."""
    parts = rows.select("pairs").mapInArrow(_partial, "pair long, n long")
    return parts.groupBy("pair").agg(F.sum("n").alias("n"))


def _counted(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, count = shared.value
        token = pair & ((1 << BITS) - 1)
        most = np.zeros(int(token.max()) + 1 if len(token) else 1, dtype=np.int64)
        np.maximum.at(most, token, count)
        best = (count == most[token]).astype(np.int64) if len(token) else count
        for batch in (part for batch in batches for part in _slices(batch, "pairs")):
            lists = batch.column(batch.schema.get_field_index("pairs"))
            at = np.searchsorted(pair, pc.list_flatten(lists).to_numpy())
            edges = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names) if name != "pairs"}
            for name, values in (("n_best", best), ("count_sum", count)):
                upto = np.concatenate([[0], np.cumsum(values[at])])
                columns[name] = pa.array(np.diff(upto[edges]))
            yield pa.RecordBatch.from_pydict(columns)

    return run


def align_documents(
    docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Alignment of each text: doc, n_a, n_b, n_groups, n_links, groups_sha256, n_best (links whose
    count over the corpus is the highest of their B id, ties included) and count_sum.

    A is a byte-level file of ``tokenizers`` that encodes a space and the text; B a sentencepiece
    model that puts the space in front itself. Null and empty texts, and those whose tokens don't
    spell the text (U+2581 in it), have no tokens: zeros and an empty digest. Repeated rows and
    rows without id are counted like others; texts of any length are taken whole; other columns
    are not read; no rows give none. Both files must be where every executor can open them.
    """
    bound = pair_bound(token_bytes(a_path), piece_bytes(b_path))
    if bound > PAIR_BOUND:
        raise ValueError(f"{bound} pairs of these vocabularies can end together; {PAIR_BOUND} may be sent")
    rows = stage(aligned(docs, a_path, b_path, id_column, text_column), "alignment")
    counts = pair_counts(rows).toPandas().sort_values("pair")
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((counts["pair"].to_numpy(), counts["n"].to_numpy()))
    columns = ", ".join(field for field in ALIGNED.split(", ") if not field.startswith("pairs"))
    return rows.mapInArrow(_counted(shared), f"{columns}, {FACTS}")
