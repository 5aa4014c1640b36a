"""Token alignment against both tokenizers' own ids and a plain walk over byte ends."""

from __future__ import annotations

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from gridtide.llm import alignment
from gridtide.llm.alignment import align_documents, pair_bound, piece_bytes, piece_encoder
from gridtide.llm.queries_manifest import piece_model_path
from gridtide.llm.queries_packing import tokenizer_path
from gridtide.llm.tokens import token_bytes

TEXTS = [
    "The quick brown fox", "internationalisation of naïve Éclairs", "a", " ", "  ", "a ", " a", "x  y   z  ",
    "tab\there\nand\n\nthere", "世界 and 🙂🙂", "<s> <|endoftext|> </s> <unk> <0x41>", "\x00\x01", "don't 1234567 it's",
    "wörd " * 400, "x" * 500, "The quick brown fox", "",
]
ODD = ["a▁b", "▁"]


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(tokenizer_path())
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=piece_model_path())
    return lambda t: a.encode(" " + t, add_special_tokens=False).ids, lambda t: b.encode(t)


def plain(text, both, a_bytes, b_bytes):
    """Ids of both, groups and links of one text."""
    if not text:
        return [], [], [], []
    a, b = both[0](text), both[1](text)
    data = (" " + text).encode()
    if b"".join(a_bytes[i] for i in a) != data or b"".join(b_bytes[i] for i in b) != data:
        return [], [], [], []
    ends_a = dict(zip(np.cumsum([len(a_bytes[i]) for i in a]).tolist(), range(len(a))))
    ends_b = dict(zip(np.cumsum([len(b_bytes[i]) for i in b]).tolist(), range(len(b))))
    groups, links, at_a, at_b = [], [], 0, 0
    for end in sorted(ends_a.keys() & ends_b.keys()):
        i, j = ends_a[end], ends_b[end]
        groups.append(",".join(map(str, a[at_a: i + 1])) + "|" + ",".join(map(str, b[at_b: j + 1])))
        links.append((a[i], b[j]))
        at_a, at_b = i + 1, j + 1
    return a, b, groups, links


def brute(texts, both):
    a_bytes, b_bytes = token_bytes(tokenizer_path()), piece_bytes(piece_model_path())
    found = [plain(t, both, a_bytes, b_bytes) for t in texts]
    count = Counter(link for f in found for link in f[3])
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return [
        (len(a), len(b), len(groups), len(links), sum(count[x] == most[x[1]] for x in links),
         sum(count[x] for x in links), sha256(";".join(groups).encode()).hexdigest() if groups else "")
        for a, b, groups, links in found
    ]


def test_parts_give_the_ids_of_whole_texts(both):
    encode, rng = piece_encoder(piece_model_path()), random.Random(3)
    parts = [" ", "  ", "\n", "the", "Éa", "'s", "12", "!?", "\t", "世", "▁", " ", "_", "<s>", "inter", "nation"]
    texts = TEXTS + ODD + ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(400)]
    for text in texts:
        if text:
            assert np.frombuffer(encode(text), dtype="<u4").tolist() == both[1](text), repr(text)


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_against_a_plain_walk(spark, documents, both, block, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block)
    texts = TEXTS + ODD + [None]
    rows = [(i, t, "1", "2") for i, t in enumerate(texts)]
    docs = documents(rows, ("n_a", "a.b")).repartition(3)
    got = align_documents(docs, tokenizer_path(), piece_model_path()).collect()
    want = brute(texts, both)
    mine = {r.doc: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got}
    assert mine == dict(enumerate(want))


def test_rows_without_id_repeated_rows_and_no_rows(spark, documents, both):
    rows = [(None, "one two"), (None, "one two"), (4, "one two three"), (4, "one two three")]
    got = align_documents(documents(rows), tokenizer_path(), piece_model_path()).collect()
    want = brute([t for _, t in rows], both)
    mine = sorted((r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got)
    assert mine == sorted(want) and sorted(str(r.doc) for r in got) == ["4", "4", "None", "None"]
    assert align_documents(documents([]), tokenizer_path(), piece_model_path()).collect() == []


def test_pair_bound():
    assert pair_bound([b"ab", b"b", b"c"], [b"b", b"b", b"aab", b"x"]) == 3 + 3
    a, b = token_bytes(tokenizer_path()), piece_bytes(piece_model_path())
    assert pair_bound(a, b) < alignment.PAIR_BOUND


def test_large_batches_are_taken_in_slices(monkeypatch):
    """Thousands of texts come in one batch: their pairs are looked at some at a time."""
    import pyarrow as pa

    monkeypatch.setattr(alignment, "PAIRS_AT_ONCE", 4)
    lists = [[1, 2, 1], [], [2], [3, 3, 3, 3, 3, 3], [], [1], [2, 1], []]
    batch = pa.RecordBatch.from_pydict({"doc": list(range(8)), "pairs": pa.array(lists, pa.list_(pa.int64()))})
    whole = batch.slice(1)
    sizes = [len(part.column(1).flatten()) for part in alignment._slices(whole, "pairs")]
    assert sizes == [1, 6, 3]

    class Shared:
        value = np.array([1, 2, 3]), np.array([4, 3, 6])

    out = pa.Table.from_batches(alignment._counted(Shared)(iter([batch, whole])))
    sums = [sum({1: 4, 2: 3, 3: 6}[p] for p in row) for row in lists]
    assert out.column("count_sum").to_pylist() == sums + sums[1:]
    assert out.column("doc").to_pylist() == [*range(8), *range(1, 8)]
    parts = pa.Table.from_batches(alignment._partial(iter([batch.select(["pairs"])]))).to_pydict()
    assert dict(zip(parts["pair"], parts["n"])) == {1: 4, 2: 3, 3: 6}
