"""Word shingles of whole texts as numbers."""

from __future__ import annotations

import numpy as np

from gridtide.llm.windows import mix, word_codes, words_of


def shingles_of_block(
    data: np.ndarray, begins: np.ndarray, size: int
) -> tuple[list[np.ndarray], list[int], np.ndarray]:
    """Of each text: its shingles (codes of ``size`` neighbouring words, in order; a text of
    fewer words has one of them all, one without words none), a code of its whole word
    sequence (0: no words), and its number of words."""
    start, end, first = words_of(data, begins)
    codes = word_codes(data, start, end)
    n_words = np.diff(first)
    with np.errstate(over="ignore"):
        rolled = np.zeros(len(codes), dtype=np.uint64)
        for i in range(min(size, len(codes))):  # a block may hold fewer words than a shingle
            rolled[: len(codes) - i] = mix(rolled[: len(codes) - i] + codes[i:] + np.uint64(i))
    out, whole = [], []
    for a, n in zip(first[:-1].tolist(), n_words.tolist()):
        value = 0
        if n:
            with np.errstate(over="ignore"):
                place = np.arange(1, n + 1, dtype=np.uint64)
                value = int(mix(codes[a: a + n] + mix(place)).sum(dtype=np.uint64)) or 1
        whole.append(value)
        if n >= size:
            out.append(rolled[a: a + n - size + 1])
        else:
            out.append(np.full(min(n, 1), value, dtype=np.uint64))
    return out, whole, n_words
