"""Counts of texts and their lines, for whole blocks of documents at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from gridtide.llm.windows import BYTE_CODES, mix, range_hash, word_codes, words_of

SYMBOLS = b"#*$%&|<>"
LINE_FEATURES = (
    "bias", "symbols", "upper", "shouts", "repeats", "digits", "short", "size", "closed",
    "duplicate", "word_size", "bare",
)


@dataclass
class Counts:
    """Per text: words, word_chars, symbols, dup_lines, repeat_words and distinct (different
    words). Per line that has a word: its text, its words and its features."""

    words: np.ndarray
    word_chars: np.ndarray
    symbols: np.ndarray
    dup_lines: np.ndarray
    repeat_words: np.ndarray
    distinct: np.ndarray
    line_text: np.ndarray
    line_words: np.ndarray
    line_features: np.ndarray


def _sums(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def _seen_before(group: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row: does an earlier row of its group hold its value; does any other row."""
    n = len(group)
    order = np.lexsort((np.arange(n), value, group))
    g, v = group[order], value[order]
    same = np.zeros(n, dtype=bool)
    if n > 1:
        same[1:] = (g[1:] == g[:-1]) & (v[1:] == v[:-1])
    either = same | np.append(same[1:], False)
    before, shared = np.empty(n, dtype=bool), np.empty(n, dtype=bool)
    before[order], shared[order] = same, either
    return before, shared


def count_block(data: np.ndarray, begins: np.ndarray) -> Counts:
    """Counts of the texts that lie at data[begins[i]:begins[i + 1]]."""
    n = len(begins) - 1
    start, end, first = words_of(data, begins)
    codes = word_codes(data, start, end)
    words = np.diff(first)
    text_of_word = np.repeat(np.arange(n), words)
    lead = (data & 0xC0) != 0x80
    white = (data == 32) | ((data >= 9) & (data <= 13))
    chars = _sums(lead & ~white)
    symbols = _sums(np.isin(data, np.frombuffer(SYMBOLS, dtype=np.uint8)))
    at = begins

    # words in a three-word window that stands twice or more in its text
    repeated = np.zeros(len(codes), dtype=bool)
    if len(codes) >= 3:
        inside = text_of_word[2:] == text_of_word[:-2]
        with np.errstate(over="ignore"):
            three = mix(mix(codes[:-2]) * np.uint64(3) + mix(codes[1:-1]) * np.uint64(5)
                        + codes[2:] * np.uint64(7))
        window = np.flatnonzero(inside)
        _, shared = _seen_before(text_of_word[window], three[window])
        for step in range(3):
            repeated[window[shared] + step] = True
    again, _ = _seen_before(text_of_word, codes)

    # lines: parts between \n, of one text
    breaks = np.flatnonzero(data == 10)
    line_start = np.unique(np.concatenate([begins[:-1][np.diff(begins) > 0], breaks + 1]))
    line_start = line_start[line_start < len(data)]
    bound = np.append(line_start[1:], len(data))[: len(line_start)]
    line_end = np.where(data[bound - 1] == 10, bound - 1, bound)
    first_word = np.searchsorted(start, line_start)
    last_word = np.searchsorted(start, line_end)
    full = last_word > first_word
    line_start, line_end = line_start[full], line_end[full]
    first_word, last_word = first_word[full], last_word[full]
    text = np.searchsorted(begins, line_start, side="right") - 1
    with np.errstate(over="ignore"):
        content = range_hash(BYTE_CODES[data], line_start, line_end)
    duplicate, _ = _seen_before(text, content)

    before = np.zeros(len(data), dtype=np.uint8)
    before[1:] = data[:-1]
    wide = before == 0xC3
    upper = _sums(((data >= 65) & (data <= 90)) | (wide & (data >= 0x80) & (data <= 0x9E)))
    lower = _sums(((data >= 97) & (data <= 122)) | (wide & (data > 0x9E)))
    digits = _sums((data >= 48) & (data <= 57))
    shouts = _sums(data == 33)
    follows = np.zeros(len(codes), dtype=bool)
    follows[1:] = (codes[1:] == codes[:-1]) & (text_of_word[1:] == text_of_word[:-1])
    follows = _sums(follows)
    bare = _sums((end - start) == 1)

    def on_line(sums: np.ndarray) -> np.ndarray:
        return (sums[line_end] - sums[line_start]).astype(float)

    count = (last_word - first_word).astype(float)
    letters = np.maximum(on_line(upper) + on_line(lower), 1)
    solid = np.maximum(on_line(chars), 1)
    closing = np.isin(data[end[last_word - 1] - 1], np.frombuffer(b".?!:;", dtype=np.uint8))
    features = np.stack(
        [
            np.ones(len(count)),
            np.minimum(on_line(symbols) / count, 2),
            on_line(upper) / letters,
            np.minimum(on_line(shouts) / count, 2),
            (follows[last_word] - follows[first_word]) / count,
            on_line(digits) / solid,
            (count < 5).astype(float),
            np.log1p(count) / 5,
            closing.astype(float),
            duplicate.astype(float),
            solid / count / 10,
            (bare[last_word] - bare[first_word]) / count,
        ],
        axis=1,
    ) if len(count) else np.zeros((0, len(LINE_FEATURES)))

    def by_text(values: np.ndarray, where: np.ndarray) -> np.ndarray:
        return np.bincount(where, weights=values, minlength=n).astype(np.int64)

    return Counts(
        words=words,
        word_chars=chars[at[1:]] - chars[at[:-1]],
        symbols=symbols[at[1:]] - symbols[at[:-1]],
        dup_lines=by_text(duplicate, text),
        repeat_words=by_text(repeated, text_of_word),
        distinct=by_text(~again, text_of_word),
        line_text=text,
        line_words=count.astype(np.int64),
        line_features=features,
    )
