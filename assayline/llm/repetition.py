"""Repetition inside a text, measured with a suffix array over its words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import add_columns, text_or_empty
from .suffixes import suffix_levels

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
#: Repeats of fewer words are chance; beyond these limits a text is refused.
MIN_WORDS, MAX_FRACTION, MAX_LONGEST = 5, 0.3, 100


def repeat_lengths(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each position, how many words from there on occur elsewhere in the same text too.

    That is the larger longest common prefix with both neighbours in the suffix array: the value
    of the innermost interval of common prefixes which holds the suffix.
    """
    n = len(words)
    longest = np.zeros(n, np.int64)
    if n < 2:
        return longest
    order, levels = suffix_levels(words, ends)
    a, b = order[:-1], order[1:]
    near = np.flatnonzero(words[a] == words[b])
    a, b = a[near], b[near]
    common = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + common, b + common
        same = (x < ends[a]) & (y < ends[b])
        same &= levels[k][np.minimum(x, n - 1)] == levels[k][np.minimum(y, n - 1)]
        common += same.astype(np.int64) << k
    longest[a] = common
    longest[b] = np.maximum(longest[b], common)
    return longest


def covered(lengths: np.ndarray, least: int, width: int | None = None) -> np.ndarray:
    """Positions inside the union of all repeats of ``least`` words or more (of ``width`` words each, if given)."""
    at = np.arange(len(lengths))
    reach = np.where(lengths >= least, at + (lengths if width is None else width), 0)
    return np.maximum.accumulate(reach) > at


def _numbers(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A number per word, different in different texts, and the words of each text."""
    seen: dict[bytes, int] = {}
    flat: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        words = text.split()
        counts[i] = len(words)
        flat += [seen.setdefault(w, len(seen)) for w in words]
    numbers = np.array(flat, np.int64) + np.repeat(np.arange(len(texts)), counts) * (len(seen) + 1)
    return numbers, counts


def _spans(inside: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Runs of covered positions as a list per text of word spans."""
    n, begins = len(inside), np.cumsum(counts) - counts
    fresh = np.zeros(n, bool)
    fresh[begins[counts > 0]] = True
    start = np.flatnonzero(inside & (fresh | ~np.append([False], inside[:-1])))
    last = np.flatnonzero(inside & (np.append(fresh[1:], True) | ~np.append(inside[1:], [False])))
    owner = np.repeat(np.arange(len(counts)), counts)[start]
    offsets = np.searchsorted(owner, np.arange(len(counts) + 1))
    fields = [pa.array((start - begins[owner]).astype(np.int32)), pa.array((last + 1 - begins[owner]).astype(np.int32))]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, names=["begin", "end"]))


def _task(columns):
    for (texts,) in columns:
        strings = texts.to_pylist()
        numbers, counts = _numbers(texts.cast(pa.binary()).to_pylist())
        stops = np.cumsum(counts)
        ends, owner = np.repeat(stops, counts), np.repeat(np.arange(len(counts)), counts)
        lengths = repeat_lengths(numbers, ends)
        union = covered(lengths, MIN_WORDS)
        per_text = lambda flags: np.bincount(owner[flags], minlength=len(counts))
        longest = np.zeros(len(counts), np.int64)
        if len(lengths):
            longest[counts > 0] = np.maximum.reduceat(lengths, (stops - counts)[counts > 0])
        chars, symbols, lines = [], [], []
        for t in strings:
            chars.append(len(t) - sum(map(t.count, BLANKS)))
            symbols.append(sum(map(t.count, SYMBOLS)))
            full = [x for x in t.split("\n") if x.strip(BLANKS)]
            lines.append(len(full) - len(set(full)))
        yield [
            *(pa.array(x, pa.int64()) for x in (counts, chars, symbols, lines, per_text(covered(lengths, 3, 3)), per_text(union), longest)),
            _spans(union, ends, counts),
        ]


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the repetition measures of every whole text.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` (lines with a word that equal an
    earlier one), ``n_repeat_words`` (words in three-word windows found twice or more),
    ``covered_words`` (words in the union of all repeats of MIN_WORDS or more), ``longest_repeat``
    (its longest, in words; occurrences may overlap) and ``repeat_spans`` (that union, as word
    spans).  Null counts as the empty text, whose measures are all zero.  What a task holds
    follows its longest text.
    """
    return add_columns(
        df, [text_or_empty(text)], _task,
        "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, covered_words bigint, longest_repeat bigint, repeat_spans array<struct<begin:int,end:int>>",
    )


def judge(measured: DataFrame, max_fraction: float = MAX_FRACTION, max_longest: int = MAX_LONGEST) -> DataFrame:
    """Add ``base_failed`` and ``kept``.

    The base refuses texts of fewer than 50 words, and those of which more than half lies in
    repeated three-word windows.  The suffix array refuses what has more than ``max_fraction`` of
    its words in longer repeats, or one repeat above ``max_longest`` words.
    """
    n = F.col("n_words")
    base = (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)
    fine = (F.col("covered_words") <= max_fraction * n) & (F.col("longest_repeat") <= max_longest)
    return measured.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & fine)
