"""Suffix arrays over numbered words."""

from __future__ import annotations

import numpy as np


def suffix_levels(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of many texts at once, by prefix doubling.

    ``words`` holds one number per word, ``ends`` the end of each position's text.  A text's end
    sorts before every word, and ends of different texts differ.  Also returned: for each power of
    two, a class per position, equal where so many following words are equal.  Only ties are
    sorted again, so rounds get short quickly.
    """
    n = len(words)
    order = np.argsort(words, kind="stable")
    head = np.ones(n, bool)
    head[1:] = words[order][1:] != words[order][:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    levels, width = [rank], 1
    while True:
        tied = np.flatnonzero(~head | ~np.append(head[1:], True))
        if not len(tied):
            return order, levels
        at = order[tied]
        after = at + width
        follow = np.where(after < ends[at], rank[np.minimum(after, n - 1)] + n + 1, ends[at])
        key = rank[at] * (2 * n + 2) + follow
        again = np.argsort(key, kind="stable")
        at, key = at[again], key[again]
        first = np.ones(len(at), bool)
        first[1:] = key[1:] != key[:-1]
        order[tied], head[tied] = at, first
        rank = rank.copy()
        rank[at] = np.maximum.accumulate(np.where(first, tied, 0))
        levels.append(rank)
        width *= 2
