from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.fixtures import documents

from assayline.llm import spelling

ALPHABET = "abcdefghijklmnopqrstuvwxyzàéöÿÀÉ"


def plain_words(rows):
    found = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows):
    words = plain_words(rows)
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and one_apart(v, w)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        end = w
        while form[end]:
            end = form[end]
        out.append((w, n, len(near[w]), form[w], words.get(form[w]), end))
    return sorted(out)


def texts(seed, n=60):
    rng = random.Random(seed)
    base = ["".join(rng.choices(ALPHABET, k=rng.randint(4, 9))) for _ in range(25)] + ["aaaaa", "aaaaaa", "aaaaab", "color", "colour", "coler"]
    weights = [2.0 ** -(i % 7) for i in range(len(base))]

    def word():
        w = rng.choices(base, weights)[0]
        if rng.random() < 0.4:
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice(ALPHABET[:4]) + w[i:], w[:i] + rng.choice(ALPHABET[:4]) + w[i + 1 :]])
        return w.upper() if rng.random() < 0.1 and w.isascii() else w

    return ["".join(word() + rng.choice([" ", "\n", "1", "×", "-", " the ", "Ā"]) for _ in range(40)) for _ in range(n)]


def found(spark, rows, **options):
    out = spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"), **options)
    return sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in out.collect())


@pytest.mark.parametrize(("seed", "options"), [(0, {}), (1, {"piece": 1, "limit": 64}), (2, {"piece": 2, "limit": 1})])
def test_equals_brute_force_also_with_small_pieces(spark, seed, options):
    rows = list(enumerate(texts(seed)))
    assert found(spark, rows, **options) == plain(rows)


def test_null_empty_long_and_repeated(spark):
    long = "colour " * 20_000 + "x" * 4_000 + " " + ("y" * 2_000 + " ") * 4
    rows = [(None, "house house house"), (1, None), (2, ""), (3, " 1 ×"), (4, long), (5, "color color color"), (5, "color color color"), (6, "ab abcd")]
    assert found(spark, rows) == plain(rows)


def test_empty_table_and_clashing_columns(spark):
    assert spelling.variants(documents(spark, [])).count() == 0
    assert spelling.variants(documents(spark, ["few words"])).count() == 0
    df = spark.createDataFrame([(1, "colour colour colour", 3, "x")], "doc_id long, text string, n int, word string")
    assert [r.word for r in spelling.variants(df).collect()] == ["colour"]


def test_ties_go_by_code_points_and_chains_end(spark):
    text = "abcde " * 3 + "abcdé " * 6 + "abcdz " * 6 + "abcdzz " * 12 + "abcdzzz " * 24
    got = {r[0]: r for r in found(spark, [(1, text)])}
    want = {r[0]: r for r in plain([(1, text)])}
    assert got == want
    assert got["abcde"][3] == "abcdz" and got["abcde"][5] == got["abcdz"][5]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abéÿ", min_size=1, max_size=6), min_size=1, max_size=8))
def test_hashes_of_edits_follow_from_the_word(words):
    alphabet = np.array([ord(c) for c in "abéÿ"], np.uint8)
    for length in {len(w) for w in words}:
        of = [w for w in words if len(w) == length]
        for fewer, i, new, wanted, h in spelling.edits(spelling.letters(of), alphabet):
            for r, c in np.argwhere(wanted) if new is not None else [(r, None) for r in np.flatnonzero(wanted)]:
                word = of[r][:i] + ("" if c is None else chr(new[c])) + of[r][i + 1 :]
                if word:
                    assert (h[r] if c is None else h[r, c]) == spelling.hashes(spelling.letters([word]))[0]


def test_filters_know_every_word_and_few_others():
    rng = random.Random(0)
    words = ["".join(rng.choices(ALPHABET, k=8)) for _ in range(20_000)]
    n = spelling.blocks_of(len(words))
    h = spelling.hashes(spelling.letters(words))
    bits = np.zeros((n, 8), np.uint32)
    for i in range(8):
        np.bitwise_or.at(bits, (spelling._blocks(h, n).astype(np.int64), i), np.uint32(1) << spelling._bits(h, i))
    whole = spelling.Shard(n, 0, bits.tobytes())
    assert len(whole.known(h)) == len(h)
    others = spelling.hashes(spelling.letters(["".join(rng.choices(ALPHABET, k=8)) for _ in range(20_000)]))
    assert len(whole.known(others)) < 200
    halves = [spelling.Shard(n, 0, bits[: n // 2].tobytes()), spelling.Shard(n, n // 2, bits[n // 2 :].tobytes())]
    assert sum(len(s.known(h)) for s in halves) == len(h)


def test_passes_hold_no_more_than_the_limit():
    sizes = defaultdict(int, {5: 1000, 6: 40_000, 7: 3})
    groups = spelling.passes(sizes, piece=100, limit=20_000)
    assert all(sum(32 * min(100, spelling.blocks_of(sizes[n]) - at * 100) for n, at in g) <= 20_000 for g in groups)
    assert sorted(p for g in groups for p in g) == [(n, at) for n in sorted(sizes) for at in range(-(-spelling.blocks_of(sizes[n]) // 100))]
