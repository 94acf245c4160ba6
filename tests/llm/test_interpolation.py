from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from llm.fixtures import documents, folder

from assayline.llm import interpolation, queries


def fold(key):
    return zlib.crc32(("" if key is None else str(key)).encode()) % 5


def tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + [None]


def texts(n=60):
    rng = random.Random(4)
    words = ["The", "of", "and", "é", "to", "x\xa0y", *("w%d" % i for i in range(40))]
    out = [None, "", " \n ", "the THE the"]
    for _ in range(n):
        w, body = rng.choice(words), []
        for _ in range(rng.randint(1, 60)):
            w = words[(words.index(w) * 7 + rng.choice([1, 1, 1, 2, 9])) % len(words)]
            body.append(w)
        out.append(" ".join(body))
    return out + [out[-1], "rare" + str(n), "the " * 3000]


@given(st.lists(st.integers(0, 2**64 - 1), max_size=50))
def test_packing(numbers):
    assert interpolation.unpack(interpolation.pack(np.array(numbers, np.uint64))).tolist() == numbers
    assert interpolation.unpack_sorted(interpolation.pack_sorted(np.array(sorted(numbers), np.uint64))).tolist() == sorted(numbers)


def brute(rows):
    """Counts and scores with plain dictionaries; the weights come from the same events, without steps."""
    learned, counted = [r for r in rows if fold(r[0]) != 1], [r for r in rows if fold(r[0]) not in (1, 2)]

    def count(some):
        words, pairs = Counter(), Counter()
        for _, t in some:
            own = tokens(t)
            words.update(own)
            pairs.update(zip([None, *own], own))
        return words, pairs, sum(words.values()), len(words)

    def parts(model, v, w):
        words, pairs, total, distinct = model
        return [pairs[v, w] / words[v] if words[v] else 0.0, words[w] / total, 1 / (distinct + 1)], 0 if not words[v] else min(int(math.log2(words[v])) + 1, 23)

    model, events = count(counted), []
    for k, t in rows:
        if fold(k) == 2:
            own = tokens(t)
            events += [parts(model, v, w) for v, w in zip([None, *own], own)]
    weights = {g: [0.5, 0.4, 0.1] if g else [0.0, 0.8, 0.2] for g in range(24)}
    for _ in range(40):
        sums = {}
        for p, g in events:
            share = [a * b for a, b in zip(weights[g], p)]
            own = sums.setdefault(g, [0.0] * 3)
            for i in range(3):
                own[i] += share[i] / sum(share)
        for g, own in sums.items():
            extra = [0.1 if g else 0.0, 0.1, 0.1]
            weights[g] = [(a + b) / (sum(own) + sum(extra)) for a, b in zip(own, extra)]
    model = count(learned)
    words, _, total, distinct = model
    out = {}
    for k, t in rows:
        own = tokens(t)
        base = sum(math.log10((words[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in own)
        logs = 0.0
        for v, w in zip([None, *own], own):
            p, g = parts(model, v, w)
            logs += math.log10(sum(a * b for a, b in zip(weights[g], p)))
        out[k] = (fold(k) == 1, len(own), sum(words[w] > 0 for w in own), total, base, logs)
    return out


@pytest.mark.parametrize("chunk", [interpolation.CHUNK_TOKENS, 50])
def test_scores(spark, tmp_path, monkeypatch, chunk):
    rows = list(enumerate(texts()))
    sf = folder(spark, tmp_path, documents=documents(spark, [t for _, t in rows]).repartition(3))
    if chunk == interpolation.CHUNK_TOKENS:
        got = queries.language_model(spark, sf).collect()
    else:
        got = interpolation.score(spark.read.parquet(f"{sf}/documents.parquet"), chunk_tokens=chunk).collect()
    want = brute(rows)
    assert sorted(r.doc_id for r in got) == sorted(want)
    for r in got:
        w = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
        assert r.base_score == pytest.approx(w[4], rel=1e-9)
        # The weights are learned from ratios in quarter octaves.
        assert r.score == pytest.approx(w[5], rel=0.02, abs=0.05)


def test_the_model_beats_the_base_on_held_out_text(spark):
    got = [r for r in interpolation.score(documents(spark, texts(200)[:-1])).collect() if r.held_out]
    assert sum(r.score for r in got) > 0.9 * sum(r.base_score for r in got)


def test_probabilities_sum_to_one():
    weights = interpolation.learn([(5 * 193 * 193 + 60 * 193 + 50, 9), (3 * 193 * 193 + 70, 4)])
    assert np.allclose(weights.sum(1), 1) and (weights[1:] > 0).all()


def test_nothing_to_learn_from(spark):
    assert interpolation.score(documents(spark, [])).count() == 0
    key = next(k for k in range(50) if fold(k) == 1)
    row = interpolation.score(spark.createDataFrame([(key, "a b")], "doc_id long, text string")).first()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and math.isfinite(row.score)
    rows = interpolation.score(spark.createDataFrame([(None, "a"), (None, "a")], "doc_id long, text string")).collect()
    assert [r.n_tokens for r in rows] == [2, 2]
