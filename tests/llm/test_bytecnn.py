from __future__ import annotations

import random

import numpy as np
import pytest
from llm.fixtures import documents, folder

from assayline.llm import bytecnn, queries


def corpus(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(rng.randint(20, 120))]
        good = i % 3 != 0
        out.append((" ".join(words) if good else " ".join(w + rng.choice(["###", "%%%"]) for w in words), int(good)))
    return out


def plain_features(net, text):
    """The network chunk by chunk and byte by byte."""
    data = list(text) + [0] * bytecnn.WIDTH
    size = max(len(text), 1)
    act = [[sum(net.filters[k][data[i + k]][f] for k in range(bytecnn.WIDTH)) + net.bias[f] for f in range(bytecnn.FILTERS)] for i in range(size)]
    chunks = [np.maximum(np.max(act[b : b + bytecnn.STRIDE + bytecnn.OVERLAP], axis=0), 0) for b in range(0, size, bytecnn.STRIDE)]
    return np.concatenate([np.mean(chunks, 0), np.max(chunks, 0)])


@pytest.fixture(scope="module")
def net():
    rows = corpus(240, 1)
    return bytecnn.fit([t.encode() for t, _ in rows], [y for _, y in rows])


@pytest.mark.parametrize("size", [0, 1, 4, 63, 64, 65, 447, 448, 449, 512, 513, 1500])
def test_chunks_cover_the_whole_text(net, size):
    text = bytes(random.Random(size).choices(range(32, 200), k=size))
    assert np.allclose(bytecnn.features(net, [b"x" * 700, text, b"y" * 9])[1], plain_features(net, text), atol=1e-4)


def test_blocks_do_not_change_a_score(net, monkeypatch):
    text = bytes(random.Random(3).choices(range(256), k=20_000))
    whole = bytecnn.features(net, [text])
    monkeypatch.setattr(bytecnn, "BLOCK", 2 * bytecnn.STRIDE)
    assert np.allclose(bytecnn.features(net, [text, b"", text]), [whole[0], bytecnn.features(net, [b""])[0], whole[0]], atol=1e-5)


def test_held_out_accuracy(net):
    rows = corpus(120, 2)
    q = net.probability(bytecnn.features(net, [t.encode() for t, _ in rows]))
    assert np.mean((q >= 0.5) == [bool(y) for _, y in rows]) > 0.97


def test_query(spark, tmp_path):
    rows = corpus(150, 4)
    texts = [t for t, _ in rows] + [None, "", "x" * 200_000]
    labels = spark.createDataFrame([(i, y, 0) for i, (_, y) in enumerate(rows)] + [(0, None, 0), (None, 1, 0), (999, 1, 1)], "doc_id long, quality int, toxic int")
    sf = folder(spark, tmp_path, documents=documents(spark, texts), labels=labels)
    got = {r.doc_id: r for r in queries.quality(spark, sf).collect()}
    assert len(got) == len(texts)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    checked = [got[i].predicted == y for i, (_, y) in enumerate(rows) if got[i].held_out]
    assert len(checked) > 15 and np.mean(checked) > 0.9


def test_nothing_to_learn_from(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    sf = folder(spark, tmp_path, documents=documents(spark, ["a", None]), labels=empty)
    assert {r.score for r in queries.quality(spark, sf).collect()} == {0.5}
