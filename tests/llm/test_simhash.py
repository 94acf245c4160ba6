from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.fixtures import documents, folder

from assayline.llm import components, queries, simhash


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) > 4 else ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, radius=4):
    """Smallest index reachable, comparing all pairs."""
    label = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for i in range(len(values)):
            for j in range(i):
                if (values[i] ^ values[j]).bit_count() <= radius and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return label


def texts(seed, n=40):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randint(1, 5)))
    out = [None, "", " \n", "One", "one", "a b c d", "A B  c\td", "a b c d e", "x" * 100_000, "no\xa0break here is one word"]
    for _ in range(n // 4):
        base = [word() for _ in range(rng.randint(60, 300))]
        out.append(" ".join(base))
        for _ in range(3):
            near = list(base)
            near[rng.randrange(len(near))] = word()
            out.append(" ".join(near))
    return out + [out[-1], out[-1]]


def test_masks_cover_every_difference_within_the_radius():
    tables = simhash.masks()
    assert len(tables) == 31
    rng = random.Random(0)
    for _ in range(5000):
        difference = sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
        assert any(not m & difference for m in tables)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB \n\xa0é", max_size=30), max_size=6))
def test_fingerprints(some):
    assert simhash.fingerprints([t.encode() for t in some]).tolist() == [plain_fingerprint(t) for t in some]


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 3])
@pytest.mark.parametrize("seed", [1, 2])
def test_links_lose_nothing(spark, seed, bucket):
    rng = random.Random(seed)
    centre = [rng.getrandbits(64) for _ in range(6)]
    values = {c for c in centre}
    for c in centre:
        x = c
        for _ in range(25):
            y = (x if rng.random() < 0.5 else c) ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6)))
            values.add(y)
            x = y
    values = sorted(values)
    df = spark.createDataFrame([(simhash._signed(v),) for v in values], "fingerprint long")
    edges = [(r.a % 2**64, r.b % 2**64) for r in simhash.links(df, bucket=bucket).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in edges)
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in edges:
        parent[root(a)] = root(b)
    want = classes(values)
    got = [root(v) for v in values]
    assert len(set(zip(want, got))) == len(set(want)) == len(set(got))


def test_query(spark, tmp_path):
    rows = texts(5)
    sf = folder(spark, tmp_path, documents=documents(spark, rows).repartition(3))
    got = {r.doc_id: r for r in queries.near_duplicates(spark, sf).collect()}
    prints = [plain_fingerprint(t) for t in rows]
    assert [got[i].fingerprint for i in range(len(rows))] == [f"{p:016x}" for p in prints]
    assert [got[i].component_id for i in range(len(rows))] == classes(prints)
    assert len(set(classes(prints))) < len(rows) - 10


def test_one_of_each_group_stays(spark):
    rows = texts(6)
    rows = [(i // 2, t, i) for i, t in enumerate(rows)] + [(None, "lonely words of a row without id " * 9, 1), (None, rows[-1], 2), (0, None, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint int")
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    kept = [tuple(r) for r in kept.collect()]
    want = classes([plain_fingerprint(t) for _, t, _ in rows])
    assert len(kept) == len(set(want))
    for group in set(want):
        members = [r for r, w in zip(rows, want) if w == group]
        best = min((k is None, k if k is not None else 0) for k, _, _ in members)
        assert sum(r in members and (r[0] is None, r[0] or 0) == best for r in kept) >= 1


@pytest.mark.parametrize("seed", [0, 1])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(50)] + [(7, 7), (500, 500), (None, 3)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {v: v for e in edges if None not in e for v in e}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in edges:
        if a is not None:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    assert got == {v: root(v) for v in parent}


def test_empty_tables(spark):
    assert simhash.groups(simhash.with_fingerprint(documents(spark, []))).count() == 0
    assert simhash.keep_one(documents(spark, [])).count() == 0
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_forest_is_linear():
    values = np.unique(np.random.default_rng(1).integers(0, 16, 2000).astype(np.uint64))
    a, _ = simhash.forest(values, 4)
    assert sum(map(len, a)) == len(values) - 1
