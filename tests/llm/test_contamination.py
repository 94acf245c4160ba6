from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from llm.fixtures import documents, folder

from assayline.llm import contamination, queries

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return PATTERN.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts, items):
    """Hit words and items of every text, window by window."""
    out = []
    for text in texts:
        doc, hit, found = words(text), set(), set()
        for key, item in items:
            own = words(item)
            width = min(10, len(own))
            for s in range(len(own) - width + 1 if width else 0):
                for p in range(len(doc) - width + 1):
                    if doc[p : p + width] == own[s : s + width]:
                        hit |= set(range(p, p + width))
                        found.add(key)
        out.append((len(doc), len(hit), sorted(found - {None})))
    return out


def sample(seed):
    rng = random.Random(seed)
    vocabulary = ["Alpha", "beta", "γάμμα", "d4", "e-f", "É", "go", "x\x7fy", "IJ"]
    say = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, say(rng.choice([3, 6, 9, 10, 12, 25]))) for i in range(12)] + [(100, ""), (101, None), (102, "...")]
    texts = [None, "", "!!", "go"]
    for _ in range(25):
        text = say(rng.randint(0, 60))
        if rng.random() < 0.6:
            cut = words(rng.choice(items)[1])
            text += " zzz " + " ".join(cut[rng.randint(0, 2) :]) + " qqq " + say(5)
        texts.append(text)
    return texts + texts[-3:], items


@pytest.mark.parametrize("seed", range(6))
def test_suffix_arrays_find_what_comparing_finds(seed):
    texts, items = sample(seed)
    block = contamination.Items.of([(k, (t or "").encode()) for k, t in items])
    counts, flags, owner, found = contamination.hits(block, [(t or "").encode() for t in texts])
    for i, want in enumerate(brute(texts, items)):
        assert (counts[i], flags[owner == i].sum(), sorted(block.ids[k] for k in found[i].tolist())) == want


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_query(spark, tmp_path, monkeypatch, block_bytes):
    monkeypatch.setattr(contamination, "BLOCK_BYTES", block_bytes)
    texts, items = sample(11)
    items += [(None, "go go go go go go go"), (0, "beta beta beta beta")]
    benchmark = spark.createDataFrame([(k, t, "x") for k, t in items], "item_id long, text string, items string").coalesce(1)
    sf = folder(spark, tmp_path, documents=documents(spark, texts), benchmark=benchmark)
    got = {r.doc_id: r for r in queries.decontamination(spark, sf).collect()}
    for i, (n, hit, found) in enumerate(brute(texts, items)):
        ids = ",".join(sorted(map(str, found)))
        assert (got[i].n_words, got[i].n_hit, got[i].n_items, got[i].contaminated) == (n, hit, len(found), hit > 0)
        assert got[i].items_sha256 == hashlib.sha256(ids.encode()).hexdigest()


def test_clean_keeps_columns_and_drops_only_hits(spark):
    item = " ".join(f"w{i}" for i in range(14))
    df = spark.createDataFrame([(1, "a " + item, 5), (2, "clean text", 6), (3, None, 7), (4, " ".join(item.split()[:9]), 8)], "doc_id long, text string, n_hit int")
    benchmark = spark.createDataFrame([(None, item)], "item_id long, text string")
    assert sorted(map(tuple, contamination.clean(df, benchmark).collect()), key=str) == sorted([(2, "clean text", 6), (3, None, 7), (4, " ".join(item.split()[:9]), 8)], key=str)


def test_longest_match_and_its_place(spark):
    item = " ".join(f"w{i}" for i in range(30))
    df = documents(spark, ["x y " + " ".join(item.split()[3:15]), "q " + " ".join(item.split()[5:28]) + " z", " ".join(item.split()[5:28]), None])
    benchmark = spark.createDataFrame([(7, item), (8, "nothing of this kind occurs here at all in any text"), (9, "")], "item_id long, text string")
    assert [tuple(r) for r in contamination.longest(df, benchmark).collect()] == [(7, 5, 23, 1, 1)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination.find(documents(spark, []), none).count() == 0
    row = contamination.find(documents(spark, ["a b"]), none).first()
    assert (row.n_words, row.n_hit, row["items"]) == (2, 0, [])
    assert contamination.longest(documents(spark, ["a b"]), none).count() == 0


def test_search_is_exact_on_one_shard():
    rng = np.random.default_rng(0)
    numbers, owner = rng.integers(0, 4, 400), np.repeat([0, 1], 200)
    shard = contamination.Shard.of(numbers, owner, 3)
    query = rng.integers(1, 4, 50).astype(np.int32)
    depth, low, high = shard.search(query, np.arange(46), np.full(46, 5))
    for k in range(46):
        runs = [p for p in range(400) if owner[p] == owner[min(p + depth[k], 400) - 1] and numbers[p : p + depth[k]].tolist() == query[k : k + depth[k]].tolist()] if depth[k] >= 3 else None
        if runs is not None:
            assert set(shard.place[shard.order[low[k] : high[k]]].tolist()) <= set(runs)
            assert len(runs) == high[k] - low[k] or depth[k] < 5
