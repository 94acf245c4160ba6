from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from llm.fixtures import documents

from assayline.llm import fragments, queries


def plain(rows):
    """``{key: (set size, smallest key reachable)}``, comparing all that share a shingle."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    label = list(range(len(rows)))

    def end(x):
        while label[x] != x:
            x = label[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for j, n in Counter(j for g in s for j in holders[g]).items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                label[end(i)] = end(j)
        for g in s:
            holders[g].append(i)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[end(i)] = min(least.get(end(i), key), key)
    return [(key, len(sets[i]), least.get(end(i))) for i, (key, _) in enumerate(rows)]


def texts(seed, bases=6, copies=12):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randint(1, 5)))
    shared = [word() for _ in range(40)]
    out = []
    for _ in range(bases):
        base = [word() for _ in range(rng.randint(5, 120))]
        for _ in range(copies):
            near = list(base)
            for _ in range(rng.randint(0, 4)):
                near[rng.randrange(len(near))] = word()
            out.append(" ".join(near + (shared if rng.random() < 0.3 else [])))
    return out + [None, "", " \n\t", "one", "One", "a b c d", "A B  c\td", "a b c d e", "no\xa0break here is one word", out[0], out[0]]


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r) for r in fragments.classes(df, **options).collect()), key=str)


@pytest.mark.parametrize(("seed", "options"), [
    (0, {}), (1, {"crowd": 2, "pivots": 1, "rounds": 1}), (2, {"crowd": 3, "pivots": 2, "rounds": 3}),
])
def test_equals_brute_force_also_with_crowded_buckets(spark, seed, options):
    rows = [(i * 3, t) for i, t in enumerate(texts(seed))]
    random.Random(seed).shuffle(rows)
    assert found(spark, rows, **options) == sorted(plain(rows), key=str)


def test_null_and_repeated_keys_long_texts_and_clashing_columns(spark):
    rng = random.Random(7)
    long = " ".join("".join(rng.choices("abcdefgh", k=3)) for _ in range(60_000))
    rows = [(5, long), (2, long + " end"), (None, long), (9, "x y z"), (9, "other words are here now"), (None, None), (None, "only nulls hold this one text"), (3, "x y z"), (3, "x y z")]
    got = found(spark, rows)
    assert got == sorted(plain(rows), key=str)
    df = spark.createDataFrame([(1, "a b c d e f", "x", 3), (2, "a b c d e f", "y", 4)], "doc_id long, text string, gram string, number int")
    assert sorted(tuple(r) for r in fragments.classes(df).collect()) == [(1, 2, 1), (2, 2, 1)]


def test_empty_table(spark):
    out = fragments.classes(documents(spark, []).select("doc_id", "text"))
    assert out.columns == ["doc_id", "n_shingles", "component_id"] and out.count() == 0


def test_overlaps_are_counted_per_fragment(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(400)]
    pair = [(1, " ".join(words)), (2, " ".join(words[:380] + ["z"] + words[381:]))]
    df = spark.createDataFrame(pair, "doc_id long, text string")
    parts = fragments.shared_parts(df, "text", fragments.hopeful(fragments.measured(df, "doc_id", "text")))
    (a, n_a), (b, n_b) = sorted((r.node, r.n) for r in parts.select("node", "n").collect())
    pairs = spark.createDataFrame([(a, n_a, b, n_b)], "a long, n_a long, b long, n_b long")
    counted = {r.fragment: r.overlap for r in fragments.overlaps(pairs, parts).collect()}
    sets = [set(fragments.shingles(t.encode()).tolist()) for _, t in pair]
    want = Counter(g >> 60 for g in sets[0] & sets[1])
    assert counted == dict(want) and len(counted) == fragments.FRAGMENTS
    assert fragments.linked(pairs, parts).count() == 1


def test_sets_that_share_too_little_are_left_out_early(spark):
    rng = random.Random(5)
    alone = [" ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(300)) for _ in range(20)]
    df = spark.createDataFrame(list(enumerate([*alone, alone[0] + " more words"])), "doc_id long, text string")
    assert fragments.hopeful(fragments.measured(df, "doc_id", "text")).count() == 2


def test_query_columns(spark):
    assert queries.QUERIES["op11_ngram_join"](spark, "/root/testdata/sf0.001").columns == ["doc_id", "n_shingles", "component_id"]
