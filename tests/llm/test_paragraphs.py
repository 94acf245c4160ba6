from __future__ import annotations

import random

import pytest
from llm.fixtures import documents, folder

from assayline.llm import paragraphs, queries


def brute(rows):
    """All pairs of paragraphs: rows of (key, line, class id, class size, removed)."""
    found = []
    for key, text in rows:
        for line, body in enumerate((text or "").split("\n")):
            words = body.encode().lower().split()
            if len(words) >= 20:
                found.append((key, line, {tuple(words[i : i + 5]) for i in range(len(words) - 4)}))
    label = list(range(len(found)))
    for i in range(len(found)):
        for j in range(i):
            a, b = found[i][2], found[j][2]
            if len(a & b) >= 0.8 * len(a | b):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    out = []
    for c in set(label):
        members = [found[i] for i in range(len(found)) if label[i] == c]
        if len(members) > 1:
            order = sorted(members, key=lambda m: m[:2])
            out += [(k, line, order[0][0], len(members), n > 0) for n, (k, line, _) in enumerate(order)]
    return sorted(out)


def texts(seed, n=30):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefg", k=rng.randint(2, 6)))
    base = [[word() for _ in range(rng.randint(20, 90))] for _ in range(6)]
    out = [None, "", "\n\n", "short line\nshort line"]
    for _ in range(n):
        lines = []
        for _ in range(rng.randint(1, 4)):
            words = list(rng.choice(base)) if rng.random() < 0.6 else [word() for _ in range(rng.randint(5, 60))]
            for _ in range(rng.choice([0, 0, 1, 2])):
                words[rng.randrange(len(words))] = word()
            lines.append(" ".join(words) if rng.random() < 0.8 else "  ".join(w.upper() for w in words))
        out.append("\n".join(lines))
    return out + [out[-1], "x " * 50_000]


@pytest.mark.parametrize("seed,crowd", [(1, paragraphs.CROWD), (2, paragraphs.CROWD), (1, 8)])
def test_classes_are_those_of_all_pairs(spark, seed, crowd):
    rows = list(enumerate(texts(seed)))
    got = paragraphs.classes(documents(spark, [t for _, t in rows]).repartition(3), crowd=crowd)
    assert sorted((r.doc_id, r.paragraph, r.class_id, r.class_size, r.removed) for r in got.collect()) == brute(rows)


def test_query(spark, tmp_path):
    rows = texts(3)
    sf = folder(spark, tmp_path, documents=documents(spark, rows))
    found = queries.repeated_paragraphs(spark, sf).collect()
    got = [r for r in found if r.begin is None]
    assert all(r.n_words == paragraphs.WINDOW for r in found if r.begin is not None) and len(got) < len(found)
    assert sorted((r.doc_id, r.paragraph, r.class_id, r.class_size, r.removed) for r in got) == brute(list(enumerate(rows)))


def test_removal_leaves_one_of_each_class(spark):
    body = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(1, "a\n" + body, 1), (2, body.upper() + "\nb\n", 2), (3, None, 3), (4, "é\n" + body + " x", 4)], "doc_id long, text string, lines int")
    assert sorted(map(tuple, paragraphs.remove(df).collect())) == [(1, "a\n" + body, 1), (2, "b\n", 2), (3, None, 3), (4, "é", 4)]


def test_repeated_rows_null_keys_and_empty_tables(spark):
    body = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(1, body), (1, body), (None, body)], "doc_id long, text string")
    got = paragraphs.classes(df).collect()
    assert [r.class_size for r in got] == [3, 3, 3] and sum(r.removed for r in got) == 2 and {r.class_id for r in got} == {1}
    assert paragraphs.classes(documents(spark, [])).count() == 0


def test_many_small_classes_in_a_crowd(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    common = [word() for _ in range(110)]
    rows = []
    for _ in range(150):
        own = [word() for _ in range(20)]
        rows += [" ".join(common + own), " ".join(common + own[:-1] + [word()])]
    rng.shuffle(rows)
    want = brute(list(enumerate(rows)))
    assert len({r[2] for r in want}) == 150
    got = paragraphs.classes(documents(spark, rows).repartition(3), crowd=24)
    assert sorted((r.doc_id, r.paragraph, r.class_id, r.class_size, r.removed) for r in got.collect()) == want


def planted(seed, n, length):
    """Texts of random words, lines broken anywhere; every third holds one of a few passages, inside its lines."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 7)))
    passages = [[word() for _ in range(length)] for _ in range(n // 12)]
    out, holds = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(30, 150))]
        chosen = rng.randrange(len(passages)) if i % 3 == 0 else None
        if chosen is not None:
            at = rng.randrange(len(words))
            words[at:at] = passages[chosen]
        out.append("".join(w + rng.choice(["\n"] + [" "] * rng.choice([4, 15, 60])) for w in words))
        holds.append(chosen)
    return out, holds


@pytest.mark.parametrize("length", [51, 70])
def test_passages_inside_lines_are_found(spark, length):
    texts, holds = planted(length, 360, length)
    got = paragraphs.passages(documents(spark, texts).repartition(3)).collect()
    copies = {c: holds.count(c) for c in set(holds) - {None}}
    there = {i for i, c in enumerate(holds) if c is not None and copies[c] > 1}
    found = {r.doc_id for r in got}
    assert len(there & found) >= 0.9 * len(there) and not found - there
    for r in got:
        words = texts[r.doc_id].lower().split()[r.begin : r.begin + paragraphs.WINDOW]
        assert len(words) == paragraphs.WINDOW and r.class_id <= r.doc_id
        before = sum(len(line.split()) for line in texts[r.doc_id].split("\n")[: r.paragraph])
        assert before <= r.begin < before + len(texts[r.doc_id].split("\n")[r.paragraph].split())
    firsts = {(r.class_id, r.class_size) for r in got}
    assert sum(not r.removed for r in got) >= len({c for c, _ in firsts})


def test_equal_windows_are_one_class_whatever_the_crowd(spark):
    texts, _ = planted(7, 120, 60)
    plain = {}
    for i, t in enumerate(texts):
        words = t.lower().split()
        for at in paragraphs.windows(t.encode())[1].tolist():
            plain.setdefault(tuple(words[at : at + paragraphs.WINDOW]), []).append((i, at))
    sets = {(i, at): {w[j : j + 5] for j in range(len(w) - 4)} for w, places in plain.items() for i, at in places}
    results = []
    for crowd, limit in ((paragraphs.CROWD, 32 << 20), (2, 32 << 20), (paragraphs.CROWD, 0)):
        got = {(r.doc_id, r.begin): r.class_id for r in paragraphs.passages(documents(spark, texts), crowd=crowd, limit=limit).collect()}
        results.append(got)
        for places in plain.values():
            if len(places) > 1:
                assert len({got[p] for p in places}) == 1
        # Whatever else is found is similar to another window.
        for p in set(got) - {p for places in plain.values() if len(places) > 1 for p in places}:
            assert any(q != p and len(sets[p] & sets[q]) >= 0.8 * len(sets[p] | sets[q]) for q in sets)
    assert results[0] == results[1] == results[2] and len(results[0]) > 40


def test_windows_begin_at_the_same_words_in_any_text():
    texts, holds = planted(3, 60, 80)
    for c in set(holds) - {None}:
        seen = []
        for t, h in zip(texts, holds):
            if h == c:
                words, at, _ = paragraphs.windows(t.encode())
                seen.append({tuple(words[i : i + paragraphs.WINDOW]) for i in at.tolist()})
        assert all(a & b for a in seen for b in seen)
    assert paragraphs.windows(b"x " * 1000)[1].tolist() == [0]
    assert not len(paragraphs.windows(b"one two")[1]) and not len(paragraphs.windows(b"")[1])


def test_ranges_hash_alike_wherever_they_stand(monkeypatch):
    import numpy as np

    rng = random.Random(1)
    words = ["".join(rng.choices("abcé", k=rng.randint(1, 9))).encode() for _ in range(3000)] + [b"x" * 500]
    hashes = {}
    for size in (1 << 18, 300, 64):
        monkeypatch.setattr(paragraphs, "ROLL", size)
        paragraphs._powers.cache_clear()
        for shift in (0, 7):
            joined = b"#" * shift + b" ".join(words)
            ends = shift + np.cumsum([len(w) + 1 for w in words]) - 1
            begins = ends - [len(w) for w in words]
            got = paragraphs.rolled(joined, begins[:-2], ends[2:]).tolist()
            for a, b, h in zip(begins[:-2], ends[2:], got):
                if b - a <= 64:
                    assert hashes.setdefault(joined[a:b], h) == h
    assert len(set(hashes.values())) > 0.999 * len(hashes)
    paragraphs._powers.cache_clear()


def test_passages_stand_nulls_repeats_and_empty_tables(spark):
    body = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(1, body, 0), (1, body, 0), (None, "a\nb " + body, 0), (4, None, 0), (5, "", 0)], "doc_id long, text string, begin int")
    got = paragraphs.passages(df).collect()
    assert {r.doc_id for r in got} == {1, None} and {r.class_size for r in got} == {3} and {r.class_id for r in got} == {1}
    assert paragraphs.passages(documents(spark, [])).count() == 0 and paragraphs.repeated(documents(spark, [])).count() == 0


def test_a_filter_knows_its_keys_and_few_others(spark):
    from pyspark.sql import functions as F

    import numpy as np

    from assayline.llm import bloom

    keys = spark.range(60_000).select(F.xxhash64("id").alias("value"))
    words = bloom.built(keys, 60_000)
    mine = np.array([r.value for r in keys.collect()], np.int64)
    assert bloom.known(words, mine).all() and words.nbytes <= 60_000 * 2 + 32
    others = np.array([r.value for r in spark.range(60_000, 120_000).select(F.xxhash64("id").alias("value")).collect()], np.int64)
    assert bloom.known(words, others).mean() < 0.01
    assert bloom.known(bloom.built(keys, 60_000, 64), mine).all() and not bloom.fits(60_000, 64) and bloom.fits(60_000)
    assert not bloom.known(bloom.built(keys.where("false"), 0), mine).any()


def test_texts_laid_out_together_are_those_laid_out_alone():
    rng = random.Random(4)
    rows = [(t or "").encode() for t in texts(6, 60)] + ["".join(rng.choices("ab \n\té", k=rng.randint(0, 300))).encode() for _ in range(100)]
    rows += [b"", b"a b c d", b"x\x0b\x0c\r\x1cY " * 30, b"\n" + b"w " * 19 + b"\n" + b"w " * 20, b" \n "]
    rng.shuffle(rows)
    laid = paragraphs.Laid(rows)
    at, hashes = paragraphs.windows_of(laid)
    first, counts = paragraphs.paragraphs_of(laid)
    flat, stops = paragraphs.sets_of(laid.hashes(), first, counts)
    for i, row in enumerate(rows):
        words = row.lower().split()
        assert laid.joined[laid.begins[laid.first[i]] :].startswith(b" ".join(words)) if words else i not in laid.text
        _, alone, own = paragraphs.windows(row)
        mine = laid.text[at] == i
        assert (at[mine] - laid.first[i]).tolist() == alone.tolist() and hashes[mine].tolist() == own.tolist()
        lines = [(k, x.lower().split()) for k, x in enumerate(row.split(b"\n")) if len(x.split()) >= paragraphs.MIN_WORDS]
        here = [j for j in range(len(first)) if laid.text[first[j]] == i]
        assert [(laid.line[first[j]], counts[j]) for j in here] == [(k, len(x)) for k, x in lines]
        for j, (_, x) in zip(here, lines):
            got = flat[stops[j] : stops[j + 1]].tolist()
            assert got == sorted(set(got)) and len(got) == len({tuple(x[k : k + 5]) for k in range(len(x) - 4)})
    assert len(at) > 50 and len(first) > 50
