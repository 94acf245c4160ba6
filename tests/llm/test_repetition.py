from __future__ import annotations

import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.fixtures import documents, folder

from assayline.llm import queries, repetition

TEXTS = [
    None, "", "\n\n", "a a a a a", "one two three " * 40, " ".join(f"w{i}" for i in range(80)), "x # y\nx # y\n\n \nq <a> | $\n",
    " ".join(f"w{i % 37}" for i in range(300)), " ".join(f"v{i}" for i in range(400)) + "\n" + " ".join(f"v{i}" for i in range(60)) + " end",
    "no\xa0break inside a word é", "tie tie tie", "tie tie tie", "z" * 100_000, "go " * 30_000,
]


def brute(words):
    """For each position, the longest run that occurs at another position too."""
    n = len(words)
    out = [0] * n
    for i in range(n):
        for j in range(n):
            if i != j:
                k = 0
                while max(i, j) + k < n and words[i + k] == words[j + k]:
                    k += 1
                out[i] = max(out[i], k)
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=25), max_size=4))
def test_repeat_lengths(texts):
    flat = np.array([w + 10 * i for i, t in enumerate(texts) for w in t], np.int64)
    ends = np.repeat(np.cumsum([len(t) for t in texts]), [len(t) for t in texts]).astype(np.int64)
    assert repetition.repeat_lengths(flat, ends).tolist() == [x for t in texts for x in brute(t)]


def test_query(spark, tmp_path):
    sf = folder(spark, tmp_path, documents=documents(spark, TEXTS))
    got = {r.doc_id: r for r in queries.repeated_text(spark, sf).collect()}
    assert len(got) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
        inside = {k + d for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for d in range(3)}
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), len(inside))
        assert r.base_failed == (len(words) < 50 or 100 * len(inside) > 50 * len(words))
        assert not (r.kept and r.base_failed)
    assert got[5].kept and not got[7].kept


def test_a_long_repeat_is_refused_though_the_base_keeps_it(spark):
    half = " ".join(f"w{i}" for i in range(120))
    text = half + " " + " ".join(f"v{i}" for i in range(900)) + " " + half
    row = repetition.judge(repetition.measure(documents(spark, [text, text.rsplit(" ", 60)[0]]))).orderBy("doc_id").collect()
    assert [r.longest_repeat for r in row] == [120, 60]
    assert [(r.base_failed, r.kept) for r in row] == [(False, False), (False, True)]
    assert [tuple(x) for x in row[0].repeat_spans] == [(0, 120), (1020, 1140)]


def test_columns_and_empty_table(spark):
    df = spark.createDataFrame([("a b", "old", 7)], "text string, N_Words string, other int")
    row = repetition.measure(df).first()
    assert (row.n_words, row.other) == (2, 7)
    assert repetition.measure(documents(spark, [])).count() == 0
