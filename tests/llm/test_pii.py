from __future__ import annotations

import hashlib
import random
import re

from llm.fixtures import documents, folder
from pyspark.sql import functions as F

from assayline.llm import pii, queries

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def plain(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            fine = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")), "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if fine:
                out.append((kind, m.start(), m.end()))
    return out


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


TRICKY = [
    None, "", "a@b.c_d@e.f", "x@y", "@@a@b.co.", "1.2.3.4.5.6.7.8", "1.2.3 1.2.3.4", "300.1.1.1 007.08.009.255", "4111 1111 1111 1111", "4111-1111-1111-1112", "4111  1111",
    "+1 (456) 555-2186", "+1 (456) 555-2186 (", "+12", "++1 234 567 890", "é漢𝄞 a@b.de 𝄞 10.0.0.1", "a." * 3000 + "@x.y", "9" * 4000, "1 " * 4000, "+1" * 500, "a@b.c" * 3,
    "a@b.c\n1.2.3.4\n+49 30 1234567", "same a@b.io", "same a@b.io", "12.34.56.78.90@host.org 4111111111111111",
]


def noisy(seed):
    rng = random.Random(seed)
    alphabet = ["a@b.c", "@", ".", "1", "23", "255", "256", "+", "(", ")", "-", " ", "4111111111111111", "x", "é", "\n", "_", "%"]
    return ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(150)]


def corpus():
    rng = random.Random(3)
    out = []
    for i in range(260):
        number = f"({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
        out.append(f"please call +1 {number} today" if i % 2 else f"your host 10.{rng.randint(0, 255)}.{rng.randint(0, 255)}.7 replied")
    return out


def test_query(spark, tmp_path):
    texts = TRICKY + noisy(1) + noisy(2) + corpus()
    sf = folder(spark, tmp_path, documents=documents(spark, texts))
    got = {r.doc_id: r for r in queries.personal_data(spark, sf).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        base = plain(text)
        r = got[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in base) for kind in BASE], text
        assert r.base_sha256 == hashlib.sha256(listed(base).encode()).hexdigest(), text
        assert set(filter(None, listed(base).split(","))) <= set(r.spans.split(",")), text
        spans = [s.split(":") for s in filter(None, r.spans.split(","))]
        assert spans == sorted(spans, key=lambda s: (list(BASE).index(s[0]), int(s[1])))


def test_trees_add_what_looks_like_the_known_ones(spark):
    bad = [f"part (1{a % 100:02}) 155-{1000 + a} of it" for a in range(100, 160)]
    extra = ["please call (456) 555-2186 today", "please mail nobody at all", "host 300.1.1.1 is none", "your host 10.1.1.1 is one"]
    texts = corpus() + bad + extra
    found = pii.find(documents(spark, texts)).orderBy("doc_id").collect()[-4:]
    cut = [[(pii.KINDS[s.kind], extra[i][s.start : s.stop]) for s in r.spans] for i, r in enumerate(found)]
    assert cut == [[("phone", "(456) 555-2186")], [], [], [("ip", "10.1.1.1")]]


def test_without_known_ones_nothing_is_added(spark):
    rows = pii.find(documents(spark, ["call (456) 555-2186", None])).collect()
    assert [r.spans for r in rows] == [[], []]
    assert pii.find(documents(spark, [])).count() == 0


def test_redaction_keeps_everything_else(spark):
    df = spark.createDataFrame([(1, "é a@b.co, 10.0.0.1!", "x", 3), (2, None, "y", 4), (3, "clean", "z", 5)], "doc_id long, text string, spans string, base int")
    assert [tuple(r) for r in pii.redact(df).orderBy("doc_id").collect()] == [(1, "é [EMAIL], [IP]!", "x", 3), (2, None, "y", 4), (3, "clean", "z", 5)]


def test_neighbours_of_other_kinds_are_not_hidden(spark):
    texts = ["𝄞 10.0.0.1 4111 1111 1111 1111\na@b.c 10.0.0.1", "a@b.c +1 234 567 8901\n\n10.0.0.2"]
    rows = documents(spark, texts).select("doc_id", "text", pii.candidates(F.col("text")).alias("c")).orderBy("doc_id").collect()
    got = [[(pii.KINDS[c.kind], r.text[c.start : c.stop], c.verdict) for c in r.c] for r in rows]
    assert ("card", "4111 1111 1111 1111", None) in got[0]
    assert [c for c in got[0] if c[2] == 1] == [("email", "a@b.c", 1), ("ip", "10.0.0.1", 1), ("ip", "10.0.0.1", 1)]
    assert got[1] == [("email", "a@b.c", 1), ("ip", "10.0.0.2", 1), ("phone", "+1 234 567 8901", 1)]


def test_overlapping_spans_leave_no_tail(spark):
    spans = [(1, 1, 10), (2, 8, 25), (0, 3, 5), (3, 26, 28)]
    df = spark.createDataFrame([("(10.0.0.18 4111 1111 1111b cd", spans), ("none", [])], "text string, spans array<struct<kind:int,start:bigint,stop:bigint>>")
    assert [r[0] for r in df.select(pii.cut_out(df.text, df.spans)).collect()] == ["([IP]b[PHONE]d", "none"]


def test_running_sums(spark):
    rows = [(list(range(n)),) for n in (0, 1, 2, 255, 256, 257, 513, 1000)]
    df = spark.createDataFrame(rows, "x array<bigint>")
    for r in df.select("x", pii.running_sums(df.x).alias("y")).collect():
        assert r.y == [sum(r.x[:i]) for i in range(len(r.x))]


def test_trees_separate_and_thresholds_hold_back():
    rows = [((3, d, 2, 0, 0, 0, 1), int(d >= 10), 50.0) for d in range(5, 15)]
    trees = pii.grow(rows)
    limit = pii.thresholds(rows, trees)
    assert [sum(pii.value_of(t, f) for t in trees) >= limit[3] for f, _, _ in rows] == [bool(y) for _, y, _ in rows]
    assert pii.thresholds(rows[:5], trees) == {} and pii.grow([]) == []


def test_thresholds_of_rare_kinds_follow_all_and_then_their_own():
    rows = [((k, d, 2, 0, 0, 0, 1), int(d >= 10), 50.0) for k in (2, 3) for d in range(5, 15)]
    trees = pii.grow(rows)
    score = lambda k, d: sum(pii.value_of(t, (k, d, 2, 0, 0, 0, 1)) for t in trees)
    few = pii.thresholds([*rows, ((0, 12, 2, 0, 0, 0, 1), 1, 1.0)], trees)
    assert set(few) == {0, 1, 2, 3} and score(0, 12) >= few[0] > score(0, 6)
    # Many bad ones of a kind outweigh what the others show, a few do not.
    assert 1 in pii.thresholds([*rows, ((1, 14, 2, 0, 0, 0, 1), 0, 1.0)], trees)
    assert 1 not in pii.thresholds([*rows, ((1, 14, 2, 0, 0, 0, 1), 0, 500.0)], trees)


def test_one_document_gets_the_same_spans_in_small_and_large_tables(spark):
    known = [f"please call +1 (4{i % 100:02}) 555-{1000 + i} today" for i in range(400)]
    bad = [f"part (1{i % 100:02}) 155-{1000 + i} of it" for i in range(100)]
    one = "please call (456) 555-2186 today"
    for n in (8, 40, 400):
        found = pii.find(documents(spark, [*known[:n], *bad[: n // 4], one])).orderBy("doc_id").collect()[-1]
        assert [(pii.KINDS[s.kind], one[s.start : s.stop]) for s in found.spans] == [("phone", "(456) 555-2186")], n


def test_long_runs_take_linear_time(spark):
    texts = ["a" * 100_000, "1" * 100_000, "1." * 50_000, "+" + "1 " * 50_000, "(" * 100_000, "a@b.c " * 20_000]
    assert [len(r.base) for r in pii.find(documents(spark, texts)).orderBy("doc_id").collect()] == [0, 0, 12_500, 0, 0, 20_000]
