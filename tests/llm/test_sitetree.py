from __future__ import annotations

import random
import time

import pytest
from llm.fixtures import folder

from assayline.llm import queries, sitetree

CASES = [
    ("", ""), ("plain  text", "plain text"), ("<p>a<p>b", "a\nb"), ("<p>a <b>bold</b>\n x<br>y</p>", "a bold x y"), ("a &amp; b &lt;c&gt; &#233;&nbsp;&am", "a & b <c> é &am"),
    ("<script>var t='</p>';</script><p>x</p><style>p{}</style>", "x"), ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"), ("<!-- <p>no</p> --><p>yes</p><!-- open <p>no", "yes"),
    ("<html><head><title>t</title><body><nav>menu</nav><article><h1>T</h1><p><b>first.<br><p>second</p></article><footer>f</footer>", "T\nfirst.\nsecond"),
    ("<body><header>site</header><main><p>x</p></main><aside>y</aside>", "x"), ('<article><p>x</p><div class="ad">buy</div><section id="comments"><p>nice</p></section></article>', "x"),
    ('<article><header><h1>T</h1></header><p>x</p><form><p>mail</p></form><footer>tags</footer></article>', "T\nx"), ('<div class="cookie-notice">ok</div><p>x</p>', "x"),
    ('<p title="a > b">x</p>', "x"), ("<p class=it's>x</p><p>y's</p>", "x\ny's"), ("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>", "a\nb\nc\nd\ne"),
    ("<P>Big</P><DIV HIDDEN>no</DIV>", "Big"), ("<p>a</p></div></p><p>b", "a\nb"), ("<p>x <span class='ad'>buy</span> y</p>", "x\ny"), ("<p>a<p", "a"), ("<div role='navigation'>n</div>t", "t"),
    ("<article class='comment'><p>c</p></article><article><p>x</p></article>", "x"), ("<p>x</p><textarea>no", "x"), ("<pre>a\n  b</pre>", "a b"), ("<head><meta charset=utf-8><p>open head", "open head"),
]


@pytest.mark.parametrize("page,text", CASES)
def test_pages(page, text):
    assert "\n".join(t for t, _ in sitetree.parse(page)[0]) == text


def sites(n=12, seed=1):
    """Pages of a host whose markup says nothing: the same bar and end, another body each."""
    rng = random.Random(seed)
    say = lambda k: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(k))
    rows = []
    for i in range(n):
        body = [say(12), say(20)]
        page = f'<div class="x1"><a href="/">home</a> news sport</div><div class="x2"><p>{body[0]}</p><p>{body[1]}</p></div><div class="x3">all rights with us</div>'
        rows.append((i, f"http://Host.example.com/{i}", page, "\n".join(body)))
    return rows


def test_branches_alike_on_a_host_are_removed(spark, tmp_path):
    rows = sites()
    lone = [(100, "http://other.example.com/1", rows[0][2], "home news sport\n" + rows[0][3] + "\nall rights with us")]
    odd = [(200, None, None, ""), (201, None, "", ""), (202, "::bad[", "<p>x</p>", "x"), (0, rows[0][1], rows[0][2], rows[0][3])]
    every = rows + lone + odd + [(300 + i, f"https://site.example.org/{i}", p, t) for i, (p, t) in enumerate(CASES) if "article" in p]
    df = spark.createDataFrame([r[:3] for r in every], "page_id long, url string, html string")
    got = sorted(tuple(r) for r in queries.main_text(spark, folder(spark, tmp_path, pages=df.repartition(3))).collect())
    want = sorted(((p, u or "", t, len(t)) for p, u, _, t in every), key=str)
    assert sorted(((p, u or "", t, n) for p, u, t, n in got), key=str) == want


def test_copies_of_an_article_stay(spark):
    page = "<nav>a b</nav><article><h1>T</h1><p>the same text</p></article>"
    df = spark.createDataFrame([(i, "http://h.example/x", page, "old") for i in range(30)], "page_id long, url string, html string, Text string")
    got = sitetree.extract(df)
    assert got.columns == ["page_id", "url", "text"]
    assert {r.text for r in got.collect()} == {"T\nthe same text"}


def test_copies_are_no_evidence(spark):
    page = lambda text: f'<article><div class="c"><p>{text}</p></div><div class="d">share this</div></article>'
    rows = [(i, "http://a.example/x", page("the one text")) for i in range(30)]
    rows += [(100 + i, "http://a.example/y", page(f"another text {i}")) for i in range(10)]
    rows += [(200 + i, "http://b.example/x", page("alone here")) for i in range(5)]
    got = dict(sitetree.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).select("page_id", "text").collect())
    want = {i: "the one text" for i in range(30)} | {100 + i: f"another text {i}" for i in range(10)} | {200 + i: "alone here\nshare this" for i in range(5)}
    assert got == want


def test_paragraphs_repeated_on_a_host_are_removed(spark):
    end = "Follow us for more like this."
    body = lambda i: [f"first words of {i}", f"more of page {i}", *(["a middle one"] if i % 3 else [])]
    page = lambda i: "<article><h1>Title {}</h1>{}</article>".format(i, "".join(f"<p>{t}</p>" for t in [*body(i)[: i % 3], end, *body(i)[i % 3 :]]))
    rows = [(i, "http://a.example/x", page(i)) for i in range(40)] + [(100, "http://b.example/x", page(1))]
    got = dict(sitetree.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).select("page_id", "text").collect())
    assert got.pop(100) == "\n".join(["Title 1", body(1)[0], end, *body(1)[1:]])
    assert got == {i: "\n".join(t for t in [f"Title {i}", *body(i)] if t != "a middle one") for i in range(40)}


def test_importance(spark):
    rows = [("h", 1, 5, i) for i in range(8)] + [("h", 2, 5, 7)] * 8 + [("h", 3, 5, 1)] + [("h", 4, i, 7) for i in range(8)]
    got = {r.path: (r.n_pages, round(r.importance, 6)) for r in sitetree.importance(spark.createDataFrame(rows, "host string, path long, style long, content long")).collect()}
    assert got == {1: (8, 0.9), 2: (8, 0.0), 3: (1, 1.0), 4: (8, 0.1)}


def test_long_and_broken_pages_take_little_time():
    begin = time.time()
    for page in ["<p>" * 20_000, "<div>" * 3_000 + "x", "<" * 100_000, "&" * 100_000, "<b>" * 50_000 + "x", "<a href='" * 300, "x " * 500_000, "<!--" * 20_000]:
        sitetree.parse(page)
    assert time.time() - begin < 20


def test_empty_table(spark):
    assert sitetree.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
