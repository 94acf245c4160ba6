"""Main text of web pages: what their markup says, and a site style tree for what it does not say.

Pages of one host are merged node by node, a node being the path of its elements with their
classes and ids.  Its importance mixes how much the presentation (the sequence of children) and the
content (the words below it) differ from page to page, as entropies in units of the largest possible
one.  Branches that look and read alike on a host's pages are removed from each of them.

Every block with text is in the tree, headings and paragraphs included, with all branches that hold
it.  A block is a leaf of its own as well, by its path and words: one that stands on many pages of
the host says the less the more they are, whatever stands beside it under the same path.

Markup is checked besides: what is outside an article (or else the main element), or in an element
which, or whose class, id or role, says menu, advert, form, comment and so on, goes in any case.
"""

from __future__ import annotations

import re
from html import unescape
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import add_columns, stage, text_or_empty

#: Share of the importance that comes from the content, and what a branch needs to stay.
CONTENT_SHARE, IMPORTANT = 0.9, 0.3
#: Branches seen on fewer pages of a host stay: there is nothing to compare.
MIN_PAGES = 5

# HTML elements by the role they have here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q ruby rb rp rt s samp small span strike strong sub sup time tt u var".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
NOISE_TAGS = frozenset("head nav aside form fieldset button select option dialog menu template noscript object svg math canvas audio video applet figcaption map".split()) | RAW
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
NOISE_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored sponsors promo promotion nav navbar navigation menu breadcrumb breadcrumbs masthead footer sidebar "
    "cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended "
    "comment comments commentlist disqus reply replies respond search toolbar pagination pager".split()
)
#: These start a new paragraph, so an open one ends before them.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
#: An element of the first kind ends an open one of the second kinds, unless one of the third is in between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}

_token = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|</[^A-Za-z>][^>]*+(?:>|\Z)|</>|<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|))*+)(?:>|\Z)", re.S)
_attribute = re.compile(r"(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_words = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _labels(attributes: str) -> tuple[str, bool]:
    """Class and id as written, and whether the attributes say that this is no text."""
    label, noise = "", False
    for name, a, b, c in _attribute.findall(attributes):
        name, value = name.lower(), unescape(a or b or c)
        if name in ("class", "id"):
            label += f".{value}"
            noise |= not NOISE_WORDS.isdisjoint(w.lower() for w in _words.findall(value))
        elif name == "role":
            noise |= value.strip().lower() in NOISE_ROLES
        elif name == "hidden":
            noise = True
        elif name == "aria-hidden":
            noise |= value.strip().lower() == "true"
        else:
            noise |= "display:none" in re.sub(r"\s", "", value.lower())
    return label, noise


class _Open:
    """An open element that matters: a block, or an inline element that is noise."""

    __slots__ = ("tag", "path", "noise", "region", "judged")

    def __init__(self, tag, path, noise, region, judged):
        self.tag, self.path, self.noise, self.region, self.judged = tag, path, noise, region, judged


def parse(html: str) -> tuple[list[tuple[str, tuple[int, ...]]], dict[int, tuple[int, int]]]:
    """Blocks of the page (text, its leaf and the branches that hold it), and per branch its style and content.

    Tags may be left open or closed twice; character references are decoded; white space in a
    block becomes one space, and blocks without text are left out.
    """
    stack = [_Open("", "", False, 0, ())]
    blocks: list[tuple[str, tuple[str, ...], int, str]] = []
    styles: dict[str, list[str]] = {}
    held: list[str] = []

    def close_block():
        if held:
            top = stack[-1]
            text = " ".join("".join(held).split())
            if text:
                blocks.append((text, top.judged, top.region, f"{top.path}\n{text}"))
            held.clear()

    def cut_to(depth):
        close_block()
        del stack[depth:]

    at, size = 0, len(html)
    while at < size:
        begin = html.find("<", at)
        if begin < 0:
            begin = size
        if begin > at and not stack[-1].noise:
            held.append(unescape(html[at:begin]))
        if begin == size:
            break
        found = _token.match(html, begin)
        if not found:  # a plain less-than sign
            if not stack[-1].noise:
                held.append("<")
            at = begin + 1
            continue
        at = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if found[1]:
            if tag == "br":
                held.append(" ")
            elif tag == "p" and not any(o.tag == "p" for o in stack):
                close_block()
            elif tag not in VOID:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag == tag:
                        cut_to(depth)
                        break
                    if stack[depth].tag in ("table", "td", "th") and tag not in ("table", "tr", "tbody", "thead", "tfoot", "article", "main", "body", "html"):
                        break
            continue
        if tag in VOID:
            if tag in ("br", "wbr"):
                held.append(" " if tag == "br" else "")
            elif tag == "hr":
                close_block()
            continue
        if tag in ("html", "body"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            at = end.start() if end else size
            end = _token.match(html, at) if end else None
            at = end.end() if end else size
            if tag not in INLINE:
                held.append(" ") if held else None
            continue
        if tag in INLINE:
            if found[3] and _labels(found[3])[1]:
                close_block()
                top = stack[-1]
                stack.append(_Open(tag, top.path, True, top.region, top.judged))
            continue
        if tag in ENDS_PARAGRAPH:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == "p":
                    cut_to(depth)
                    break
                if stack[depth].tag in ("table", "td", "th", "button", "object"):
                    break
        if tag in ENDS:
            ended, guards = ENDS[tag]
            last = None
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in ended:
                    last = depth
                elif stack[depth].tag in guards or stack[depth].tag in ("table",):
                    break
            if last:
                cut_to(last)
        if tag != "head" and stack[-1].tag == "head" and tag not in NOISE_TAGS:
            cut_to(len(stack) - 1)  # the head was left open
        close_block()
        top = stack[-1]
        label, noise = _labels(found[3]) if found[3] else ("", False)
        region = 2 if tag == "article" else max(top.region, 1) if tag == "main" else top.region
        # A header or footer of the page is none of the text, and so is an article's footer.
        noise |= tag in NOISE_TAGS or tag == "footer" or (tag == "header" and region < 2)
        noise &= tag not in ("article", "main") or bool(label)
        path = f"{top.path}/{tag}{label}"
        judged = top.judged
        if not (top.noise or noise):
            styles.setdefault(top.path, []).append(tag + label)
            if tag not in ("article", "main"):
                judged = (*judged, path)
        if not found[3].endswith("/") or tag not in ("path", "circle", "rect", "use"):
            stack.append(_Open(tag, path, top.noise or noise, region, judged))
    close_block()
    best = max((r for _, _, r, _ in blocks), default=0)
    kept = [(t, (leaf, *j)) for t, j, r, leaf in blocks if r == best]
    content: dict[str, list[str]] = {}
    for text, (_, *judged) in kept:
        for path in judged:
            content.setdefault(path, []).append(text)
    nodes = {_hash(p): (_hash(" ".join(styles.get(p, ()))), _hash("\n".join(t))) for p, t in content.items()}
    return [(t, tuple(_hash(p) for p in j)) for t, j in kept], nodes


def host_of(url: str | None) -> str:
    try:
        return (urlsplit((url or "").strip()).hostname or "").lower()
    except ValueError:
        return ""


_BLOCKS = pa.list_(pa.struct([("text", pa.string()), ("branches", pa.list_(pa.int64()))]))
_NODES = pa.list_(pa.struct([("path", pa.int64()), ("style", pa.int64()), ("content", pa.int64())]))
_SCHEMA = "host string, blocks array<struct<text:string,branches:array<bigint>>>, nodes array<struct<path:bigint,style:bigint,content:bigint>>, same bigint"


def _task(columns):
    for pages, urls in columns:
        parsed = [parse(h) for h in pages.to_pylist()]
        blocks = [[{"text": t, "branches": b} for t, b in found] for found, _ in parsed]
        nodes = [[{"path": p, "style": s, "content": c} for p, (s, c) in own.items()] for _, own in parsed]
        same = [_hash("\n".join(t for t, _ in found)) for found, _ in parsed]
        yield [pa.array(map(host_of, urls.to_pylist()), pa.string()), pa.array(blocks, _BLOCKS), pa.array(nodes, _NODES), pa.array(same, pa.int64())]


def importance(nodes: DataFrame) -> DataFrame:
    """``host``, ``path``, ``n_pages`` and ``importance`` of the merged nodes, from rows of host, path, style and content.

    Equal values are counted with combined aggregates, so a host of any size is a few rows per task.
    """

    def spread(value: str, name: str) -> DataFrame:
        counted = nodes.groupBy("host", "path", value).agg(F.count("*").alias("c"))
        n = F.sum("c")
        entropy = F.log(n) - F.sum(F.col("c") * F.log("c")) / n
        return counted.groupBy("host", "path").agg(n.alias("n_pages"), F.when(n > 1, F.greatest(entropy, F.lit(0.0)) / F.log(n)).otherwise(1.0).alias(name))

    both = spread("content", "content_importance").join(spread("style", "style_importance").drop("n_pages"), ["host", "path"])
    mixed = CONTENT_SHARE * F.col("content_importance") + (1 - CONTENT_SHARE) * F.col("style_importance")
    return both.select("host", "path", "n_pages", mixed.alias("importance"))


def repeated(leaves: DataFrame, pages: DataFrame) -> DataFrame:
    """``host`` and ``path`` of leaves that say too little, from rows of host and leaf, once per page, and of hosts, once per page.

    A leaf on c of n pages says log(n / c), in units of the log(n) of one that is on a single page.
    """
    often = leaves.groupBy("host", "leaf").agg(F.count("*").alias("c")).where(F.col("c") >= MIN_PAGES)
    sizes = pages.groupBy("host").agg(F.count("*").alias("n"))
    says = CONTENT_SHARE * (1 - F.log("c") / F.log("n"))
    return often.join(sizes, "host").where(says < IMPORTANT).select("host", F.col("leaf").alias("path"))


def extract(pages: DataFrame, html: str = "html", url: str = "url", column: str = "text") -> DataFrame:
    """Add ``column``: the main text of each page, a line per block; empty if there is none.

    Null pages have no text; a page without url belongs to the host of all such pages.  Repeated
    rows get the same text.  Other columns stay, but for one named like the new one.
    """
    kept = [c for c in pages.columns if c.lower() not in (column.lower(), html.lower())]
    whole = pages.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), text_or_empty(html).alias("page"), F.col(f"`{url}`").cast("string").alias("address"))
    parsed = add_columns(whole, [F.col("page"), F.col("address")], _task, _SCHEMA, keep=["row"])
    parsed = stage(parsed, "pages")
    # Pages of a host with the same text are one page: copies say nothing about what its pages share.
    nodes = parsed.select("host", "same", F.explode("nodes").alias("n")).groupBy("host", "same", "n.path").agg(F.min("n").alias("n")).select("host", "n.*")
    leaves = parsed.select("host", "same", F.explode(F.transform("blocks", lambda b: b.branches[0])).alias("leaf")).distinct()
    # Only branches and leaves that many pages of a host share and that say nothing are listed with the host.
    alike = importance(nodes).where((F.col("n_pages") >= MIN_PAGES) & (F.col("importance") < IMPORTANT)).select("host", "path")
    poor = alike.unionByName(repeated(leaves, parsed.select("host", "same").distinct())).groupBy("host").agg(F.collect_set("path").alias("poor"))
    open_, clear = parsed.where(F.size("blocks") > 0), parsed.where(F.size("blocks") == 0)
    judged = open_.join(stage(poor, "branches"), "host", "left").withColumn(
        "blocks", F.when(F.col("poor").isNull(), F.col("blocks")).otherwise(F.filter("blocks", lambda b: ~F.arrays_overlap(b.branches, F.col("poor"))))
    )
    both = clear.select("row", "blocks").unionByName(judged.select("row", "blocks"))
    return both.select("row.*", F.array_join(F.transform("blocks", lambda b: b.text), "\n").alias(column))
