"""Personal data: high-recall candidates, judged by boosted trees over format and context.

Four exact patterns give the base spans.  Wider patterns propose further, overlapping candidates.
Those that overlap a base span of their kind are known to be good, and those that cannot be what
they look like (a wrong check digit, a part above 255, no such top level or area code) known to be
bad.  Boosted trees learn from both which of the others look and stand like good ones, and a
threshold per kind, set on rows that the trees have not seen, decides which of them become spans.

Everything per row is an expression over columns.  Features are small whole numbers, so that all
candidates come down to one row per distinct combination; the trees are grown from these counts,
and read as an expression again.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import stage, text_or_empty

# Kinds in order and the exact patterns.  Runs are possessive, which takes the same
# text without going back, and may only begin at the start of a run or where a match ended.
KINDS = ("email", "ip", "card", "phone")
EXACT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What proposes candidates: other ways to write the same, and what the exact patterns refuse.
WIDE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++(?:(?:@|\x20?[\[(]at[\])]\x20?)[A-Za-z0-9-]++(?:(?:\.|\x20?[\[(]dot[\])]\x20?|\x20dot\x20)[A-Za-z0-9-]++)++|\x20at\x20[A-Za-z0-9-]++(?:\x20dot\x20[A-Za-z0-9-]++)++)",
    "ip": r"(?:\G|(?<![0-9]))[0-9]{1,3}+(?:(?:\.|\[\.\]|\(\.\)|\x20\.\x20)[0-9]{1,3}+){3}(?![0-9])",
    "card": r"(?:\G|(?<![0-9]))[0-9]{4}+(?:[\x20./_-]{0,3}[0-9]{2,6}+){2,4}+(?![0-9])",
    "phone": r"(?:\G|(?<![0-9A-Za-z]))(?:\+\x20?|00)?(?:[0-9]{1,3}[\x20.-]{1,2})?\(?[0-9]{3}\)?[\x20./-]{0,2}[0-9]{3}[\x20./-]{1,2}[0-9]{4}(?![0-9A-Za-z])",
}
#: A text without this has no match; most texts are done with it.
NEED = {"email": r"@|[\[(]at[\])]|\x20dot\x20", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}
#: Words before a candidate that announce its kind.
CUES = {
    "email": r"(?i)(?:e-?mail|mail|contact|write|reach)\b", "ip": r"(?i)\b(?:ip|host|server|address|client|from)\b",
    "card": r"(?i)\b(?:card|visa|credit|payment|account|pay)\b", "phone": r"(?i)\b(?:call|phone|tel|telephone|mobile|fax|cell|contact|dial)\b",
}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
#: What the exact phone pattern asks for; the trees see the number without it.
COUNTRY = r"^(?:\+\x20?|00)?(?:[0-9]{1,3}[\x20.-]{1,2})?(?=\(?[0-9]{3}\)?[\x20./-]{0,2}[0-9]{3}[\x20./-]{1,2}[0-9]{4}$)"
CONTEXT_CHARS = 24
BLOCK = 256

#: Features and their largest values; the product bounds the rows that reach the driver.
FEATURES = {"digits": 20, "groups": 8, "cue": 1, "before": 2, "after": 2, "marks": 7}
ROUNDS, SHRINK, MIN_WEIGHT = 25, 0.3, 5
#: The share of known good ones among all that a threshold lets through, on rows kept aside.
PRECISION = 0.9
#: So many rows of all kinds together stand beside those of one kind when its share is estimated.
PRIOR = 20


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used and in whatever lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running_sums(sizes: Column) -> Column:
    """For each element the sum of those before it, in blocks, so that appending stays cheap."""

    def walk(numbers: Column) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(numbers, start, lambda s, x: F.struct((s.at + x).alias("at"), F.array_append(s.out, s.at).alias("out")))

    def blocks(numbers: Column) -> Column:
        last = F.floor(F.greatest(F.size(numbers) - 1, F.lit(0)) / BLOCK).cast("int")
        return F.transform(F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(numbers, b * BLOCK + 1, F.lit(BLOCK))), walk)

    def joined(inner: Column) -> Column:
        before = walk(F.transform(inner, lambda x: x.at)).out
        return F.flatten(F.zip_with(inner, before, lambda x, b: F.transform(x.out, lambda o: o + b)))

    return bound(sizes, lambda numbers: bound(blocks(numbers), joined))


def parts(text: Column, pattern: str) -> Column:
    """What stands before each leftmost match without overlap, the match, and what follows it.

    The last element has no match.  Both arrays come from the same search.
    """
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.arrays_zip(between.alias("gap"), found.alias("body"), F.slice(between, F.lit(2), F.lit(2**31 - 1)).alias("next"))


def matches(text: Column, pattern: str, use) -> Column:
    """``use(start, stop, body, before, after)`` of every match; positions are code points."""

    def placed(found: Column) -> Column:
        begins = running_sums(F.transform(found, lambda p: (F.length(p.gap) + F.length(p.body)).cast("bigint")))

        def one(p: Column, begin: Column) -> Column:
            start = begin + F.length(p.gap)
            return use(start, start + F.length(p.body), p.body, F.right(p.gap, F.lit(CONTEXT_CHARS)), F.left(p.next, F.lit(1)))

        return F.zip_with(found, begins, one)

    return bound(F.filter(parts(text, pattern), lambda p: p.body.isNotNull()), placed)


def blanked(text: Column, kind: str) -> Column:
    """The text with its base spans of a kind turned into as many zero characters."""

    def one(p: Column) -> Column:
        return F.concat(p.gap, F.when(p.body.isNull(), "").when(_valid(kind, p.body), F.repeat(F.lit("\0"), F.length(p.body))).otherwise(p.body))

    return F.when(text.rlike(NEED[kind]), F.array_join(F.transform(parts(text, EXACT[kind]), one), "")).otherwise(text)


def overlaid(one: Column, other: Column) -> Column:
    """Two texts of the same characters, zeros where either has them; only lines with zeros in both are taken apart."""

    def characters(a: Column, b: Column) -> Column:
        return F.array_join(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when(y == "\0", y).otherwise(x)), "")

    def lines(a: Column, b: Column) -> Column:
        return F.when((a == b) | ~F.contains(b, F.lit("\0")), a).when(~F.contains(a, F.lit("\0")), b).otherwise(characters(a, b))

    whole = F.array_join(F.zip_with(F.split(one, "\n"), F.split(other, "\n"), lines), "\n")
    return F.when((one == other) | ~F.contains(other, F.lit("\0")), one).when(~F.contains(one, F.lit("\0")), other).otherwise(whole)


def _digits(body: Column) -> Column:
    return F.regexp_replace(body, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def walk(state, c):
        value = F.ascii(c) - 48
        doubled = F.when(state.i % 2 == 1, F.when(value > 4, 2 * value - 9).otherwise(2 * value)).otherwise(value)
        return F.struct((state.i + 1).alias("i"), (state.sum + doubled).alias("sum"))

    chars = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    return F.aggregate(chars, F.struct(F.lit(0).alias("i"), F.lit(0).alias("sum")), walk, lambda s: s.sum % 10 == 0)


def _valid(kind: str, body: Column) -> Column:
    size = F.length(_digits(body))
    if kind == "ip":
        return body.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return F.when(size.between(13, 19), luhn(_digits(body))).otherwise(False)
    if kind == "phone":
        return size.between(9, 15)
    return F.lit(True)


def _possible(kind: str, body: Column) -> Column:
    """Whether a candidate can be what it looks like."""
    digits = _digits(body)
    if kind == "email":
        return body.rlike(r"(?:^|[^A-Za-z0-9-])[A-Za-z]{2,}$")
    if kind == "ip":
        return F.regexp_replace(body, "[^0-9]+", ".").rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    return F.length(digits).between(10, 13) & F.right(digits, F.lit(10)).rlike("^[2-9]")


def _features(kind: str, body: Column, preceding: Column, following: Column) -> list[Column]:
    """Whole numbers from 0 to the sizes in FEATURES."""
    body = F.regexp_replace(body, COUNTRY, "") if kind == "phone" else body
    digits = F.length(_digits(body))

    def place(c):
        return F.when((c == "") | c.rlike(r"^\s$"), 0).when(c.rlike(r"^[\p{L}\p{N}]$"), 2).otherwise(1)

    marks = F.when(body.rlike(r"[()\[\]]"), 1).otherwise(0) + F.when(body.rlike(r"\x20"), 2).otherwise(0) + F.when(body.rlike(r"[-_/]"), 4).otherwise(0)
    return [
        F.least(digits, F.lit(20)).alias("digits"), F.least(F.size(F.split(body, "[^A-Za-z0-9]+")), F.lit(8)).alias("groups"),
        preceding.rlike(CUES[kind]).cast("int").alias("cue"), place(F.right(preceding, F.lit(1))).alias("before"), place(following).alias("after"),
        marks.alias("marks"),
    ]


def candidates(text: Column) -> Column:
    """All candidates of a text: the base spans by kind and start, then those of the wide patterns.

    The verdict is 1 for base spans, 0 for what cannot be what it looks like and null for the rest.
    The wide patterns search the text without its base spans, so nothing is proposed twice.  The base
    spans of every kind are those of the whole text, and only they are hidden.
    """
    kind_of = "struct<start:bigint,stop:bigint,kind:int,verdict:int," + ",".join(f"{f}:int" for f in FEATURES) + ">"
    none = F.array().cast(f"array<{kind_of}>")

    def of(where: Column, kind: str, patterns: dict[str, str], verdict) -> Column:
        def one(start, stop, body, before, after):
            return F.struct(start.alias("start"), stop.alias("stop"), F.lit(KINDS.index(kind)).alias("kind"), verdict(kind, body).cast("int").alias("verdict"), *_features(kind, body, before, after)).cast(kind_of)

        return F.when(where.rlike(NEED[kind]), matches(where, patterns[kind], one)).otherwise(none)

    def every(whole: Column) -> Column:
        exact = [F.filter(of(whole, k, EXACT, lambda kind, body: F.when(_valid(kind, body), 1)), lambda c: c.verdict == 1) for k in KINDS]
        rest = reduce(lambda t, k: bound(F.array(t, blanked(whole, k)), lambda x: overlaid(x[0], x[1])), KINDS[1:], blanked(whole, KINDS[0]))
        wide = bound(rest, lambda t: F.concat(*[of(t, k, WIDE, lambda kind, body: F.when(~_possible(kind, body), 0)) for k in KINDS]))
        return F.concat(*exact, wide)

    return F.when(text.rlike("|".join(dict.fromkeys(NEED.values()))), bound(text, every)).otherwise(none)


def located(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``candidates`` and ``aside`` (whether the row is kept for the thresholds; copies are on one side).

    Texts are read once; the result is a written table, on which the rest works.
    """
    body = text_or_empty(text)
    return stage(df.withColumns({"candidates": candidates(body), "aside": F.pmod(F.xxhash64(body), F.lit(4)) == 0}), "candidates")


def grow(rows: list[tuple[tuple[int, ...], int, float]]) -> list[tuple]:
    """Boosted trees of two levels on weighted rows (features, label, weight), for the logistic loss.

    A tree is (feature, limit, left, right) or a number; rows with feature <= limit go left.
    """
    score = [0.0] * len(rows)
    trees = []

    def leaf(at):
        g = sum(rows[i][2] * (rows[i][1] - p[i]) for i in at)
        return SHRINK * g / (sum(rows[i][2] * p[i] * (1 - p[i]) for i in at) + 1)

    def split(at, depth):
        if depth == 0:
            return leaf(at)
        total_g = sum(rows[i][2] * (rows[i][1] - p[i]) for i in at)
        total_h = sum(rows[i][2] * p[i] * (1 - p[i]) for i in at)
        best = (1e-6, None, None)
        for f in range(len(rows[0][0])):
            sums: dict[int, list[float]] = {}
            for i in at:
                s = sums.setdefault(rows[i][0][f], [0.0, 0.0, 0.0])
                w = rows[i][2]
                s[0] += w * (rows[i][1] - p[i])
                s[1] += w * p[i] * (1 - p[i])
                s[2] += w
            whole = sum(s[2] for s in sums.values())
            g = h = weight = 0.0
            for value in sorted(sums)[:-1]:
                g, h, weight = g + sums[value][0], h + sums[value][1], weight + sums[value][2]
                if min(weight, whole - weight) >= MIN_WEIGHT:
                    gain = g * g / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1) - total_g**2 / (total_h + 1)
                    best = max(best, (gain, f, value), key=lambda b: b[0])
        if best[1] is None:
            return leaf(at)
        _, f, value = best
        return f, value, split([i for i in at if rows[i][0][f] <= value], depth - 1), split([i for i in at if rows[i][0][f] > value], depth - 1)

    for _ in range(ROUNDS if rows else 0):
        p = [1 / (1 + math.exp(-s)) for s in score]
        tree = split(range(len(rows)), 2)
        trees.append(tree)
        score = [s + value_of(tree, r[0]) for s, r in zip(score, rows)]
    return trees


def value_of(tree, features: tuple[int, ...]) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if features[tree[0]] <= tree[1] else tree[3]
    return tree


def _expression(tree, features: list[Column]) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    f, limit, left, right = tree
    return F.when(features[f] <= limit, _expression(left, features)).otherwise(_expression(right, features))


def thresholds(rows: list[tuple[tuple[int, ...], int, float]], trees: list[tuple]) -> dict[int, float]:
    """For each kind the lowest score from which on the share of good ones is at least PRECISION.

    The share of a kind is smoothed by that of all kinds from the same score on, which counts as PRIOR
    rows.  So a kind of which few are known, in a small table or because it is rare, follows what is
    known of all, and the more there are the less it does; there is no number at which the rule changes.
    Where no score reaches the share, or nothing is known at all, a kind has no threshold.
    """
    tallies: dict[float, dict[int, list[float]]] = {}
    for features, label, weight in rows:
        score = round(sum(value_of(t, features) for t in trees), 9)
        own = tallies.setdefault(score, {}).setdefault(features[0], [0.0, 0.0])
        own[0] += weight * label
        own[1] += weight
    found = {}
    good, seen = dict.fromkeys(range(len(KINDS)), 0.0), dict.fromkeys(range(len(KINDS)), 0.0)
    for score in sorted(tallies, reverse=True):
        for kind, (g, n) in tallies[score].items():
            good[kind] += g
            seen[kind] += n
        shared = sum(good.values()) / sum(seen.values())
        for kind in good:
            if good[kind] + PRIOR * shared >= PRECISION * (seen[kind] + PRIOR):
                found[kind] = score - 1e-6
    return found


def judge(found: DataFrame) -> DataFrame:
    """Add ``base`` and ``spans``, base and added ones by kind and start, to what ``located`` gives.

    One row per distinct combination of features, verdict and half of the rows reaches the driver;
    there are at most some 400,000, whatever the input.  Spans of one kind do not overlap.
    """
    one = found.select("aside", F.explode("candidates").alias("c")).where("c.verdict is not null")
    counts = one.groupBy("aside", "c.verdict", "c.kind", *[f"c.{f}" for f in FEATURES]).count().collect()
    rows = {side: sorted(((r.kind, *[r[f] for f in FEATURES]), r.verdict, float(r["count"])) for r in counts if r.aside == side) for side in (False, True)}
    trees = grow(rows[False])
    limits = thresholds(rows[True], trees)

    def enough(c: Column) -> Column:
        features = [c.kind, *[c[f] for f in FEATURES]]
        score = reduce(lambda a, t: a + _expression(t, features), trees, F.lit(0.0))
        return reduce(lambda a, k: a.when(c.kind == k, score >= limits[k]), limits, F.when(F.lit(False), False)).otherwise(False)

    def plain(spans: Column) -> Column:
        return F.transform(spans, lambda c: F.struct(c.kind.alias("kind"), c.start.alias("start"), c.stop.alias("stop")))

    base = plain(F.filter("candidates", lambda c: c.verdict == 1))
    picked = F.filter("candidates", lambda c: (c.verdict == 1) | (c.verdict.isNull() & enough(c)))
    return found.withColumns({"base": base, "spans": F.array_sort(plain(picked))})


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start.cast("string"), s.stop.cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s.kind == KINDS.index(kind))).cast("long")


def cut_out(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans go as one, under the kind of the earliest, then longest."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    in_order = F.array_sort(F.transform(spans, lambda s: F.struct(s.start.alias("start"), (-s.stop).alias("back"), s.kind.alias("kind"))))
    pieces = F.aggregate(
        in_order, F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out")),
        lambda state, s: F.when(s.start < state.at, F.struct(F.greatest(state.at, -s.back).alias("at"), state.out.alias("out"))).otherwise(F.struct(
            (-s.back).alias("at"),
            F.array_append(F.array_append(state.out, F.substring(text, (state.at + 1).cast("int"), (s.start - state.at).cast("int"))), F.get(names, s.kind)).alias("out"),
        )),
        lambda state: F.concat(F.array_join(state.out, ""), F.substring(text, (state.at + 1).cast("int"), F.lit(2**31 - 1))),
    )
    return F.when(F.size(spans) == 0, text).otherwise(pieces)


def find(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``base`` and ``spans`` (arrays of kind number, start and stop in code points, the stop exclusive).

    Null texts have none.  Repeated rows get the same spans.  Columns of these names give way.
    """
    return judge(located(df.drop("base", "candidates", "aside", "spans"), text)).drop("candidates", "aside")


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """The same rows and columns, with personal data in ``text`` replaced by its kind; null stays null."""
    kept = df.columns
    whole = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{text}`").alias("text"))
    found = find(whole)
    return found.select(*[(cut_out(F.col("text"), F.col("spans")) if c == text else F.col("row")[c]).alias(c) for c in kept])
