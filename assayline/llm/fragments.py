"""Similar texts by a join on word n-grams whose global order is cut into fragments.

A text's set holds its distinct shingles of five lower-cased words, as 64-bit hashes.  Hashes are the
global order of the n-grams, and equal ranges of them its FRAGMENTS; a set is cut into one segment per
fragment.  Overlaps of a pair are counted segment by segment, each fragment apart, and summed per pair.

Which pairs are counted: two sets of a similarity of 0.8 share four fifths of either.  So a set with
more than a fifth of n-grams that no other set has is in no pair.  The first fragments show this for
nearly all texts, and only the others are read again and counted over all fragments.  Of what remains,
two sets that are similar share one of their rarest n-grams (the prefix of a set, rarest first), at
places that leave enough to share behind them, so sets meet in buckets of these.  Large buckets are not paired: some members are pivots for all others,
over a few rounds, and whoever is already in one component is not compared again.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayline import session

from .components import components
from .frames import add_columns, stage, text_or_empty

WORDS, PERCENT = 5, 80
#: Equal ranges of the n-gram order; the first HEAD of them decide which texts are read again.
FRAGMENTS, HEAD = 16, 5
#: Buckets of more members than CROWD are compared through PIVOTS of them first, which a member meets
#: in PICKS of its buckets, in ROUNDS at most before whatever is undecided is paired.
CROWD, PIVOTS, PICKS, ROUNDS = 8, 8, 2, 4

_BITS = FRAGMENTS.bit_length() - 1


def shingles(text: bytes) -> np.ndarray:
    """The set of a text as ascending hashes; fewer words than a shingle has are one shingle, none are none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= WORDS:
        return np.array([xxhash.xxh64_intdigest(joined)], np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    begins = (ends - sizes)[: 1 - WORDS].tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b]) for a, b in zip(begins, ends[WORDS - 1 :].tolist())), np.uint64, len(begins)))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    offsets = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.view(np.int64)))


def _texts(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def _measure_task(parts):
    """Texts -> size and identity (128 bits, and 64 of them) of the set, and its n-grams in the first fragments."""
    end = np.uint64(HEAD << (64 - _BITS))
    for (texts,) in parts:
        sets = [shingles(t) for t in _texts(texts)]
        same = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
        short = [None if s is None else int.from_bytes(s[:8], "big", signed=True) for s in same]
        yield [pa.array([len(s) for s in sets], pa.int64()), pa.array(same, pa.binary()), pa.array(short, pa.int64()), _lists([s[: np.searchsorted(s, end)] for s in sets])]


def _set_task(parts):
    for (texts,) in parts:
        yield [_lists([shingles(t) for t in _texts(texts)])]


def measured(documents: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, ``number`` (unique), ``text_id``, ``n_shingles``, ``same`` and ``short`` (null without words) and ``head`` of each row."""
    body = text_or_empty(text)
    rows = documents.select(F.col(f"`{key}`").alias("key"), F.unhex(F.md5(body)).alias("text_id"), body.alias("text"))
    found = add_columns(rows, [F.col("text")], _measure_task, "n_shingles bigint, same binary, short bigint, head array<bigint>", ["key", "text_id"])
    return stage(found.withColumn("number", F.monotonically_increasing_id()), "sets")


def hopeful(sets: DataFrame) -> DataFrame:
    """One row (node, n, text_id, copies) for each distinct set that the first fragments leave a chance.

    An n-gram that only one set has counts against that set.  Sets go by 64 bits of their identity
    here; where two share these, which the full identity shows, neither is judged.
    """
    grams = sets.select("short", F.explode("head").alias("gram"))
    alone = grams.groupBy("gram").agg(F.min("short").alias("short"), F.max("short").alias("last")).where("short = last")
    lost = alone.groupBy("short").agg(F.count("*").alias("lost"))
    of = sets.where("same is not null").groupBy("same").agg(
        F.min("short").alias("short"), F.min("number").alias("node"), F.max("n_shingles").alias("n"), F.min("text_id").alias("text_id"), F.count("*").alias("copies"),
    )
    clash = of.groupBy("short").agg(F.count("*").alias("sets")).where("sets > 1").select("short", F.lit(True).alias("clash"))
    nodes = stage(of, "distinct")
    judged = nodes.join(lost, "short", "left").join(clash, "short", "left")
    kept = judged.where(F.col("clash") | ((100 - PERCENT) * F.col("n") >= 100 * F.coalesce("lost", F.lit(0))))
    return stage(kept.select("node", "n", "text_id", "copies"), "hopeful")


def shared_parts(documents: DataFrame, text: str, nodes: DataFrame) -> DataFrame:
    """Of each set that can still be similar to another: ``node``, ``n``, ``alone``, ``prefix`` and ``segments`` by fragment.

    Only n-grams that at least two sets have are kept, the rarest first; the others come before them
    in the order, are in no overlap, and so only make the prefix shorter (``alone`` counts them).
    """
    body = text_or_empty(text)
    rows = documents.select(F.unhex(F.md5(body)).alias("text_id"), body.alias("text")).join(nodes, "text_id")
    # Only of texts that may come several times is one chosen, so that the others are not moved.
    several = rows.where("copies > 1").groupBy("text_id", "node", "n").agg(F.first("text").alias("text"))
    once = rows.where("copies = 1").select("node", "n", "text").unionByName(several.select("node", "n", "text"))
    # Where the list of sets is too long to be broadcast, Spark sends a Bloom filter of it to the texts
    # (of 8 MB at most), so that few others are moved to the join.
    with session.settings(documents.sparkSession, spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold="0"):
        sets = stage(add_columns(once, [F.col("text")], _set_task, "grams array<bigint>", ["node", "n"]), "grams")
    grams = sets.select("node", "n", F.explode("grams").alias("gram"))
    counts = stage(grams.groupBy("gram").agg(F.count("*").cast("int").alias("found")).where("found > 1"), "frequencies")
    # Merged at every size: n-grams and their counts both are as large as the texts.
    rarest = grams.join(counts.hint("merge"), "gram").groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("found", "gram"))).alias("grams"))
    kept = rarest.withColumn("least", F.expr(f"(n * {PERCENT} + 99) div 100")).where("size(grams) >= least")
    ordered = kept.withColumn("grams", F.col("grams.gram"))
    of = lambda f: F.filter("grams", lambda g: F.shiftrightunsigned(g, 64 - _BITS) == f)
    segments = F.array(*[of(f) for f in range(FRAGMENTS)])
    prefix = F.slice("grams", F.lit(1), (F.size("grams") - F.col("least") + 1).cast("int"))
    return stage(ordered.select("node", "n", (F.col("n") - F.size("grams")).cast("int").alias("alone"), prefix.alias("prefix"), segments.alias("segments")), "segments")


def overlaps(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """Partial overlaps of each pair (a, n_a, b, n_b): one row per fragment that both have n-grams in."""
    segments = parts.select("node", F.posexplode("segments").alias("fragment", "grams")).where("size(grams) > 0")
    left, right = (segments.select(F.col("node").alias(end), "fragment", F.col("grams").alias(f"grams_{end}")) for end in "ab")
    return pairs.join(left, "a").join(right, ["b", "fragment"]).select("a", "b", "n_a", "n_b", "fragment", F.size(F.array_intersect("grams_a", "grams_b")).alias("overlap"))


def linked(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """The pairs whose overlaps, summed over the fragments, make them similar."""
    summed = overlaps(pairs, parts).groupBy("a", "b", "n_a", "n_b").agg(F.sum("overlap").alias("overlap"))
    return summed.where(100 * F.col("overlap") >= PERCENT * (F.col("n_a") + F.col("n_b") - F.col("overlap"))).select("a", "b")


def _reach(n: Column, at: Column, m: Column, there: Column) -> Column:
    """Whether sets of sizes n and m can be similar if the first n-gram they share is at these places of their orders.

    All that they share is this one and what follows it in both.  A pair that is similar passes at the
    first n-gram it shares, whatever other buckets it meets in.
    """
    after = F.least(n - at, m - there)
    return (100 * F.least(n, m) >= PERCENT * F.greatest(n, m)) & ((100 + PERCENT) * after >= PERCENT * (n + m))


def prefixes(parts: DataFrame) -> DataFrame:
    """Buckets: ``gram``, ``node``, ``n``, ``at`` (the place in the order of the set) and ``members`` of the bucket.

    A set is not in a bucket in which even the smallest set is too large for what follows the place.
    """
    met = parts.select("node", "n", "alone", F.posexplode("prefix").alias("rank", "gram")).withColumn("at", F.col("alone") + F.col("rank"))
    ends = met.groupBy("gram").agg(F.count("*").alias("members"), F.min("n").alias("smallest")).where("members > 1")
    other = F.greatest(F.col("smallest"), F.expr(f"(n * {PERCENT}) div 100"))
    near = stage(met.join(ends, "gram").where((100 + PERCENT) * (F.col("n") - F.col("at")) >= PERCENT * (F.col("n") + other)).select("gram", "node", "n", "at", "alone"), "prefixes")
    return stage(near.join(near.groupBy("gram").agg(F.count("*").alias("members")).where("members > 1"), "gram").withColumn("component", F.col("node")), "buckets")


_OTHER = ("node", "n", "at", "component")


def _met(members: DataFrame, others: DataFrame) -> DataFrame:
    """Rows of members with those of a bucket's others, named ``o_...``, in different components and within reach."""
    far = others.select("gram", *[F.col(c).alias(f"o_{c}") for c in _OTHER])
    apart = F.col("component") != F.col("o_component")
    return members.join(far, "gram").where(apart & _reach(F.col("n"), F.col("at"), F.col("o_n"), F.col("o_at")))


def _pairs(members: DataFrame, others: DataFrame) -> DataFrame:
    """Distinct pairs of members and others of a bucket."""
    low = F.col("node") < F.col("o_node")
    pick = lambda x, y, name: F.when(low, F.col(x)).otherwise(F.col(y)).alias(name)
    return _met(members, others).select(pick("node", "o_node", "a"), pick("n", "o_n", "n_a"), pick("o_node", "node", "b"), pick("o_n", "n", "n_b")).distinct()


def _all_pairs(members: DataFrame) -> DataFrame:
    met = _met(members, members).where("node < o_node")
    return met.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("o_node").alias("b"), F.col("o_n").alias("n_b")).distinct()


def _star(members: DataFrame, turn: int, pivots: int) -> DataFrame:
    """Pairs of members and pivots: each member in PICKS of its buckets, the largest, or as the turn draws them.

    The pivots of a bucket are the least of each class of a hash that changes with the turn: at first
    those with the fewest n-grams of their own, which are in the middle of a group of near copies, then
    whichever the hash brings.
    """
    drawn = F.xxhash64("gram", F.lit(turn))
    order = F.struct("members", "gram", "at") if not turn else F.struct(drawn.alias("drawn"), "gram", "at")
    picked = members.groupBy("node", "n", "alone", "component", F.pmod(drawn, F.lit(PICKS)).alias("of")).agg(F.max(order).alias("pick"))
    picked = stage(picked.select("node", "n", "alone", "component", "pick.gram", "pick.at"), "picked")
    mixed = F.xxhash64("node", F.lit(turn))
    order = [mixed.alias("mixed")] if turn else ["alone", mixed.alias("mixed")]
    least = picked.groupBy("gram", F.pmod(mixed, F.lit(pivots)).alias("of")).agg(F.min(F.struct(*order, *_OTHER)).alias("pivot"))
    return _pairs(picked, least.select("gram", *[f"pivot.{c}" for c in _OTHER]))


def _undecided(members: DataFrame) -> tuple[int, int]:
    """How many members there are, and how many pairs of a bucket lie in different components."""
    sizes = members.groupBy("gram", "component").agg(F.count("*").cast("double").alias("k"))
    buckets = sizes.groupBy("gram").agg(F.sum("k").alias("n"), F.sum(F.col("k") * F.col("k")).alias("squares"))
    n, pairs = buckets.agg(F.sum("n"), F.sum((F.col("n") * F.col("n") - F.col("squares")) / 2)).first()
    return n or 0, pairs or 0


def links(parts: DataFrame, crowd: int = CROWD, pivots: int = PIVOTS, rounds: int = ROUNDS) -> DataFrame:
    """``node`` and ``component``: the components of all similar pairs, and no other.

    Small buckets are paired.  Of large ones every member meets a few pivots in each round, so the
    rows grow with the members; most of a large group of near copies is one component after that.
    Members that are not, whichever bucket they are in, meet all of it in the end: no pair that
    could join two components is left out.
    """
    members = prefixes(parts)
    large = members.where(F.col("members") > crowd)
    pairs = stage(_all_pairs(members.where(F.col("members") <= crowd)).unionByName(_star(large, 0, pivots)).distinct(), "pairs")
    tested = pairs.select("a", "b")
    labels = stage(components(linked(pairs, parts)), "components")
    for turn in range(1, rounds + 1):
        named = large.drop("component").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        mixed = named.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("gram")
        large = stage(named.join(mixed, "gram", "left_semi").select(*large.columns), "undecided")
        n, open_pairs = _undecided(large)
        if not open_pairs:
            break
        last = turn == rounds or open_pairs <= 4 * pivots * n
        fresh = stage((_all_pairs(large) if last else _star(large, turn, pivots)).join(tested, ["a", "b"], "left_anti"), "pairs")
        tested = tested.unionByName(fresh.select("a", "b"))
        joins = linked(fresh, parts).unionByName(labels.select(F.col("node").alias("a"), F.col("component").alias("b")))
        labels = stage(components(joins), "components")
        if last:
            break
    return labels


def classes(documents: DataFrame, key: str = "doc_id", text: str = "text", crowd: int = CROWD, pivots: int = PIVOTS, rounds: int = ROUNDS) -> DataFrame:
    """``key``, ``n_shingles`` and ``component_id`` of each row, the smallest key reachable by links, its own included.

    Two rows are linked when 100 times the size of the intersection of their sets is at least 80 times
    that of the union; rows with equal sets always are, and cost one set together.  A null, empty or
    blank text has no n-grams and no links.  Repeated rows are copies like any others; null keys are
    ignored unless a component has no other.  Only ``key`` and ``text`` are read, so other columns
    may have any name.  An empty table gives an empty result.
    """
    sets = measured(documents, key, text)
    nodes = hopeful(sets)
    labels = links(shared_parts(documents, text, nodes), crowd, pivots, rounds)
    own = stage(sets.where("same is not null").groupBy("same").agg(F.min("number").alias("node"), F.min("key").alias("own")), "nodes")
    named = own.join(labels, "node")
    least = named.groupBy("component").agg(F.min("own").alias("least"))
    joined = named.join(least, "component").select("same", "least")
    found = stage(own.select("same", "own").join(joined, "same", "left").select("same", F.coalesce("least", "own").alias("component_id")), "classes")
    out = sets.select("key", "n_shingles", "same").join(found, "same", "left")
    return out.select(F.col("key").alias(key), "n_shingles", F.when(F.col("same").isNull(), F.col("key")).otherwise(F.col("component_id")).alias("component_id"))
