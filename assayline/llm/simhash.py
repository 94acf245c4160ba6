"""Near-duplicates by SimHash, found with covering locality-sensitive hashing.

Bit i of a fingerprint gets a non-zero vector m(i) of RADIUS + 1 bits.  Table v, for each non-zero
vector v, looks at the bits with an odd product of m(i) and v.  The vectors of at most RADIUS
differing bits leave some v orthogonal to all of them, and its table does not look at any of these
bits: every pair within the radius meets in some table, whatever the data.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayline import session

from .components import components
from .frames import add_columns, bounded_batches, stage, text_or_empty, tidy
from .paragraphs import alike

WORDS, SEED, RADIUS = 4, 42, 4
#: Up to so many fingerprints of one bucket are compared in a task; larger buckets go by flips.
BUCKET = 8192


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """64-bit SimHash of each text: a bit is set if it is set in over half the shingles' hashes."""
    digest, hashes, counts = xxhash.xxh64_intdigest, [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        words = text.lower().split()
        joined = b" ".join(words)
        if len(words) <= WORDS:
            own = [digest(joined, SEED)] if words else []
        else:
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(sizes + 1) - 1
            own = [digest(joined[a:b], SEED) for a, b in zip((ends - sizes)[: 1 - WORDS].tolist(), ends[WORDS - 1 :].tolist())]
        counts[i] = len(own)
        hashes += own
    result = np.zeros(len(texts), np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums = np.add.reduceat(bits, (np.cumsum(counts) - counts)[some], axis=0, dtype=np.int64)
        result[some] = np.packbits(2 * sums > counts[some, None], axis=1, bitorder="little").view("<u8").ravel()
    return result


def with_fingerprint(df: DataFrame, text: str = "text", column: str = "fingerprint") -> DataFrame:
    """Add the SimHash (long, its bits as they are) of every whole text; no words, or null, give zero."""

    def task(columns):
        for (texts,) in columns:
            yield [pa.array(fingerprints(texts.cast(pa.binary()).to_pylist()).view(np.int64))]

    return add_columns(df, [text_or_empty(text)], task, f"`{column}` bigint")


def masks(radius: int = RADIUS) -> list[int]:
    """The bits that each table looks at."""
    size = 1 << (radius + 1)
    vector = [1 + i % (size - 1) for i in range(64)]
    return [sum(1 << i for i in range(64) if (vector[i] & v).bit_count() % 2) for v in range(1, size)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def forest(values: np.ndarray, radius: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """A spanning forest of the graph that links distinct values within the radius: one edge fewer than nodes."""
    left, ends_a, ends_b = values, [], []
    while len(left):
        waiting, left = [left[0]], left[1:]
        while waiting and len(left):
            x = waiting.pop()
            near = np.bitwise_count(left ^ x) <= radius
            if near.any():
                met = left[near]
                ends_a.append(np.full(len(met), x))
                ends_b.append(met)
                waiting += list(met)
                left = left[~near]
    return ends_a, ends_b


def _link_task(radius: int, bucket: int):
    """Rows (table, key, value) in order of bucket -> edges (a, b), or members (table, a) of buckets that are too large."""

    def run(batches):
        held = np.zeros(0, np.uint64)
        name, overflown = None, False

        def batch(a, b, tables):
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), b, tables], names=["a", "b", "tab"])

        def members(tab, values):
            return batch(values, pa.nulls(len(values), pa.int64()), pa.array(np.full(len(values), tab, np.int32)))

        def edges(ends):
            a, b = (np.concatenate(x) for x in ends)
            return batch(a, pa.array(b.view(np.int64)), pa.nulls(len(a), pa.int32()))

        for rows in batches:
            tab, key, value = (rows.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            value = value.view(np.uint64)
            if not len(tab):
                continue
            cut = np.flatnonzero((tab[1:] != tab[:-1]) | (key[1:] != key[:-1])) + 1
            begins, stops = np.append(0, cut), np.append(cut, len(tab))
            out_a, out_b = [], []
            # Only the first bucket may go on from the batch before, and the last into the next.
            for i in [0, *(np.flatnonzero(stops[1:-1] - begins[1:-1] > 1) + 1).tolist(), *([len(begins) - 1] if len(begins) > 1 else [])]:
                own, part = (int(tab[begins[i]]), int(key[begins[i]])), value[begins[i] : stops[i]]
                if own != name:
                    if name is not None and not overflown and len(held) > 1:
                        a, b = forest(held, radius)
                        out_a += a
                        out_b += b
                    name, held, overflown = own, part, False
                else:
                    held = np.concatenate([held, part])
                if overflown or len(held) > bucket:
                    yield members(name[0], held)
                    overflown, held = True, held[:0]
            if out_a:
                yield edges((out_a, out_b))
        if not overflown and len(held) > 1:
            a, b = forest(held, radius)
            if a:
                yield edges((a, b))

    return run


def _by_flips(members: DataFrame, radius: int) -> DataFrame:
    """Edges among the members (tab, a) of large buckets, without comparing them in pairs.

    Two members of a bucket differ only in bits that its table does not look at.  Each is sent to
    all values that it becomes by flipping at most half the radius of these bits.  Members within
    the radius meet at one of them, and all that meet are within the radius, so a chain is enough;
    no more members can meet than there are flips.
    """
    flips = []
    for t, mask in enumerate(masks(radius)):
        free = [1 << i for i in range(64) if not mask >> i & 1]
        layer = {0}
        every = set(layer)
        for _ in range(radius // 2):
            layer = {x | bit for x in layer for bit in free if not x & bit}
            every |= layer
        flips += [(t, _signed(x)) for x in sorted(every)]
    # Some 17,000 rows for a radius of four, whatever the input.
    table = F.broadcast(members.sparkSession.createDataFrame(flips, "tab int, flip bigint"))
    met = members.join(table, "tab").select("tab", F.col("a").bitwiseXOR(F.col("flip")).alias("at"), "a")
    first = met.withColumn("b", F.min("a").over(Window.partitionBy("tab", "at")))
    return first.where("a <> b").select("a", "b").distinct()


def links(values: DataFrame, column: str = "fingerprint", radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of ``column`` within ``radius`` bits.

    ``values`` holds each fingerprint once.  In each bucket of each table the fingerprints are
    compared in one task, which puts out a spanning forest, never all pairs; buckets above
    ``bucket`` fingerprints are linked exactly by flips.  The radius must be even for that.
    """
    if radius % 2:
        raise ValueError("the radius must be even")
    looks = [F.struct(F.lit(t).alias("tab"), F.col(column).bitwiseAND(F.lit(_signed(m))).alias("key")) for t, m in enumerate(masks(radius))]
    rows = values.select(F.col(column).alias("value"), F.explode(F.array(*looks)).alias("x")).select("x.tab", "x.key", "value")
    bounded_batches(values.sparkSession)
    placed = rows.repartition("tab", "key").sortWithinPartitions("tab", "key")
    found = stage(placed.mapInArrow(tidy(_link_task(radius, bucket)), "a bigint, b bigint, tab int"), "links")
    return found.where("tab is null").select("a", "b").unionByName(_by_flips(found.where("tab is not null").select("tab", "a"), radius))


def groups(fingerprinted: DataFrame, key: str = "doc_id", column: str = "fingerprint", radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """``column`` and ``component_id``, the smallest ``key`` of all rows reachable, once per fingerprint.

    Equal fingerprints are one node, found with a combined aggregate, so that a group of copies of
    any size is one row from there on.  A null fingerprint is in no group; null keys are ignored
    unless a group has no other.
    """
    nodes = stage(fingerprinted.where(F.col(column).isNotNull()).groupBy(column).agg(F.min(key).alias("own")), "fingerprints")
    labels = stage(components(links(nodes, column, radius, bucket)), "labels").withColumnRenamed("node", column)
    linked = nodes.join(labels, column)
    least = linked.groupBy("component").agg(F.min("own").alias("least"))
    named = labels.join(least, "component").select(column, "least")
    return nodes.join(named, column, "left").select(column, F.coalesce("least", "own").alias("component_id"))


def hexadecimal(column: Column) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def keep_one(documents: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, similar: bool = False) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest key, of equal ones the first written.

    With ``similar`` texts whose five-word shingles have a Jaccard similarity of 0.8 are linked too,
    however many bits of their fingerprints differ.
    Documents without words are one group like any other.  Rows are written once with a number of
    their own, so that rows that are equal in every column are told apart.
    """
    kept = documents.columns
    whole = documents.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    rows = stage(with_fingerprint(whole).drop("text").withColumn("number", F.monotonically_increasing_id()), "rows")
    spark = documents.sparkSession
    path = session.scratch(spark, "gone")
    # The rows to leave out are the shorter list, and only numbers travel to find them.  What is staged on
    # the way, fingerprints and shingles of all texts among it, is removed as soon as the list is written.
    with session.scratch_run(spark):
        nodes = rows.groupBy("fingerprint").agg(F.min(F.struct(F.col("key").isNull().alias("no_key"), "key", "number")).alias("own"))
        nodes = stage(nodes, "fingerprints")
        edges = links(nodes, "fingerprint", radius)
        if similar:
            edges = edges.unionByName(alike(rows.select("fingerprint", F.col("row")[text].alias("text")), "fingerprint", "text"))
        labels = stage(components(edges), "labels")
        least = nodes.join(labels, nodes.fingerprint == labels.node).groupBy("component").agg(F.min("own").alias("least"))
        winners = nodes.join(labels, nodes.fingerprint == labels.node, "left_anti").select("own.number").unionByName(least.select("least.number"))
        rows.select("number").join(stage(winners, "winners"), "number", "left_anti").write.parquet(path)
    gone = spark.read.schema("number bigint").parquet(path)
    return rows.join(gone, "number", "left_anti").select("row.*")
