"""A Merkle tree over a dataset, stored as blocks in van Emde Boas order.

Each row is a leaf; the leaves of a source, by key, are the bottom of its tree, every FAN neighbours
become one node, and the roots of the sources are the bottom of the tree over them.  A tree is cut into
aligned subtrees, blocks of FAN^HEIGHT leaves.  The roots of one layer of blocks are the leaves of the
next, until one block is left.  A block is one row: its nodes in one binary column, the upper half of
its levels first, then each subtree below, all of them cut at half height again.  So a node and its
siblings are found by arithmetic on level and place alone, and stay close whatever a page holds.
"""

from __future__ import annotations

from functools import lru_cache, reduce
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayline.operators.numbering import number_rows

from .frames import bounded_batches, stage

FAN, HEIGHT, DIGEST = 16, 3, 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def size(levels: int) -> int:
    """Nodes of a full tree of so many levels."""
    return (FAN**levels - 1) // (FAN - 1)


def address(levels: int, depth: int, at):
    """Place in the layout of the ``at``-th node (a number or an array) of a depth, the root's being zero."""
    if levels == 1:
        return at * 0
    top = levels // 2
    if depth < top:
        return address(top, depth, at)
    below = FAN ** (depth - top)
    return size(top) + at // below * size(levels - top) + address(levels - top, depth - top, at % below)


@lru_cache(maxsize=32)
def addresses(levels: int, depth: int) -> np.ndarray:
    return address(levels, depth, np.arange(FAN**depth))


def joined(nodes: list[bytes]) -> bytes:
    """The digest over nodes, which are hashed as hexadecimal text."""
    return sha256("".join([n.hex() for n in nodes]).encode()).digest()


def levels_of(members: int, height: int = HEIGHT) -> int:
    """Levels of a block that is a whole tree of so many leaves: just enough, those of a full block at most."""
    levels = 1
    while FAN ** (levels - 1) < members and levels <= height:
        levels += 1
    return levels


def built(leaves: list[bytes], levels: int) -> bytes:
    """The nodes of a block above (and with) its leaves; places that a partly filled block lacks are zero."""
    held = np.zeros((size(levels), DIGEST), np.uint8)
    row = leaves
    for depth in range(levels - 1, -1, -1):
        held[addresses(levels, depth)[: len(row)]] = np.frombuffer(b"".join(row), np.uint8).reshape(-1, DIGEST)
        row = [joined(row[i : i + FAN]) for i in range(0, len(row), FAN)]
    return held.tobytes()


class Block:
    """Reads the nodes of a block from their layout."""

    def __init__(self, nodes: bytes, levels: int, members: int):
        self.nodes, self.levels, self.members = nodes, levels, members

    def node(self, depth: int, at: int) -> bytes:
        place = DIGEST * int(addresses(self.levels, depth)[at])
        return self.nodes[place : place + DIGEST]

    def run(self, depth: int, at: int) -> list[bytes]:
        """A node and its siblings, left to right."""
        first = at - at % FAN
        there = -(-self.members // FAN ** (self.levels - 1 - depth))
        return [self.node(depth, i) for i in range(first, min(first + FAN, there))]

    def path(self, at: int) -> list[tuple[int, list[bytes]]]:
        """From the ``at``-th leaf up: its place in each run, and the run."""
        steps = []
        for depth in range(self.levels - 1, 0, -1):
            steps.append((at % FAN, self.run(depth, at)))
            at //= FAN
        return steps


def folded(digest: bytes, path: list[tuple[int, list[bytes]]]) -> bytes:
    """The root that a leaf leads to with the siblings of its path."""
    for at, run in path:
        digest = joined([*run[:at], digest, *run[at + 1 :]])
    return digest


class Tree(NamedTuple):
    """Layers of blocks from the leaves up, and the root of each tree (``tree``, ``root``)."""

    layers: list[DataFrame]
    roots: DataFrame


_BLOCK = "tree string, block bigint, levels int, count int, nodes binary, root binary, keys array<bigint>, changed array<binary>"


def _build_task(height: int):
    def build(key, rows):
        order = rows.sort_by("place")
        leaves = order.column("leaf").to_pylist()
        block = key[1].as_py()
        # Only the first block of a tree can be its only one, and then needs no more levels than it has leaves for.
        levels = height + 1 if block else levels_of(len(leaves), height)
        nodes = built(leaves, levels)
        return pa.table({
            "tree": pa.array([key[0].as_py()], pa.string()), "block": pa.array([block], pa.int64()), "levels": pa.array([levels], pa.int32()), "count": pa.array([len(leaves)], pa.int32()),
            "nodes": pa.array([nodes], pa.binary()), "root": pa.array([nodes[:DIGEST]], pa.binary()),
            "keys": pa.array([order.column("key").to_pylist()], pa.list_(pa.int64())), "changed": pa.array([order.column("changed").to_pylist()], pa.list_(pa.binary())),
        })

    return build


def grown(leaves: DataFrame, height: int = HEIGHT) -> Tree:
    """The trees over leaves (``tree``, ``at`` from zero, ``leaf``, ``key``, ``changed``), layer by layer.

    A block is built in one task from at most FAN^height leaves, whatever the size of its tree.
    """
    full = FAN**height
    layers, tops = [], []
    layer = leaves
    while True:
        of = layer.select("tree", F.expr(f"at div {full}").alias("block"), (F.col("at") % full).alias("place"), "leaf", "key", "changed")
        blocks = stage(of.groupBy("tree", "block").applyInArrow(_build_task(height), _BLOCK), "blocks")
        layers.append(blocks)
        several = stage(blocks.groupBy("tree").agg(F.count("*").alias("n")).where("n > 1").select("tree"), "higher-trees")
        tops.append(blocks.join(several, "tree", "left_anti").select("tree", "root"))
        if not several.limit(1).count():
            return Tree(layers, reduce(DataFrame.unionByName, tops))
        none = F.lit(None)
        layer = blocks.join(several, "tree", "left_semi").select("tree", F.col("block").alias("at"), F.col("root").alias("leaf"), none.cast("long").alias("key"), none.cast("binary").alias("changed"))


_STEPS = "array<struct<at: int, run: array<binary>>>"


def _path_task(batches):
    """Blocks with the path above them -> the path of each of their leaves."""
    kind = pa.list_(pa.struct([("at", pa.int32()), ("run", pa.list_(pa.binary()))]))
    for batch in batches:
        for tree, block, levels, count, nodes, above, width in zip(*(c.to_pylist() for c in batch.columns)):
            held = Block(nodes, levels, count)
            paths = [[{"at": at, "run": run} for at, run in held.path(i)] + (above or []) for i in range(count)]
            yield pa.RecordBatch.from_arrays([pa.array([tree] * count, pa.string()), pa.array([block * width + i for i in range(count)], pa.int64()), pa.array(paths, kind)], names=["tree", "at", "path"])


def paths_above(tree: Tree, height: int = HEIGHT, bottom: int = 1) -> DataFrame:
    """``tree``, ``at`` and ``path`` of the members of layer ``bottom``: all runs up to the root.

    With ``bottom`` one these are the blocks of the leaves, one row each, and not the leaves.
    """
    found = None
    for blocks in reversed(tree.layers[bottom:]):
        rows = blocks.select("tree", "block", "levels", "count", "nodes")
        rows = rows.withColumn("above", F.lit(None).cast(_STEPS)) if found is None else rows.join(found.select("tree", F.col("at").alias("block"), F.col("path").alias("above")), ["tree", "block"], "left")
        found = stage(rows.withColumn("width", F.lit(FAN**height).cast("long")).mapInArrow(_path_task, f"tree string, at bigint, path {_STEPS}"), "paths")
    if found is None:
        return tree.roots.select("tree", F.lit(0).cast("long").alias("at"), F.array().cast(_STEPS).alias("path")).where("false")
    return found


def _field(name: str, value: Column | None = None) -> Column:
    text = (F.col(f"`{name}`") if value is None else value).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaves_of(documents: DataFrame, key: str = "doc_id", group: str = "source", fields: tuple[str, ...] = FIELDS, text: str = "text", every: int = 5) -> DataFrame:
    """``tree``, ``at``, ``key``, ``leaf`` and ``changed`` (the leaf of the tampered row, or null) of each row.

    Places in a tree go by key, nulls first, then by leaf, so that repeated keys have an order that
    does not depend on how rows arrive.  Only digests are shuffled, and ranges are cut inside a group
    as well, so that a group of any size spreads over tasks.
    """
    leaf = F.sha2(F.concat(*[_field(f) for f in fields]).cast("binary"), 256)
    lowered = F.translate(F.col(f"`{text}`"), UPPER, LOWER)
    changed = F.sha2(F.concat(*[_field(f, lowered if f == text else None) for f in fields]).cast("binary"), 256)
    chosen = F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % every == 0
    tree = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit(""))
    rows = documents.select(tree.alias("tree"), F.col(f"`{key}`").cast("long").alias("key"), F.unhex(leaf).alias("leaf"), F.when(chosen, F.unhex(changed)).alias("changed"))
    return number_rows(rows, ["tree"], ["key", "leaf"], "nr").select("tree", (F.col("nr") - 1).alias("at"), "key", "leaf", "changed")


class Manifest(NamedTuple):
    """Trees of the groups, and the tree over their roots, whose only tree is named ``''``."""

    groups: Tree
    top: Tree


def manifest(documents: DataFrame, key: str = "doc_id", group: str = "source", fields: tuple[str, ...] = FIELDS, text: str = "text", height: int = HEIGHT) -> Manifest:
    """Build and store the trees of all groups and the one over them.

    Null fields count as ``-``; a null group is a tree of its own and comes first.  Repeated rows
    are leaves of their own.  Columns that are no fields may have any name.  Without rows there is
    no tree and no root.
    """
    groups = grown(leaves_of(documents, key, group, fields, text), height)
    roots = number_rows(groups.roots.withColumn("all", F.lit("")), ["all"], ["tree"], "nr")
    over = roots.select(F.col("all").alias("tree"), (F.col("nr") - 1).alias("at"), F.col("root").alias("leaf"), F.lit(None).cast("long").alias("key"), F.lit(None).cast("binary").alias("changed"))
    top = grown(over, height)
    named = stage(roots.select("tree", "root", (F.col("nr") - 1).alias("at")), "roots")
    return Manifest(Tree(groups.layers, named), top)


_PROVED = pa.schema([("key", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("verified", pa.bool_())])


def _prove_task(batches):
    """Blocks of leaves with the paths above them -> proof and check of each leaf."""
    for batch in batches:
        for levels, count, nodes, keys, changed, subroot, root, above, over in zip(*(c.to_pylist() for c in batch.columns)):
            held = Block(nodes, levels, count)
            upper = [(s["at"], s["run"]) for s in [*(above or []), *(over or [])]]
            out = []
            for i, (key, tampered) in enumerate(zip(keys, changed)):
                leaf = held.node(levels - 1, i)
                path = held.path(i) + upper
                proof = sha256("".join([n.hex() for at, run in path for j, n in enumerate(run) if j != at]).encode()).hexdigest()
                end = folded(leaf if tampered is None else tampered, path)
                out.append((key, leaf.hex(), subroot.hex(), root.hex(), proof, end.hex(), end == root))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _PROVED)], schema=_PROVED)


def proofs(made: Manifest, height: int = HEIGHT) -> DataFrame:
    """``key``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` and ``verified`` of each row.

    Paths above a block travel once per block; its rows are proved where the block is read.  A row is
    folded up from its tampered leaf, if it has one, with the siblings that are stored.
    """
    blocks = made.groups.layers[0]
    bounded_batches(blocks.sparkSession)
    above = paths_above(made.groups, height).select("tree", F.col("at").alias("block"), F.col("path").alias("above"))
    over = paths_above(made.top, height, 0).join(made.top.roots.withColumnRenamed("root", "whole"), "tree").select("at", F.col("path").alias("over"), "whole")
    sources = stage(made.groups.roots.join(over, "at").select("tree", F.col("root").alias("subroot"), "whole", "over"), "sources")
    rows = blocks.select("tree", "block", "levels", "count", "nodes", "keys", "changed").join(above, ["tree", "block"], "left").join(sources, "tree")
    given = rows.select("levels", "count", "nodes", "keys", "changed", "subroot", "whole", "above", "over")
    return given.mapInArrow(_prove_task, "key bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
