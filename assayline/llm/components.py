"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import stage


def _with_smallest(edges: DataFrame) -> DataFrame:
    """``a``, ``b`` and the smallest node ``m`` among ``a`` and all its ``b``."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return edges.join(least, "a")


def components(edges: DataFrame) -> DataFrame:
    """Columns ``node`` and ``component``, the smallest node that it reaches, for every node of ``edges`` (``a``, ``b``: long).

    In turn, every node links its larger neighbours, then itself and its smaller ones, to its
    smallest neighbour; the paths between nodes shrink until each component is a star.  Smallest
    neighbours are found with a combined aggregate and joined back, so that a node with very many
    edges is neither gathered nor sorted.  Each round is a written table.  Edges of a node with
    itself, repeated edges and null ends are allowed; a null end counts as no edge.
    """
    forward = edges.where("a is not null and b is not null").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    loops = forward.where("a = b").select("a").distinct()
    stars = stage(forward.where("a <> b").distinct(), "edges")
    last = None
    while True:
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == last or not state[0]:
            break
        last = state
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_smallest(both).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        small = _with_smallest(large)
        linked = small.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        stars = stage(linked, "edges")
    centres = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    alone = loops.join(stars.select("a").unionByName(stars.select(F.col("b").alias("a"))).distinct(), "a", "left_anti")
    found = stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.unionByName(centres).unionByName(alone.select(F.col("a").alias("node"), F.col("a").alias("component")))
