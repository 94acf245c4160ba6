"""Row numbers without a single-task sort.

A window over the whole table, or over one large file, would sort all of its rows in one
task.  Here rows get their place inside a bounded piece (a partition of a range shuffle, or
a split of a file), and a small table of piece sizes says how many rows come before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import COMPACT, materialise

_POSITION_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def _number_pieces(staged: DataFrame, group: list[str], piece: str, position: str, out: str) -> DataFrame:
    """Number rows of ``group`` when each ``(group, piece)`` holds consecutive positions."""
    sizes = staged.groupBy(*group, piece).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(position).alias("_first")
    )
    earlier = W.partitionBy(*group).orderBy(piece).rowsBetween(W.unboundedPreceding, -1)
    before = sizes.select(
        *group, piece, (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift")
    )
    # Written out so that its true size is known when the join is planned.
    before = materialise(before, "row-offsets")
    same = F.lit(True)
    for c in [*group, piece]:
        same = same & staged[c].eqNullSafe(before[c])
    return staged.join(before, same).select(
        *[staged[c] for c in staged.columns if c not in (piece, position)],
        (staged[position] + before["_shift"]).alias(out),
    )


def number_rows(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], out: str, tasks: int | None = None) -> DataFrame:
    """1-based number of each row in its group, in the given order.

    The order should identify a row; rows that tie get their numbers in no fixed order.
    Ranges are cut on group *and* order, so a group of any size spreads over many tasks.
    ``tasks`` says how many; input bytes over some hundred megabytes is a good number for large
    inputs.  Without it ``spark.sql.shuffle.partitions`` counts, and AQE joins small ranges.
    """
    keys = [F.col(c) for c in group] + [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = (df.repartitionByRange(tasks, *keys) if tasks else df.repartitionByRange(*keys)).sortWithinPartitions(*keys)
    placed = ranged.withColumn("_position", F.monotonically_increasing_id())
    placed = placed.withColumn("_piece", F.shiftright("_position", _POSITION_BITS))
    staged = materialise(placed, "numbered", COMPACT)
    return _number_pieces(staged, list(group), "_piece", "_position", out)


def number_file_rows(staged: DataFrame, out: str = "measurement_nr", file_col: str = "file_path") -> DataFrame:
    """1-based row number in each file, in file order, for rows staged by ``sources.releases``.

    A split of a file is read by one task in order, so its positions are consecutive; the
    splits of a file follow each other by ``block``.
    """
    return _number_pieces(staged, [file_col], "block", "position", out)
