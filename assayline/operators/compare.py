"""Comparing a warehouse with its sources."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.identity import canonical_number, tuple_hash
from ..session import COMPACT, materialise
from .reshape import counted_conflicts, to_wide, to_wide_counted


def nullsafe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on many nullable keys, null matching null, through one hash column.

    Keeps the keys of the left side.
    """
    a = left.withColumn("_key", tuple_hash(_aligned(left, right, c) for c in keys))
    b = right.withColumn("_key", tuple_hash(_aligned(right, left, c) for c in keys)).drop(*keys)
    return a.join(b, "_key", how).drop("_key")


def _aligned(mine: DataFrame, other: DataFrame, name: str) -> Column:
    """A key column in the form in which both sides spell equal values alike: numbers of two types as plain digits."""
    kinds = [df.schema[name].dataType for df in (mine, other)]
    if kinds[0] != kinds[1] and all(isinstance(k, NumericType) for k in kinds):
        return canonical_number(F.col(name))
    return F.col(name)


def column_set_diff(spark, left: Sequence[str], right: Sequence[str], left_name: str = "original", right_name: str = "warehouse") -> DataFrame:
    """Column names that only one side has.  Works on two schemas, not on rows."""
    rows = [(c, left_name) for c in left if c not in set(right)] + [(c, right_name) for c in right if c not in set(left)]
    return spark.createDataFrame(rows, "column string, only_in string")


def compare_values(left: DataFrame, right: DataFrame, ids: Sequence[str], name: str = "variable") -> DataFrame:
    """Cells that both sides have and that differ.  Both sides are long: ``ids, name, value``.

    Cells are compared as sets: equal copies of a cell on one side are one cell, so copies
    do not multiply with each other.
    """
    a = left.select(*ids, name, F.col("value").alias("value_x")).distinct()
    b = right.select(*ids, name, F.col("value").alias("value_y")).distinct()
    return nullsafe_join(a, b, [*ids, name]).filter(F.col("value_x") != F.col("value_y"))


def missing_cells(left: DataFrame, right: DataFrame, ids: Sequence[str], name: str = "variable") -> DataFrame:
    """Cells that only one side has, which an inner comparison cannot see."""
    keys = [*ids, name]
    hashed = [df.withColumn("_key", tuple_hash(F.col(c) for c in keys)) for df in (left, right)]
    only = []
    for mine, other, tag in ((hashed[0], hashed[1], "left"), (hashed[1], hashed[0], "right")):
        only.append(mine.join(other.select("_key").distinct(), "_key", "left_anti").select(*keys, "value", F.lit(tag).alias("only_in")))
    return only[0].unionByName(only[1])


def column_digests(df: DataFrame, file_col: str, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per file one digest for each column, whatever the order of rows: ``file_col``, ``rows`` and a struct per column.

    A digest counts the cells of a column and adds up two halves of a hash of the keys and the cell, so
    copies count.  One pass, combined before the shuffle.
    """
    def digest(c: str) -> Column:
        h = F.when(F.col(c).isNotNull(), F.xxhash64(*keys, c))
        low, high = h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32)
        return F.struct(F.count(c).alias("n"), F.sum(low).alias("low"), F.sum(high).alias("high")).alias(c)

    return df.groupBy(file_col).agg(F.count(F.lit(1)).alias("rows"), *[digest(c) for c in columns])


def differing_files(left: DataFrame, right: DataFrame, file_col: str, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Files whose digests differ, or that one side lacks, with the ``columns`` that differ.  Small: one row per file."""
    a = column_digests(left, file_col, keys, columns).select(F.col(file_col).alias("_file"), F.struct("rows", *columns).alias("a"))
    b = column_digests(right, file_col, keys, columns).select(F.col(file_col).alias("_other"), F.struct("rows", *columns).alias("b"))
    both = a.join(b, F.col("_file").eqNullSafe(F.col("_other")), "full")
    names = F.filter(F.array(*[F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), F.lit(c)) for c in columns]), lambda x: x.isNotNull())
    rows = ~F.col("a.rows").eqNullSafe(F.col("b.rows"))
    return both.select(F.coalesce("_file", "_other").alias(file_col), names.alias("columns"), rows.alias("other_rows")).where((F.size("columns") > 0) | F.col("other_rows"))


def differing_cells(left: DataFrame, right: DataFrame, ids: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Cells that differ between wide rows of the same ``ids``: ``variable``, ``value_x``, ``value_y``, null where a side has none.

    Rows meet whole, on one hash of their ids; only cells that differ become rows.  Equal rows on one
    side count once.  Each side is shuffled once, by that hash: equal rows meet there as well.
    """
    sides = []
    for df, other, name in ((left, right, "x"), (right, left, "y")):
        key = F.xxhash64(*[_aligned(df, other, c) for c in ids])
        rows = df.select(key.alias("_key"), *ids, *columns).repartition("_key").distinct()
        aligned = [_aligned(df, other, c).alias(f"{name}{i}") for i, c in enumerate(ids)]
        sides.append(rows.select(F.col("_key").alias(f"_key_{name}"), *aligned, F.struct(*ids).alias(f"ids_{name}"), F.struct(*[F.col(c).cast("string").alias(c) for c in columns]).alias(name)))
    same = F.col("_key_x") == F.col("_key_y")
    for i in range(len(ids)):
        same = same & F.col(f"x{i}").eqNullSafe(F.col(f"y{i}"))
    # Rows are dealt by the short hash, which the ids themselves confirm.
    met = sides[0].join(sides[1], same, "full")
    cells = F.array(*[
        F.when(~F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")), F.struct(F.lit(c).alias("variable"), F.col(f"x.{c}").alias("value_x"), F.col(f"y.{c}").alias("value_y"))) for c in columns
    ])
    odd = met.select(F.coalesce("ids_x", "ids_y").alias("ids"), F.explode(F.filter(cells, lambda x: x.isNotNull())).alias("cell"))
    return odd.select("ids.*", "cell.*")


def reconstruct_wide(
    core: DataFrame,
    sample_rest: DataFrame,
    measurement_rest: DataFrame,
    sample_columns: Sequence[str],
    measurement_columns: Sequence[str],
    sample: str = "sample_core_id",
    measurement: Sequence[str] = ("file_id", "measurement_nr"),
) -> DataFrame:
    """Rebuild wide rows from the core table and both attribute tables."""
    samples = to_wide(sample_rest, [sample], sample_columns)
    measurements = to_wide(measurement_rest, list(measurement), measurement_columns)
    return core.join(samples, sample, "left").join(measurements, list(measurement), "left")


class Rebuilt(NamedTuple):
    """Wide rows, and the attributes that are stored more than once, of which the least value was taken."""

    rows: DataFrame
    conflicts: DataFrame


def rebuild(
    core: DataFrame,
    sample_rest: DataFrame,
    measurement_rest: DataFrame,
    sample_columns: Sequence[str],
    measurement_columns: Sequence[str],
    sample: str = "sample_core_id",
    measurement: Sequence[str] = ("file_id", "measurement_nr"),
) -> Rebuilt:
    """``reconstruct_wide``, written once, and what it could not represent, from the same two aggregates."""
    samples = to_wide_counted(sample_rest, [sample], sample_columns)
    measurements = to_wide_counted(measurement_rest, list(measurement), measurement_columns)
    joined = materialise(core.join(samples, sample, "left").join(measurements, list(measurement), "left"), "rebuilt", COMPACT)
    counts = [f"n_{c}" for c in [*sample_columns, *measurement_columns]]
    # The sample's attributes stand on each of its measurements; its conflicts are listed once.
    own = joined.select(sample, *[f"n_{c}" for c in sample_columns]).distinct()
    as_text = lambda ids: F.concat_ws("|", *[F.col(c).cast("string") for c in ids]).alias("of")
    found = [
        counted_conflicts(own, [sample], sample_columns).select(as_text([sample]), "columnname", "n"),
        counted_conflicts(joined, list(measurement), measurement_columns).select(as_text(measurement), "columnname", "n"),
    ]
    return Rebuilt(joined.drop(*counts), found[0].unionByName(found[1]))
