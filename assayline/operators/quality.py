"""Data-quality reports.  Each returns the violations; an empty result means clean."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from ..functions.identity import tuple_hash


def _column_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value)`` of the named columns in one scan, as text, nulls left out."""
    cells = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return cells.unpivot([], list(columns), "column", "value").filter(F.col("value").isNotNull())


def _domain(dictionaries: dict[str, DataFrame], key: str) -> DataFrame:
    """``(column, value)`` of all allowed values."""
    allowed: DataFrame | None = None
    for column, dictionary in dictionaries.items():
        part = dictionary.select(F.lit(column).alias("column"), F.col(key).cast("string").alias("value"))
        allowed = part if allowed is None else allowed.union(part)
    return allowed.distinct()


def invalid_codes(df: DataFrame, dictionaries: dict[str, DataFrame], catalogue_names: dict[str, str]) -> DataFrame:
    """Distinct values outside the catalogue of their column.

    One scan and one shuffle for all columns; a column may be checked against the union of
    several catalogues by passing that union.
    """
    values = _column_values(df, list(dictionaries)).distinct()
    names = F.create_map(*[F.lit(x) for pair in catalogue_names.items() for x in pair])
    bad = values.join(_domain(dictionaries, "termcode"), ["column", "value"], "left_anti")
    return bad.select("value", "column", names[F.col("column")].alias("catalogue"))


def fk_violations(df: DataFrame, references: dict[str, DataFrame], key: str = "id") -> DataFrame:
    """Foreign keys that point nowhere, with the number of rows that hold them.

    Keys are counted and looked up column by column in their own type, and spelled as text only where they
    are reported: a task holds a few bytes per key, not the names of column and key as text.
    """
    found: DataFrame | None = None
    for column, reference in references.items():
        kinds = df.schema[column].dataType, reference.schema[key].dataType
        plain = kinds[0] == kinds[1] and isinstance(kinds[0], (IntegralType, StringType))
        value, known = (c if plain else c.cast("string") for c in (F.col(column), F.col(key)))
        counted = df.select(value.alias("value")).filter("value is not null").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
        lost = counted.join(reference.select(known.alias("value")), "value", "left_anti")
        part = lost.select(F.lit(column).alias("column"), F.col("value").cast("string").alias("value"), "n")
        found = part if found is None else found.unionByName(part)
    return found


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def not_null_violations(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows that lack a required value, with the names of the columns it is missing in."""
    lacking = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
    return df.withColumn("missing", lacking).filter(F.col("missing") != "")


def domain_violations(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Values outside a fixed list, with their number; null is not a violation."""
    return df.filter(~F.col(column).isin(*allowed)).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def orphans_by_file(rows: DataFrame, parents: DataFrame, key: str, file_col: str = "file") -> DataFrame:
    """Rows per file whose parent is missing."""
    lost = rows.join(parents.select(key).distinct(), key, "left_anti")
    return lost.groupBy(file_col).agg(F.count(F.lit(1)).alias("n"))


def unmatched_keys(df: DataFrame, lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """For rows without a partner in the lookup: the key values the lookup never has.

    Compares the rows that failed, before the join loses them.
    """
    hashed = df.select(*keys, tuple_hash(F.col(c) for c in keys).alias("_key"))
    partners = lookup.select(tuple_hash(F.col(c) for c in keys).alias("_key")).distinct()
    failed = hashed.join(partners, "_key", "left_anti")
    have = _column_values(lookup, keys).distinct()
    return _column_values(failed, keys).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")).join(
        have, ["column", "value"], "left_anti"
    )


def choose_files(files: DataFrame, n: int = 5, seed: int = 0, name: str = "filename") -> DataFrame:
    """A repeatable random choice of files to verify."""
    return files.orderBy(F.xxhash64(F.col(name), F.lit(seed)), name).limit(n)
