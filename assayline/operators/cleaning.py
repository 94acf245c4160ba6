"""Cell cleaning, name harmonising and casting."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegralType, NullType, StringType

from ..functions.columns import clean_columns, rename_columns
from ..functions.numbers import zero_to_null
from ..functions.text import blank_to_null, clean_text, null_sentinels


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def _replace(df: DataFrame, names: Iterable[str], rule) -> DataFrame:
    """Apply one rule to the named columns in a single projection."""
    names = set(names)
    return df.select(*[rule(F.col(c)).alias(c) if c in names else F.col(c) for c in df.columns])


def clean_cells(df: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """Lower-case and strip every text column."""
    return _replace(df, set(string_columns(df)) - set(skip), clean_text)


def null_sentinel_cells(df: DataFrame, skip: Sequence[str] = (), reader_sentinels: bool = False) -> DataFrame:
    """Null for cells that spell a missing value."""
    return _replace(df, set(string_columns(df)) - set(skip), lambda c: null_sentinels(c, reader_sentinels))


def blank_cells_to_null(df: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """Null for empty texts, as a bulk load would store them."""
    return _replace(df, set(string_columns(df)) - set(skip), blank_to_null)


def filled_cells(df: DataFrame, skip: Sequence[str] = (), reader_sentinels: bool = False) -> DataFrame:
    """``clean_cells``, ``null_sentinel_cells`` and ``blank_cells_to_null``, the last two in one projection."""
    cleaned = clean_cells(df, skip)
    return _replace(cleaned, set(string_columns(df)) - set(skip), lambda c: null_sentinels(c, reader_sentinels, blank=True))


def zeros_to_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Null for zeros in the named columns; names that are not present are skipped."""
    return _replace(df, [c for c in columns if c in df.columns], zero_to_null)


def harmonise(df: DataFrame, renames: dict[str, str], known: Sequence[str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Clean column names, apply the renames and keep the columns that are known."""
    plumbing = [c for c in keep if c in df.columns]
    cells = clean_columns(df.drop(*plumbing), drop_tags=True)
    names = rename_columns(cells, renames).columns
    renamed = df.select(
        *[F.col(f"`{old}`").alias(new) for old, new in zip([c for c in df.columns if c not in plumbing], names)],
        *plumbing,
    )
    if known is None:
        return renamed
    return renamed.select(*[c for c in renamed.columns if c in set(known) | set(plumbing)])


def add_missing(df: DataFrame, columns: Iterable[str], datatype: str = "string") -> DataFrame:
    """Add the columns that are absent, as nulls."""
    missing = {c: F.lit(None).cast(datatype) for c in columns if c not in df.columns}
    return df.withColumns(missing) if missing else df


def cast_by_registry(df: DataFrame, datatypes: dict[str, str], skip: Sequence[str] = ()) -> DataFrame:
    """Cast to the registered kind: numbers to double unless already whole, the rest to text.

    A malformed number becomes null; ``malformed_numbers`` reports it.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def cast(name: str) -> Column:
        c = F.col(name)
        kind = datatypes.get(name, "")
        if name in skip:
            return c
        if "number" in kind:
            return c if isinstance(kinds[name], IntegralType) else c.try_cast("double").alias(name)
        if "text" in kind or "catalogue" in kind:
            return c.cast("string").alias(name)
        return c

    return df.select(*[cast(c) for c in df.columns])


def cast_with_losses(df: DataFrame, datatypes: dict[str, str], skip: Sequence[str] = (), out: str = "lost") -> DataFrame:
    """``cast_by_registry``, and in ``out`` the cells (``column``, ``value``) whose text is not the number it should be.

    Each text is cast once.  The list is null for a row without such cells and only made for the others.
    """
    numbers = [c for c in string_columns(df) if "number" in datatypes.get(c, "") and c not in skip]
    if not numbers:
        none = F.lit(None).cast("array<struct<column:string,value:string>>")
        return cast_by_registry(df, datatypes, skip).withColumn(out, none)
    cast = cast_by_registry(df.withColumns({f"_text_{c}": F.col(c) for c in numbers}), datatypes, [*skip, *[f"_text_{c}" for c in numbers]])
    bad = {c: F.col(f"_text_{c}").isNotNull() & F.col(c).isNull() for c in numbers}
    cells = F.array(*[F.when(b, F.struct(F.lit(c).alias("column"), F.col(f"_text_{c}").alias("value"))) for c, b in bad.items()])
    anywhere = reduce(lambda a, b: a | b, bad.values())
    return cast.select(*df.columns, F.when(anywhere, F.filter(cells, lambda x: x.isNotNull())).alias(out))


def malformed_numbers(df: DataFrame, datatypes: dict[str, str]) -> DataFrame:
    """Texts in number columns that are not numbers, with how often they occur."""
    numbers = [c for c in string_columns(df) if "number" in datatypes.get(c, "")]
    if not numbers:
        return df.sparkSession.createDataFrame([], "column string, value string, n bigint")
    cells = df.unpivot([], numbers, "column", "value")
    bad = cells.filter(F.col("value").isNotNull() & F.col("value").try_cast("double").isNull())
    return bad.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def drop_all_null_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop the columns without any value.  Costs one aggregate that returns a single row."""
    filled = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    return df.select(*[F.col(f"`{c}`") for c in df.columns if filled[c] > 0 or c in keep])


def best_effort_cast(df: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """Per column: double if every value parses as a number, else text.

    Decided for the whole column by one aggregate that returns a single row.
    """
    texts = [c for c in string_columns(df) if c not in skip]
    fails: dict[str, int] = {}
    if texts:
        unparsed = [
            F.count(F.when(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull(), 1)).alias(c) for c in texts
        ]
        fails = df.agg(*unparsed).first().asDict()

    def cast(field) -> Column:
        c = F.col(field.name)
        if field.name in skip:
            return c
        if isinstance(field.dataType, StringType):
            return c if fails[field.name] else c.cast("double").alias(field.name)
        return c if isinstance(field.dataType, (DoubleType, NullType)) else c.cast("double").alias(field.name)

    return df.select(*[cast(f) for f in df.schema.fields])
