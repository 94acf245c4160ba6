"""Wide to long and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_long(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str = "variable", value: str = "value") -> DataFrame:
    """One row per non-null cell; every value becomes text.  Without columns there are no rows."""
    if not columns:
        return df.select(*ids, F.lit("").alias(name), F.lit("").alias(value)).where("false")
    cells = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in columns])
    return cells.unpivot(list(ids), list(columns), name, value).filter(F.col(value).isNotNull())


def to_wide(long: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str = "columnname", value: str = "value") -> DataFrame:
    """One column per attribute.  The list of attributes is given, which saves a job to find it.

    Of a cell that is given more than once the least value is taken; ``conflicting_cells``
    lists such cells.
    """
    return long.groupBy(*ids).pivot(name, list(columns)).agg(F.min(value))


def conflicting_cells(long: DataFrame, ids: Sequence[str], name: str = "columnname") -> DataFrame:
    """Cells given more than once, which ``to_wide`` could not represent."""
    return long.groupBy(*ids, name).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def to_wide_counted(long: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str = "columnname", value: str = "value") -> DataFrame:
    """``to_wide`` with ``n_<column>``, how often each cell was given, from the same aggregate."""
    cell = {c: F.when(F.col(name) == c, F.col(value)) for c in columns}
    return long.groupBy(*ids).agg(*[F.min(x).alias(c) for c, x in cell.items()], *[F.count(x).alias(f"n_{c}") for c, x in cell.items()])


def counted_conflicts(counted: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str = "columnname") -> DataFrame:
    """Cells that ``to_wide_counted`` was given more than once, as ``conflicting_cells`` lists them."""
    cells = F.array(*[F.when(F.col(f"n_{c}") > 1, F.struct(F.lit(c).alias(name), F.col(f"n_{c}").alias("n"))) for c in columns])
    return counted.select(*ids, F.explode(F.filter(cells, lambda x: x.isNotNull())).alias("cell")).select(*ids, f"cell.{name}", "cell.n")


def sums_by_label(label: str, labels: Sequence[str], measure: Column) -> list[Column]:
    """One sum per fixed label, 0 where a label is missing; other labels are ignored."""
    return [F.coalesce(F.sum(F.when(F.col(label) == x, measure)), F.lit(0)).alias(x) for x in labels]


def level(path_col: str, number: int, sep: str = "::") -> Column:
    """One level of a path, counted from 1, at whatever depth; null beyond the end of the path."""
    return F.get(F.split(F.col(path_col), sep), F.lit(number - 1))
