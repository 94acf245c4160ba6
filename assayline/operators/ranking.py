"""Top-N and row shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top_per_group(df: DataFrame, group: str, order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group.

    Spark keeps only ``n`` rows per group and task before the shuffle (window group limit),
    so a group that holds most of the rows is no burden.
    """
    place = F.row_number().over(W.partitionBy(group).orderBy(*order))
    return df.withColumn(rank, place).filter(F.col(rank) <= n)


def last_years(df: DataFrame, year: str = "year", n: int = 5) -> DataFrame:
    """Rows of the ``n`` most recent years that occur (gaps do not count)."""
    recent = df.select(year).distinct().where(F.col(year).isNotNull()).orderBy(F.col(year).desc()).limit(n)
    return df.join(recent, year, "left_semi")


def without_years(df: DataFrame, years: Sequence[int], year: str = "year") -> DataFrame:
    """Drop outlier years; rows without a year stay."""
    return df.filter(~F.coalesce(F.col(year).isin(*years), F.lit(False)))


def row_shares(columns: Sequence[str]) -> dict[str, Column]:
    """Each column as a share of their sum in the row; null where the sum is 0."""
    total = sum((F.col(c) for c in columns), F.lit(0)).cast("double")
    return {c: F.col(c).cast("double") / F.nullif(total, F.lit(0.0)) for c in columns}
