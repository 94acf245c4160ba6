"""Collects the registered queries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
ORDERS: dict[str, tuple[str, ...]] = {}


def in_order(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Sort a report by column names, ``-`` for descending; nulls are the largest value."""
    return df.orderBy(*[F.col(c[1:]).desc_nulls_first() if c.startswith("-") else F.col(c).asc_nulls_last() for c in order])


def query(key: str, sql: str | None = None, order: Sequence[str] = ()):
    """Register a query under a key, with the SQL that must give the same rows, and the order of its rows."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(configure(spark), str(sf_dir).rstrip("/"))
            return in_order(df, order) if order else df

        ORDERS[key] = tuple(order)
        run.__name__, run.__doc__ = key, fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register
