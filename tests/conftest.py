from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from assayline import session

    spark = session.build(
        "assayline-tests", "local[*]", 8,
        **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))},
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate an expression over single values: ``one(fn, value)``."""
    from pyspark.sql import functions as F

    def evaluate(fn, *values, kind="string"):
        schema = ", ".join(f"c{i} {kind}" for i in range(len(values)))
        row = spark.createDataFrame([tuple(values)], schema).select(fn(*[F.col(f"c{i}") for i in range(len(values))]).alias("x")).first()
        return row.x

    return evaluate


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
