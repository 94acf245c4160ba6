"""Counts of measurements, positive measurements and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOTAL, POSITIVE = "total_measurements", "positive_measurements"


def count_measurements(df: DataFrame, keys: Sequence[str | Column], positive: Column) -> DataFrame:
    """Total and positive rows per key; null keys are groups of their own."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(TOTAL), F.count_if(positive).alias(POSITIVE)
    )


def add_up(counts: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Add up counts to coarser keys; null keys stay."""
    return counts.groupBy(*keys).agg(F.sum(TOTAL).alias(TOTAL), F.sum(POSITIVE).alias(POSITIVE))


def regroup(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add up counts to coarser keys; rows with a null key are left out."""
    for k in keys:
        counts = counts.filter(F.col(k).isNotNull())
    return add_up(counts, keys)


def counts_per_sample(measurements: DataFrame, positive: Column, extra: Sequence[str] = ("filetype",)) -> DataFrame:
    """Counts per sample (and file type), the first step of every sample-level question.

    Counting before the join to samples combines a hot sample inside each task and sends
    one narrow row per sample through the shuffle instead of all of its measurements.
    """
    return count_measurements(measurements, ["sample_id", *extra], positive)


def grouping_grains(counts: DataFrame, always: Sequence[str], optional: Sequence[str]) -> DataFrame:
    """Counts by ``always`` alone and by ``always`` plus each one of ``optional``.

    All grains come from one pass.  ``counts`` should already be added up by all of these
    keys, so the copies that grouping sets make are copies of few rows.  ``grain`` names the
    extra key; columns that a grain does not use are null.
    """
    sets = [list(always)] + [[*always, o] for o in optional]
    cube = counts.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in [*always, *optional]]).agg(
        F.sum(TOTAL).alias(TOTAL),
        F.sum(POSITIVE).alias(POSITIVE),
        *[F.grouping(o).alias(f"_{o}") for o in optional],
    )
    grain = F.lit("all")
    for o in optional:
        grain = F.when(F.col(f"_{o}") == 0, F.lit(o)).otherwise(grain)
    return cube.withColumn("grain", grain).drop(*[f"_{o}" for o in optional])


def histogram(df: DataFrame, key: str, count_name: str) -> DataFrame:
    """How many keys have how many rows."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias(count_name))
    return per_key.groupBy(count_name).agg(F.count(F.lit(1)).alias("num_samples"))


def sample_flows(samples: DataFrame, positive_ids: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Samples, and samples with at least one positive measurement, per key.

    ``positive_ids`` holds each positive sample once; samples are read once for both counts.
    """
    marked = samples.join(positive_ids.select(F.col("sample_id").alias("_id")).withColumn("_hit", F.lit(True)), F.col("sample_id") == F.col("_id"), "left")
    return marked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("number_of_samples"),
        F.count("_hit").alias("pos_number_of_samples"),
    )
