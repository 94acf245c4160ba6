"""Plan shapes that matter at scale."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from assayline.operators import grains, ranking
from assayline.plans import analytics as an
from assayline.registered import QUERIES
from assayline.registered.registry import ORDERS
from assayline.registered import standin as st
from assayline.sources import tables

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    keep = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in keep.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_star_needs_one_shuffle(spark, no_broadcast):
    """With both tables bucketed by sample, counting per sample and joining happen in place."""
    names = ("plan_samples", "plan_measurements")
    try:
        tables.write_bucketed(spark.range(200).select(F.col("id").alias("sample_id"), (F.col("id") % 3).alias("year")), names[0], "sample_id", 4)
        facts = spark.range(1000).select((F.col("id") % 200).alias("sample_id"), F.lit("vmpr").alias("filetype"), (F.col("id") % 7).alias("evalcode"))
        tables.write_bucketed(facts, names[1], "sample_id", 4)
        out = an.by_sample_attributes(spark.table(names[1]), spark.table(names[0]), ["filetype"], ["year"], F.col("evalcode") == 2)
        assert len(re.findall(r"\bExchange\b", physical(out))) == 1
        assert out.agg(F.sum(grains.TOTAL)).first()[0] == 1000
    finally:
        for n in names:
            spark.sql(f"DROP TABLE IF EXISTS {n}")


def test_top_n_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    plan = physical(ranking.top_per_group(df, "g", [F.col("v").desc()], 5))
    assert plan.count("WindowGroupLimit") == 2


def test_global_top_n_does_not_sort_everything(spark):
    flows = spark.createDataFrame([("a", "b", 2000, 5, 1)], "orig_country string, samp_country string, year int, number_of_samples bigint, pos_number_of_samples bigint")
    assert "TakeOrderedAndProject" in physical(an.trade_routes(flows, 0))


@needs_tables
@pytest.mark.parametrize("key", sorted(k for k, o in ORDERS.items() if o))
def test_reports_come_in_order(spark, key):
    got = QUERIES[key](spark, SF_DIR)
    names = [c.lstrip("-") for c in ORDERS[key]]
    cells = [tuple(r) for r in got.select(*names).collect()]
    for i in range(len(names) - 1, -1, -1):
        cells_sorted = sorted(cells if i == len(names) - 1 else cells_sorted, key=lambda r: (r[i] is None, r[i] if r[i] is not None else 0), reverse=ORDERS[key][i].startswith("-"))
    assert cells == cells_sorted and len(cells) > 0


def test_second_level_branches(spark):
    rows = [(f"{an.POPS.title()}::dioxins::x", 5, 1), (f"{an.ELEMENTS}::lead and derivatives", 4, 2), (f"{an.ELEMENTS}::lead and derivatives::y", 6, 0), (f"{an.ELEMENTS}::gold", 9, 9), (None, 1, 1)]
    totals = spark.createDataFrame(rows, f"full_name string, {grains.TOTAL} bigint, {grains.POSITIVE} bigint")
    assert [tuple(r) for r in an.pops_breakdown(totals).collect()] == [("Dioxins", 5, 1, 0.2)]
    assert [tuple(r) for r in an.metals_breakdown(totals).collect()] == [("Lead And Derivatives", 10, 2, 0.2)]


@needs_tables
@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_cross_join_and_no_python_in_any_plan(spark, no_broadcast, key):
    plan = physical(QUERIES[key](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in plan


@needs_tables
def test_a_question_about_one_type_filters_in_the_scan(spark):
    plan = physical(st.measurements_of(spark, SF_DIR, "vmpr").groupBy("param_id").count())
    assert "EqualTo(l_returnflag,R)" in plan and "l_extendedprice" not in plan
