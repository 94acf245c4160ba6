from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from assayline.operators import cleaning, compare, dedup, dims, grains, inserts, numbering, product_rules, quality, ranking, reshape
from assayline.session import settings


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


# --- cleaning -------------------------------------------------------------------------


def test_harmonise_renames_and_selects(spark):
    df = frame(spark, "`LabSampCode_A` string, `Other Col` string, file string", ("s", "x", "F.ZIP"))
    out = cleaning.harmonise(df, {"labsampcode": "sampid"}, ["sampid"], keep=["file"])
    assert out.columns == ["sampid", "file"] and rows(out) == [("s", "F.ZIP")]


def test_malformed_number_is_null_and_reported(spark):
    df = frame(spark, "n string, t string", ("1.5", "a"), ("x", "b"), (None, "c"))
    assert rows(cleaning.cast_by_registry(df, {"n": "number", "t": "text"})) == [(1.5, "a"), (None, "b"), (None, "c")]
    assert rows(cleaning.malformed_numbers(df, {"n": "number", "t": "text"})) == [("n", "x", 1)]


def test_drop_all_null_columns_keeps_named(spark):
    df = frame(spark, "a int, b int, c int", (1, None, None))
    assert cleaning.drop_all_null_columns(df, keep=["c"]).columns == ["a", "c"]


def test_best_effort_cast(spark):
    out = cleaning.best_effort_cast(frame(spark, "a string, b string", ("1", "1"), ("2.5", "x"), (None, None)))
    assert dict(out.dtypes) == {"a": "double", "b": "string"}


# --- numbering and duplicates ---------------------------------------------------------


def test_number_rows_matches_a_plain_count(spark):
    rng = random.Random(11)
    data = [(rng.choice(["hot"] * 6 + ["a", "b", None]), i) for i in rng.sample(range(5000), 2000)]
    out = numbering.number_rows(frame(spark, "g string, v int", *data), ["g"], ["v"], "nr")
    want = {}
    for g in {d[0] for d in data}:
        for nr, v in enumerate(sorted(v for h, v in data if h == g), 1):
            want[(g, v)] = nr
    assert {(r.g, r.v): r.nr for r in out.collect()} == want


def test_number_rows_without_group(spark):
    out = numbering.number_rows(frame(spark, "k string", ("b",), ("a",), ("c",)), [], ["k"], "id")
    assert rows(out) == [("a", 1), ("b", 2), ("c", 3)]


def test_flag_repeats_keeps_first_and_matches_nulls(spark):
    df = frame(spark, "k string, n int", ("a", 2), ("a", 1), ("a", 3), (None, 4), (None, 5), ("b", 6))
    flagged = dedup.flag_repeats(df, ["k"], ["n"]).filter("is_repeat")
    assert rows(flagged, "n") == [(2,), (3,), (5,)]
    assert rows(dedup.first_per_key(df, ["k"], ["n"]), "n") == [(1,), (4,), (6,)]


def test_one_repeated_key_disqualifies_its_file(spark):
    df = frame(spark, "id string, other string, file string", ("1", "x", "f"), ("1", "y", "f"), ("2", "x", "f"), ("1", "x", "g"))
    good, bad = dedup.split_bad_files(df, ["id"])
    assert rows(good) == [("1", "x", "g")] and rows(bad) == [("f",)]


def test_repair_only_touches_ids_with_copies_in_that_file(spark):
    df = frame(spark, "id string, unit string, file string", ("1", None, "f"), ("1", "k", "f"), ("2", "k", "f"), ("1", "k", "g"), ("1", "m", "g"))
    out = dedup.repair_duplicates(df, ["id"], "id", "unit", F.lit("g050a"), F.col("file") == "f")
    assert rows(out) == [("1", "g050a", "f"), ("1", "g050a", "f"), ("1", "k", "g"), ("1", "m", "g"), ("2", "k", "f")]


# --- reshape --------------------------------------------------------------------------


def test_long_and_back_is_identity_on_filled_cells(spark):
    rng = random.Random(2)
    data = [(i, *(rng.choice([None, "x", "y"]) for _ in range(3))) for i in range(200)]
    df = frame(spark, "id int, a string, b string, c string", *data)
    long = reshape.to_long(df, ["id"], ["a", "b", "c"], "columnname")
    assert long.count() == sum(v is not None for d in data for v in d[1:])
    back = {r.id: (r.a, r.b, r.c) for r in reshape.to_wide(long, ["id"], ["a", "b", "c"]).collect()}
    assert all(back.get(d[0], (None,) * 3) == d[1:] for d in data)


def test_conflicting_cells(spark):
    long = frame(spark, "id int, columnname string, value string", (1, "a", "x"), (1, "a", "y"), (2, "a", "x"))
    assert rows(reshape.conflicting_cells(long, ["id"])) == [(1, "a", 2)]


# --- dictionaries ---------------------------------------------------------------------


def test_encode_unknown_and_null_codes(spark):
    dictionary = frame(spark, "id int, termcode string", (1, "a"), (2, "b"))
    out = dims.encode(frame(spark, "c string", ("a",), ("z",), (None,)), [("c", dictionary, "c_id")])
    assert rows(out) == [("a", 1), ("z", None), (None, None)]


def test_resolve_product_prefers_first_dictionary(spark):
    mtx = frame(spark, "id int, termcode string", (1, "both"), (2, "m"))
    matrix = frame(spark, "id int, termcode string", (7, "both"), (8, "x"))
    products = frame(spark, "id int, mtx_id int, matrix_id int", (10, 1, None), (11, 2, None), (12, None, 7), (13, None, 8))
    out = dims.resolve_product(frame(spark, "code string", ("both",), ("m",), ("x",), ("none",)), "code", mtx, matrix, products)
    assert rows(out) == [("both", 10), ("m", 11), ("none", None), ("x", 13)]


def test_replace_keeps_unknown_values(spark):
    dictionary = frame(spark, "id int, termcode string", (1, "a"))
    assert rows(dims.replace_by_dictionary(frame(spark, "v string", ("a",), ("q",), (None,)), "v", dictionary)) == [("1",), ("q",), (None,)]


def test_hierarchy_paths(spark):
    terms = frame(spark, "code string, name string, o int", ("1", "a", 1), ("1.2", "b", 2), ("1.2.9", "c", 3), ("5.6", "lost", 4), (None, "n", 5), ("1.2", "b again", 6))
    out = dims.hierarchy_paths(terms, "code", "name", order="o")
    assert rows(out) == [("1", "a"), ("1.2", "a::b again"), ("1.2.9", "a::b again::c"), ("5.6", None)]


def test_rules_take_the_first_match(spark):
    listed = frame(spark, "i int, item string, category string", (2, "beans", "pulses"), (1, " Green ", "vegetables "), (3, "green", "late"))
    rules = dims.ordered_rules(listed, "item", "category", "i")
    # A repeated item keeps its place and takes the last category.
    assert rows(rules.orderBy("ordinal"), "item", "category", "ordinal") == [("beans", "pulses", 2), ("green", "late", 1)]
    labels = frame(spark, "l string", ("GREEN beans",), ("soy beans",), ("milk",), (None,))
    assert rows(dims.first_matching_category(labels, "l", rules, "c")) == [
        ("GREEN beans", "late"), ("milk", "milk"), ("soy beans", "pulses"), (None, None)]


def test_any_number_of_rules(spark):
    listed = spark.range(12_000).select(F.col("id").alias("i"), F.concat(F.lit("item-"), F.col("id"), F.lit("-")).alias("item"), F.concat(F.lit("c"), F.col("id")).alias("category"))
    rules = dims.ordered_rules(listed, "item", "category", "i")
    labels = frame(spark, "l string", ("an ITEM-11999- of it",), ("item-5- and item-4-",), ("none",), ("",))
    assert rows(dims.first_matching_category(labels, "l", rules, "c")) == [("", ""), ("an ITEM-11999- of it", "c11999"), ("item-5- and item-4-", "c4"), ("none", "none")]


def test_a_path_keeps_all_its_levels(spark):
    df = frame(spark, "p string", ("a::b::c::d::e::f",), ("a",), (None,))
    assert rows(df.select(reshape.level("p", 6), reshape.level("p", 1))) == [("f", "a"), (None, "a"), (None, None)]


def test_keys_of_two_number_types_meet(spark):
    left, right = frame(spark, "k int, a string", (1, "x"), (None, "y")), frame(spark, "k double, b string", (1.0, "u"), (None, "v"))
    assert rows(compare.nullsafe_join(left, right, ["k"]), "a", "b") == [("x", "u"), ("y", "v")]


# --- insert rules ---------------------------------------------------------------------


def test_new_rows_null_key_is_new(spark):
    batch = frame(spark, "k string", ("a",), ("b",), (None,))
    assert rows(inserts.new_rows(batch, frame(spark, "k string", ("a",), (None,)), ["k"])) == [("b",), (None,)]


def test_new_files_fold_case(spark):
    staged = frame(spark, "filename string, filetype string, year int, country_code string, nr_cols int", ("A.ZIP", "VMPR", 2017, "PT", 3), ("B.ZIP", "VMPR", 2017, "PT", 3))
    assert rows(inserts.new_files(staged, frame(spark, "filename string", ("a.zip",)))) == [("b.zip", "vmpr", 2017, "pt", 3)]


def test_measurement_rules(spark):
    params = frame(spark, "id int, termcode string", (1, "p1"), (9, inserts.UNLISTED_PARAM))
    unlisted = "param=" + inserts.UNLISTED_PARAM
    batch = frame(
        spark, "sample_core_id int, paramcodebaseparam string, resid string",
        (1, "param=p1", "r1"), (1, "p1", "r2"), (2, "p1", "r1"), (1, unlisted, "r9"), (3, unlisted, "r9"), (3, unlisted, "r9"),
        (2, "gone", "r1"), (1, "p1", None))
    target = frame(spark, "sample_core_id int, param_id int, resid string", (1, 1, "r1"))
    new = inserts.new_measurements(batch, params, target)
    assert rows(new, "sample_core_id", "param_id", "resid") == [(1, 1, "r2"), (1, 1, None), (2, 1, "r1"), (3, 9, "r9"), (3, 9, "r9")]
    assert rows(inserts.unknown_params(batch, params), "paramcodebaseparam") == [("gone",)]


def test_sample_with_an_attribute_is_closed(spark):
    staged = frame(spark, "samplehash string, variable string, value string", ("h1", "x", "1"), ("h1", "y", "2"), ("h2", "x", "3"), ("h3", "x", "4"), ("h2", "z", "5"))
    samples = frame(spark, "id int, samplehash string", (1, "h1"), (2, "h2"))
    attributes = {"x": 10, "y": 11}
    existing = frame(spark, "sample_core_id int", (1,))
    assert rows(inserts.new_sample_attributes(staged, samples, attributes, existing)) == [(2, 10, "3")]


# --- quality and comparison -----------------------------------------------------------


def test_invalid_codes(spark):
    df = frame(spark, "a string, b string", ("x", "1"), ("y", None), ("x", "2"))
    out = quality.invalid_codes(df, {"a": frame(spark, "termcode string", ("x",)), "b": frame(spark, "termcode string", ("1",))}, {"a": "A", "b": "B"})
    assert rows(out) == [("2", "b", "B"), ("y", "a", "A")]


def test_foreign_keys_are_counted_in_their_own_type(spark):
    df = spark.createDataFrame([(1, "a", 1), (9, "b", 2), (9, None, 2), (None, "a", 7)], "n long, s string, d int")
    known = spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "n long, s string")
    references = {"n": known.select(F.col("n").alias("id")), "s": known.select(F.col("s").alias("id")), "d": known.select(F.col("n").alias("id"))}
    found = quality.fk_violations(df, references)
    assert rows(found) == [("d", "2", 2), ("d", "7", 1), ("n", "9", 2), ("s", "b", 1)]
    # No row carries the name of its column through a shuffle.
    assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()


def test_domain_and_not_null(spark):
    df = frame(spark, "a string, b string", ("x", None), ("q", "1"), (None, "1"))
    assert rows(quality.domain_violations(df, "a", ["x"])) == [("q", 1)]
    assert rows(quality.not_null_violations(df, ["a", "b"]), "missing") == [("a",), ("b",)]


def test_unmatched_keys_names_the_odd_values(spark):
    df = frame(spark, "a string, b string", ("1", "x"), ("2", "x"), (None, "x"))
    lookup = frame(spark, "a string, b string", ("1", "x"), (None, "x"))
    assert rows(quality.unmatched_keys(df, lookup, ["a", "b"])) == [("a", "2", 1)]


def test_choose_files_is_repeatable(spark):
    files = frame(spark, "filename string", *[(f"f{i}",) for i in range(30)])
    assert rows(quality.choose_files(files, 5, 1)) == rows(quality.choose_files(files.repartition(3), 5, 1))


def test_nullsafe_join_on_many_keys(spark):
    keys = [f"k{i}" for i in range(15)]
    schema = ", ".join(f"{k} string" for k in keys)
    data = [tuple(None if (i + j) % 4 == 0 else str(i) for j in range(15)) for i in range(20)]
    left = frame(spark, schema, *data).withColumn("l", F.lit(1))
    right = frame(spark, schema, *data).withColumn("r", F.lit(2))
    assert compare.nullsafe_join(left, right, keys).count() == 20


def test_compare_and_missing_cells(spark):
    schema = "id string, variable string, value string"
    a = frame(spark, schema, ("1", "x", "p"), ("1", "y", "q"), (None, "x", "p"), ("3", "x", "p"), ("3", "x", "p"))
    b = frame(spark, schema, ("1", "x", "P"), (None, "x", "z"), ("2", "x", "p"), ("3", "x", "p"))
    assert rows(compare.compare_values(a, b, ["id"])) == [("1", "x", "p", "P"), (None, "x", "p", "z")]
    assert rows(compare.missing_cells(a, b, ["id"])) == [("1", "y", "q", "left"), ("2", "x", "p", "right")]


def test_column_set_diff(spark):
    assert rows(compare.column_set_diff(spark, ["a", "b"], ["b", "c"])) == [("a", "original"), ("c", "warehouse")]


# --- grains, ranking, rules -----------------------------------------------------------


def counts(spark, *data):
    return frame(spark, "type string, k string, year int, total_measurements bigint, positive_measurements bigint", *data)


def test_sql_style_keeps_null_keys_and_regroup_drops_them(spark):
    df = counts(spark, ("a", None, 1, 2, 1), ("a", "x", 1, 3, 0))
    assert rows(grains.add_up(df, ["k"])) == [("x", 3, 0), (None, 2, 1)]
    assert rows(grains.regroup(df, ["k"])) == [("x", 3, 0)]


def test_all_grains_add_up_to_the_same_total(spark):
    rng = random.Random(1)
    df = counts(spark, *[(rng.choice("ab"), rng.choice(["x", "y", None]), rng.choice([1, 2, None]), rng.randrange(9), 0) for _ in range(100)])
    out = grains.grouping_grains(df, ["type"], ["k", "year"])
    sums = {r.grain: r.s for r in out.groupBy("grain").agg(F.sum("total_measurements").alias("s")).collect()}
    assert set(sums) == {"all", "k", "year"} and len(set(sums.values())) == 1


def test_histogram(spark):
    df = frame(spark, "s int", (1,), (1,), (2,), (3,), (3,))
    assert rows(grains.histogram(df, "s", "n")) == [(1, 1), (2, 2)]


def test_top_per_group_ties_by_name(spark):
    df = frame(spark, "g string, n string, v int", ("a", "z", 5), ("a", "b", 5), ("a", "c", 9), ("b", "q", 1))
    assert rows(ranking.top_per_group(df, "g", [F.col("v").desc(), F.col("n")], 2), "g", "n") == [("a", "b"), ("a", "c"), ("b", "q")]


def test_last_years_counts_present_years(spark):
    df = frame(spark, "year int", (2000,), (2010,), (2010,), (2012,), (2020,), (None,))
    assert rows(ranking.last_years(df, n=3).distinct()) == [(2010,), (2012,), (2020,)]


def test_row_shares_of_empty_row_is_null(spark):
    out = frame(spark, "a int, b int", (1, 3), (0, 0)).withColumns(ranking.row_shares(["a", "b"]))
    assert rows(out) == [(0.25, 0.75), (None, None)]


FRUIT = "fruits and nuts, vegetables and other plant products"
PLANT = "plant commodities (rpcs)"


@pytest.mark.parametrize("kind, l2, l3, l4, l5, want", [
    ("pesticides", "all lists", "food", PLANT, "fruit rpcs", "fruit rpcs"),
    ("pesticides", "all lists", "food", PLANT, None, None),
    ("pesticides", "all lists", "food", "x", "y", "y"),
    ("pesticides", "all lists", "food", None, "y", "y"),
    ("pesticides", "all lists", "food", "x", None, "Other x"),
    ("pesticides", "all lists", "food", None, None, "Other None"),
    ("pesticides", "all lists", "feed", None, None, "feed"),
    ("pesticides", "all lists", None, None, None, "Other None"),
    ("pesticides", "all lists", "toys", None, None, "Other toys"),
    ("pesticides", "animal products", "milk", None, None, "milk"),
    ("pesticides", "cereals", None, None, None, "cereals"),
    ("pesticides", "cereals", "rye", None, None, "rye"),
    ("pesticides", FRUIT, "a", "b", None, "b"),
    ("pesticides", FRUIT, "a", None, None, f"Other {FRUIT}"),
    ("pesticides", "honey", None, None, None, "honey"),
    ("pesticides", None, "x", None, None, None),
    ("chemical", "x", "food", PLANT, "y", "y"),
    ("chemical", "x", "food", None, None, "Other None"),
    ("chemical", "x", "feed", "q", None, "feed"),
    ("chemical", "x", None, "q", None, "Other q"),
    ("vmpr", "x", "food", "a", None, "a"),
    ("vmpr", "x", "food", "a", "b", "b"),
    ("vmpr", "x", "facets", None, None, "facets"),
    ("vmpr", "x", "non-food matrices", None, None, "non-food matrices"),
    ("vmpr", "x", None, None, None, "Other VMPR"),
    ("amr", "x", "food", None, None, None),
    (None, "x", "food", None, None, None),
])
def test_product_group(one, kind, l2, l3, l4, l5, want):
    assert one(product_rules.product_group, kind, l2, l3, l4, l5) == want


def test_sides_of_a_comparison_are_shuffled_once(spark):
    left = frame(spark, "file string, nr int, v string, w int", ("a", 1, "x", 1), ("a", 1, "x", 1), (None, 2, "y", 2), ("b", 3, None, 3))
    right = frame(spark, "file string, nr long, v string, w int", ("a", 1, "z", 1), (None, 2, "y", 2), ("c", 4, "q", None))
    with settings(spark, spark__sql__requireAllClusterKeysForCoPartition="false", spark__sql__autoBroadcastJoinThreshold="-1"):
        cells = compare.differing_cells(left, right, ["file", "nr"], ["v", "w"])
        plan = cells._jdf.queryExecution().executedPlan().toString()
        found = rows(cells)
    assert plan.count("Exchange") == 2
    assert found == [("a", 1, "v", "x", "z"), ("b", 3, "w", "3", None), ("c", 4, "v", None, "q")]


def test_suspects_hold_all_rows_of_repeated_keys(spark):
    df = frame(spark, "k string, f string, v int", ("a", "x", 1), ("a", "x", 2), ("a", "y", 3), (None, "x", 4), (None, "x", 5), ("b", "x", 6))
    assert rows(dedup.suspects(df, ["k", "f"]), "v") == [(1,), (2,), (4,), (5,)]
