"""The example questions: counts by country, parameter and result, and exceedance rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import grains
from ..plans import analytics as an
from ..session import materialise
from . import standin as st
from .registry import query

PAIR = ("nation_3", "nation_7")
SUSPECT = "suspect sampling"

STAR = f"WITH {st.SAMPLES}, {st.MEASUREMENTS}, {st.COUNTRIES}, {st.PARAMS}"
VIEW = f"""{STAR}, view AS (
  SELECT m.filetype, p.name AS param, c.name AS sampcountry, s.strategy, s.year AS sampy, m.evalcode, m.sample_id, m.param_id
  FROM measurements m JOIN samples s ON m.sample_id = s.sample_id
       LEFT JOIN countries c ON s.samp_country_id = c.id LEFT JOIN params p ON m.param_id = p.id),
  selected AS (SELECT id, name FROM params WHERE name LIKE '%bolt%'),
  flagged AS (SELECT *, CASE WHEN {st.POSITIVE} THEN 1 ELSE 0 END AS exceeding
              FROM view WHERE filetype = 'chemical' AND param IN {st.sql_list(st.CHOSEN)})"""


def _selected(spark, sf) -> DataFrame:
    """Parameters chosen by name, with the number of entries of that name.

    Stored like a temporary table, so that its size is known when measurements are joined
    to it: small, it is broadcast and the measurements are not shuffled by parameter.
    """
    params = st.params(spark, sf)
    return materialise(an.param_copies(params, an.select_params(params, "bolt")), "selected-params")


def _all_params(spark, sf) -> DataFrame:
    return st.params(spark, sf).select(F.col("id").alias("param_id"), F.col("name").alias("param"), F.lit(1).alias("copies"))


def _samples_of(spark, sf, names) -> DataFrame:
    """Samples taken in the named countries; the name is looked up before the join."""
    wanted = st.countries(spark, sf).filter(F.col("name").isin(*names)).select(F.col("id").alias("samp_country_id"))
    return st.samples(spark, sf).join(wanted, "samp_country_id", "left_semi")


def _by_country(df: DataFrame, spark, sf) -> DataFrame:
    return an.name_by_id(df, "samp_country_id", st.countries(spark, sf), "sampcountry")


def _chosen_flagged(spark, sf) -> DataFrame:
    ids = st.params(spark, sf).filter(F.col("name").isin(*st.CHOSEN)).select(F.col("id").alias("param_id"))
    return an.exceeding_flag(st.measurements_of(spark, sf, "chemical").join(ids, "param_id", "left_semi"))


@query("param_like", f"WITH {st.PARAMS} SELECT id, name, code FROM params WHERE name LIKE '%bolt%'")
def param_like(spark, sf):
    return an.select_params(st.params(spark, sf), "bolt")


@query("mycotoxin_counts", f"""{VIEW}
SELECT v.filetype, v.param, count(*) AS n FROM view v JOIN selected t ON v.param = t.name GROUP BY v.filetype, v.param""", order=["-n", "filetype", "param"])
def mycotoxin_counts(spark, sf):
    return an.count_selected(st.measurements(spark, sf), _selected(spark, sf), ["filetype", "param"])


@query("count_by_country", f"""{VIEW}
SELECT sampcountry, count(*) AS n FROM view v JOIN selected t ON v.param = t.name WHERE filetype = 'chemical' GROUP BY sampcountry""", order=["-n", "sampcountry"])
def count_by_country(spark, sf):
    counts = an.count_selected_by_sample(
        st.measurements_of(spark, sf, "chemical"), st.samples(spark, sf), _selected(spark, sf), ["samp_country_id"])
    return _by_country(counts, spark, sf)


@query("suspect_only", f"""{VIEW}
SELECT sampcountry, count(*) AS n FROM view v JOIN selected t ON v.param = t.name
WHERE filetype = 'chemical' AND strategy = '{SUSPECT}' GROUP BY sampcountry""", order=["-n", "sampcountry"])
def suspect_only(spark, sf):
    counts = an.count_selected_by_sample(
        st.measurements_of(spark, sf, "chemical"), st.samples(spark, sf).filter(F.col("strategy") == SUSPECT),
        _selected(spark, sf), ["samp_country_id"])
    return _by_country(counts, spark, sf)


@query("two_country_compare", f"""{VIEW}
SELECT sampcountry, param, count(*) AS n FROM view WHERE filetype = 'chemical' AND sampcountry IN {st.sql_list(PAIR)}
GROUP BY sampcountry, param""", order=["param", "-n", "sampcountry"])
def two_country_compare(spark, sf):
    counts = an.count_selected_by_sample(
        st.measurements_of(spark, sf, "chemical"), _samples_of(spark, sf, PAIR), _all_params(spark, sf), ["samp_country_id"], True)
    return _by_country(counts, spark, sf)


@query("exclude_strategy", f"""{VIEW}
SELECT sampcountry, param, count(*) AS n FROM view
WHERE filetype = 'chemical' AND sampcountry IN {st.sql_list(PAIR)} AND strategy <> '{SUSPECT}' GROUP BY sampcountry, param""", order=["param", "-n", "sampcountry"])
def exclude_strategy(spark, sf):
    others = _samples_of(spark, sf, PAIR).filter(F.col("strategy") != SUSPECT)
    counts = an.count_selected_by_sample(
        st.measurements_of(spark, sf, "chemical"), others, _all_params(spark, sf), ["samp_country_id"], True)
    return _by_country(counts, spark, sf)


@query("two_country_selected_params", f"""{VIEW}
SELECT sampcountry, param, count(*) AS n FROM view v JOIN selected t ON v.param = t.name
WHERE filetype = 'chemical' AND sampcountry IN {st.sql_list(PAIR)} AND strategy <> '{SUSPECT}' GROUP BY sampcountry, param""", order=["-n", "param", "sampcountry"])
def two_country_selected_params(spark, sf):
    others = _samples_of(spark, sf, PAIR).filter(F.col("strategy") != SUSPECT)
    counts = an.count_selected_by_sample(
        st.measurements_of(spark, sf, "chemical"), others, _selected(spark, sf), ["samp_country_id"], True)
    return _by_country(counts, spark, sf)


@query("exceeding_flag", f"{VIEW} SELECT sample_id, param_id, filetype, evalcode, exceeding FROM flagged")
def exceeding_flag(spark, sf):
    return _chosen_flagged(spark, sf)


@query("evaluation_by_country", f"{VIEW} SELECT sampcountry, evalcode, count(*) AS n FROM flagged GROUP BY sampcountry, evalcode", order=["evalcode", "-n", "sampcountry"])
def evaluation_by_country(spark, sf):
    per_sample = _chosen_flagged(spark, sf).groupBy("sample_id", "evalcode").agg(F.count(F.lit(1)).alias("n"))
    joined = per_sample.join(st.samples(spark, sf).select("sample_id", "samp_country_id"), "sample_id")
    return _by_country(joined.groupBy("samp_country_id", "evalcode").agg(F.sum("n").alias("n")), spark, sf)


RATE = """SELECT {0}, n, n_exceeding, CAST(n_exceeding AS DOUBLE) / CAST(n AS DOUBLE) AS perc_exceeding
FROM (SELECT {0}, count(*) AS n, CAST(sum(exceeding) AS BIGINT) AS n_exceeding FROM flagged {1} GROUP BY {0})"""


@query("exceeding_rate", f"{VIEW} {RATE.format('sampcountry', '')}", order=["-perc_exceeding", "sampcountry"])
def exceeding_rate(spark, sf):
    rates = an.exceeding_rate(_chosen_flagged(spark, sf), st.samples(spark, sf), ["samp_country_id"])
    return _by_country(rates, spark, sf)


@query("exceeding_rate_yearly", f"{VIEW} {RATE.format('sampy', chr(32) + 'WHERE sampcountry = ' + chr(39) + 'nation_7' + chr(39))}", order=["sampy"])
def exceeding_rate_yearly(spark, sf):
    rates = an.exceeding_rate(_chosen_flagged(spark, sf), _samples_of(spark, sf, ["nation_7"]), ["year"])
    return rates.withColumnRenamed("year", "sampy")


@query("conditional_count", f"""{STAR}
SELECT filetype, count(*) AS total_measurements, count(*) FILTER (WHERE {st.POSITIVE}) AS positive_measurements
FROM measurements GROUP BY filetype""")
def conditional_count(spark, sf):
    return grains.count_measurements(st.measurements(spark, sf), ["filetype"], an.is_positive(F.col("evalcode")))


@query("positive_samples", f"""{STAR}
SELECT s.* FROM samples s WHERE s.sample_id IN (SELECT sample_id FROM measurements WHERE {st.POSITIVE})""")
def positive_samples(spark, sf):
    ids = an.positive_samples(st.measurements(spark, sf), an.is_positive(F.col("evalcode")))
    return st.samples(spark, sf).join(ids, "sample_id", "left_semi")


@query("samples_per_positive_count", f"""{STAR}
SELECT positive_measurements, count(*) AS num_samples FROM (
  SELECT sample_id, count(*) AS positive_measurements FROM measurements WHERE {st.POSITIVE} GROUP BY sample_id)
GROUP BY positive_measurements""", order=["positive_measurements"])
def samples_per_positive_count(spark, sf):
    positive = st.measurements(spark, sf).filter(an.is_positive(F.col("evalcode")))
    return grains.histogram(positive, "sample_id", "positive_measurements")


@query("samples_per_total_count", f"""{STAR}
SELECT total_measurements, count(*) AS num_samples FROM (
  SELECT sample_id, count(*) AS total_measurements FROM measurements GROUP BY sample_id) GROUP BY total_measurements""", order=["total_measurements"])
def samples_per_total_count(spark, sf):
    return grains.histogram(st.measurements(spark, sf), "sample_id", "total_measurements")
