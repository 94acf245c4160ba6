"""The questions asked of the warehouse.

Inputs are the star's tables.  ``samples``: ``sample_id, samp_country_id, orig_country_id,
strategy, year, product_id``.  ``measurements``: ``sample_id, param_id, filetype, evalcode``.
Dictionaries: ``id`` and names.

Shape shared by all of them: filter measurements, count per sample (combined before the
shuffle), join the counts to samples, add up, and attach names last.  Names never travel
through a shuffle of fact rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import log_scale_size, percent_text, share, thousands_text
from ..functions.text import capitalise, title_case
from ..operators import grains, product_rules, ranking
from ..operators.dims import first_matching_category
from ..operators.grains import POSITIVE, TOTAL
from ..operators.reshape import level, sums_by_label

# Evaluation results that count as positive.
POSITIVE_RESULTS = (
    "greater than maximum permissible quantities", "non compliant", "unsatisfactory", "detected",
)

# The toxins of the exceedance question.
TOXINS = (
    "aflatoxin b1", "ochratoxin a", "deoxynivalenol", "zearalenone", "fumonisin b1",
    "fumonisin b2", "sum of fumonisin b1 + b2", "t-2 toxin", "ht-2 toxin",
    "sum t-2 and ht-2", "zearalenol alpha", "zearalanol", "zearalanone",
)

# Sampling strategies in reporting order, and types of releases.
STRATEGIES = (
    "objective sampling", "selective sampling", "suspect sampling", "convenient sampling", "other",
)
TYPES = ("chemical", "pesticides", "vmpr")

# Years that are typing errors.
OUTLIER_YEARS = (1970, 1998, 1999, 2107)

# Top categories that are not substances, and shorter names for two others.
SKIPPED_CATEGORIES = ("terms used for grouping purposes", "oft term", "not in list", "microorganisms")
CATEGORY_LABELS = {
    "Persistent Organic Pollutants (Pops) And Other Organic Contaminants": "POPs and Other Organic Contaminants",
    "Chemical Elements (Including Derivatives) And Others": "Chemical Elements and Derivatives",
}
NUTRIENTS = "nutrients"

# First levels whose second levels are reported, and the metals of the last one.
POPS = "persistent organic pollutants (pops) and other organic contaminants"
ELEMENTS = "chemical elements (including derivatives) and others"
METALS = (
    "lead and derivatives", "cadmium and derivatives", "mercury and derivatives",
    "arsenic and derivatives", "nickel and derivatives", "copper and derivatives",
    "zinc and derivatives", "chromium and derivatives", "selenium and derivatives",
    "manganese and derivatives", "tin and derivatives", "thallium and derivatives",
    "barium and derivatives", "cobalt and derivatives", "antimony and derivatives",
    "silver and derivatives", "beryllium and derivatives", "vanadium and derivatives",
    "uranium and derivatives", "thorium and derivatives",
)

UNKNOWN = "unknown"


def is_positive(evalcode: Column, results: Sequence[str] = POSITIVE_RESULTS) -> Column:
    return evalcode.isin(*results)


def positive_samples(measurements: DataFrame, positive: Column) -> DataFrame:
    """Ids of samples with at least one positive measurement, each once."""
    return measurements.filter(positive).select("sample_id").distinct()


def by_sample_attributes(
    measurements: DataFrame, samples: DataFrame, measurement_keys: Sequence[str], sample_keys: Sequence[str],
    positive: Column, how: str = "left",
) -> DataFrame:
    """Total and positive measurements by keys of both tables."""
    per_sample = grains.counts_per_sample(measurements, positive, measurement_keys)
    joined = per_sample.join(samples.select("sample_id", *sample_keys), "sample_id", how)
    return grains.add_up(joined, [*measurement_keys, *sample_keys])


def name_by_id(df: DataFrame, id_col: str, dictionary: DataFrame, out: str, name: str = "name", default: str | None = None) -> DataFrame:
    """Swap an id for its name; ids without a name get the default."""
    side = dictionary.select(F.col("id").alias("_id"), F.col(name).alias(out))
    named = df.join(side, F.col(id_col) == F.col("_id"), "left").drop("_id", id_col)
    return named.fillna({out: default}) if default is not None else named


# --- counts ---------------------------------------------------------------------------


def select_params(params: DataFrame, text: str, name: str = "name") -> DataFrame:
    return params.filter(F.col(name).contains(text))


def param_copies(params: DataFrame, selected: DataFrame, name: str = "name") -> DataFrame:
    """Parameters whose *name* is selected, with how often the name was selected.

    Joining by name counts a measurement once per selected entry of that name; carrying the
    number of entries gives the same counts without multiplying rows.
    """
    times = selected.groupBy(F.col(name).alias("_name")).agg(F.count(F.lit(1)).alias("copies"))
    return params.join(times, F.col(name) == F.col("_name")).select(F.col("id").alias("param_id"), F.col(name).alias("param"), "copies")


def count_selected(measurements: DataFrame, chosen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Measurements of the chosen parameters by measurement columns and ``param``."""
    own = [k for k in keys if k != "param"]
    counts = measurements.groupBy("param_id", *own).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(chosen, "param_id").groupBy(*keys).agg(F.sum(F.col("n") * F.col("copies")).alias("n"))


def count_selected_by_sample(
    measurements: DataFrame, samples: DataFrame, chosen: DataFrame, sample_keys: Sequence[str], param: bool = False
) -> DataFrame:
    """Measurements of the chosen parameters by sample columns, and by ``param`` if asked for."""
    extra = ["param"] if param else []
    joined = measurements.join(chosen, "param_id")
    per_sample = joined.groupBy("sample_id", *extra).agg(F.sum("copies").alias("n"))
    return per_sample.join(samples.select("sample_id", *sample_keys), "sample_id").groupBy(*sample_keys, *extra).agg(F.sum("n").alias("n"))


def exceeding_flag(measurements: DataFrame, results: Sequence[str] = POSITIVE_RESULTS) -> DataFrame:
    """1 for a result above the limit, else 0; a missing result is 0."""
    return measurements.withColumn("exceeding", F.when(is_positive(F.col("evalcode"), results), 1).otherwise(0))


def exceeding_rate(flagged: DataFrame, samples: DataFrame, sample_keys: Sequence[str]) -> DataFrame:
    """Measurements, those above the limit, and their ratio by sample columns."""
    per_sample = flagged.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n"), F.sum("exceeding").alias("n_exceeding"))
    joined = per_sample.join(samples.select("sample_id", *sample_keys), "sample_id")
    totals = joined.groupBy(*sample_keys).agg(F.sum("n").alias("n"), F.sum("n_exceeding").alias("n_exceeding"))
    return totals.withColumn("perc_exceeding", share(F.col("n_exceeding"), F.col("n")))


def param_totals(measurements: DataFrame, params: DataFrame, positive: Column, paths: DataFrame) -> DataFrame:
    """Totals per type and parameter; names and hierarchy are attached to the totals."""
    counts = grains.count_measurements(measurements, ["filetype", "param_id"], positive)
    named = counts.join(params.select(F.col("id").alias("param_id"), F.col("name").alias("param_name"), "code"), "param_id", "left")
    return named.join(paths, "code", "left").select(
        F.col("filetype").alias("type"), F.col("param_id").alias("paramid"), "param_name", "full_name", TOTAL, POSITIVE
    )


# --- categories -----------------------------------------------------------------------


def with_category(totals: DataFrame) -> DataFrame:
    """The category: the third level of nutrients, else the first."""
    first = level("full_name", 1)
    return totals.withColumn("category", F.when(first == NUTRIENTS, level("full_name", 3)).otherwise(first))


def category_summary(totals: DataFrame) -> DataFrame:
    """Totals and percentage of positives per category, without the non-substances."""
    grouped = grains.regroup(with_category(totals), ["category"])
    kept = grouped.filter(~F.lower("category").isin(*SKIPPED_CATEGORIES))
    label = title_case(F.col("category"))
    for long, short in CATEGORY_LABELS.items():
        label = F.replace(label, F.lit(long), F.lit(short))
    return kept.select(
        label.alias("category"), TOTAL, POSITIVE,
        (F.col(POSITIVE).cast("double") * 100 / F.nullif(F.col(TOTAL).cast("double"), F.lit(0.0))).alias("proportion_positive"),
    )


def level2_breakdown(totals: DataFrame, lev1: str, only: Sequence[str] | None = None) -> DataFrame:
    """Totals per second level below one first level, optionally for listed members only."""
    below = totals.filter(F.lower(level("full_name", 1)) == lev1).withColumn("lev2", level("full_name", 2))
    if only is not None:
        below = below.filter(F.col("lev2").isin(*only))
    grouped = grains.regroup(below, ["lev2"])
    return grouped.select(title_case(F.col("lev2")).alias("lev2"), TOTAL, POSITIVE, share(F.col(POSITIVE), F.col(TOTAL)).alias("proportion_positive"))


def pops_breakdown(totals: DataFrame) -> DataFrame:
    """Second levels of the organic contaminants."""
    return level2_breakdown(totals, POPS)


def metals_breakdown(totals: DataFrame, metals: Sequence[str] = METALS) -> DataFrame:
    """The listed metals among the chemical elements."""
    return level2_breakdown(totals, ELEMENTS, metals)


def bubble_scaling(summary: DataFrame, smallest: float = 50.0, largest: float = 400.0) -> DataFrame:
    """Marker size per category on a log scale, with the total as a readable number.

    The extremes come from a scalar subquery, so there is neither a join nor a window.
    """
    ends = summary.agg(F.min(TOTAL).alias("low"), F.max(TOTAL).alias("high"))
    low, high = ends.select("low").scalar(), ends.select("high").scalar()
    return summary.select(
        "category", TOTAL, thousands_text(F.col(TOTAL)).alias("label"),
        log_scale_size(F.col(TOTAL), low, high, smallest, largest).alias("size"),
    )


def top_params(totals: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most measured parameters per type, with the share of positives as text."""
    grouped = grains.regroup(totals, ["type", "param_name"])
    top = ranking.top_per_group(grouped, "type", [F.col(TOTAL).desc(), F.col("param_name")], n)
    return top.select(
        "type", "rank", title_case(F.col("param_name")).alias("param_name"),
        F.col(TOTAL).alias("total_meas"), F.col(POSITIVE).alias("pos_meas"),
        (F.col(POSITIVE).cast("double") / F.col(TOTAL).cast("double") * 100).alias("percentage"),
    )


def percent_labels(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return counts.select(
        *keys, percent_text(F.col(POSITIVE), F.col(TOTAL)).alias("label"), thousands_text(F.col(TOTAL)).alias("total_text")
    )


# --- countries ------------------------------------------------------------------------


def strategy_pivot(counts: DataFrame, key: str, strategies: Sequence[str] = STRATEGIES) -> DataFrame:
    """Measurements per fixed sampling strategy; other strategies are ignored."""
    return counts.filter(F.col(key).isNotNull()).groupBy(key).agg(*sums_by_label("strategy", strategies, F.col(TOTAL)))


def strategy_mix(counts: DataFrame, n: int = 15, strategies: Sequence[str] = STRATEGIES) -> DataFrame:
    """Per type, the ``n`` most measured countries with the share of each strategy.

    ``counts``: ``type, samp_country, strategy`` and totals.  The share is taken over the
    listed strategies only.
    """
    titled = counts.withColumn("samp_country", title_case(F.col("samp_country")))
    known = titled.filter(F.col("type").isNotNull() & F.col("samp_country").isNotNull())
    wide = known.groupBy("type", "samp_country").agg(
        F.sum(TOTAL).alias("total_meas"), F.sum(POSITIVE).alias("pos_meas"),
        *sums_by_label("strategy", strategies, F.col(TOTAL)),
    )
    top = ranking.top_per_group(wide, "type", [F.col("total_meas").desc(), F.col("samp_country")], n)
    return top.withColumns(ranking.row_shares(strategies))


def country_totals(counts: DataFrame) -> DataFrame:
    """Totals and percentage of positives per type and country (title-cased name)."""
    titled = counts.withColumn("samp_country", title_case(F.col("samp_country")))
    grouped = grains.regroup(titled, ["type", "samp_country"])
    return grouped.withColumn("percentage", share(F.col(POSITIVE), F.col(TOTAL)) * 100)


def production_join(counts: DataFrame, statistics: DataFrame) -> DataFrame:
    """Measurements per country next to an external total; null where there is none."""
    per_country = country_totals(counts).groupBy("samp_country").agg(F.sum(TOTAL).alias("total_meas_sum"))
    external = statistics.groupBy(title_case(F.col("area")).alias("samp_country")).agg(
        F.coalesce(F.sum("value"), F.lit(0.0)).alias("total_production")
    )
    return per_country.join(external, "samp_country", "left")


def country_type_matrix(counts: DataFrame, types: Sequence[str] = TYPES) -> DataFrame:
    """One row per country with total and positive columns per type, 0 where there is none."""
    titled = counts.withColumn("samp_country", title_case(F.col("samp_country"))).filter(F.col("samp_country").isNotNull())
    cells = []
    for t in types:
        for measure, tag in ((TOTAL, "total"), (POSITIVE, "pos")):
            cells.append(F.coalesce(F.sum(F.when(F.col("type") == t, F.col(measure))), F.lit(0)).alias(f"{t}_{tag}"))
    return titled.groupBy("samp_country").agg(*cells)


def top_country_matrix(counts: DataFrame, n: int = 15, types: Sequence[str] = TYPES) -> DataFrame:
    """The rows of ``country_type_matrix`` of the ``n`` countries with most measurements of all types, with ``total_meas_sum``.

    Their order is by that sum, the largest first, equal ones by name.
    """
    totals = country_totals(counts).groupBy("samp_country").agg(F.sum(TOTAL).alias("total_meas_sum"))
    top = totals.orderBy(F.col("total_meas_sum").desc(), "samp_country").limit(n)
    return country_type_matrix(counts, types).join(top, "samp_country").orderBy(F.col("total_meas_sum").desc(), "samp_country")


def yearly_trend(counts: DataFrame, outliers: Sequence[int] = OUTLIER_YEARS) -> DataFrame:
    """Totals and percentage of positives per type and year, without outlier years."""
    grouped = grains.regroup(ranking.without_years(counts, outliers), ["type", "year"])
    return grouped.withColumn("percentage", share(F.col(POSITIVE), F.col(TOTAL)) * 100)


# --- products -------------------------------------------------------------------------


def product_groups(counts: DataFrame, path_col: str = "full_name") -> DataFrame:
    """Totals per type and reporting group; products without a group are left out."""
    group = product_rules.product_group(F.col("type"), *[level(path_col, n) for n in (2, 3, 4, 5)])
    grouped = grains.regroup(counts.withColumn("result", group), ["type", "result"])
    return grouped.withColumn("proportion_positive", share(F.col(POSITIVE), F.col(TOTAL)))


def food_categories(groups: DataFrame, rules: DataFrame, label: str = "result") -> DataFrame:
    """Totals per type and category, by the first rule that fits the label."""
    named = first_matching_category(groups, label, rules)
    grouped = grains.regroup(named, ["type", "category"])
    return grouped.select(
        "type", capitalise(F.col("category")).alias("category"), TOTAL, POSITIVE,
        share(F.col(POSITIVE), F.col(TOTAL)).alias("proportion_positive"),
    )


# --- flows between countries ----------------------------------------------------------


def country_flows(samples: DataFrame, positive_ids: DataFrame, countries: DataFrame) -> DataFrame:
    """Samples by origin, sampling country and year; a missing origin is ``unknown``."""
    counts = grains.sample_flows(samples, positive_ids, ["orig_country_id", "samp_country_id", "year"])
    named = name_by_id(counts, "orig_country_id", countries, "orig_country", default=UNKNOWN)
    return name_by_id(named, "samp_country_id", countries, "samp_country", default=UNKNOWN)


def routes(flows: DataFrame) -> DataFrame:
    """Flows added up over the years, with the share of positive samples."""
    summed = flows.groupBy("orig_country", "samp_country").agg(
        F.sum("number_of_samples").alias("number_of_samples"), F.sum("pos_number_of_samples").alias("pos_number_of_samples")
    )
    return summed.select(
        title_case(F.col("orig_country")).alias("orig_country"), title_case(F.col("samp_country")).alias("samp_country"),
        "number_of_samples", "pos_number_of_samples",
        share(F.col("pos_number_of_samples"), F.col("number_of_samples")).alias("positive_ratio"),
    )


def trade_routes(flows: DataFrame, more_than: int, n: int = 20, outliers: Sequence[int] = OUTLIER_YEARS) -> DataFrame:
    """The ``n`` cross-border routes with the highest share of positives."""
    busy = routes(ranking.without_years(flows, outliers)).filter(
        (F.col("orig_country") != F.col("samp_country")) & (F.col("number_of_samples") > more_than)
    )
    return busy.orderBy(F.col("positive_ratio").desc(), F.col("orig_country"), F.col("samp_country")).limit(n)


def recent_routes(flows: DataFrame, more_than: int, n: int = 20, years: int = 5, outliers: Sequence[int] = OUTLIER_YEARS) -> DataFrame:
    """The same over the last years that occur."""
    kept = ranking.last_years(ranking.without_years(flows, outliers), n=years)
    return trade_routes(kept, more_than, n, outliers)


def unknown_origin_share(flows: DataFrame, outliers: Sequence[int] = (2107,)) -> DataFrame:
    """Per year, the percentage of samples without an origin."""
    kept = ranking.without_years(flows, outliers).filter(F.col("year").isNotNull())
    lost = F.when(F.lower("orig_country") == UNKNOWN, F.col("number_of_samples"))
    totals = kept.groupBy("year").agg(
        F.sum("number_of_samples").alias("total_samples"), F.coalesce(F.sum(lost), F.lit(0)).alias("unknown_samples")
    )
    return totals.withColumn("unknown_percentage", share(F.col("unknown_samples"), F.col("total_samples")) * 100)


def unknown_origin_targets(flows: DataFrame, outliers: Sequence[int] = (2107,)) -> DataFrame:
    """Where samples without an origin were taken."""
    kept = ranking.without_years(flows, outliers).filter(F.lower("orig_country") == UNKNOWN)
    return kept.filter(F.col("samp_country").isNotNull()).groupBy("samp_country").agg(F.sum("number_of_samples").alias("number_of_samples"))


