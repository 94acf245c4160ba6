"""Totals by parameter, product, country and year, and flows between countries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import title_case
from ..operators import grains
from ..operators.dims import hierarchy_paths, ordered_rules, product_names
from ..operators.reshape import level
from ..plans import analytics as an
from ..sources.catalogues import product_catalogue
from . import standin as st
from .registry import query

STAR = f"WITH {st.SAMPLES}, {st.MEASUREMENTS}, {st.COUNTRIES}, {st.PARAMS}"
TOTALS = f"count(*) AS total_measurements, count(*) FILTER (WHERE {st.POSITIVE}) AS positive_measurements"
ADDED = "CAST(sum(total_measurements) AS BIGINT) AS total_measurements, CAST(sum(positive_measurements) AS BIGINT) AS positive_measurements"

# One row per measurement, with its sample's attributes.
FACTS = f"""{STAR}, facts AS (
  SELECT m.filetype AS type, m.param_id, m.evalcode, s.*, sc.name AS samp_country, oc.name AS orig_country
  FROM measurements m LEFT JOIN samples s ON m.sample_id = s.sample_id
       LEFT JOIN countries sc ON s.samp_country_id = sc.id LEFT JOIN countries oc ON s.orig_country_id = oc.id)"""


def _positive():
    return an.is_positive(F.col("evalcode"))


def _counts(spark, sf, sample_keys):
    """Totals by type and sample attributes."""
    counts = an.by_sample_attributes(st.measurements(spark, sf), st.samples(spark, sf), ["filetype"], sample_keys, _positive())
    return counts.withColumnRenamed("filetype", "type")


def _country_counts(spark, sf, *extra):
    return an.name_by_id(_counts(spark, sf, ["samp_country_id", *extra]), "samp_country_id", st.countries(spark, sf), "samp_country")


# --- parameters -----------------------------------------------------------------------

PARAM_TOTALS = f"""{STAR}, totals AS (
  SELECT c.type, c.paramid, p.name AS param_name, p.full_name, p.lev1, p.lev2, p.lev3, c.total_measurements, c.positive_measurements
  FROM (SELECT filetype AS type, param_id AS paramid, {TOTALS} FROM measurements GROUP BY filetype, param_id) c
       LEFT JOIN params p ON c.paramid = p.id)"""
CATEGORIES = f"""{PARAM_TOTALS}, grouped AS (
  SELECT CASE WHEN lev1 = 'nutrients' THEN lev3 ELSE lev1 END AS category, {ADDED} FROM totals GROUP BY ALL),
  summary AS (
  SELECT replace(replace({st.sql_title('category')},
           'Persistent Organic Pollutants (Pops) And Other Organic Contaminants', 'POPs and Other Organic Contaminants'),
           'Chemical Elements (Including Derivatives) And Others', 'Chemical Elements and Derivatives') AS category,
         total_measurements, positive_measurements,
         CAST(positive_measurements AS DOUBLE) * 100 / CAST(total_measurements AS DOUBLE) AS proportion_positive
  FROM grouped WHERE category IS NOT NULL
    AND lower(category) NOT IN ('terms used for grouping purposes', 'oft term', 'not in list', 'microorganisms'))"""


def _totals(spark, sf):
    paths = hierarchy_paths(st.param_terms(spark, sf), "code", "name")
    return an.param_totals(st.measurements(spark, sf), st.params(spark, sf), _positive(), paths)


@query("hierarchy_paths", f"""WITH {st.PARAMS}
SELECT code, full_name FROM params
UNION SELECT regexp_replace(code, '\\.[0-9]+$', ''), lev1 || '::' || lev2 FROM params
UNION SELECT split_part(code, '.', 1), lev1 FROM params""")
def hierarchy_path_names(spark, sf):
    return hierarchy_paths(st.param_terms(spark, sf), "code", "name")


@query("hierarchy_levels", f"WITH {st.PARAMS} SELECT id, lev1, lev2, lev3, CAST(NULL AS VARCHAR) AS lev4 FROM params")
def hierarchy_levels(spark, sf):
    paths = hierarchy_paths(st.param_terms(spark, sf), "code", "name")
    named = st.params(spark, sf).join(paths, "code", "left")
    return named.select("id", *[level("full_name", n).alias(f"lev{n}") for n in range(1, 5)])


@query("param_totals", f"{PARAM_TOTALS} SELECT type, paramid, param_name, full_name, total_measurements, positive_measurements FROM totals")
def param_totals(spark, sf):
    return _totals(spark, sf)


@query("category_summary", f"{CATEGORIES} SELECT * FROM summary", order=["-total_measurements", "category"])
def category_summary(spark, sf):
    return an.category_summary(_totals(spark, sf))


@query("level2_breakdown", f"""{PARAM_TOTALS}
SELECT {st.sql_title('lev2')} AS lev2, total_measurements, positive_measurements,
       CAST(positive_measurements AS DOUBLE) / CAST(total_measurements AS DOUBLE) AS proportion_positive
FROM (SELECT lev2, {ADDED} FROM totals WHERE lev1 = 'toxins' GROUP BY lev2)""", order=["-total_measurements", "lev2"])
def level2_breakdown(spark, sf):
    return an.level2_breakdown(_totals(spark, sf), "toxins")


_LEV2 = f"""SELECT {st.sql_title('lev2')} AS lev2, total_measurements, positive_measurements,
       CAST(positive_measurements AS DOUBLE) / CAST(total_measurements AS DOUBLE) AS proportion_positive"""
# Brands take the place of the listed metals.
LISTED_BRANDS = ("brand#21", "brand#22", "brand#24", "brand#25")


@query("pops_breakdown", f"{PARAM_TOTALS} {_LEV2} FROM (SELECT lev2, {ADDED} FROM totals WHERE lev1 = '{an.POPS}' GROUP BY lev2)", order=["-total_measurements", "lev2"])
def pops_breakdown(spark, sf):
    return an.pops_breakdown(_totals(spark, sf))


@query("metals_breakdown", f"""{PARAM_TOTALS} {_LEV2}
FROM (SELECT lev2, {ADDED} FROM totals WHERE lev1 = '{an.ELEMENTS}' AND lev2 IN {st.sql_list(LISTED_BRANDS)} GROUP BY lev2)""", order=["-total_measurements", "lev2"])
def metals_breakdown(spark, sf):
    return an.metals_breakdown(_totals(spark, sf), LISTED_BRANDS)


@query("bubble_scaling", f"""{CATEGORIES}
SELECT category, total_measurements, format('{{:,}}', total_measurements) AS label,
       round(50.0 + (log10(total_measurements) - low) / nullif(high - low, 0) * 350.0, 6) AS size
FROM summary, (SELECT log10(min(total_measurements)) AS low, log10(max(total_measurements)) AS high FROM summary)""")
def bubble_scaling(spark, sf):
    scaled = an.bubble_scaling(an.category_summary(_totals(spark, sf)))
    return scaled.withColumn("size", F.round("size", 6))


@query("top_params_per_type", f"""{PARAM_TOTALS}
SELECT type, rank, {st.sql_title('param_name')} AS param_name, total_measurements AS total_meas, positive_measurements AS pos_meas,
       CAST(positive_measurements AS DOUBLE) / CAST(total_measurements AS DOUBLE) * 100 AS percentage
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY type ORDER BY total_measurements DESC, param_name) AS INTEGER) AS rank
      FROM (SELECT type, param_name, {ADDED} FROM totals GROUP BY type, param_name)) WHERE rank <= 10""")
def top_params_per_type(spark, sf):
    return an.top_params(_totals(spark, sf))


@query("percent_label", f"""{PARAM_TOTALS}
SELECT type, paramid, printf('%.2f%%', round(CAST(positive_measurements AS DOUBLE) / total_measurements * 100, 2)) AS label,
       format('{{:,}}', total_measurements) AS total_text FROM totals""")
def percent_label(spark, sf):
    return an.percent_labels(_totals(spark, sf), ["type", "paramid"])


@query("title_case", f"SELECT p_partkey, {st.sql_title('label')} AS title FROM (SELECT p_partkey, p_type || ' ' || p_name || ' (' || lower(p_brand) || ') o''x-y' AS label FROM part)")
def title_case_names(spark, sf):
    label = F.concat(F.col("p_type"), F.lit(" "), F.col("p_name"), F.lit(" ("), F.lower("p_brand"), F.lit(") o'x-y"))
    return st.table(spark, sf, "part").select("p_partkey", title_case(label).alias("title"))


# --- products and strategies ----------------------------------------------------------

GRAIN_KEYS = (("all", None), ("year", "year"), ("samp_country_id", "samp_country_id"), ("orig_country_id", "orig_country_id"))


def _grain_sql(always: str) -> str:
    parts = []
    for grain, key in GRAIN_KEYS:
        cells = ", ".join(
            f"{k}" if k == key else f"CAST(NULL AS INTEGER) AS {k}" for _, k in GRAIN_KEYS if k is not None
        )
        by = always + (f", {key}" if key else "")
        parts.append(f"SELECT '{grain}' AS grain, {always}, {cells}, {TOTALS} FROM facts GROUP BY {by}")
    return f"{FACTS} " + " UNION ALL ".join(parts)


@query("product_grouping_sets", _grain_sql("product_id, type"))
def product_grouping_sets(spark, sf):
    keys = ["product_id", "year", "samp_country_id", "orig_country_id"]
    return grains.grouping_grains(_counts(spark, sf, keys), ["product_id", "type"], keys[1:])


@query("strategy_grouping_sets", _grain_sql("strategy, product_id, type"))
def strategy_grouping_sets(spark, sf):
    keys = ["strategy", "product_id", "year", "samp_country_id", "orig_country_id"]
    return grains.grouping_grains(_counts(spark, sf, keys), ["strategy", "product_id", "type"], keys[2:])


@query("measurements_by_strategy", f"{FACTS} SELECT type, strategy, product_id, {TOTALS} FROM facts GROUP BY type, strategy, product_id")
def measurements_by_strategy(spark, sf):
    return _counts(spark, sf, ["strategy", "product_id"])


_SUMS = ", ".join(
    f"CAST(count(*) FILTER (WHERE strategy = '{x}') AS BIGINT) AS \"{x}\"" for x in an.STRATEGIES)


@query("strategy_pivot", f"{FACTS} SELECT samp_country, {_SUMS} FROM facts WHERE samp_country IS NOT NULL GROUP BY samp_country")
def strategy_pivot(spark, sf):
    return an.strategy_pivot(_country_counts(spark, sf, "strategy"), "samp_country")


_LISTED = " + ".join(f'"{x}"' for x in an.STRATEGIES)
_SHARES = ", ".join(f'CAST("{x}" AS DOUBLE) / nullif(CAST({_LISTED} AS DOUBLE), 0) AS "{x}"' for x in an.STRATEGIES)


@query("top_country_strategy_mix", f"""{FACTS}, wide AS (
  SELECT type, {st.sql_title('samp_country')} AS samp_country, count(*) AS total_meas, count(*) FILTER (WHERE {st.POSITIVE}) AS pos_meas, {_SUMS}
  FROM facts GROUP BY type, {st.sql_title('samp_country')}), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY type ORDER BY total_meas DESC, samp_country) AS INTEGER) AS rank FROM wide)
SELECT type, samp_country, total_meas, pos_meas, rank, {_SHARES} FROM ranked WHERE rank <= 15""")
def top_country_strategy_mix(spark, sf):
    return an.strategy_mix(_country_counts(spark, sf, "strategy"))


@query("product_names", f"""WITH {st.PARAMS}, mtx AS (SELECT id, code, name, full_name FROM params),
  matrix AS (
    SELECT s_suppkey AS id, n_regionkey || '.' || n_nationkey || '.' || s_suppkey AS code, lower(s_name) AS name,
           lower(r_name) || '::' || lower(n_name) || '::' || lower(s_name) AS full_name
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
  products AS (SELECT CAST(row_number() OVER (ORDER BY mtx_id NULLS LAST, matrix_id) AS BIGINT) AS id, mtx_id, matrix_id FROM (
    SELECT id AS mtx_id, CAST(NULL AS BIGINT) AS matrix_id FROM mtx UNION ALL SELECT NULL, id FROM matrix))
SELECT p.id AS product_id, coalesce('matrix::' || b.name, 'mtx::' || a.name) AS product_name,
       coalesce('matrix::' || b.full_name, 'mtx::' || a.full_name) AS full_name
FROM products p LEFT JOIN mtx a ON p.mtx_id = a.id LEFT JOIN matrix b ON p.matrix_id = b.id""")
def product_name_paths(spark, sf):
    """Products from two dictionaries: parts (with brands and groups) and suppliers (with nations and regions)."""
    supplier, nation, region = (st.table(spark, sf, t) for t in ("supplier", "nation", "region"))
    # Inner nodes have no product of their own, so their id is null.
    inner = lambda code, name: [F.lit(None).cast("bigint").alias("id"), code.cast("string").alias("code"), F.lower(name).alias("name")]
    matrix = (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.col("s_suppkey").alias("id"), F.concat_ws(".", "n_regionkey", "n_nationkey", "s_suppkey").alias("code"), F.lower("s_name").alias("name"))
        .unionByName(nation.select(*inner(F.concat_ws(".", "n_regionkey", "n_nationkey"), "n_name")))
        .unionByName(region.select(*inner(F.col("r_regionkey"), "r_name")))
    )
    parts = st.params(spark, sf).select("id", "code", "name")
    mtx = st.param_terms(spark, sf).join(parts.select("id", "code"), "code", "left")
    leaves = matrix.filter("id is not null")
    return product_names(product_catalogue(parts, leaves), mtx, matrix, "code", "code", "name")


# Paths that touch every branch of the product rules, made from the part's own columns.
_ADJECTIVE = "split_part(p_name, ' ', 1)"
LIST_OF = {"red": "all lists", "blue": "all lists", "hot": "animal products", "cold": "cereals", "old": "fruits and nuts, vegetables and other plant products"}
KIND_OF = {"STANDARD": "food", "ECONOMY": "food", "PROMO": "feed", "SMALL": "facets", "MEDIUM": "non-food matrices", "LARGE": "food"}
FOURTH = {"STANDARD": "plant commodities (rpcs)", "ECONOMY": "other commodities", "LARGE": "animal commodities"}
_LEVELS = f"""leveled AS (
  SELECT p_partkey AS param_id, 'root' AS lev1,
         coalesce({st.sql_mapped(_ADJECTIVE, LIST_OF)}, {_ADJECTIVE}) AS lev2,
         {st.sql_mapped('p_type', KIND_OF)} AS lev3, {st.sql_mapped('p_type', FOURTH)} AS lev4,
         CASE WHEN p_size > 15 AND p_type IN ('STANDARD', 'ECONOMY', 'LARGE') THEN split_part(p_name, ' ', 2) || 's' END AS lev5 FROM part)"""
_FOOD = "CASE WHEN lev4 = 'plant commodities (rpcs)' THEN lev5 WHEN lev5 IS NOT NULL THEN lev5 ELSE 'Other ' || coalesce(lev4, 'None') END"
_GROUP_SQL = f"""CASE
  WHEN type = 'pesticides' AND lev2 = 'all lists' AND lev3 = 'food' THEN {_FOOD}
  WHEN type = 'pesticides' AND lev2 = 'all lists' AND lev3 = 'feed' THEN lev3
  WHEN type = 'pesticides' AND lev2 = 'all lists' THEN 'Other ' || coalesce(lev3, 'None')
  WHEN type = 'pesticides' AND lev2 = 'animal products' THEN lev3
  WHEN type = 'pesticides' AND lev2 = 'cereals' THEN coalesce(lev3, lev2)
  WHEN type = 'pesticides' AND lev2 = 'fruits and nuts, vegetables and other plant products' THEN coalesce(lev4, 'Other ' || lev2)
  WHEN type = 'pesticides' THEN lev2
  WHEN type = 'chemical' AND lev3 = 'food' THEN {_FOOD}
  WHEN type = 'chemical' AND lev3 = 'feed' THEN lev3
  WHEN type = 'chemical' THEN 'Other ' || coalesce(lev4, 'None')
  WHEN type = 'vmpr' AND lev3 = 'food' THEN coalesce(lev5, lev4)
  WHEN type = 'vmpr' AND lev3 IN ('feed', 'facets', 'non-food matrices') THEN lev3
  WHEN type = 'vmpr' THEN 'Other VMPR' END"""
GROUPED = f"""{STAR}, {_LEVELS}, groups AS (
  SELECT type, result, {ADDED} FROM (
    SELECT c.*, {_GROUP_SQL} AS result FROM (SELECT filetype AS type, param_id, {TOTALS} FROM measurements GROUP BY filetype, param_id) c
    JOIN leveled USING (param_id)) WHERE result IS NOT NULL GROUP BY type, result)"""


def _product_groups(spark, sf):
    part = st.table(spark, sf, "part")
    words = F.split("p_name", " ")
    first = F.get(words, F.lit(0))
    lev4 = st.mapped(F.col("p_type"), FOURTH)
    lev5 = F.when((F.col("p_size") > 15) & F.col("p_type").isin(*FOURTH), F.concat(F.get(words, F.lit(1)), F.lit("s")))
    # A path with a gap in it cannot be written down, so a missing fourth level also ends it.
    path = F.concat_ws("::", F.lit("root"), F.coalesce(st.mapped(first, LIST_OF), first), st.mapped(F.col("p_type"), KIND_OF), lev4, lev5)
    paths = part.select(F.col("p_partkey").alias("param_id"), path.alias("full_name"))
    counts = grains.count_measurements(st.measurements(spark, sf), ["filetype", "param_id"], _positive())
    return an.product_groups(counts.join(paths, "param_id").withColumnRenamed("filetype", "type"))


@query("product_group", f"""{GROUPED}
SELECT *, CAST(positive_measurements AS DOUBLE) / CAST(total_measurements AS DOUBLE) AS proportion_positive FROM groups""", order=["-total_measurements", "type", "result"])
def product_group(spark, sf):
    return _product_groups(spark, sf)


CATEGORY_RULES = (("Gear", "machine parts"), ("ring", "round parts"), (" bolt ", "fasteners"), ("commodities", "commodities"), ("ears", "never reached by gears"))


@query("category_mapping", f"""{GROUPED}, named AS (
  SELECT *, CASE WHEN lower(result) LIKE '%gear%' THEN 'machine parts' WHEN lower(result) LIKE '%ring%' THEN 'round parts'
    WHEN lower(result) LIKE '%bolt%' THEN 'fasteners' WHEN lower(result) LIKE '%commodities%' THEN 'commodities'
    WHEN lower(result) LIKE '%ears%' THEN 'never reached by gears' ELSE result END AS category FROM groups)
SELECT type, upper(category[1]) || category[2:] AS category, total_measurements, positive_measurements,
       CAST(positive_measurements AS DOUBLE) / CAST(total_measurements AS DOUBLE) AS proportion_positive
FROM (SELECT type, category, {ADDED} FROM named GROUP BY type, category)""", order=["-total_measurements", "type", "category"])
def category_mapping(spark, sf):
    listed = spark.createDataFrame([(i, *r) for i, r in enumerate(CATEGORY_RULES)], "ordinal int, item string, category string")
    return an.food_categories(_product_groups(spark, sf), ordered_rules(listed, "item", "category", "ordinal"))


# --- countries and years --------------------------------------------------------------


@query("country_type_matrix", f"""{FACTS}
SELECT {st.sql_title('samp_country')} AS samp_country, """ + ", ".join(
    f"count(*) FILTER (WHERE type = '{t}') AS {t}_total, count(*) FILTER (WHERE type = '{t}' AND {st.POSITIVE}) AS {t}_pos" for t in an.TYPES
) + " FROM facts WHERE samp_country IS NOT NULL GROUP BY 1", order=["samp_country"])
def country_type_matrix(spark, sf):
    return an.country_type_matrix(_country_counts(spark, sf))


@query("top_country_matrix", f"""{FACTS}
SELECT {st.sql_title('samp_country')} AS samp_country, count(*) AS total_meas_sum, """ + ", ".join(
    f"count(*) FILTER (WHERE type = '{t}') AS {t}_total, count(*) FILTER (WHERE type = '{t}' AND {st.POSITIVE}) AS {t}_pos" for t in an.TYPES
) + " FROM facts WHERE samp_country IS NOT NULL AND type IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15", order=["-total_meas_sum", "samp_country"])
def top_country_matrix(spark, sf):
    """Measured and positive per type in the fifteen countries with most measurements."""
    return an.top_country_matrix(_country_counts(spark, sf))


@query("production_join", f"""{FACTS}, external AS (
  SELECT {st.sql_title('n_name')} AS samp_country, sum(s_acctbal) AS total_production
  FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal BETWEEN 2000 AND 9000 GROUP BY 1)
SELECT a.samp_country, a.total_meas_sum, round(e.total_production, 2) AS total_production
FROM (SELECT {st.sql_title('samp_country')} AS samp_country, count(*) AS total_meas_sum FROM facts GROUP BY 1) a
LEFT JOIN external e ON a.samp_country = e.samp_country""", order=["-total_meas_sum", "samp_country"])
def production_join(spark, sf):
    """The balance of a nation's suppliers stands in for production, and a range of balances for the range of years."""
    supplier, nation = st.table(spark, sf, "supplier"), st.table(spark, sf, "nation")
    statistics = supplier.filter(F.col("s_acctbal").between(2000, 9000)).join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("area"), F.col("s_acctbal").alias("value"))
    joined = an.production_join(_country_counts(spark, sf), statistics)
    return joined.withColumn("total_production", F.round("total_production", 2))


@query("yearly_trend", f"""{FACTS}
SELECT type, year, {TOTALS}, CAST(count(*) FILTER (WHERE {st.POSITIVE}) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100 AS percentage
FROM facts WHERE year NOT IN (1970, 1998, 1999, 2107) GROUP BY type, year""")
def yearly_trend(spark, sf):
    return an.yearly_trend(_counts(spark, sf, ["year"]))


# --- flows ----------------------------------------------------------------------------

FLOWS = f"""{STAR}, positives AS (SELECT DISTINCT sample_id FROM measurements WHERE {st.POSITIVE}),
  flows AS (
  SELECT coalesce(oc.name, 'unknown') AS orig_country, coalesce(sc.name, 'unknown') AS samp_country, s.year,
         count(*) AS number_of_samples, count(p.sample_id) AS pos_number_of_samples
  FROM samples s LEFT JOIN countries oc ON s.orig_country_id = oc.id LEFT JOIN countries sc ON s.samp_country_id = sc.id
       LEFT JOIN positives p ON s.sample_id = p.sample_id GROUP BY 1, 2, 3)"""


def _routes_sql(cutoff: int, extra: str = "") -> str:
    return f"""{FLOWS}, kept AS (SELECT * FROM flows WHERE year NOT IN (1970, 1998, 1999, 2107) {extra}),
  routes AS (SELECT {st.sql_title('orig_country')} AS orig_country, {st.sql_title('samp_country')} AS samp_country,
    CAST(sum(number_of_samples) AS BIGINT) AS number_of_samples, CAST(sum(pos_number_of_samples) AS BIGINT) AS pos_number_of_samples
    FROM kept GROUP BY 1, 2)
SELECT *, CAST(pos_number_of_samples AS DOUBLE) / CAST(number_of_samples AS DOUBLE) AS positive_ratio FROM routes
WHERE orig_country <> samp_country AND number_of_samples > {cutoff}
ORDER BY positive_ratio DESC, orig_country, samp_country LIMIT 20"""


def _flows(spark, sf):
    ids = an.positive_samples(st.measurements(spark, sf), _positive())
    return an.country_flows(st.samples(spark, sf), ids, st.countries(spark, sf))


@query("origin_destination", f"{FLOWS} SELECT * FROM flows")
def origin_destination(spark, sf):
    return _flows(spark, sf)


@query("trade_routes", _routes_sql(12))
def trade_routes(spark, sf):
    return an.trade_routes(_flows(spark, sf), more_than=12)


@query("last_five_years", _routes_sql(
    8, "AND year IN (SELECT DISTINCT year FROM flows WHERE year NOT IN (1970, 1998, 1999, 2107) ORDER BY year DESC LIMIT 5)"))
def last_five_years(spark, sf):
    return an.recent_routes(_flows(spark, sf), more_than=8)


@query("unknown_origin_share", f"""{FLOWS}
SELECT year, CAST(sum(number_of_samples) AS BIGINT) AS total_samples,
       CAST(coalesce(sum(number_of_samples) FILTER (WHERE orig_country = 'unknown'), 0) AS BIGINT) AS unknown_samples,
       CAST(coalesce(sum(number_of_samples) FILTER (WHERE orig_country = 'unknown'), 0) AS DOUBLE) / CAST(sum(number_of_samples) AS DOUBLE) * 100 AS unknown_percentage
FROM flows WHERE year <> 2107 GROUP BY year""")
def unknown_origin_share(spark, sf):
    return an.unknown_origin_share(_flows(spark, sf))


@query("unknown_origin_targets", f"""{FLOWS}
SELECT samp_country, CAST(sum(number_of_samples) AS BIGINT) AS number_of_samples FROM flows
WHERE orig_country = 'unknown' AND year <> 2107 GROUP BY samp_country""", order=["-number_of_samples", "samp_country"])
def unknown_origin_targets(spark, sf):
    return an.unknown_origin_targets(_flows(spark, sf))
