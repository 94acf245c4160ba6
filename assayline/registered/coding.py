"""Dictionary coding, views and insert-only-new rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import compare, dims, inserts, reshape
from ..plans import loads, star
from ..session import materialise
from ..sources.catalogues import ingest_catalogue, load_catalogue, product_catalogue, union_catalogues
from . import standin as st
from .registry import query

# Orders before this day are "already loaded"; the batch that arrives is all orders.
LOADED_BEFORE = "1998-01-01"


def _nation_codes(spark, sf):
    """Nations as a dictionary that lacks some of the codes in use."""
    return st.table(spark, sf, "nation").filter("n_regionkey <> 4").select(F.col("n_nationkey").alias("id"), F.lower("n_name").alias("termcode"))


def _priorities(spark, sf):
    """A dictionary is a stored table, so it is stored here too: its size is then known."""
    return materialise(st.table(spark, sf, "orders").select(
        F.left("o_orderpriority", F.lit(1)).cast("int").alias("id"), F.lower("o_orderpriority").alias("termcode")).distinct(), "priorities")


@query("dict_encode", """WITH rows AS (SELECT o_orderkey, 'nation_' || (o_custkey % 25) AS country, lower(o_orderpriority) AS priority FROM orders),
  nations AS (SELECT n_nationkey AS id, lower(n_name) AS termcode FROM nation WHERE n_regionkey <> 4)
SELECT r.*, n.id AS country_id, CAST(left(priority, 1) AS INTEGER) AS priority_id FROM rows r LEFT JOIN nations n ON r.country = n.termcode""")
def dict_encode(spark, sf):
    """Unknown codes get a null id."""
    rows = st.table(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit("nation_"), (F.col("o_custkey") % 25).cast("string")).alias("country"), F.lower("o_orderpriority").alias("priority"))
    return dims.encode(rows, [("country", _nation_codes(spark, sf), "country_id"), ("priority", _priorities(spark, sf), "priority_id")])


@query("role_playing_country", """SELECT l_orderkey, l_linenumber, l_partkey, lower(a.n_name) AS sampcountry, lower(b.n_name) AS origcountry
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN nation a ON c_nationkey = a.n_nationkey LEFT JOIN nation b ON s_nationkey = b.n_nationkey""")
def role_playing_country(spark, sf):
    """One dictionary in two roles: the customer's and the supplier's nation."""
    line, orders, customer, supplier = (st.table(spark, sf, t) for t in ("lineitem", "orders", "customer", "supplier"))
    ids = (
        line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select("l_orderkey", "l_linenumber", "l_partkey", "c_nationkey", "s_nationkey"))
    nation = st.countries(spark, sf)
    return dims.decode(ids, [("c_nationkey", nation, {"name": "sampcountry"}), ("s_nationkey", nation, {"name": "origcountry"})]).drop("c_nationkey", "s_nationkey")


def _segments(spark, sf):
    """Two product dictionaries that share a code: segments up to H, and segments from F on."""
    codes = st.table(spark, sf, "customer").select(F.ascii("c_mktsegment").alias("id"), F.lower("c_mktsegment").alias("termcode")).distinct()
    codes = materialise(codes, "segments")
    return codes.filter("termcode < 'i'"), codes.filter("termcode > 'c'").select((F.col("id") + 1000).alias("id"), "termcode")


SEGMENTS = """codes AS (SELECT DISTINCT ascii(c_mktsegment) AS id, lower(c_mktsegment) AS termcode FROM customer),
  mtx AS (SELECT * FROM codes WHERE termcode < 'i'), matrix AS (SELECT id + 1000 AS id, termcode FROM codes WHERE termcode > 'c'),
  products AS (SELECT row_number() OVER (ORDER BY mtx_id NULLS LAST, matrix_id) AS id, mtx_id, matrix_id FROM (
    SELECT id AS mtx_id, CAST(NULL AS INTEGER) AS matrix_id FROM mtx UNION ALL SELECT NULL, id FROM matrix))"""


@query("resolve_product", f"""WITH {SEGMENTS}
SELECT c_custkey, lower(c_mktsegment) AS code, coalesce(a.id, b.id) AS product_id
FROM customer LEFT JOIN mtx ON lower(c_mktsegment) = mtx.termcode LEFT JOIN products a ON mtx.id = a.mtx_id
LEFT JOIN matrix ON lower(c_mktsegment) = matrix.termcode LEFT JOIN products b ON matrix.id = b.matrix_id""")
def resolve_product(spark, sf):
    mtx, matrix = _segments(spark, sf)
    rows = st.table(spark, sf, "customer").select("c_custkey", F.lower("c_mktsegment").alias("code"))
    return dims.resolve_product(rows, "code", mtx, matrix, product_catalogue(mtx, matrix))


@query("catalogue_union", f"WITH {SEGMENTS} SELECT id, termcode, 'mtx' AS catalogue FROM mtx UNION SELECT id, termcode, 'matrix' FROM matrix")
def catalogue_union(spark, sf):
    mtx, matrix = _segments(spark, sf)
    return union_catalogues({"mtx": mtx, "matrix": matrix})


@query("replace_by_dictionary", """WITH nations AS (SELECT n_nationkey AS id, lower(n_name) AS termcode FROM nation WHERE n_regionkey <> 4)
SELECT c_custkey, coalesce(CAST(n.id AS VARCHAR), lower(m.n_name)) AS country
FROM customer JOIN nation m ON c_nationkey = m.n_nationkey LEFT JOIN nations n ON lower(m.n_name) = n.termcode""")
def replace_by_dictionary(spark, sf):
    """Known codes become ids, unknown ones stay as they are."""
    customer, nation = st.table(spark, sf, "customer"), st.table(spark, sf, "nation")
    rows = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.lower("n_name").alias("country"))
    return dims.replace_by_dictionary(rows, "country", _nation_codes(spark, sf))


@query("catalogue_load", """SELECT 'ord-' || o_orderkey AS termcode, lower(o_orderpriority) AS termextendedname,
  CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS lastupdate, CAST(NULL AS DATE) AS validto FROM orders""")
def catalogue_load(spark, sf):
    """A catalogue sheet as delivered; unreadable dates become null."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    sheet = st.table(spark, sf, "orders").select(
        F.concat(F.lit(" ORD-"), F.col("o_orderkey")).alias(" TermCode"), F.col("o_orderpriority").alias("TermExtendedName"),
        F.when(F.col("o_orderstatus") == "P", "soon").otherwise(day).alias("LastUpdate"), F.lit("").alias("ValidTo"))
    return load_catalogue(sheet)


@query("catalogue_refused", """SELECT 'c-' || o_custkey AS termcode, lower(o_orderpriority) AS termextendedname FROM orders
QUALIFY count(*) OVER (PARTITION BY o_custkey) > 1""")
def catalogue_refused(spark, sf):
    """Entries of a sheet whose code stands more than once."""
    sheet = st.table(spark, sf, "orders").select(F.concat(F.lit("C-"), F.col("o_custkey")).alias("TermCode"), F.col("o_orderpriority").alias("TermExtendedName"))
    return ingest_catalogue(sheet).refused


# --- views ----------------------------------------------------------------------------


def _star(spark, sf):
    samples = st.samples(spark, sf).select(
        F.col("sample_id").alias("sample_core_id"), F.col("samp_country_id").alias("sampcountry_id"),
        F.col("orig_country_id").alias("origcountry_id"), F.col("year").alias("sampy"))
    measurements = st.measurements(spark, sf).select(F.col("sample_id").alias("sample_core_id"), "param_id", "filetype", "evalcode", "resval")
    countries = st.countries(spark, sf).withColumnRenamed("name", "termextendedname")
    params = st.params(spark, sf).select("id", F.col("code").alias("termcode"), F.col("name").alias("termextendedname"))
    return samples, measurements, {"country": countries, "param": params}


VIEW = f"""WITH {st.SAMPLES}, {st.MEASUREMENTS}, {st.COUNTRIES}, {st.PARAMS}"""


@query("star_view", f"""{VIEW}
SELECT s.sample_id AS sample_core_id, s.samp_country_id AS sampcountry_id, s.orig_country_id AS origcountry_id, s.year AS sampy,
       a.name AS sampcountry, b.name AS origcountry
FROM samples s LEFT JOIN countries a ON s.samp_country_id = a.id LEFT JOIN countries b ON s.orig_country_id = b.id""")
def star_view(spark, sf):
    samples, _, dictionaries = _star(spark, sf)
    return star.sample_view(samples, dictionaries)


@query("sample_measurement_view", f"""{VIEW}
SELECT s.sample_id AS sample_core_id, s.year AS sampy, a.name AS sampcountry, b.name AS origcountry, m.filetype, m.evalcode, m.resval,
       p.name AS paramcodebaseparam
FROM samples s JOIN measurements m ON s.sample_id = m.sample_id LEFT JOIN countries a ON s.samp_country_id = a.id
     LEFT JOIN countries b ON s.orig_country_id = b.id LEFT JOIN params p ON m.param_id = p.id""")
def sample_measurement_view(spark, sf):
    return star.sample_measurement_view(*_star(spark, sf)).drop("sampcountry_id", "origcountry_id", "param_id")


# --- insert only what is new ----------------------------------------------------------


@query("anti_new_samples", f"""SELECT o_orderkey AS samplehash, o_custkey, o_orderstatus FROM orders
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '{LOADED_BEFORE}')""")
def anti_new_samples(spark, sf):
    orders = st.table(spark, sf, "orders")
    stored = orders.filter(F.col("o_orderdate") < F.lit(LOADED_BEFORE).cast("timestamp")).select(F.col("o_orderkey").alias("samplehash"))
    return inserts.new_samples(orders.select(F.col("o_orderkey").alias("samplehash"), "o_custkey", "o_orderstatus"), stored)


@query("files_insert_new", f"""WITH staged AS (
  SELECT {st.SQL_RELEASE} AS filename, upper({st.sql_mapped('l_returnflag', st.TYPES)}) AS filetype, CAST(year(o_orderdate) AS INTEGER) AS year,
         chr(CAST(floor(n_nationkey / 5) AS INTEGER) + 65) || chr(n_nationkey % 5 + 65) AS country_code, 22 AS nr_cols
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)
SELECT lower(filename) AS filename, lower(filetype) AS filetype, year, lower(country_code) AS country_code, nr_cols FROM staged
WHERE lower(filename) NOT IN (SELECT lower(filename) FROM staged WHERE year < 1998)""")
def files_insert_new(spark, sf):
    from .layout import inventory

    staged = inventory(spark, sf).withColumns({"filename": F.col("release"), "filetype": F.upper("filetype")})
    known = staged.filter("year < 1998").select(F.lower("filename").alias("filename"))
    return inserts.new_files(staged, known)


# A batch of staged measurements.  Line 6 carries the not-in-list parameter, line 5 an
# unknown one; results without a discount have no result id.
BATCH_SQL = """batch AS (
  SELECT l_orderkey AS sample_core_id, CASE l_linenumber WHEN 6 THEN 'rf-xxxx-xxx-xxx' WHEN 5 THEN 'gone' ELSE 'p' || l_partkey END AS code,
         CASE WHEN l_discount > 0 THEN 'r' || l_linenumber END AS resid, l_extendedprice AS resval, l_shipdate FROM lineitem),
  catalogue AS (SELECT 'p' || p_partkey AS termcode, p_partkey AS id FROM part UNION ALL SELECT 'rf-xxxx-xxx-xxx', -1),
  coded AS (SELECT b.*, c.id AS param_id FROM batch b JOIN catalogue c ON b.code = c.termcode),
  target AS (SELECT sample_core_id, param_id, resid FROM coded WHERE l_shipdate < TIMESTAMP '1997-01-01')"""
KNOWN_SQL = """SELECT sample_core_id, param_id, resid, resval FROM coded c WHERE code <> 'rf-xxxx-xxx-xxx' AND NOT EXISTS (
  SELECT 1 FROM target t WHERE t.sample_core_id = c.sample_core_id AND t.param_id = c.param_id AND t.resid = c.resid)"""
UNLISTED_SQL = """SELECT sample_core_id, param_id, resid, resval FROM coded WHERE code = 'rf-xxxx-xxx-xxx'
  AND sample_core_id NOT IN (SELECT sample_core_id FROM target)"""


def _batch(spark, sf):
    code = F.when(F.col("l_linenumber") == 6, inserts.UNLISTED_PARAM).when(F.col("l_linenumber") == 5, "gone").otherwise(F.concat(F.lit("p"), F.col("l_partkey")))
    return st.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("sample_core_id"), F.concat(F.lit("param="), code).alias("paramcodebaseparam"),
        F.when(F.col("l_discount") > 0, F.concat(F.lit("r"), F.col("l_linenumber"))).alias("resid"), F.col("l_extendedprice").alias("resval"), "l_shipdate")


def _catalogue(spark, sf):
    parts = st.table(spark, sf, "part").select(F.concat(F.lit("p"), F.col("p_partkey")).alias("termcode"), F.col("p_partkey").alias("id"))
    return parts.union(spark.range(1).select(F.lit(inserts.UNLISTED_PARAM), F.lit(-1).cast("bigint")))


def _stored(spark, sf):
    old = _batch(spark, sf).filter(F.col("l_shipdate") < F.lit("1997-01-01").cast("timestamp"))
    return inserts.code_params(old, _catalogue(spark, sf)).select("sample_core_id", "param_id", "resid")


RESULT = ["sample_core_id", "param_id", "resid", "resval"]


@query("measurement_insert_known", f"WITH {BATCH_SQL} {KNOWN_SQL}")
def measurement_insert_known(spark, sf):
    coded = inserts.code_params(_batch(spark, sf), _catalogue(spark, sf))
    return inserts.new_known_measurements(coded, _stored(spark, sf)).select(*RESULT)


@query("measurement_insert_unlisted", f"WITH {BATCH_SQL} {UNLISTED_SQL}")
def measurement_insert_unlisted(spark, sf):
    coded = inserts.code_params(_batch(spark, sf), _catalogue(spark, sf))
    return inserts.new_unlisted_measurements(coded, _stored(spark, sf)).select(*RESULT)


@query("measurement_insert", f"WITH {BATCH_SQL} {KNOWN_SQL} UNION ALL {UNLISTED_SQL}")
def measurement_insert(spark, sf):
    return inserts.new_measurements(_batch(spark, sf), _catalogue(spark, sf), _stored(spark, sf)).select(*RESULT)


# The same batch with the file of each sample and a number of each row.
_NR = "concat_ws('-', l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INTEGER), strftime(l_shipdate, '%Y%m%d'), CAST(round(l_extendedprice * 100) AS BIGINT))"
JUDGED_SQL = f"""{BATCH_SQL.replace("l_shipdate FROM lineitem)", f"l_shipdate, l_orderkey % 40 AS file_id, {_NR} AS measurement_nr FROM lineitem)")},
  judged AS (SELECT b.sample_core_id, b.code, c.id AS param_id, b.resid, b.resval, b.file_id, b.measurement_nr,
    CASE WHEN c.id IS NULL THEN 'unknown_param'
      WHEN b.code = 'rf-xxxx-xxx-xxx' AND b.sample_core_id IN (SELECT sample_core_id FROM target) THEN 'stored'
      WHEN b.code <> 'rf-xxxx-xxx-xxx' AND EXISTS (SELECT 1 FROM target t WHERE t.sample_core_id = b.sample_core_id AND t.param_id = c.id AND t.resid = b.resid) THEN 'stored'
      WHEN b.resid IS NOT NULL AND row_number() OVER (PARTITION BY b.sample_core_id, c.id, b.resid ORDER BY b.file_id, b.measurement_nr) > 1 THEN 'repeated' END AS verdict
  FROM batch b LEFT JOIN catalogue c ON b.code = c.termcode)"""


def _loaded(spark, sf):
    line = st.table(spark, sf, "lineitem")
    code = F.when(F.col("l_linenumber") == 6, inserts.UNLISTED_PARAM).when(F.col("l_linenumber") == 5, "gone").otherwise(F.concat(F.lit("p"), F.col("l_partkey")))
    number = F.concat_ws(
        "-", *[F.col(c).cast("string") for c in ("l_linenumber", "l_partkey", "l_suppkey")], F.col("l_quantity").cast("int").cast("string"),
        F.date_format("l_shipdate", "yyyyMMdd"), F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string"))
    batch = line.select(
        F.col("l_orderkey").alias("sample_core_id"), F.concat(F.lit("param="), code).alias("paramcodebaseparam"),
        F.when(F.col("l_discount") > 0, F.concat(F.lit("r"), F.col("l_linenumber"))).alias("resid"), F.col("l_extendedprice").alias("resval"),
        (F.col("l_orderkey") % 40).alias("file_id"), number.alias("measurement_nr"), "l_shipdate")
    old = batch.filter(F.col("l_shipdate") < F.lit("1997-01-01").cast("timestamp"))
    stored = inserts.code_params(old, _catalogue(spark, sf)).select("sample_core_id", "param_id", "resid", "file_id")
    return loads.load_measurements(batch.drop("l_shipdate"), {"param": _catalogue(spark, sf)}, stored)


@query("measurement_load", f"WITH {JUDGED_SQL} SELECT sample_core_id, param_id, resid, resval, file_id, measurement_nr FROM judged WHERE verdict IS NULL")
def measurement_load(spark, sf):
    """The rows that a whole load appends: unknown, stored and repeated ones are gone."""
    return _loaded(spark, sf).rows.select(*RESULT, "file_id", "measurement_nr")


@query("measurement_load_rejected", f"WITH {JUDGED_SQL} SELECT sample_core_id, 'param=' || code AS paramcodebaseparam, resid, file_id, measurement_nr, verdict FROM judged WHERE verdict IN ('unknown_param', 'repeated')")
def measurement_load_rejected(spark, sf):
    return _loaded(spark, sf).rejected.select("sample_core_id", "paramcodebaseparam", "resid", "file_id", "measurement_nr", "verdict")


@query("sample_rest_insert", """WITH staged AS (
  SELECT o_orderkey, 1 AS column_metainfo_id, o_orderstatus AS value FROM orders
  UNION ALL SELECT o_orderkey, 2, o_orderpriority FROM orders)
SELECT o_orderkey AS sample_core_id, column_metainfo_id, value FROM staged
WHERE o_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01')
  AND o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '2-HIGH')""")
def sample_rest_insert(spark, sf):
    """A third attribute is not registered; old samples are not stored; samples of one
    priority have an attribute already and are closed."""
    orders = st.table(spark, sf, "orders").withColumn("samplehash", F.md5(F.col("o_orderkey").cast("string")))
    staged = reshape.to_long(orders, ["samplehash"], ["o_orderstatus", "o_orderpriority", "o_custkey"])
    core = orders.filter(F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp")).select("samplehash", F.col("o_orderkey").alias("id"))
    registered = {"o_orderstatus": 1, "o_orderpriority": 2}
    existing = orders.filter("o_orderpriority = '2-HIGH'").select(F.col("o_orderkey").alias("sample_core_id"))
    return inserts.new_sample_attributes(staged, core, registered, existing)


@query("reconstruct_wide", """SELECT l_orderkey AS sample_core_id, l_suppkey AS file_id, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INTEGER), strftime(l_shipdate, '%Y%m%d'), CAST(round(l_extendedprice * 100) AS BIGINT)) AS measurement_nr, l_extendedprice AS resval,
  o_orderstatus AS status, nullif(o_orderpriority, '5-LOW') AS priority, l_linestatus AS linestatus, nullif(l_returnflag, 'N') AS returnflag
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def reconstruct_wide(spark, sf):
    """Core rows with both attribute tables pivoted back on."""
    number = F.concat_ws(
        "-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
        F.col("l_quantity").cast("int").cast("string"), F.date_format("l_shipdate", "yyyyMMdd"), F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string"))
    line = st.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("sample_core_id"), F.col("l_suppkey").alias("file_id"), number.alias("measurement_nr"),
        F.col("l_extendedprice").alias("resval"), F.col("l_linestatus").alias("linestatus"), F.nullif("l_returnflag", F.lit("N")).alias("returnflag"))
    orders = st.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("sample_core_id"), F.col("o_orderstatus").alias("status"), F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"))
    ids = ["file_id", "measurement_nr"]
    return compare.reconstruct_wide(
        line.select("sample_core_id", *ids, "resval"), reshape.to_long(orders, ["sample_core_id"], ["status", "priority"], "columnname"),
        reshape.to_long(line, ids, ["linestatus", "returnflag"], "columnname"), ["status", "priority"], ["linestatus", "returnflag"])
