"""Cell and column cleaning, de-duplication and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import filenames as fn
from ..functions.columns import RELEASE_RENAMES, clean_columns
from ..functions.identity import tuple_hash
from ..functions.numbers import half_up_int, zero_to_null
from ..functions.text import clean_text, null_sentinels, strip_prefix
from ..operators import cleaning as ops
from ..operators import dedup, numbering, reshape
from ..operators.compare import column_set_diff
from . import standin as st
from .registry import query

# --- cells ----------------------------------------------------------------------------


@query("normalise_text", """SELECT doc_id, md5(trim(lower(text), chr(9) || chr(10) || chr(13) || chr(32) || chr(160) || chr(8195))) AS text_md5,
  lower(source) AS source FROM documents""")
def normalise_text(spark, sf):
    """Whole document texts, wrapped in white space, lower-cased and stripped.  Compared by md5."""
    wrapped = F.concat(F.lit("\t  "), F.col("text"), F.lit(" \n"))
    messy = st.table(spark, sf, "documents").select("doc_id", wrapped.alias("text"), F.concat(F.lit(" "), F.upper("source"), F.lit("\r")).alias("source"))
    cleaned = ops.clean_cells(messy)
    return cleaned.select("doc_id", F.md5("text").alias("text_md5"), "source")


@query("null_sentinels", """SELECT event_id, CASE WHEN event_type NOT IN ('error', 'view') THEN event_type END AS event_type, props
FROM events""")
def sentinels(spark, sf):
    """``N_A`` and ``NaN`` in place of two event types become null."""
    spelled = F.when(F.col("event_type") == "error", "N_A").when(F.col("event_type") == "view", " NaN ").otherwise(F.col("event_type"))
    return st.table(spark, sf, "events").select("event_id", null_sentinels(clean_text(spelled)).alias("event_type"), "props")


@query("zero_to_null", "SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax FROM lineitem")
def zeros(spark, sf):
    line = st.table(spark, sf, "lineitem")
    return line.select("l_orderkey", "l_linenumber", *[zero_to_null(F.col(c)).alias(c) for c in ("l_discount", "l_tax")])


@query("strip_prefix", "SELECT event_id, event_type AS code FROM events")
def prefix(spark, sf):
    marked = F.when(F.col("event_type") != "click", F.concat(F.lit("param="), F.col("event_type"))).otherwise(F.col("event_type"))
    return st.table(spark, sf, "events").select("event_id", strip_prefix(marked).alias("code"))


@query("numeric_to_int", "SELECT l_orderkey, l_linenumber, CAST(round(l_quantity / 2) AS INTEGER) AS half, CAST(round(-l_quantity / 2) AS INTEGER) AS minus_half FROM lineitem")
def rounding(spark, sf):
    """Half quantities hit every tie; ties go away from zero."""
    half = F.col("l_quantity") / 2
    return st.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", half_up_int(half).alias("half"), half_up_int(-half).alias("minus_half"))


@query("file_type", f"""SELECT release, count(*) AS n, {st.sql_mapped('l_returnflag', st.TYPES)} AS filetype
FROM (SELECT l_returnflag, {st.SQL_RELEASE} AS release FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) GROUP BY release, l_returnflag""")
def file_types(spark, sf):
    names = _release_names(spark, sf)
    return names.groupBy("release").agg(F.count(F.lit(1)).alias("n")).withColumn("filetype", fn.file_type(F.col("release")))


@query("parse_filename", f"""SELECT DISTINCT release, CAST(year(o_orderdate) AS INTEGER) AS year, split_part(replace(release, '.ZIP', ''), '_', 3) AS country_code
FROM (SELECT o_orderdate, {st.SQL_RELEASE} AS release FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)""")
def parse_names(spark, sf):
    names = _release_names(spark, sf).distinct()
    return names.select("release", fn.release_year(F.col("release")).alias("year"), fn.release_country(F.col("release")).alias("country_code"))


def _release_names(spark, sf):
    line, orders, customer, nation = (st.table(spark, sf, t) for t in ("lineitem", "orders", "customer", "nation"))
    return (
        line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(st.release_name().alias("release"))
    )


@query("sample_hash", f"""WITH cells AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus || '|' END AS status,
  CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderpriority END AS priority, CAST(o_custkey AS VARCHAR) AS cust FROM orders)
SELECT o_orderkey, md5({st.sql_tuple('status', 'priority', 'cust')}) AS hash FROM cells""")
def hashes(spark, sf):
    """Nulls, empty texts and separators inside values all keep tuples apart."""
    orders = st.table(spark, sf, "orders")
    status = F.when(F.col("o_orderstatus") != "P", F.concat(F.col("o_orderstatus"), F.lit("|")))
    priority = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("")).otherwise(F.col("o_orderpriority"))
    return orders.select("o_orderkey", tuple_hash([status, priority, F.col("o_custkey")]).alias("hash"))


# --- columns --------------------------------------------------------------------------


@query("clean_columns", "SELECT o_orderkey AS order_key, o_custkey AS customer_nr, o_orderstatus AS status, o_totalprice AS total_price FROM orders")
def column_names(spark, sf):
    messy = st.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias(" Order Key"), F.col("o_custkey").alias("Customer Nr.?_A"),
        F.col("o_orderstatus").alias("(Status)"), F.col("o_totalprice").alias("Total Price_A "))
    return clean_columns(messy, drop_tags=True)


@query("harmonise_columns", """SELECT 's-' || o_orderkey AS sampid, lower(o_orderpriority) AS sampstrategy, CAST(year(o_orderdate) AS INTEGER) AS sampy,
  CAST(NULL AS VARCHAR) AS progid FROM orders""")
def harmonised(spark, sf):
    """Old names to new ones, unknown columns dropped, missing ones added as nulls."""
    old = st.table(spark, sf, "orders").select(
        F.concat(F.lit("s-"), F.col("o_orderkey")).alias("LabSampCode"), F.lower("o_orderpriority").alias("ProgSampStrategy_A"),
        F.year("o_orderdate").alias("SampY"), F.col("o_totalprice").alias("Not Registered"))
    known = ["sampid", "progid", "sampstrategy", "sampy"]
    return ops.add_missing(ops.harmonise(old, RELEASE_RENAMES, known), known)


@query("cast_by_registry", """SELECT l_orderkey, CAST(l_linenumber AS INTEGER) AS whole, l_extendedprice AS price,
  CASE WHEN l_linenumber <> 3 THEN l_discount END AS discount, CAST(l_suppkey AS VARCHAR) AS supplier FROM lineitem""")
def registered_casts(spark, sf):
    """Malformed numbers become null instead of failing the job."""
    text = st.table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").alias("whole"), F.col("l_extendedprice").cast("string").alias("price"),
        F.when(F.col("l_linenumber") == 3, "x").otherwise(F.col("l_discount").cast("string")).alias("discount"), F.col("l_suppkey").alias("supplier"))
    return ops.cast_by_registry(text, {"whole": "number", "price": "number", "discount": "number", "supplier": "text"})


@query("drop_all_null_columns", "SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders")
def filled_columns(spark, sf):
    return ops.drop_all_null_columns(st.table(spark, sf, "orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"), F.nullif("o_custkey", F.col("o_custkey")).alias("never")))


@query("best_effort_cast", "SELECT CAST(l_orderkey AS DOUBLE) AS l_orderkey, l_quantity, l_linestatus || '1' AS mixed FROM lineitem")
def guessed_casts(spark, sf):
    """A column is a number only if every one of its values is."""
    return ops.best_effort_cast(st.table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_quantity").cast("string").alias("l_quantity"), F.concat("l_linestatus", F.lit("1")).alias("mixed")))


@query("column_set_diff", """SELECT 'custkey' AS "column", 'original' AS only_in FROM orders HAVING count(o_custkey) > 0
UNION ALL SELECT 'partkey', 'warehouse' FROM lineitem HAVING count(l_partkey) > 0
UNION ALL SELECT 'unknown', 'original' FROM orders HAVING count(CASE WHEN o_orderstatus = '?' THEN 1 END) > 0
UNION ALL SELECT 'unused', 'warehouse' FROM lineitem HAVING count(CASE WHEN l_quantity < 0 THEN 1 END) > 0""")
def schema_differences(spark, sf):
    """Columns that only one side has, after columns without any value are dropped."""
    original = st.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("orderkey"), F.col("o_custkey").alias("custkey"), F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderstatus") == "?", 1).alias("unknown"))
    warehouse = st.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), F.col("l_partkey").alias("partkey"), F.col("l_linestatus").alias("status"),
        F.when(F.col("l_quantity") < 0, 1).alias("unused"))
    return column_set_diff(spark, ops.drop_all_null_columns(original).columns, ops.drop_all_null_columns(warehouse).columns)


@query("union_by_name", """SELECT o_orderkey AS id, o_orderstatus AS status, CAST(NULL AS DOUBLE) AS quantity FROM orders
UNION ALL SELECT l_orderkey, NULL, l_quantity FROM lineitem""")
def united(spark, sf):
    return st.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status")).unionByName(
        st.table(spark, sf, "lineitem").select(F.col("l_quantity").alias("quantity"), F.col("l_orderkey").alias("id")), allowMissingColumns=True)


# --- duplicates -----------------------------------------------------------------------

LINE_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query("dedup_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus, year(l_shipdate) AS year FROM lineitem")
def distinct_rows(spark, sf):
    return st.table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus", F.year("l_shipdate").cast("long").alias("year")).dropDuplicates()


@query("dedup_after_nulling", "SELECT DISTINCT l_suppkey, nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax, l_returnflag AS file FROM lineitem")
def distinct_after_nulling(spark, sf):
    """The file is one of the columns, so equal rows of two files both stay."""
    rows = st.table(spark, sf, "lineitem").select("l_suppkey", "l_discount", "l_tax", F.col("l_returnflag").alias("file"))
    return ops.zeros_to_null(rows, ["l_discount", "l_tax"]).dropDuplicates()


@query("duplicate_rows", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(LINE_ORDER)}) AS rn FROM lineitem) WHERE rn > 1""")
def repeats(spark, sf):
    copies = dedup.later_copies(st.table(spark, sf, "lineitem").select(*dict.fromkeys(["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *LINE_ORDER])), ["l_orderkey", "l_linenumber"], LINE_ORDER)
    return copies.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


FILE_OF = "l_suppkey || '-' || l_returnflag || '-' || year(l_shipdate)"


@query("skip_bad_files", f"""WITH rows AS (SELECT *, {FILE_OF} AS file FROM lineitem),
  bad AS (SELECT DISTINCT file FROM (SELECT file, l_orderkey, l_linenumber FROM rows GROUP BY ALL HAVING count(*) > 1))
SELECT file, l_orderkey, l_linenumber, l_partkey FROM rows WHERE file NOT IN (SELECT file FROM bad)""")
def good_files(spark, sf):
    file = F.concat_ws("-", F.col("l_suppkey").cast("string"), "l_returnflag", F.year("l_shipdate").cast("string"))
    rows = st.table(spark, sf, "lineitem").select(file.alias("file"), "l_orderkey", "l_linenumber", "l_partkey")
    return dedup.split_bad_files(rows, ["l_orderkey", "l_linenumber"])[0]


@query("repair_duplicates", """WITH ids AS (SELECT DISTINCT l_suppkey FROM (
    SELECT l_suppkey, l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL HAVING count(*) > 1))
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag,
       CASE WHEN l_returnflag = 'R' AND l_suppkey IN (SELECT l_suppkey FROM ids) THEN 'g050a' ELSE l_linestatus END AS l_linestatus FROM lineitem""")
def repaired(spark, sf):
    """In one file, all rows of an id with repeated keys get the same value in one column."""
    rows = st.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    return dedup.repair_duplicates(
        rows, ["l_suppkey", "l_orderkey", "l_linenumber"], "l_suppkey", "l_linestatus", F.lit("g050a"), F.col("l_returnflag") == "R")


@query("measurement_numbers", f"""SELECT l_returnflag AS file, l_orderkey, l_linenumber, l_partkey,
  row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, {', '.join(c for c in LINE_ORDER if c != 'l_returnflag')}) AS measurement_nr FROM lineitem""")
def measurement_numbers(spark, sf):
    """Three files, so each holds a third of all rows: numbered without one task per file."""
    order = ["l_orderkey", "l_linenumber", *[c for c in LINE_ORDER if c != "l_returnflag"]]
    rows = st.table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "file")
    return numbering.number_rows(rows, ["file"], order, "measurement_nr").select("file", "l_orderkey", "l_linenumber", "l_partkey", "measurement_nr")


# --- reshaping ------------------------------------------------------------------------

REST = ("o_orderstatus", "o_orderpriority", "o_custkey")


@query("sample_rest_unpivot", """SELECT o_orderkey, variable, value FROM (
  SELECT o_orderkey, 'o_orderstatus' AS variable, nullif(o_orderstatus, 'P') AS value FROM orders
  UNION ALL SELECT o_orderkey, 'o_orderpriority', o_orderpriority FROM orders
  UNION ALL SELECT o_orderkey, 'o_custkey', CAST(o_custkey AS VARCHAR) FROM orders) WHERE value IS NOT NULL""")
def sample_attributes(spark, sf):
    orders = st.table(spark, sf, "orders").withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    return reshape.to_long(orders, ["o_orderkey"], REST)


@query("measurement_rest_unpivot", """SELECT l_orderkey, l_linenumber, l_partkey, columnname, value FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, 'l_linestatus' AS columnname, l_linestatus AS value FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'l_suppkey', CAST(nullif(l_suppkey, 7) AS VARCHAR) FROM lineitem) WHERE value IS NOT NULL""")
def measurement_attributes(spark, sf):
    line = st.table(spark, sf, "lineitem").withColumn("l_suppkey", F.nullif("l_suppkey", F.lit(7)))
    return reshape.to_long(line, ["l_orderkey", "l_linenumber", "l_partkey"], ["l_linestatus", "l_suppkey"], "columnname")


@query("eav_pivot", """SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus, o_orderpriority, CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders""")
def pivoted(spark, sf):
    """Long form and back: the original cells."""
    return reshape.to_wide(sample_attributes(spark, sf), ["o_orderkey"], REST, name="variable")
