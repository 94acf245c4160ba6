"""Data-quality reports and comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import compare, quality, reshape
from . import standin as st
from .registry import query


@query("invalid_codes", """SELECT DISTINCT value, col AS "column", cat AS catalogue FROM (
  SELECT event_type AS value, 'event_type' AS col, 'kinds' AS cat FROM events
  WHERE event_type NOT IN (SELECT event_type FROM events WHERE value > 0 AND event_type < 'f')
  UNION ALL SELECT source, 'source', 'mtx' FROM (SELECT 'src' || (user_id % 25) AS source FROM events) WHERE source NOT IN (SELECT source FROM documents)) AS x(value, col, cat)""")
def invalid_codes(spark, sf):
    """Two coded columns checked against their catalogues in one pass."""
    events, documents = st.table(spark, sf, "events"), st.table(spark, sf, "documents")
    rows = events.select("event_type", F.concat(F.lit("src"), (F.col("user_id") % 25).cast("string")).alias("source"))
    kinds = events.filter("value > 0 and event_type < 'f'").select(F.col("event_type").alias("termcode")).distinct()
    sources = documents.select(F.col("source").alias("termcode")).distinct()
    return quality.invalid_codes(rows, {"event_type": kinds, "source": sources}, {"event_type": "kinds", "source": "mtx"})


@query("fk_violations", """SELECT "column", value, n FROM (
  SELECT 'l_partkey' AS "column", CAST(l_partkey AS VARCHAR) AS value, count(*) AS n FROM lineitem
  WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_type <> 'PROMO') GROUP BY l_partkey
  UNION ALL SELECT 'l_suppkey', CAST(l_suppkey AS VARCHAR), count(*) FROM lineitem
  WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY l_suppkey)""")
def fk_violations(spark, sf):
    """Parts and suppliers that are missing from shortened dictionaries."""
    parts = st.table(spark, sf, "part").filter("p_type <> 'PROMO'").select(F.col("p_partkey").alias("id"))
    suppliers = st.table(spark, sf, "supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("id"))
    return quality.fk_violations(st.table(spark, sf, "lineitem"), {"l_partkey": parts, "l_suppkey": suppliers})


@query("unique_violations", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def unique_violations(spark, sf):
    return quality.unique_violations(st.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("not_null_violations", """SELECT * FROM (
  SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, nullif(o_orderpriority, '5-LOW') AS priority,
         concat_ws(',', CASE WHEN o_orderstatus = 'P' THEN 'status' END, CASE WHEN o_orderpriority = '5-LOW' THEN 'priority' END) AS missing FROM orders)
WHERE missing <> ''""")
def not_null_violations(spark, sf):
    rows = st.table(spark, sf, "orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"), F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"))
    return quality.not_null_violations(rows, ["status", "priority"])


@query("domain_violations", "SELECT event_type, count(*) AS n FROM events WHERE event_type NOT IN ('click', 'view') GROUP BY event_type")
def domain_violations(spark, sf):
    return quality.domain_violations(st.table(spark, sf, "events"), "event_type", ["click", "view"])


@query("orphan_check", """SELECT l_returnflag || '-' || year(l_shipdate) AS file, count(*) AS n FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY 1""")
def orphan_check(spark, sf):
    file = F.concat_ws("-", "l_returnflag", F.year("l_shipdate").cast("string"))
    rows = st.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("sample"), file.alias("file"))
    parents = st.table(spark, sf, "orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("sample"))
    return quality.orphans_by_file(rows, parents, "sample")


@query("unmatched_keys", """WITH rows AS (SELECT o_orderpriority, nullif(o_orderstatus, 'P') AS status, CAST(o_custkey AS VARCHAR) AS cust FROM orders),
  lookup AS (SELECT * FROM rows WHERE o_orderpriority <> '5-LOW' AND cust < '5'),
  failed AS (SELECT * FROM rows r WHERE NOT EXISTS (SELECT 1 FROM lookup l WHERE l.o_orderpriority IS NOT DISTINCT FROM r.o_orderpriority
    AND l.status IS NOT DISTINCT FROM r.status AND l.cust IS NOT DISTINCT FROM r.cust))
SELECT "column", value, count(*) AS n FROM (
  SELECT 'o_orderpriority' AS "column", o_orderpriority AS value FROM failed WHERE o_orderpriority NOT IN (SELECT o_orderpriority FROM lookup)
  UNION ALL SELECT 'status', status FROM failed WHERE status IS NOT NULL AND status NOT IN (SELECT status FROM lookup WHERE status IS NOT NULL)
  UNION ALL SELECT 'cust', cust FROM failed WHERE cust NOT IN (SELECT cust FROM lookup)) GROUP BY ALL""")
def unmatched_keys(spark, sf):
    rows = st.table(spark, sf, "orders").select(
        "o_orderpriority", F.nullif("o_orderstatus", F.lit("P")).alias("status"), F.col("o_custkey").cast("string").alias("cust"))
    return quality.unmatched_keys(rows, rows.filter("o_orderpriority <> '5-LOW' and cust < '5'"), ["o_orderpriority", "status", "cust"])


@query("nullsafe_multikey_join", """WITH rows AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, nullif(o_orderpriority, '5-LOW') AS priority,
  nullif(o_custkey, 5) AS cust, year(o_orderdate) AS year FROM orders)
SELECT a.status, a.priority, a.cust, a.year, a.n, b.last FROM
  (SELECT status, priority, cust, year, count(*) AS n FROM rows GROUP BY ALL) a JOIN
  (SELECT status, priority, cust, year, max(o_orderkey) AS last FROM rows GROUP BY ALL) b
  ON a.status IS NOT DISTINCT FROM b.status AND a.priority IS NOT DISTINCT FROM b.priority AND a.cust IS NOT DISTINCT FROM b.cust AND a.year IS NOT DISTINCT FROM b.year""")
def nullsafe_join(spark, sf):
    keys = ["status", "priority", "cust", "year"]
    rows = st.table(spark, sf, "orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"), F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        F.nullif("o_custkey", F.lit(5)).alias("cust"), F.year("o_orderdate").cast("long").alias("year"))
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return compare.nullsafe_join(counts, rows.groupBy(*keys).agg(F.max("o_orderkey").alias("last")), keys)


def _cells(spark, sf):
    """Orders as cells, original and with some values changed or missing."""
    orders = st.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    changed = orders.select(
        "o_orderkey", F.when(F.col("o_orderpriority") == "1-URGENT", "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.nullif(F.when(F.col("o_orderstatus") == "F", F.lower("o_orderpriority")).otherwise(F.col("o_orderpriority")), F.lit("5-LOW")).alias("o_orderpriority"))
    columns = ["o_orderstatus", "o_orderpriority"]
    return [reshape.to_long(df, ["o_orderkey"], columns) for df in (orders, changed)]


DIFFERENCES = """WITH diffs AS (
  SELECT o_orderkey, 'o_orderstatus' AS variable, o_orderstatus AS value_x, 'X' AS value_y FROM orders WHERE o_orderpriority = '1-URGENT'
  UNION ALL SELECT o_orderkey, 'o_orderpriority', o_orderpriority, lower(o_orderpriority) FROM orders WHERE o_orderstatus = 'F')"""


@query("compare_values", f"{DIFFERENCES} SELECT * FROM diffs WHERE value_x <> value_y")
def compare_values(spark, sf):
    return compare.compare_values(*_cells(spark, sf), ["o_orderkey"])


@query("diff_value_counts", f"{DIFFERENCES} SELECT variable, count(*) AS n FROM diffs WHERE value_x <> value_y GROUP BY variable")
def diff_value_counts(spark, sf):
    diffs = compare.compare_values(*_cells(spark, sf), ["o_orderkey"])
    return diffs.groupBy("variable").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc())
