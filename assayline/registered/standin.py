"""How the given tables stand in for the warehouse.

=====================  =================================================================
sample                 ``orders``; year of ``o_orderdate``; strategy from ``o_orderpriority``
sampling country       nation of the customer
origin country         a nation derived from the customer key, sometimes missing
measurement            ``lineitem``; type from ``l_returnflag``; result from ``l_linenumber``
parameter              ``part``, with a three-level hierarchy made from ``p_brand``
product                market segment, or part/supplier where a hierarchy is needed
=====================  =================================================================

Each table has a SQL twin, a common table expression that the oracles start from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


TYPES = {"A": "chemical", "N": "pesticides", "R": "vmpr"}
STRATEGIES = {
    "1-URGENT": "suspect sampling", "2-HIGH": "selective sampling", "3-MEDIUM": "objective sampling",
    "4-NOT SPECIFIED": None, "5-LOW": "census",
}
RESULTS = (
    "less than or equal to maximum permissible quantities", "greater than maximum permissible quantities",
    "compliant", "satisfactory", "not detected", None, "non compliant",
)
GROUPS = (
    "nutrients", "toxins", "not in list",
    "persistent organic pollutants (pops) and other organic contaminants",
    "chemical elements (including derivatives) and others",
)
# Names that the exceedance questions look at.
CHOSEN = (
    "red widget", "old bolt", "red gear", "blue gizmo", "cold ring", "cold gear", "hot ring",
    "blue anvil", "cold gizmo", "large bolt", "new widget", "blue plate", "new plate",
)
MARKERS = {"A": "OCC", "N": "MOPER", "R": "VMPR"}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def mapped(c: Column, values: dict[str, str | None]) -> Column:
    out = None
    for key, value in values.items():
        out = F.when(c == key, F.lit(value)) if out is None else out.when(c == key, F.lit(value))
    return out


def sql_mapped(c: str, values: dict) -> str:
    quoted = lambda v: "NULL" if v is None else "'" + str(v) + "'"
    return "CASE " + c + " " + " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in values.items()) + " END"


def sql_list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


# --- star -----------------------------------------------------------------------------


def samples(spark: SparkSession, sf: str) -> DataFrame:
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        F.col("o_orderkey").alias("sample_id"),
        F.col("c_nationkey").alias("samp_country_id"),
        F.nullif(F.col("o_custkey") % 25, F.lit(7)).cast("int").alias("orig_country_id"),
        mapped(F.col("o_orderpriority"), STRATEGIES).alias("strategy"),
        F.year("o_orderdate").alias("year"),
        F.col("c_mktsegment").alias("product_id"),
    )


SAMPLES = f"""samples AS (
  SELECT o_orderkey AS sample_id, c_nationkey AS samp_country_id,
         CAST(nullif(o_custkey % 25, 7) AS INTEGER) AS orig_country_id,
         {sql_mapped('o_orderpriority', STRATEGIES)} AS strategy,
         CAST(year(o_orderdate) AS INTEGER) AS year, c_mktsegment AS product_id
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey)"""


def measurements(spark: SparkSession, sf: str) -> DataFrame:
    results = F.array(*[F.lit(r) for r in RESULTS])
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("sample_id"),
        F.col("l_partkey").alias("param_id"),
        mapped(F.col("l_returnflag"), TYPES).alias("filetype"),
        F.get(results, F.col("l_linenumber") - 1).alias("evalcode"),
        F.col("l_extendedprice").alias("resval"),
        F.col("l_discount").alias("resloq"),
    )


def measurements_of(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """Measurements of one type; the filter is on the stored column, so the scan takes it."""
    flag = next(k for k, v in TYPES.items() if v == kind)
    results = F.array(*[F.lit(r) for r in RESULTS])
    return table(spark, sf, "lineitem").filter(F.col("l_returnflag") == flag).select(
        F.col("l_orderkey").alias("sample_id"), F.col("l_partkey").alias("param_id"),
        F.lit(kind).alias("filetype"), F.get(results, F.col("l_linenumber") - 1).alias("evalcode"),
    )


MEASUREMENTS = f"""measurements AS (
  SELECT l_orderkey AS sample_id, l_partkey AS param_id,
         {sql_mapped('l_returnflag', TYPES)} AS filetype,
         {sql_mapped('CAST(l_linenumber AS VARCHAR)', {str(i + 1): r for i, r in enumerate(RESULTS)})} AS evalcode,
         l_extendedprice AS resval, l_discount AS resloq
  FROM lineitem)"""

POSITIVE = "evalcode IN ('greater than maximum permissible quantities', 'non compliant', 'unsatisfactory', 'detected')"


def countries(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("id"), F.lower("n_name").alias("termcode"), F.lower("n_name").alias("name")
    )


COUNTRIES = "countries AS (SELECT n_nationkey AS id, lower(n_name) AS name FROM nation)"


def _brand_number() -> Column:
    return F.substr("p_brand", F.lit(7)).cast("int")


def _group_number() -> Column:
    return F.floor((_brand_number() - 1) / 5).cast("int") + 1


def params(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.concat_ws(".", _group_number(), _brand_number(), "p_partkey").alias("code"),
    )


def param_terms(spark: SparkSession, sf: str) -> DataFrame:
    """Every node of the parameter hierarchy: groups, brands and parts."""
    part = table(spark, sf, "part")
    brands = part.select(
        F.concat_ws(".", _group_number(), _brand_number()).alias("code"), F.lower("p_brand").alias("name")
    ).distinct()
    groups = part.select(
        _group_number().cast("string").alias("code"),
        F.get(F.array(*[F.lit(g) for g in GROUPS]), _group_number() - 1).alias("name"),
    ).distinct()
    return params(spark, sf).select("code", "name").unionByName(brands).unionByName(groups)


_N = "CAST(substr(p_brand, 7) AS INTEGER)"
_G = f"CAST(floor(({_N} - 1) / 5) + 1 AS INTEGER)"
_GROUP_NAME = sql_mapped(f"CAST({_G} AS VARCHAR)", {str(i + 1): g for i, g in enumerate(GROUPS)})
PARAMS = f"""params AS (
  SELECT p_partkey AS id, p_name AS name, {_G} || '.' || {_N} || '.' || p_partkey AS code,
         {_GROUP_NAME} AS lev1, lower(p_brand) AS lev2, p_name AS lev3,
         {_GROUP_NAME} || '::' || lower(p_brand) || '::' || p_name AS full_name
  FROM part)"""


# --- raw releases ---------------------------------------------------------------------


def raw_release(spark: SparkSession, sf: str) -> DataFrame:
    """Release rows as they would be delivered: old names, upper case, blanks, sentinels.

    One row per measurement, with the sample's columns repeated, all cells text.
    """
    line, orders, customer, nation = (table(spark, sf, t) for t in ("lineitem", "orders", "customer", "nation"))
    columns = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus"]
    # Orders meet their customers while they are one row each, so measurements are shuffled once at most.
    ordered = orders.join(customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")), F.col("o_custkey") == F.col("c_custkey"))
    joined = line.select(*columns).join(ordered, F.col("l_orderkey") == F.col("o_orderkey"))
    text = lambda c: (F.col(c) if isinstance(c, str) else c).cast("string")
    origin = F.nullif(F.col("o_custkey") % 25, F.lit(7))
    release = release_name()
    cells = {
        "LabSampCode_A": F.concat(F.lit("  S-"), text("o_orderkey"), F.lit("\t")),
        "ProgCode_A": F.when(F.col("o_orderstatus") == "P", F.lit("N_A")).otherwise(F.concat(F.lit("PR "), F.col("o_orderstatus"))),
        "SampCountry": F.concat(F.upper("n_name"), F.lit(" ")),
        "OrigCountry": F.coalesce(F.concat(F.lit("NATION_"), text(origin)), F.lit("nan")),
        "ProdCode": F.col("c_mktsegment"),
        "ProgSampStrategy": F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("N_A")).otherwise(F.col("o_orderpriority")),
        "SampY": text(F.year("o_orderdate")), "SampM": text(F.month("o_orderdate")), "SampD": text(F.day("o_orderdate")),
        "AnalysisY": text(F.year("o_orderdate")), "AnalysisM": text(F.month("o_orderdate")),
        "AnalysisD": F.when(F.col("o_orderstatus") == "F", F.lit("0")).otherwise(text(F.day("o_orderdate"))),
        "ProdY": F.when(F.col("o_orderstatus") == "O", F.lit("0")).otherwise(text(F.year("o_orderdate") - 1)),
        "RepYear": F.concat(text(F.year("o_orderdate")), F.lit(".0")),
        "ProdText": F.concat(F.lit(" Text "), F.col("o_orderpriority")),
        "ParamCode": F.concat(F.lit("PARAM=P"), text("l_partkey")),
        "ResultCode": F.concat(F.lit("R"), text("l_linenumber")),
        "ResVal": text("l_extendedprice"), "ResLOQ": text("l_discount"),
        "ResEvaluation": F.when(F.col("l_linenumber") == 6, F.lit("N_A")).otherwise(F.concat(F.lit("EV"), text("l_linenumber"))),
        "ResLegalLimitType": F.col("l_linestatus"),
        "AnMethCode": F.when(F.col("l_quantity") < 10, F.lit("nan")).otherwise(F.concat(F.lit("M"), text(F.col("l_quantity").cast("int")))),
    }
    return joined.select(
        *[c.alias(n) for n, c in cells.items()], release.alias("release"), F.lower(release).alias("file"),
        mapped(F.col("l_returnflag"), TYPES).alias("filetype"),
    )


def release_name() -> Column:
    """``OCC_1997_AB.ZIP``: type, year and a two-letter code of the sampling country."""
    letters = F.concat(F.char(F.floor(F.col("n_nationkey") / 5) + 65), F.char(F.col("n_nationkey") % 5 + 65))
    return F.concat_ws("_", mapped(F.col("l_returnflag"), MARKERS), F.year("o_orderdate").cast("string"), F.concat(letters, F.lit(".ZIP")))


SQL_RELEASE = (
    f"({sql_mapped('l_returnflag', MARKERS)} || '_' || year(o_orderdate) || '_' || "
    "chr(CAST(floor(n_nationkey / 5) AS INTEGER) + 65) || chr(n_nationkey % 5 + 65) || '.ZIP')"
)

# Cleaned release rows, straight from the tables.
RELEASE = f"""release AS (
  SELECT 's-' || o_orderkey AS sampid,
         CASE WHEN o_orderstatus <> 'P' THEN 'pr ' || lower(o_orderstatus) END AS progid,
         lower(n_name) AS sampcountry,
         'nation_' || nullif(o_custkey % 25, 7) AS origcountry,
         lower(c_mktsegment) AS sampmatcodebasebuilding,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN lower(o_orderpriority) END AS sampstrategy,
         year(o_orderdate) AS sampy, month(o_orderdate) AS sampm, day(o_orderdate) AS sampd,
         year(o_orderdate) AS analysisy, month(o_orderdate) AS analysism,
         CASE WHEN o_orderstatus <> 'F' THEN day(o_orderdate) END AS analysisd,
         CASE WHEN o_orderstatus <> 'O' THEN year(o_orderdate) - 1 END AS sampmatinfoprody,
         year(o_orderdate) AS repyear, 'text ' || lower(o_orderpriority) AS sampmattext,
         'p' || l_partkey AS param, 'r' || l_linenumber AS resid, l_extendedprice AS resval, l_discount AS resloq,
         CASE WHEN l_linenumber <> 6 THEN 'ev' || l_linenumber END AS evalcode,
         lower(l_linestatus) AS evallimittype,
         CASE WHEN l_quantity >= 10 THEN 'm' || CAST(l_quantity AS INTEGER) END AS anmethcodebasemeth,
         lower({SQL_RELEASE}) AS file, {sql_mapped('l_returnflag', TYPES)} AS filetype,
         l_partkey, l_linenumber, l_quantity, l_suppkey, l_tax, l_shipdate
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey)"""

TITLE = "array_to_string(list_transform(regexp_extract_all({0}, '\\p{{L}}+|[^\\p{{L}}]+'), lambda s: upper(s[1]) || lower(s[2:])), '')"


def sql_title(c: str) -> str:
    return TITLE.format(c)


def sql_tuple(*cells: str) -> str:
    """The text behind a tuple key, for cells that are already text."""
    parts = [f"coalesce('=' || replace(replace({c}, '\\', '\\\\'), '|', '\\|'), '~')" for c in cells]
    return "concat_ws('|', " + ", ".join(parts) + ")"
