"""The star schema: dictionaries by name, and the views that decode the fact tables.

A view is a function that returns a DataFrame, so Catalyst sees through it and prunes the
columns and dictionary joins' inputs that a query does not use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dims import decode

# Fixed values: (id column, dictionary, label) of the sample table.
SAMPLE_LABELS = (
    ("prgtyp_id", "prgtyp", "progtype"),
    ("labacc_id", "labacc", "labaccred"),
    ("labcountry_id", "country", "labcountry"),
    ("sampmd_id", "sampmd", "sampmethod"),
    ("sampstr_id", "sampstr", "sampstrategy"),
    ("unit_id", "unit", "anportsizeunit"),
    ("sampnt_id", "sampnt", "samppoint"),
    ("sampcountry_id", "country", "sampcountry"),
    ("origcountry_id", "country", "origcountry"),
)

# Fixed values: (id column, dictionary, label) of the measurement table.
MEASUREMENT_LABELS = (
    ("param_id", "param", "paramcodebaseparam"),
    ("restyp_id", "valtyp", "restype"),
    ("resunit_id", "unit", "resunit"),
    ("evalcode_id", "reseval", "evalcode"),
)

# Fixed values: (id column, dictionary, stem of the labels) of the antimicrobial-resistance table.
AMR_LABELS = (
    ("zoonosis_id", "param", "zoonosis"),
    ("matrix_id", "zoo_cat_matrix", "matrix"),
    ("sampunittype_id", "sampuntyp", "sampunittype"),
    ("sampstage_id", "sampnt", "sampstage"),
    ("samptype_id", "zoo_cat_smptyp", "samptype"),
    ("sampcontext_id", "prgtyp", "sampcontext"),
    ("sampler_id", "samplr", "sampler"),
    ("progsampstrategy_id", "sampstr", "progsampstrategy"),
    ("anmethcode_id", "anlymd", "anmethcode"),
    ("substance_id", "param", "substance"),
    ("lowest_id", "zoo_cat_fixmeas", "lowest"),
    ("highest_id", "zoo_cat_fixmeas", "highest"),
    ("mic_id", "zoo_cat_fixmeas", "mic"),
    ("seqtech_code", "instrum", "seqtech"),
    ("tracescode_code", "zoo_cat_traces", "tracescode"),
)

NAME, CODE = "termextendedname", "termcode"


def _present(df: DataFrame, labels, dims: dict[str, DataFrame], column: str):
    return [(i, dims[d], {column: label}) for i, d, label in labels if i in df.columns and d in dims]


def _with_product(df: DataFrame, dims: dict[str, DataFrame], column: str, out: str) -> DataFrame:
    """Label of the product; a product without an entry in the product list is left out."""
    products = dims["products"].select(F.col("id").alias("product_id"), F.col("mtx_id").alias("_mtx_id"), F.col("matrix_id").alias("_matrix_id"))
    known = df.join(products, "product_id")
    both = decode(known, [("_mtx_id", dims["mtx"], {column: "_mtx"}), ("_matrix_id", dims["matrix"], {column: "_matrix"})])
    return both.withColumn(out, F.coalesce("_mtx", "_matrix")).drop("_mtx_id", "_matrix_id", "_mtx", "_matrix")


def sample_view(samples: DataFrame, dims: dict[str, DataFrame], column: str = NAME, product: str = "productname") -> DataFrame:
    """Samples with the names (or, with ``column=CODE``, the codes) of their dictionaries."""
    labelled = decode(samples, _present(samples, SAMPLE_LABELS, dims, column))
    if "product_id" in samples.columns and "products" in dims:
        labelled = _with_product(labelled, dims, column, product)
    if "file_id" in samples.columns and "files" in dims:
        labelled = decode(labelled, [("file_id", dims["files"], {c: c for c in ("filename", "country_code", "filetype") if c in dims["files"].columns and c not in labelled.columns})])
    return labelled


def measurement_view(measurements: DataFrame, dims: dict[str, DataFrame], column: str = NAME) -> DataFrame:
    """Measurements with names or codes.

    ``filetype`` is the fact's own column, which is also its partition column, so a filter
    on the view prunes partitions.
    """
    return decode(measurements, _present(measurements, MEASUREMENT_LABELS, dims, column))


def sample_measurement_view(
    samples: DataFrame, measurements: DataFrame, dims: dict[str, DataFrame], column: str = NAME
) -> DataFrame:
    """Every measurement with its sample: the join of the two large tables.

    Joined on ids first, decoded afterwards, so that no label goes through the shuffle.
    """
    own = [c for c in samples.columns if c in measurements.columns and c != "sample_core_id"]
    joined = samples.drop(*own).join(measurements, "sample_core_id")
    return measurement_view(sample_view(joined, dims, column), dims, column)


def amr_view(amr: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Antimicrobial-resistance results with code and name of each dictionary."""
    for column in ("seqtech_code", "tracescode_code"):
        if column in amr.columns:
            amr = amr.withColumnRenamed(column, column.replace("_code", "_id"))
    labels = [(i.replace("_code", "_id"), d, stem) for i, d, stem in AMR_LABELS]
    return decode(amr, [
        (i, dims[d], {CODE: f"{stem}_code", NAME: f"{stem}_name"}) for i, d, stem in labels if i in amr.columns and d in dims
    ])
