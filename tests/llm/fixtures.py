"""Rows that every operator must stand: nulls, empty and long texts, repeats, clashing names."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, extra=""):
    """One document for each text; ids count from zero."""
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def folder(spark, path, **tables):
    """Write tables as an input folder and return its name."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}.parquet")
    return str(path)
