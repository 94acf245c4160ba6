"""Column names: cleaning and harmonising.  These work on the schema, not on rows."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame

# Old column name -> harmonised name, sample attributes.
SAMPLE_RENAMES = {
    "prodcode": "sampmatcodebasebuilding",
    "labsampcode": "sampid",
    "expiryd": "sampmatinfoexpiryd",
    "expirym": "sampmatinfoexpirym",
    "expiryy": "sampmatinfoexpiryy",
    "fatperc": "exprrespercfatperc",
    "labcode": "labid",
    "localorg": "localorgid",
    "moistperc": "exprrespercmoistperc",
    "prodbrandname": "sampmatinfobrandname",
    "prodcom": "sampmatinfocom",
    "prodd": "sampmatinfoprodd",
    "prodm": "sampmatinfoprodm",
    "prodmanuf": "sampmatinfomanuf",
    "prodprodmeth": "sampmatcodeprod",
    "prodtext": "sampmattext",
    "prody": "sampmatinfoprody",
    "progcode": "progid",
    "progsampstrategy": "sampstrategy",
}

# Old column name -> harmonised name, measurement attributes.
MEASUREMENT_RENAMES = {
    "resevaluation": "evalcode",
    "paramcode": "paramcodebaseparam",
    "resultcode": "resid",
    "anmethcode": "anmethcodebasemeth",
    "reslegallimittype": "evallimittype",
    "exprres": "exprrestype",
}

RELEASE_RENAMES = {**MEASUREMENT_RENAMES, **SAMPLE_RENAMES}


def clean_column_name(name: str) -> str:
    """Strip, lower-case, keep word characters and white space, blanks to underscores."""
    kept = re.sub(r"[^\w\s]", "", name.strip().lower())
    return kept.replace(" ", "_")


def drop_a_tags(name: str) -> str:
    """Remove every ``_a``, also inside a name: ``foo_amount`` becomes ``foomount``."""
    return name.replace("_a", "")


def _check_unique(names: list[str]) -> list[str]:
    clashes = sorted(n for n, k in Counter(names).items() if k > 1)
    if clashes:
        raise ValueError(f"column names collide after cleaning: {clashes}")
    return names


def clean_columns(df: DataFrame, drop_tags: bool = False) -> DataFrame:
    """Clean all column names; ``drop_tags`` also removes the ``_a`` tags."""
    names = [clean_column_name(c) for c in df.columns]
    if drop_tags:
        names = [drop_a_tags(c) for c in names]
    return df.toDF(*_check_unique(names))


def rename_columns(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    """Rename the columns that are present, refusing a rename onto an existing column."""
    return df.toDF(*_check_unique([renames.get(c, c) for c in df.columns]))
