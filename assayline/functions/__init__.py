"""Column expressions.  All are built from JVM-side functions; there are no Python UDFs."""

from .columns import RELEASE_RENAMES, clean_column_name, clean_columns, drop_a_tags
from .filenames import amr_country, amr_year, file_type, release_country, release_year
from .identity import canonical_number, tuple_hash, tuple_text
from .numbers import (
    half_up_int,
    log_scale_size,
    percent_text,
    share,
    thousands_text,
    zero_to_null,
)
from .text import (
    blank_to_null,
    capitalise,
    clean_text,
    null_sentinels,
    strip_prefix,
    strip_text,
    title_case,
)

__all__ = [
    "RELEASE_RENAMES", "amr_country", "amr_year", "blank_to_null", "canonical_number",
    "capitalise", "clean_column_name", "clean_columns", "clean_text", "drop_a_tags",
    "file_type", "half_up_int", "log_scale_size", "null_sentinels", "percent_text",
    "release_country", "release_year", "share", "strip_prefix", "strip_text",
    "thousands_text", "title_case", "tuple_hash", "tuple_text", "zero_to_null",
]
