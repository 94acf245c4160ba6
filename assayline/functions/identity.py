"""One comparable key for a tuple of nullable columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_number(c: Column) -> Column:
    """The same text for 1, 1.0, '1.0' and '1E0', so that a key does not depend on the type read.

    Plain numbers are only stripped of what does not count, so neither scale nor precision is
    limited.  Numbers with an exponent, as doubles are spelled when large or small, are spelled
    out where 38 digits hold them and keep their text elsewhere.  What is no number becomes null.
    """
    text = F.trim(c.cast("string"))
    number = F.when(text.rlike(r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)$"), text).when(
        text.rlike(r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)[eE][+-]?[0-9]+$"),
        F.coalesce(
            F.when(F.abs(text.try_cast("double")) >= 1, text.try_cast("decimal(38,10)").cast("string")),
            F.nullif(text.try_cast("decimal(38,37)").cast("string"), F.lit("0." + "0" * 37)),
            F.when(text.try_cast("double") == 0, "0"), text,
        ),
    )
    bare = F.regexp_replace(F.regexp_replace(number, r"^\+?(-?)0*(?=[0-9.])", "$1"), r"\.0*$|(\.[0-9]*[1-9])0+$", "$1")
    led = F.when(bare.rlike(r"^-?(?:\.|$)"), F.concat(F.when(bare.startswith("-"), "-0").otherwise("0"), F.ltrim(bare, F.lit("-")))).otherwise(bare)
    return F.when(led == "-0", "0").otherwise(led)


def number_text(c: Column) -> Column:
    """``canonical_number`` of a column of type double, from its value and without patterns.

    Whole numbers below 2^53 are spelled as integers.  Others are spelled by their own text where that
    has no exponent, and as decimals where it has.
    """
    whole = (c == F.floor(c)) & (F.abs(c) < 2**53)
    plain = F.abs(c).between(1e-3, 9999999.0)
    text = c.cast("string")

    def decimals(scale: int) -> Column:
        return F.rtrim(c.try_cast(f"decimal(38,{scale})").cast("string"), F.lit("0"))

    spelled = F.when(F.abs(c) >= 1, F.rtrim(decimals(10), F.lit("."))).otherwise(F.nullif(decimals(37), F.lit("0.")))
    return F.when(whole, c.cast("bigint").cast("string")).when(plain, text).otherwise(F.coalesce(spelled, text))


def tuple_text(columns: Iterable[Column]) -> Column:
    """Text that is equal exactly when two tuples are equal, null matching null.

    A value is marked with ``=`` and its separators are escaped; a null is ``~``.  So null
    differs from the empty text, and neighbours cannot run into each other.
    """
    parts = []
    for c in columns:
        escaped = F.replace(F.replace(c.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
        parts.append(F.coalesce(F.concat(F.lit("="), escaped), F.lit("~")))
    return F.concat_ws("|", *parts)


def tuple_hash(columns: Iterable[Column]) -> Column:
    """128-bit key of a tuple.

    Joining on this one column replaces a null-safe condition per column, which Spark would
    turn into two shuffle keys each.
    """
    return F.md5(tuple_text(columns))
