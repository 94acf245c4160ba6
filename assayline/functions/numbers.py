"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zero_to_null(c: Column) -> Column:
    """A zero in a date part means "not given"."""
    return F.when(c != 0, c)


def half_up_int(c: Column) -> Column:
    """Assign a number to an integer column: round half away from zero.

    A plain cast would truncate (2.5 to 2).  Out-of-range values become null.
    """
    return F.round(c.cast("double")).try_cast("int")


def share(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double; null when the whole is zero."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def percent_text(part: Column, whole: Column) -> Column:
    """A label such as ``12.34%``; a zero whole counts as 0 %."""
    return F.format_string("%.2f%%", F.coalesce(share(part, whole) * 100, F.lit(0.0)))


def thousands_text(c: Column) -> Column:
    """A label such as ``1,234,567``."""
    return F.format_number(c, 0)


def log_scale_size(value: Column, low: Column, high: Column, smallest: float = 50.0, largest: float = 400.0) -> Column:
    """Place log10(value) linearly between ``smallest`` and ``largest``.

    ``low`` and ``high`` are the least and greatest value of the whole set.  One distinct
    value has no span to scale over and gives null.
    """
    span = F.nullif(F.log10(high) - F.log10(low), F.lit(0.0))
    return F.lit(smallest) + (F.log10(value) - F.log10(low)) / span * F.lit(largest - smallest)
