"""Text cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space at either end of a cell.
ASCII_WHITE_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
WHITE_SPACE = ASCII_WHITE_SPACE + (
    "\x85\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Cell texts (after lower-casing) that mean "no value".
SENTINELS = ("n_a", "nan")

# Further texts that a CSV reader with default settings takes as missing.
# They are only used on request, because ``na`` is also a country code.
READER_SENTINELS = (
    "", "#n/a", "#n/a n/a", "#na", "-1.#ind", "-1.#qnan", "-nan", "1.#ind", "1.#qnan",
    "<na>", "n/a", "na", "none", "null",
)


def strip_text(c: Column) -> Column:
    """Strip all Unicode white space at both ends (``trim`` alone strips only blanks).

    The cost of ``btrim`` grows with the characters it looks for, so texts that begin and end with a
    printing ASCII character, which most cells do, are left alone, and others in plain ASCII get the short list.
    """
    last = F.substr(c, F.lit(-1))
    bare = (c >= "!") & (c < "\x7f") & (last >= "!") & (last < "\x7f")
    ascii_only = F.octet_length(c) == F.char_length(c)
    return F.when(bare, c).otherwise(F.btrim(c, F.when(ascii_only, F.lit(ASCII_WHITE_SPACE)).otherwise(F.lit(WHITE_SPACE))))


def clean_text(c: Column) -> Column:
    """Strip and lower-case."""
    return F.lower(strip_text(c))


def null_sentinels(c: Column, reader_sentinels: bool = False, blank: bool = False) -> Column:
    """Null for the texts that stand for a missing value, with ``blank`` for the empty one too; anything else is kept."""
    texts = SENTINELS + READER_SENTINELS if reader_sentinels else SENTINELS
    texts = (*texts, "") if blank and "" not in texts else texts
    return F.when(~c.isin(*texts), c)


def blank_to_null(c: Column) -> Column:
    """An empty cell of a bulk load is a missing value."""
    return F.when(c != "", c)


def strip_prefix(c: Column, prefix: str = "param=") -> Column:
    """Remove a marker such as ``param=`` wherever it stands in a code."""
    return F.replace(c, F.lit(prefix), F.lit(""))


def title_case(c: Column) -> Column:
    """Capital after *any* non-letter, lower case elsewhere: ``(pops)`` gives ``(Pops)``.

    ``initcap`` only looks at blanks, so the text is cut into runs of letters and of other
    characters, and each run is capitalised for itself.
    """
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def capitalise(c: Column) -> Column:
    """Upper-case the first character and leave the rest alone."""
    return F.concat(F.upper(F.left(c, F.lit(1))), F.substr(c, F.lit(2)))
