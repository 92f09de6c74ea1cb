"""Trimming, upper-casing and the notions of "missing"."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scrutin.schemas import MISSING_CODES, MISSING_FIELDS

# Every character Unicode (or ASCII, for U+001C-U+001F) counts as whitespace.
# `trim` without an argument would only take U+0020.
WHITESPACE = (
    "\t\n\u000b\f\r\u001c\u001d\u001e\u001f \u0085\u00a0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def is_filled(value: Column | str) -> Column:
    """True when a text is neither null nor blank."""
    text = as_column(value)
    visible = (text >= "!") & (text < "\u007f")
    return F.coalesce(visible | (F.btrim(text, F.lit(WHITESPACE)) != ""), F.lit(False))


def stripped(value: Column | str) -> Column:
    """Text without leading and trailing Unicode whitespace.

    Texts that begin and end with a visible ASCII character, which two comparisons tell, are passed
    through; searching the long list of whitespace characters costs several times as much.
    """
    text = as_column(value).cast("string")
    last = F.right(text, F.lit(1))
    clean = (text >= "!") & (text < "\u007f") & (last >= "!") & (last < "\u007f")
    return F.when(clean, text).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def stripped_upper(value: Column | str) -> Column:
    return F.upper(stripped(value))


def blank_to_null(value: Column | str) -> Column:
    """Trimmed text; null when nothing is left."""
    return F.nullif(stripped(value), F.lit(""))


def made_of(text: Column, alphabet: str) -> Column:
    """True when every character is in ``alphabet``; also for an empty text."""
    return F.btrim(text, F.lit(alphabet)) == ""


def is_missing(trimmed_upper: Column) -> Column:
    """True for null and for the texts that stand for a missing code. Expects trimmed upper case."""
    return trimmed_upper.isNull() | trimmed_upper.isin(*MISSING_CODES)


def null_missing_fields(value: Column | str) -> Column:
    """Null for the texts that stand for a missing field in a delimited file, else the text as is."""
    c = as_column(value)
    return F.when(c.isin(*MISSING_FIELDS), None).otherwise(c)
