"""Lenient number parsing. A text that is no number becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scrutin.functions.text import as_column, made_of, stripped

# The characters of a decimal number with blanks around it. Whether they form one is up to the cast;
# the alphabet keeps the engine's own extensions out (`1d`, `Infinity`, hexadecimal).
DECIMAL = "0123456789+-.eE \t\n\u000b\f\r"
INTEGER = r"\A[+-]?[0-9]+\z"


# Texts that cannot be numbers are kept from the casts: a failing cast costs as much as fifty others.
def _double_of(text: Column) -> Column:
    return F.when((text != "") & made_of(text, DECIMAL), text.try_cast("double"))


def lenient_double(value: Column | str) -> Column:
    """Number held in a text."""
    return _double_of(stripped(value))


def long_of(text: Column) -> Column:
    """Like :func:`lenient_long` for a text that is trimmed already."""
    as_double = _double_of(text)
    integral = F.when(as_double % 1 == 0, as_double.try_cast("bigint"))
    return F.when(text.rlike(INTEGER), text.try_cast("bigint")).otherwise(integral)


def lenient_long(value: Column | str) -> Column:
    """Whole number held in a text, including spellings like ``12.0`` or ``1e3``.

    A fractional value is not a whole number and gives null.
    """
    return long_of(stripped(value))


def localised_double(value: Column | str, extra_spaces: str = "") -> Column:
    """Number with blanks as thousands separators and a decimal comma.

    Only U+0020 counts as a separator unless ``extra_spaces`` names more characters.
    """
    text = as_column(value).cast("string")
    for space in " " + extra_spaces:
        text = F.replace(text, F.lit(space), F.lit(""))
    return _double_of(F.replace(text, F.lit(","), F.lit(".")))
