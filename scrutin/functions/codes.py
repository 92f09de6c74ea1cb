"""Administrative codes and natural keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scrutin.functions.text import as_column, is_missing, stripped, stripped_upper

DIGITS = r"\A[0-9]+\z"

# Fixed values. The overseas pattern trims and ignores case by itself, so that a filter on a raw field
# reads the field once.
OVERSEAS = r"(?iU)\A[\s\x1c-\x1f]*(z[^\s\x1c-\x1f]|9[0-9][0-9])[\s\x1c-\x1f]*\z"
UNCLASSIFIED = "NC"
UNKNOWN = "UNKNOWN"


def _zero_filled(text: Column, width: int) -> Column:
    # `lpad` alone would cut longer texts.
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


# The `…_of` functions take texts that are trimmed and in upper case already. Jobs clean a column in
# one projection and derive codes in the next, which keeps the cleaning out of every branch below.


def padded_of(text: Column, width: int) -> Column:
    filled = F.when(text.rlike(DIGITS), _zero_filled(text, width)).otherwise(text)
    return F.when(~is_missing(text), filled)


def label_of(text: Column) -> Column:
    return F.when(is_missing(text), F.lit(UNCLASSIFIED)).otherwise(text)


def commune_of(department: Column, commune: Column) -> Column:
    """``department`` is a padded code here."""
    local = commune.rlike(DIGITS) & (F.length(commune) <= 3)
    full = F.when(local, F.concat(department, _zero_filled(commune, 3))).otherwise(commune)
    return F.when(~is_missing(commune) & department.isNotNull(), full)


def padded_code(value: Column | str, width: int) -> Column:
    """Upper-case code; all-digit codes are zero-filled to ``width``; missing spellings are null."""
    return padded_of(stripped_upper(value), width)


def label_or_unclassified(value: Column | str) -> Column:
    """Political label in upper case, ``NC`` where there is none."""
    return label_of(stripped_upper(value))


def commune_code(department: Column | str, commune: Column | str) -> Column:
    """Commune code that is unique nationwide.

    A number of up to three digits is local to its department and gets the department in
    front. Anything else is taken to be complete. Null when either part is missing.
    """
    return commune_of(padded_code(department, 2), stripped_upper(commune))


def is_overseas(department: Column | str) -> Column:
    """True for overseas departments (``Z`` and a character, or 900 to 999).

    False, not null, for a null department.
    """
    return F.coalesce(as_column(department).rlike(OVERSEAS), F.lit(False))


def star_commune_of(text: Column) -> Column:
    signed = F.startswith(text, F.lit("-")) | F.startswith(text, F.lit("+"))
    moved = F.concat(F.left(text, F.lit(1)), F.lpad(F.substr(text, F.lit(2)), 4, "0"))
    return (
        F.when(F.length(text) >= 5, text)
        .when(signed, moved)
        .when(text != "", F.lpad(text, 5, "0"))
    )


def star_commune_code(value: Column | str) -> Column:
    """Commune code zero-filled to five characters whatever it holds; a sign stays in front."""
    return star_commune_of(stripped(value))


def election_of(year: Column, round_: Column) -> Column:
    return F.concat(
        F.coalesce(year, F.lit(UNKNOWN)), F.lit("|T"), F.coalesce(round_, F.lit(UNKNOWN))
    )


def candidate_of(label: Column, last: Column, first: Column, slate: Column) -> Column:
    """The parts are trimmed texts here, in any case."""
    parts = [(label, UNCLASSIFIED), (last, UNKNOWN), (first, UNKNOWN), (slate, UNKNOWN)]
    return F.upper(F.concat_ws("|", *[F.coalesce(part, F.lit(other)) for part, other in parts]))


def election_key(year: Column | str, round_: Column | str) -> Column:
    """``2020|T1``; a missing part reads ``UNKNOWN``."""
    return election_of(stripped(year), stripped(round_))


def candidate_key(
    label: Column | str, last: Column | str, first: Column | str, slate: Column | str
) -> Column:
    """``LABEL|LAST|FIRST|LIST`` in upper case. An empty part stays empty, only null is replaced."""
    return candidate_of(*[stripped(part) for part in (label, last, first, slate)])
