"""Column functions: text cleaning, administrative codes, lenient numbers."""

from scrutin.functions.codes import (
    candidate_key,
    commune_code,
    election_key,
    is_overseas,
    label_or_unclassified,
    padded_code,
    star_commune_code,
)
from scrutin.functions.numbers import lenient_long, localised_double
from scrutin.functions.text import (
    blank_to_null,
    is_missing,
    null_missing_fields,
    stripped,
    stripped_upper,
)

__all__ = [
    "blank_to_null",
    "candidate_key",
    "commune_code",
    "election_key",
    "is_missing",
    "is_overseas",
    "label_or_unclassified",
    "lenient_long",
    "localised_double",
    "null_missing_fields",
    "padded_code",
    "star_commune_code",
    "stripped",
    "stripped_upper",
]
