"""Unpivot groups of fields that repeat along a line."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrutin.functions.text import is_filled


def unpivot_blocks(
    df: DataFrame,
    fields: str,
    prefix: int,
    width: int,
    present: Column | None = None,
    slots: int | Column | None = None,
    block: str = "block",
) -> DataFrame:
    """One row per complete block of ``width`` fields behind a prefix of ``prefix`` fields.

    ``fields`` is an array column, replaced in the result by the array column ``block``;
    ``present`` is the number of fields the line really has, where the array is padded;
    ``slots`` caps the blocks at what the header announces (a number, or a column where headers differ). An incomplete last block is dropped.
    """
    size = present if present is not None else F.size(fields)
    blocks = F.floor((size - F.lit(prefix)) / F.lit(width)).cast("int")
    if slots is not None:
        blocks = F.least(blocks, slots if isinstance(slots, Column) else F.lit(slots))
    # No filter on the count: it would make the engine split every line a second time.
    cut = F.when(
        blocks >= 1,
        F.transform(
            F.sequence(F.lit(0), blocks - 1),
            lambda i: F.slice(F.col(fields), i * width + (prefix + 1), F.lit(width)),
        ),
    )
    return df.select(*[c for c in df.columns if c != fields], F.explode(cut).alias(block))


def any_filled(columns: Sequence[Column]) -> Column:
    """True when at least one of the texts is neither null nor blank."""
    return reduce(lambda a, b: a | b, [is_filled(c) for c in columns])
