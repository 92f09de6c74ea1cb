"""Projections: picking positional fields, patching cells, conforming to a schema, stacking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrutin.functions.numbers import long_of
from scrutin.functions.text import stripped


def quoted_name(name: str) -> str:
    """A column name that is safe to hand to ``col``, dots and blanks included."""
    return "`" + name.replace("`", "``") + "`"


def fields_at(array: str, positions: Mapping[str, int]) -> list[Column]:
    """Named columns for 0-based positions of an array column."""
    return [F.get(F.col(array), F.lit(i)).alias(name) for name, i in positions.items()]


@dataclass(frozen=True)
class Patch:
    """Set cells to new values on the rows that fulfil a condition."""

    where: Column
    values: Mapping[str, Column]


def patch_cells(df: DataFrame, patches: Sequence[Patch]) -> DataFrame:
    """Apply patches; conditions and values see the unpatched row, the first match wins."""
    out = []
    for c in df.columns:
        cell = F.col(c)
        for patch in reversed([p for p in patches if c in p.values]):
            cell = F.when(patch.where, patch.values[c]).otherwise(cell)
        out.append(cell.alias(c))
    return df.select(*out)


def parse_longs(df: DataFrame, columns: Sequence[str], trimmed: bool = False) -> DataFrame:
    """Texts of the given columns as whole numbers; columns that are no texts stay."""
    types = dict(df.dtypes)
    texts = [c for c in columns if types[c] == "string"]
    if not texts:
        return df
    if not trimmed:
        df = df.withColumns({c: stripped(c) for c in texts})
    return df.withColumns({c: long_of(F.col(c)) for c in texts})


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema`` in its order: missing ones null, others dropped.

    Text meant for an integer column is parsed leniently.
    """
    whole = [f.name for f in schema.fields if isinstance(f.dataType, T.LongType)]
    df = parse_longs(df, [c for c in whole if c in df.columns])
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; a column a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def clean_header(df: DataFrame) -> DataFrame:
    """Column names trimmed and in lower case."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def with_unknown_member(df: DataFrame, key: str, natural_key: str, label: str) -> DataFrame:
    """Add a row with key 0 and the given natural key; its other columns are null."""
    row = df.sparkSession.range(1).select(
        *[
            F.lit(0).cast("bigint").alias(c)
            if c == key
            else (F.lit(label) if c == natural_key else F.lit(None)).cast(t).alias(c)
            for c, t in df.dtypes
        ]
    )
    return row.unionByName(df)
