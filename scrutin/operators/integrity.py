"""Unique keys and foreign keys of many tables, each kind of rule in one shuffle of small rows.

Uniqueness: the keys of all tables become pairs (rule, 64-bit hash), and one aggregate finds the hashes that
occur twice. Equal keys have equal hashes, so a key that repeats is among them; only those are compared themselves.

References between whole numbers: keys are bits of words of 64. One aggregate brings the bits that tables use and those
that their dimensions have together, word by word. Where all used bits are known no row of a table is joined with
anything; rows are counted only for the words that have others. Dense keys make few words.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrutin.scratch import staged

#: Hashes or words that are broadcast when rows are compared; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
WHOLE = ("tinyint", "smallint", "int", "bigint")


@dataclass(frozen=True)
class Unique:
    """No two rows of ``frame`` have the same ``keys``; null equals null."""

    frame: DataFrame
    keys: tuple[str, ...]
    table: str

    @property
    def rule(self) -> str:
        return f"({', '.join(self.keys)}) is not unique"


@dataclass(frozen=True)
class Reference:
    """Every row of ``frame`` has a ``key``, and ``dimension`` has it."""

    frame: DataFrame
    key: str
    dimension: DataFrame
    table: str
    dimension_key: str | None = None

    @property
    def rule(self) -> str:
        return f"{self.key} has no match"

    @property
    def whole(self) -> bool:
        other = self.dimension_key or self.key
        return dict(self.frame.dtypes)[self.key] in WHOLE and dict(self.dimension.dtypes)[other] in WHOLE


def _hash(frame: DataFrame, keys: Sequence[str]) -> Column:
    cells: list[Column] = []
    types = dict(frame.dtypes)
    for k in keys:
        # Zero has one hash whatever its sign; a null is told from no value at all.
        cells += [F.col(k).isNull(), F.col(k) + F.lit(0.0) if types[k] in ("float", "double") else F.col(k)]
    return F.xxhash64(*cells)


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _total(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1))).first()[0]


def repeats(rules: Sequence[Unique]) -> list[int]:
    """How many keys occur more than once, for each rule."""
    marks = [u.frame.select(F.lit(i).alias("rule"), _hash(u.frame, u.keys).alias("hash")) for i, u in enumerate(rules)]
    again = reduce(DataFrame.union, marks).groupBy("rule", "hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = staged(again.select("rule", "hash"), "repeated-keys")
    # One row per rule.
    suspects = {r["rule"] for r in again.select("rule").distinct().collect()}
    out = []
    for i, u in enumerate(rules):
        if i not in suspects:
            out.append(0)
            continue
        mine = _few(again.filter(F.col("rule") == i).select(F.col("hash").alias("__hash")))
        rows = u.frame.select(*u.keys).withColumn("__hash", _hash(u.frame, u.keys)).join(mine, "__hash", "left_semi")
        out.append(_total(rows.groupBy(*u.keys).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")))
    return out


def _word(key: str) -> tuple[Column, Column]:
    value = F.col(key).cast("bigint")
    return F.shiftright(value, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), value.bitwiseAND(F.lit(63)).cast("int"))


def dangling(references: Sequence[Reference]) -> list[int]:
    """How many rows have a key that is null or unknown, for each reference between whole numbers."""
    nothing, sides = F.lit(0).cast("bigint"), []
    for i, r in enumerate(references):
        if not r.whole:
            raise TypeError(f"{r.table}.{r.key} is no whole number")
        for frame, key, used in ((r.frame, r.key, True), (r.dimension, r.dimension_key or r.key, False)):
            word, bit = _word(key)
            bits = [(bit if used else nothing).alias("used"), (nothing if used else bit).alias("known")]
            sides.append(frame.filter(F.col(key).isNotNull()).select(F.lit(i).alias("reference"), word, *bits))
    words = reduce(DataFrame.union, sides).groupBy("reference", "word").agg(F.bit_or("used").alias("used"), F.bit_or("known").alias("known"))
    unknown = words.select("reference", "word", F.col("used").bitwiseAND(F.bitwise_not("known")).alias("bits")).filter("bits <> 0")
    unknown = staged(unknown, "unknown-keys")
    # One row per reference.
    suspects = {row["reference"] for row in unknown.select("reference").distinct().collect()}
    out = _nulls(references)
    for i in sorted(suspects):
        r = references[i]
        mine = _few(unknown.filter(F.col("reference") == i).select("word", "bits"))
        word, bit = _word(r.key)
        rows = r.frame.filter(F.col(r.key).isNotNull()).select(word, bit.alias("bit")).join(mine, "word")
        out[i] += _total(rows.filter(F.col("bits").bitwiseAND(F.col("bit")) != 0))
    return out


def _nulls(references: Sequence[Reference]) -> list[int]:
    """Rows without a key, counted in one pass per table."""
    out, by_frame = [0] * len(references), {}
    for i, r in enumerate(references):
        by_frame.setdefault(id(r.frame), []).append(i)
    for places in by_frame.values():
        frame = references[places[0]].frame
        row = frame.agg(*[F.count_if(F.col(references[i].key).isNull()).alias(f"n{i}") for i in places]).first()
        for i in places:
            out[i] = row[f"n{i}"]
    return out


def require_unique(frame: DataFrame, keys: Sequence[str], what: str) -> None:
    """Fail when a table that rows look up holds a key twice: a many-to-one join would multiply rows."""
    n = repeats([Unique(frame, tuple(keys), what)])[0]
    if n:
        raise ValueError(f"{what}: ({', '.join(keys)}) is not unique ({n} keys)")
