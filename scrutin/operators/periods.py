"""Keep the keys that are present in every period."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrutin.operators.lookup import HOT_ROWS, lookup
from scrutin.scratch import staged

WORD_PERIODS = 63  # periods that fit into the bits of a bigint
MASK_PERIODS = 64 * WORD_PERIODS  # periods that are kept as bits
BROADCAST_KEYS = 500_000  # keys that rows are compared with where they are; with more, rows are shuffled


def distinct_periods(df: DataFrame, period: str) -> DataFrame:
    """The distinct non-null periods."""
    return df.select(period).filter(F.col(period).isNotNull()).distinct()


def period_counts(df: DataFrame, key: str, period: str, periods: Sequence | None) -> DataFrame:
    """Per non-null key: in how many of ``periods`` (None: of all) it occurs, and its number of rows."""
    wanted = F.col(period).isNotNull() if periods is None else F.col(period).isin(*periods)
    scoped = df.filter(F.col(key).isNotNull() & wanted)
    if periods is not None and len(periods) <= MASK_PERIODS:
        # One bit per period: a single shuffle with one row per key and task, however many words of bits.
        if len(periods) <= WORD_PERIODS:
            number = F.lit(None).cast("int")
            for position, value in enumerate(periods):
                number = F.when(F.col(period) == F.lit(value), F.lit(position)).otherwise(number)
            numbered = scoped.select(key, number.alias("__number"))
        else:
            kind = scoped.schema[period].dataType.simpleString()
            table = scoped.sparkSession.createDataFrame(list(enumerate(periods)), f"__number int, __period {kind}")
            numbered = scoped.join(F.broadcast(table), F.col(period) == F.col("__period")).select(key, "__number")
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("__number") % WORD_PERIODS)
        words = range(-(-len(periods) // WORD_PERIODS))
        masks = [F.bit_or(F.when((F.col("__number") / WORD_PERIODS).cast("int") == w, bit)).alias(f"__w{w}") for w in words]
        found = numbered.groupBy(key).agg(*masks, F.count(F.lit(1)).alias("rows"))
        held = [F.coalesce(F.bit_count(f"__w{w}"), F.lit(0)).cast("bigint") for w in words]
        return found.select(key, reduce(lambda a, b: a + b, held).alias("periods"), "rows")
    per_period = scoped.groupBy(key, period).agg(F.count(F.lit(1)).alias("rows"))
    return per_period.groupBy(key).agg(
        F.count(F.lit(1)).alias("periods"), F.sum("rows").alias("rows")
    )


def present_in_all(
    df: DataFrame,
    key: str,
    period: str,
    periods: Sequence | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rows of the given periods whose key occurs in all of them.

    Without ``periods`` all non-null periods of the data count; if there are none, the frame is
    returned as it is. A selected period without any row empties the result.
    """
    scope = None if periods is None else list(dict.fromkeys(periods))
    size = distinct_periods(df, period).count() if scope is None else len(scope)
    if not size:
        return df
    if scope is None and size <= MASK_PERIODS:
        scope = [row[0] for row in distinct_periods(df, period).collect()]  # at most MASK_PERIODS values
    counts = period_counts(df, key, period, scope).withColumnRenamed("periods", "__periods")
    counts = staged(counts, "period-counts")
    wanted = F.col(period).isNotNull() if scope is None else F.col(period).isin(*scope)
    scoped = df.filter(F.col(key).isNotNull() & wanted)
    # Every key of these rows has a count, so keys to keep and keys to drop tell the same; the fewer ones travel.
    full = F.col("__periods") == size
    kept, dropped = counts.agg(F.count_if(full), F.count_if(~full)).first()
    if min(kept, dropped) <= BROADCAST_KEYS:
        chosen, how = (full, "left_semi") if kept < dropped else (~full, "left_anti")
        return scoped.join(F.broadcast(counts.filter(chosen).select(key)), key, how).select(*df.columns)
    return (
        lookup(scoped, counts, [key], weight="rows", null_safe=False, hot_rows=hot_rows)
        .filter(F.col("__periods") == size)
        .drop("__periods")
    )


def empty_periods(df: DataFrame, period: str, periods: Sequence) -> list:
    """Selected periods without any row: each of them empties :func:`present_in_all`."""
    asked = list(dict.fromkeys(periods))
    # No more rows than periods are asked for.
    found = {row[0] for row in distinct_periods(df.filter(F.col(period).isin(*asked)), period).collect()} if asked else set()
    return [p for p in periods if p not in found]
