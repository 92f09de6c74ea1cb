"""Roll measures up when they are repeated on detail rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from scrutin.operators.lookup import HASHED, HOT_ROWS, WEIGHT, heavy_keys, lookup
from scrutin.scratch import settled, small_tasks, staged


def _rows() -> list:
    return [F.count(F.lit(1)).alias(WEIGHT)]


def grains(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    detail: Sequence[str],
    votes: str,
    unit: str | None,
) -> tuple[DataFrame, DataFrame]:
    """Totals per key of measures that are repeated on every detail row of a unit, and votes per key and detail.

    With a unit, each measure counts once per unit (its maximum) and the units are added up; a key without
    any value totals 0. Without a unit, the maximum per key is taken. The totals' column ``__rows`` counts the
    rows below each key. Both come from one pass over ``df`` (:func:`both_grains`). The aggregated grains, smaller
    than the rows, are written to the shared folder once.
    """
    found = staged(both_grains(df, keys, measures, detail, votes, unit), "grains", None, True)
    units = found.filter("__grain = 0").select(*keys, *measures, WEIGHT)
    if unit is not None:
        units = units.groupBy(*keys).agg(*[_added(F.sum(m)).alias(m) for m in measures], F.sum(WEIGHT).alias(WEIGHT))
    scores = found.filter("__grain = 1").select(*keys, *[F.col(f"__{c}").alias(c) for c in detail], votes)
    return units, scores


def _added(total: Column) -> Column:
    return F.coalesce(total, F.lit(0)).cast("bigint")


def both_grains(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    detail: Sequence[str],
    votes: str,
    unit: str | None,
) -> DataFrame:
    """Maxima per key and unit (``__grain`` 0), votes per key and detail (1), in one aggregate over one pass.

    Each row is sent to both grains, whose partial results share a shuffle; rows that are partitioned by the keys
    need none. The unit and the details have the prefix ``__``.
    """
    # A column may serve both grains.
    names = list(dict.fromkeys([*([unit] if unit else []), *detail, *measures, votes]))
    types = dict(df.dtypes)

    def side(grain: int, held: Sequence[str]) -> Column:
        cells = [(F.col(c) if c in held else F.lit(None)).cast(types[c]).alias(f"__{c}") for c in names]
        return F.struct(F.lit(grain).cast("tinyint").alias("__grain"), *cells)

    totals_of, votes_of = side(0, [*([unit] if unit else []), *measures]), side(1, [*detail, votes])
    both = df.select(*keys, F.inline(F.array(totals_of, votes_of)))
    apart = [f"__{c}" for c in names if c not in (*measures, votes)]
    return both.groupBy(*keys, "__grain", *apart).agg(
        *[F.max(f"__{m}").alias(m) for m in measures], F.sum(f"__{votes}").alias(votes), *_rows()
    )


def rollup_units(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    detail: Sequence[str],
    votes: str,
    unit: str | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Sum ``votes`` per key and detail, next to the unit totals of the key.

    Keys are compared null-safely, both when grouping and when joining the totals.
    """
    totals, scores = grains(df, keys, measures, detail, votes, unit)
    return lookup(scores, totals, keys, weight=WEIGHT, hot_rows=hot_rows)


def _by_key(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, WindowSpec]:
    """``df`` and a window over the rows of a key, for rows that are partitioned by the keys and keys that fit a task."""
    types = dict(df.dtypes)
    if any(types[k] not in HASHED for k in keys):
        return df, Window.partitionBy(*keys)
    # A hash in front decides nearly all comparisons of the sort.
    return df.withColumn("__digest", F.hash(*keys)), Window.partitionBy("__digest", *keys)


def rollup_rows(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    detail: Sequence[str],
    votes: str,
    unit: str | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """:func:`rollup_units` for rows that aggregating per unit and detail makes hardly fewer.

    The rows are written once and shuffled once, by the keys, where both grains and the totals are made of them;
    the rolled table is written, and the rows go. Where a key has ``hot_rows`` rows or more, so that it would fill
    a task, the grains are shuffled and joined instead.
    """
    names = list(dict.fromkeys([*keys, *([unit] if unit else []), *measures, *detail, votes]))
    rows = staged(df.select(*names), "rollup-rows", None, True)
    spark = rows.sparkSession
    if heavy_keys(rows, keys, hot_rows) is not None:
        return settled(rollup_units(rows, keys, measures, detail, votes, unit, hot_rows), "rolled", rows)
    with small_tasks(spark):
        found, same_key = _by_key(both_grains(rows.repartition(*keys), keys, measures, detail, votes, unit), keys)
        # Rows of the other grain have no measures.
        totals = [(F.max(m).over(same_key) if unit is None else _added(F.sum(m).over(same_key))).alias(m) for m in measures]
        scores = found.select(*keys, "__grain", *[F.col(f"__{c}").alias(c) for c in detail], votes, *totals).filter("__grain = 1")
        return settled(scores.drop("__grain"), "rolled", rows)


def spread_max(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Replace each measure by its maximum over the rows with the same keys (null keys included).

    Maxima are aggregated before they are joined back: a window would bring all rows of a key
    into one task.
    """
    top = df.groupBy(*keys).agg(*[F.max(m).alias(f"__max_{m}") for m in measures], *_rows())
    joined = lookup(df, top, keys, weight=WEIGHT, hot_rows=hot_rows)
    return joined.select(
        *[F.col(f"__max_{c}").alias(c) if c in measures else F.col(c) for c in df.columns]
    )


def spread_max_rows(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """:func:`spread_max` for wide rows with many keys: they are written once and shuffled once, by the keys.

    Where a key has ``hot_rows`` rows or more, so that it would fill a task, the maxima are joined instead.
    """
    rows = staged(df, "spread-rows", None, True)
    if heavy_keys(rows, keys, hot_rows) is not None:
        return spread_max(rows, keys, measures, hot_rows)
    placed, same_key = _by_key(rows.repartition(*keys), keys)
    return placed.select(*[F.max(c).over(same_key).alias(c) if c in measures else F.col(c) for c in df.columns])
