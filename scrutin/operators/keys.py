"""Surrogate keys and first-row-per-key, without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrutin.scratch import new_path, shuffles_freed, small_tasks

ROW_BITS = 33  # monotonically_increasing_id: partition above, row within the partition below


def nulls_last(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def order_struct(columns: Sequence[str]) -> Column:
    """A struct that compares like ``ORDER BY columns`` with nulls last."""
    parts: list[Column] = []
    for c in columns:
        parts += [F.col(c).isNull().alias(f"{c}_null"), F.col(c).alias(c)]
    return F.struct(*parts)


def first_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str] | None = None,
    count: str | None = None,
) -> DataFrame:
    """Keys and values of the first row per key in ``order``, nulls last; null keys are one group.

    Written as an aggregate, so each task sends one row per key whatever the size of the group.
    ``values`` defaults to all other columns; ``count`` names an extra column with the number of
    rows of the key.
    """
    payload = list(values) if values is not None else [c for c in df.columns if c not in keys]
    aggs = [F.min_by(F.struct(*payload), order_struct(order)).alias("__first")]
    if count:
        aggs.append(F.count(F.lit(1)).alias(count))
    return df.groupBy(*keys).agg(*aggs).select(
        *keys, *[F.col(f"__first.{c}").alias(c) for c in payload], *([count] if count else [])
    )


def dense_id(
    df: DataFrame, order: Sequence[str], name: str, partitions: int | None = None
) -> tuple[DataFrame, int]:
    """Number the rows 1..n in ``order`` (nulls last). Returns the frame and n.

    ``order`` must identify a row. Rows are range-partitioned and sorted, every task numbers its
    own range, and the ranges are shifted by the sizes of those before them. The placed rows are
    written to the shared folder first: range bounds come from a sample, so computing them twice
    could number rows twice.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = nulls_last(order)
    path = new_path(spark, f"numbered-{name}")
    ranged = df.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn("__slot", F.monotonically_increasing_id())
    with shuffles_freed(spark), small_tasks(spark):
        ranged.write.parquet(path)
    placed = spark.read.parquet(path)
    part = F.shiftright("__slot", ROW_BITS).alias("__part")
    # One row per range: n entries at most.
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("rows")).collect()
    start, shifts = 0, []
    for row in sorted(sizes, key=lambda r: r["__part"]):
        shifts.append((row["__part"], start))
        start += row["rows"]
    shift = F.broadcast(spark.createDataFrame(shifts, "__part bigint, __shift bigint"))
    local = F.col("__slot").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    numbered = (
        placed.withColumn("__part", part)
        .join(shift, "__part")
        .select(
            (local + F.col("__shift") + F.lit(1)).cast("bigint").alias(name),
            *[F.col(c) for c in df.columns],
        )
    )
    return numbered, start


def stable_order(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """Sort by ``keys``; rows with equal keys keep the order of ``position``, which is dropped.

    The position is that of a row in its source (see ``read_table``), so stages, shuffles and joins before do not
    matter. It is part of the range key, so a key with very many rows is still spread over several tasks.
    """
    return df.orderBy(*nulls_last(keys), F.col(position)).drop(position)
