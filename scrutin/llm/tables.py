"""Tables written between the steps of an operator."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scrutin.operators.lookup import lookup
from scrutin.scratch import new_path, staged

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"

#: Bytes of rows that a task hands to its Python worker at once. Both sides hold them, and several arrays made of them.
BATCH_BYTES = 4 << 20


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Writes inside hand rows to Python workers by few bytes, so that these and the buffers before them stay small."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back. Its shuffle files go when the write has ended."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        with small_batches(df.sparkSession):
            return staged(df, name)
    finally:
        conf.set(_CLEANUP, before)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


#: Rows of a table that is joined by broadcast whole (some 24 bytes each).
BROADCAST_ROWS = 500_000
#: Rows of one key from which joins answer it by broadcast; N rows have at most N / HOT_ROWS such keys.
HOT_ROWS = 100_000


def to_one(many: DataFrame, one: DataFrame, key: str) -> DataFrame:
    """Left join of ``many`` to ``one``, a written table of few columns with one row per ``key``.

    A table of a bounded number of rows is broadcast; of a larger one, the keys with very many rows are.
    """
    if one.count() <= BROADCAST_ROWS:
        return many.join(F.broadcast(one), key, "left")
    weights = many.groupBy(key).agg(F.count(F.lit(1)).alias("__rows"))
    return lookup(many, one.join(weights, key), [key], weight="__rows", hot_rows=HOT_ROWS)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Columns ``node`` and ``root``, the smallest node that is reachable, for each node of an edge.

    ``edges`` has long columns ``a`` and ``b``. Every round takes the smallest root among the
    neighbours and then the root of that root, so chains shrink at a doubling rate. Each round is a
    written table, so a lost executor costs one round at most.
    """
    both = kept(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), name)
    roots = kept(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), name)
    while True:
        # A node may be linked with very many others, and be the root of even more.
        near = to_one(both, roots.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        lower = roots.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("low"))
        lower = kept(lower, name)
        upper = lower.select(F.col("node").alias("low"), F.col("low").alias("lower"))
        step = kept(to_one(lower, upper, "low").select("node", F.least("low", "lower").alias("root"), "old"), name)
        if step.filter("root <> old").isEmpty():
            return step.select("node", "root")
        roots = step.select("node", "root")


def pinned(column: Column) -> Column:
    """``column`` as a value that the optimizer computes once, instead of once more in each filter on it."""
    return F.when(F.monotonically_increasing_id() >= 0, column)
