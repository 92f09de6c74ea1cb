"""Intermediate tables in the shared folder.

A table written here cuts lineage and survives the loss of any executor. The folder is the one
the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_FIRST = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_METHOD = "spark.sql.codegen.hugeMethodLimit"
_FALLBACK: dict[str, str] = {}

# Shuffled bytes that a task of a written step reads. Rows are some thirty times as large once they are decompressed,
# multiplied and held in an aggregate.
TASK_BYTES = 8 << 20
# Shares per shuffle partition that rows are dealt into first; neighbours are read together up to the size above.
SHARES = 10
# The JVM only interprets methods above this size; the cleaning of many fields makes one that is longer.
COMPILED_BYTES = 8000


def scratch_dir(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``.

    Only a local session, where all tasks share one machine, may go without the setting.
    """
    app = spark.sparkContext.applicationId
    shared = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return f"{shared.rstrip('/')}/scrutin-{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            f"{CHECKPOINT_DIR} must name a folder that every executor can reach"
        )
    if app not in _FALLBACK:
        _FALLBACK[app] = tempfile.mkdtemp(prefix="scrutin-")
    return f"file:{_FALLBACK[app]}"


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the scratch folder that is not in use yet."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go when each has ended, not when the driver collects its garbage."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


@contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """Tasks behind the shuffles of the writes inside read few bytes, however large the input is.

    Their memory is then that of a share and not that of the input over a fixed number of partitions. Sizes that the
    session names itself stay. Methods stay short enough for the JVM to compile them.
    """
    if spark.conf.get(_FIRST, None) is not None:
        yield
        return
    settings = {
        _FIRST: SHARES * int(spark.conf.get("spark.sql.shuffle.partitions")),
        _ADVISORY: TASK_BYTES,
        _METHOD: COMPILED_BYTES,
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, str(value))
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def staged(df: DataFrame, name: str, home: SparkSession | None = None, small: bool = False) -> DataFrame:
    """``df`` written once as parquet and read back (by the session ``home``), for tables with several consumers.

    ``small`` keeps the tasks of the write small (:func:`small_tasks`).
    """
    path = new_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession), small_tasks(df.sparkSession) if small else nullcontext():
        df.write.parquet(path)
    return (home or df.sparkSession).read.schema(df.schema).parquet(path)


def settled(df: DataFrame, name: str, source: DataFrame) -> DataFrame:
    """``df`` written by small tasks and read back. ``source``, a staged table that only ``df`` reads, goes then."""
    out = staged(df, name, small=True)
    discard(source)
    return out


def discard(table: DataFrame) -> None:
    """Delete a staged table. Frames that read it are unusable afterwards."""
    spark = table.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    scratch = jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    scratch = scratch.getFileSystem(conf).makeQualified(scratch)
    for folder in {name.rpartition("/")[0] for name in table.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        fs = path.getFileSystem(conf)
        if not fs.makeQualified(path).getParent().equals(scratch):
            raise ValueError(f"not a staged table: {folder}")
        fs.delete(path, True)


def release(spark: SparkSession) -> None:
    """Delete this application's scratch folder. Frames read from it are unusable afterwards."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(path, True)
    _FALLBACK.pop(spark.sparkContext.applicationId, None)
