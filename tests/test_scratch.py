"""Shuffle files of written steps."""

import time

from pyspark.sql import functions as F

from scrutin.catalog.writing import write_files
from scrutin.scratch import small_tasks, staged


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [found.apply(i).getName() for i in range(found.size())]
    return {n for n in names if n.startswith("shuffle_")}


def left_by(spark, write):
    before = shuffle_files(spark)
    write()
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    return left


def test_shuffle_files_of_written_steps_are_freed(spark):
    rows = spark.range(1000).withColumn("key", F.col("id") % 7)
    lines = rows.select(F.lit(1).alias("part"), F.col("id").cast("string").alias("line"))
    assert not left_by(spark, lambda: staged(rows.groupBy("key").count(), "freed"))
    assert not left_by(spark, lambda: write_files(spark, lines, "freed", {1: ["head"]}))
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_small_tasks_split_what_a_fixed_number_of_partitions_would_hold(spark):
    rows = spark.range(0, 400_000, 1, 4).select(F.sha2(F.col("id").cast("string"), 512).alias("key"))
    grouped = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    names = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    before = [spark.conf.get(n, None) for n in names]
    files = staged(grouped, "small", small=True).inputFiles()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(files) > partitions >= len(staged(grouped, "large").inputFiles())
    assert [spark.conf.get(n, None) for n in names] == before
    with small_tasks(spark), small_tasks(spark):
        pass
    assert [spark.conf.get(n, None) for n in names] == before
