"""Blocks of small files that share tasks."""

from pyspark.sql import functions as F

from scrutin.sources import lines as L


def test_small_files_share_tasks_and_keep_their_positions(spark, folder):
    files = 5 * spark.sparkContext.defaultParallelism
    for k in range(files):
        with open(f"{folder}/f{k:03}.txt", "w") as out:
            out.write("".join(f"{k};{i}\n" for i in range(20)))
    lines = L.read_lines(spark, folder, "utf-8")
    assert lines.rdd.getNumPartitions() < files
    number = F.regexp_extract("file", r"f(\d+)\.txt$", 1).cast("int")
    place = F.concat_ws(";", number, F.col("row"))
    assert lines.filter((place == F.col("line")) & (F.col("block") == 0)).count() == lines.count() == 20 * files
    assert L.without_header(lines).count() == 19 * files


def test_blocks_of_large_files_keep_their_own_tasks(spark, folder):
    with open(f"{folder}/large.txt", "w") as out:
        out.write("0123456789\n" * 4000)
    lines = L.read_lines(spark, folder, "utf-8", 1000)
    assert lines.rdd.getNumPartitions() == 44
    assert lines.select("block", "row").distinct().count() == 4000
