"""Source files that catalog jobs write, and how their sizes count."""

import glob
import gzip

import pytest
from conftest import rows
from pyspark.sql import functions as F

from scrutin.catalog.writing import write_files
from scrutin.sources.lines import block_reader, read_lines, reading_tasks, sectioned


@pytest.mark.parametrize("n", [0, 1000])
def test_source_files_are_written_where_their_rows_are(spark, folder, n):
    lines = spark.range(0, n, 1, 3).select((F.col("id") % 2 + 1).alias("part"), F.concat(F.lit("é"), "id").alias("line"))
    heads = {0: ["before"], 1: ["Tour1", "header"], 2: ["Tour2", "header"]}
    path = write_files(spark, lines, "own", heads, "ISO-8859-1", f"{folder}/own")
    files = [gzip.open(f, "rt", encoding="ISO-8859-1").read().splitlines() for f in glob.glob(f"{path}/part-*")]
    # One file a task, and one of heads alone: nothing was dealt out anew.
    assert len(files) == (4 if n else 1)
    for found in files:
        second = found.index("Tour2")
        assert found[:3] == ["before", "Tour1", "header"] and found[second + 1] == "header"
        assert all(int(x[1:]) % 2 == 0 for x in found[3:second]) and all(int(x[1:]) % 2 == 1 for x in found[second + 2:])
    read = sectioned(read_lines(spark, path, "latin-1"), ["Tour1", "Tour2"], "tour")
    assert rows(read.select("tour", "line")) == rows(lines)
    assert write_files(spark, lines, "one", {1: ["h"]}, "UTF-8", f"{folder}/one")
    assert all(gzip.open(f, "rt").readline() == "h\n" for f in glob.glob(f"{folder}/one/part-*"))


def test_compressed_files_count_by_their_text(spark, folder):
    lines = spark.range(0, 2000, 1, 1).select(F.sha2(F.col("id").cast("string"), 256).alias("value"))
    lines.write.option("compression", "gzip").text(f"{folder}/z")
    lines.write.text(f"{folder}/plain")
    reader = block_reader(spark, 10_000)
    assert reading_tasks(reader, [f"{folder}/z"]) > reading_tasks(reader, [f"{folder}/plain"]) >= 13
