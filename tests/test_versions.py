"""Period datasets stay whole when a write fails, and rows keep their place in their file."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from scrutin.sinks import versions as V
from scrutin.sources.registry import file_system
from scrutin.sources.tables import read_table


def data(spark, *years, value="old"):
    return spark.createDataFrame([(y, i, value) for y in years for i in range(3)], "annee_election int, id int, v string")


def seen(spark, uri, *periods):
    found = V.read_periods(spark, uri, "annee_election", periods or None)
    return {(r.annee_election, r.v) for r in found.select("annee_election", "v").distinct().collect()}


def test_periods_are_replaced_at_once_or_not_at_all(spark, folder):
    uri = f"{folder}/set"
    with pytest.raises(FileNotFoundError):
        V.read_periods(spark, uri, "annee_election")
    V.write_periods(data(spark, 2008, 2014), uri)
    V.write_periods(data(spark, 2014, 2020, value="new"), uri)
    assert seen(spark, uri) == {(2008, "old"), (2014, "new"), (2020, "new")}
    assert seen(spark, uri, 2014) == {(2014, "new")}
    # A write that dies in its tasks, after some files are complete.
    broken = data(spark, 2008, 2014, value="bad").repartition(6, "annee_election", "id")
    broken = broken.withColumn("v", F.when(F.col("id") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        V.write_periods(broken, uri)
    assert seen(spark, uri) == {(2008, "old"), (2014, "new"), (2020, "new")}
    # A job that dies while it writes its manifest.
    number = V.current(spark, uri)[0]
    fs, path = file_system(spark, f"{uri}/{V.MANIFESTS}/{number + 1:012d}.json")
    stream = fs.create(path)
    stream.write(bytearray(b'{"periods": {"annee_el'))
    stream.close()
    assert seen(spark, uri, 2008, 2020) == {(2008, "old"), (2020, "new")}
    V.write_periods(data(spark, 2008, value="newer"), uri)
    assert seen(spark, uri) == {(2008, "newer"), (2014, "new"), (2020, "new")}
    V.write_periods(data(spark), uri)
    assert len(V.drop_unused(spark, uri)) >= 1
    assert seen(spark, uri) == {(2008, "newer"), (2014, "new"), (2020, "new")}


def test_one_of_two_writers_fails(spark, folder, monkeypatch):
    uri, first = f"{folder}/set", V.current
    V.write_periods(data(spark, 2008), uri)
    calls = []

    def interrupted(session, where):
        calls.append(1)
        if len(calls) == 2:
            monkeypatch.setattr(V, "current", first)
            V.write_periods(data(spark, 2008, value="other"), uri)
        return first(session, where)

    monkeypatch.setattr(V, "current", interrupted)
    with pytest.raises(V.Conflict):
        V.write_periods(data(spark, 2008, value="late"), uri)
    monkeypatch.setattr(V, "current", first)
    assert seen(spark, uri) == {(2008, "other")}


@pytest.mark.parametrize("block", [64, 1 << 20])
def test_positions_follow_the_files(spark, folder, block):
    for name in ("a", "b"):
        with open(f"{folder}/{name}.csv", "w") as out:
            out.write("n;x\n" + "".join(f"{name}{k:03d};{'y' * (k % 7)}\n" for k in range(60)))
    table = read_table(spark, folder, columns=["n"], position="place", block_bytes=block)
    shuffled = table.repartition(7, "n").filter("n <> 'a005'")
    got = [r.n for r in shuffled.orderBy("place").collect()]
    assert got == [f"{f}{k:03d}" for f in "ab" for k in range(60) if (f, k) != ("a", 5)]
    assert rows(table.select(F.count(F.lit(1)))) == [(120,)]


def test_small_blocks_share_tasks_and_positions_hold_no_path(spark, folder):
    with open(f"{folder}/a b%.csv", "w") as out:
        out.write("n\n" + "".join(f"{k:05d}\n" for k in range(4000)))
    with open(f"{folder}/b.csv", "w") as out:
        out.write("n\n" + "".join(f"{k:05d}\n" for k in range(4000, 4100)))
    table = read_table(spark, folder, position="place", block_bytes=100)
    assert table.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism < 24000 // 100
    assert dict(table.dtypes)["place"] == "struct<file:int,block:bigint,row:bigint>"
    placed = table.repartition(5, "n").orderBy("place").select("n").collect()
    assert [int(r.n) for r in placed] == list(range(4100))
