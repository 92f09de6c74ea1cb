"""What jobs leave on disk while they run: shuffles and staged rows."""

import glob
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from scrutin import scratch
from scrutin.operators import rollup
from scrutin.scratch import discard, scratch_dir, staged


def ballots(spark, n=3000):
    rng = random.Random(5)
    data = [
        (rng.choice([None, *range(40)]), rng.choice(["x", "", None]), rng.choice([None, *"abc"]), rng.choice([None, 3, 5, 8]),
         rng.choice([None, 7, 9]), rng.choice([None, *"pqr"]), rng.choice([None, 1, 2]))
        for _ in range(n)
    ] + [(None, None, None, None, None, None, None)] * 3
    return spark.createDataFrame(data, "k int, t string, u string, m bigint, n bigint, d string, v bigint").repartition(5)


def tables(spark):
    return {p.rsplit("/", 1)[-1].rsplit("-", 1)[0] for p in glob.glob(scratch_dir(spark).removeprefix("file:") + "/*")}


def plans(monkeypatch):
    found = []
    write = scratch.staged

    def recorded(df, *args, **named):
        found.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, *args, **named)

    monkeypatch.setattr(scratch, "staged", recorded)
    return found


@pytest.mark.parametrize("unit", ["u", None])
@pytest.mark.parametrize("hot_rows", [20, 10**9])
def test_rolled_rows_are_shuffled_once_and_go(spark, monkeypatch, unit, hot_rows):
    df = ballots(spark)
    want = rollup.rollup_units(df, ["k", "t"], ["m", "n"], ["d"], "v", unit)
    before, found = tables(spark), plans(monkeypatch)
    got = rollup.rollup_rows(df, ["k", "t"], ["m", "n"], ["d"], "v", unit, hot_rows)
    assert got.schema == want.schema and rows(got) == rows(want)
    assert "rollup-rows" not in tables(spark) - before
    if hot_rows == 10**9:
        assert found[-1].count("Exchange") == 1 and "SinglePartition" not in found[-1]


def test_rolled_rows_of_other_types(spark):
    df = ballots(spark).withColumn("k", F.col("k").cast("double"))
    want = rollup.rollup_units(df, ["k", "t"], ["m"], ["d"], "v", "u")
    assert rows(rollup.rollup_rows(df, ["k", "t"], ["m"], ["d"], "v", "u")) == rows(want)
    assert rollup.rollup_rows(df.limit(0), ["k", "t"], ["m"], ["d"], "v", "u").count() == 0


@pytest.mark.parametrize("hot_rows", [20, 10**9])
def test_maxima_of_rows_take_one_shuffle(spark, hot_rows):
    df = ballots(spark)
    got = rollup.spread_max_rows(df, ["k", "u"], ["m", "n"], hot_rows)
    if hot_rows == 10**9:
        assert got._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert rows(got) == rows(rollup.spread_max(df, ["k", "u"], ["m", "n"])) and got.columns == df.columns


def test_only_staged_tables_are_discarded(spark, folder):
    kept, gone = staged(spark.range(5), "kept"), staged(spark.range(5), "gone")
    discard(gone)
    assert kept.count() == 5 and "gone" not in tables(spark)
    spark.range(3).write.parquet(f"{folder}/own")
    with pytest.raises(ValueError, match="not a staged table"):
        discard(spark.read.parquet(f"{folder}/own"))
    assert spark.read.parquet(f"{folder}/own").count() == 3
