"""Unique keys and references against counts by hand."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from scrutin.operators import integrity as I
from scrutin.operators.lookup import lookup
from scrutin.operators.rules import count_keys


@pytest.mark.parametrize("broadcast", [1_000_000, 0])
def test_repeats(spark, monkeypatch, broadcast):
    monkeypatch.setattr(I, "BROADCAST_ROWS", broadcast)
    rng = random.Random(3)
    pick = lambda values: rng.choice(values)
    # A third of the rows on one key; nulls in one or the other column.
    pairs = [(1, "hot") if k % 3 == 0 else (pick([None, *range(40)]), pick([None, "a", "b", ""])) for k in range(600)]
    numbers = [(x,) for x in (0.0, -0.0, 1.5, None, None, float("nan"), float("nan"), 2.0)]
    frames = [
        spark.createDataFrame(pairs, "a int, b string").repartition(5),
        spark.createDataFrame([(k,) for k in range(500)], "a int"),
        spark.createDataFrame(numbers, "x double"),
        spark.createDataFrame([], "a int"),
    ]
    keys = [("a", "b"), ("a",), ("x",), ("a",)]
    twice = sum(n > 1 for n in Counter(pairs).values())
    assert I.repeats([I.Unique(f, k, "t") for f, k in zip(frames, keys, strict=True)]) == [twice, 0, 3, 0]


def test_equal_hashes_are_compared(spark, monkeypatch):
    monkeypatch.setattr(I, "_hash", lambda frame, keys: F.col(keys[0]) % 5)
    frame = spark.createDataFrame([(k,) for k in [*range(50), 7, 8, 8]], "a bigint")
    assert I.repeats([I.Unique(frame, ("a",), "t")]) == [2]


@pytest.mark.parametrize("broadcast", [1_000_000, 0])
def test_dangling(spark, monkeypatch, broadcast):
    monkeypatch.setattr(I, "BROADCAST_ROWS", broadcast)
    rng = random.Random(4)
    keys = [None if k % 11 == 0 else 63 if k % 3 == 0 else rng.choice([0, -1, 64, 65, 2**62, rng.randint(1, 300)]) for k in range(900)]
    known = [k for k in range(1, 301) if k not in (63, 70, 71)] + [2**62, -64]
    facts = spark.createDataFrame([(k, 1) for k in keys], "k bigint, other int").repartition(4)
    dims = spark.createDataFrame([(k,) for k in known], "id bigint")
    small = spark.createDataFrame([(k,) for k in range(-2, 400)], "k int")
    references = [I.Reference(facts, "k", dims, "f", "id"), I.Reference(facts, "other", small, "f", "k"), I.Reference(small, "k", small, "s")]
    assert I.dangling(references) == [sum(k is None or k not in known for k in keys), 0, 0]
    with pytest.raises(TypeError):
        I.dangling([I.Reference(facts.withColumn("k", F.col("k").cast("string")), "k", dims, "f", "id")])


def test_report_takes_any_key(spark):
    facts = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n int")
    dims = spark.createDataFrame([("a",)], "k string")
    lines = count_keys([I.Unique(facts, ("n",), "f")], [I.Reference(facts, "k", dims, "f"), I.Reference(facts, "n", facts, "f")])
    assert [tuple(r) for r in lines.collect()] == [("(n) is not unique", "f", 0), ("k has no match", "f", 2), ("n has no match", "f", 0)]


def test_valid_references_join_nothing(spark):
    """All rules of a kind take one shuffle, and no table is joined where nothing dangles."""
    facts = spark.range(1000).select((F.col("id") % 100 + 1).alias("k"), F.col("id"))
    dims = spark.range(1, 101).withColumnRenamed("id", "k")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("integrity", "integrity")
    try:
        assert I.dangling([I.Reference(facts, "k", dims, "f"), I.Reference(dims, "k", dims, "d")]) == [0, 0]
        # One job for the words, one to see that none is left, one per table for its nulls.
        assert len(tracker.getJobIdsForGroup("integrity")) <= 8
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_lookup_checks_its_table(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    table = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    with pytest.raises(ValueError, match=r"prices: \(k\) is not unique \(1 keys\)"):
        lookup(left, table, ["k"], checked="prices")
    assert lookup(left, table.filter("v <> 'b'"), ["k"], checked="prices").count() == 2
