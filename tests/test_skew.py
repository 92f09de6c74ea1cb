"""Joins and period counts where one key holds a third of the rows, or there are very many of either."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from scrutin.operators import lookup as L
from scrutin.operators import periods as P


def skewed(spark, n=3000, partitions=6):
    """A third of the rows on key 7, some null, the others spread."""
    rng = random.Random(2)
    keys = [7 if k % 3 == 0 else None if k % 17 == 0 else rng.randint(0, 400) for k in range(n)]
    frame = spark.createDataFrame([(k, k if k is None else f"t{k % 5}", i) for i, k in enumerate(keys)], "k int, t string, row int")
    return frame.repartition(partitions), keys


def test_heavy_keys_are_exact(spark, monkeypatch):
    frame, keys = skewed(spark)
    assert [(r.k, r["__rows"]) for r in L.heavy_keys(frame, ["k"], 900).collect()] == [(7, keys.count(7))]
    assert L.heavy_keys(frame, ["k"], keys.count(7) + 1) is None and L.heavy_keys(frame, ["k"], 10_000) is None
    # One bucket for all keys: full, and still only true heavy keys come out.
    monkeypatch.setattr(L, "BUCKETS", 1)
    assert [r.k for r in L.heavy_keys(frame, ["k", "t"], 900).collect()] == [7]
    nulls = spark.createDataFrame([(None,)] * 20 + [(1,)] * 3, "k int")
    assert [tuple(r) for r in L.heavy_keys(nulls, ["k"], 20).collect()] == [(None, 20)]


@pytest.mark.parametrize("null_safe", [True, False])
def test_lookup_without_counts_finds_hot_keys(spark, null_safe):
    frame, keys = skewed(spark)
    table = spark.createDataFrame([(k, f"v{k}") for k in [None, *range(0, 300)]], "k int, v string")
    got = L.lookup(frame, table, ["k"], null_safe=null_safe, hot_rows=900)
    want = [(k, None if k is None else f"t{k % 5}", i, ("vNone" if null_safe else None) if k is None else f"v{k}" if k < 300 else None) for i, k in enumerate(keys)]
    assert rows(got) == sorted(want, key=repr)
    # The rows of the hot key have their answer from a broadcast table and are spread over the shuffle.
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "__side" in plan
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        sizes = got.select("k", F.spark_partition_id().alias("p")).filter("k = 7").groupBy("p").count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < keys.count(7) / 2


@pytest.mark.parametrize(("few", "words"), [(100_000, 1 << 21), (0, 1 << 21), (0, 0)])
def test_semi(spark, monkeypatch, few, words):
    monkeypatch.setattr(L, "BROADCAST_ROWS", few)
    monkeypatch.setattr(L, "BITMAP_WORDS", words)
    frame, keys = skewed(spark)
    allowed = spark.createDataFrame([(k, f"t{k % 5}") for k in [7, 7, *range(100, 250)]] + [(None, None)], "k int, t string")
    want = [i for i, k in enumerate(keys) if k == 7 or k is not None and 100 <= k < 250]
    for names in (["k"], ["k", "t"]):
        got = L.semi(frame, allowed, names, hot_rows=900)
        assert got.columns == frame.columns
        assert sorted(r.row for r in got.collect()) == want
    assert L.semi(frame, allowed.limit(0), ["k"]).count() == 0


def test_bitmap_takes_out_most_other_keys(spark):
    left = spark.range(100_000, 200_000).withColumnRenamed("id", "k")
    allowed = spark.range(0, 4000).withColumnRenamed("id", "k")
    assert L._may_match(left, allowed, 4000, ["k"]).count() < 0.05 * 100_000
    assert L._may_match(allowed, allowed, 4000, ["k"]).count() == 4000


@pytest.mark.parametrize("n", [5, 63, 64, 200])
def test_any_number_of_periods_takes_one_shuffle(spark, n):
    rng = random.Random(n)
    data = [(k, p) for k in range(30) for p in range(n) if k % 3 == 0 or rng.random() < 0.9] + [(None, 1), (1, None), (0, 0), (0, n + 9)]
    frame = spark.createDataFrame(data, "k int, p int")
    whole = {k for k in range(30) if {p for key, p in data if key == k} >= set(range(n))}
    scope = list(range(n))
    counts = P.period_counts(frame, "k", "p", scope)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    found = {r.k: (r.periods, r.rows) for r in counts.collect()}
    assert found == {k: (len({p for a, p in data if a == k and p in scope}), sum(a == k and p in scope for a, p in data)) for k in range(30)}
    assert plan.count("Exchange hashpartitioning") == 1
    got = P.present_in_all(frame, "k", "p", scope)
    assert {r.k for r in got.collect()} == whole and whole
