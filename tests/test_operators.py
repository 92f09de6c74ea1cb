"""Hot keys, numbering, periods and reshapes, compared with plain Python."""

from collections import defaultdict

import pytest
from conftest import rows
from pyspark.sql import functions as F

from scrutin.operators import periods
from scrutin.operators.keys import dense_id, stable_order
from scrutin.operators.lookup import lookup
from scrutin.operators.periods import present_in_all
from scrutin.operators.reshape import MappedColumn, by_table
from scrutin.operators.rollup import rollup_units, spread_max
from scrutin.plans import indicators as I


def skewed(spark):
    """A third of the rows, all equal, belong to one key; one key is null."""
    data = [("hot", "u", 1, 7)] * 300
    data += [(f"k{i % 40}", f"u{i % 7}", i % 9, i) for i in range(600)]
    data += [(None, None, 3, 4)] * 20
    return spark.createDataFrame(data, "k string, u string, t bigint, v bigint"), data


@pytest.mark.parametrize("hot_rows", [1, 100, 10**9])
def test_hot_keys_change_nothing(spark, hot_rows):
    df, data = skewed(spark)
    top = defaultdict(int)
    unit = defaultdict(int)
    for k, u, t, v in data:
        top[k] = max(top[k], v)
        unit[k, u] = max(unit[k, u], t)
    total = defaultdict(int)
    for (k, _), t in unit.items():
        total[k] += t
    got = rows(spread_max(df, ["k"], ["v"], hot_rows))
    assert got == sorted([(k, u, t, top[k]) for k, u, t, v in data], key=repr)
    got = rows(rollup_units(df, ["k"], ["t"], ["u"], "v", unit="u", hot_rows=hot_rows).select("k", "u", "v", "t"))
    votes = defaultdict(int)
    for k, u, t, v in data:
        votes[k, u] += v
    assert got == sorted([(k, u, v, total[k]) for (k, u), v in votes.items()], key=repr)
    periods = [(k, p) for k, _, p, _ in data]
    years = df.select("k", F.col("t").alias("p"))
    seen = defaultdict(set)
    for k, p in periods:
        seen[k].add(p)
    for scope in ([1], [1, 3], None, [1, 99]):
        wanted = set(scope or {p for _, p in periods})
        keep = [(k, p) for k, p in periods if k is not None and p in wanted and seen[k] >= wanted]
        assert rows(present_in_all(years, "k", "p", scope, hot_rows)) == sorted(keep, key=repr)


def test_hot_rows_are_spread_over_tasks(spark):
    left = spark.range(0, 8000, 1, 8).select(F.lit("hot").alias("k"), F.col("id"))
    right = spark.createDataFrame([("hot", 1, 8000), ("cold", 2, 1)], "k string, x int, n bigint")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = lookup(left, right, ["k"], weight="n", hot_rows=1000)
        sizes = out.groupBy(F.spark_partition_id()).count().collect()
        assert out.filter("x = 1").count() == 8000
        assert len(sizes) == 8 and max(r["count"] for r in sizes) < 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_more_periods_than_bits(spark):
    df = spark.range(70 * 3).select((F.col("id") % 3).alias("k"), (F.col("id") % 70).alias("p"))
    scope = list(range(70))
    full = rows(present_in_all(df, "k", "p", scope))
    assert len(full) == 210
    assert present_in_all(df.filter("not (k = 1 and p = 5)"), "k", "p", scope).select("k").distinct().count() == 2


def test_stack_without_any_period_is_returned_as_it_is(spark):
    df = spark.createDataFrame([("a", None)], "k string, p bigint")
    assert rows(present_in_all(df, "k", "p")) == [("a", None)]


@pytest.mark.parametrize("partitions", [1, 3, 8, 64])
def test_dense_ids_follow_the_order(spark, partitions):
    data = [(a, b) for a in ("x", "é", "", None) for b in (3, None, 1, 2)]
    df = spark.createDataFrame(data, "a string, b int").repartition(5)
    numbered, n = dense_id(df, ["a", "b"], "id", partitions)
    expected = sorted(data, key=lambda r: (r[0] is None, (r[0] or "").encode(), r[1] is None, r[1] or 0))
    assert n == len(data)
    assert [(r.a, r.b) for r in sorted(numbered.collect(), key=lambda r: r.id)] == expected
    assert sorted(r.id for r in numbered.collect()) == list(range(1, n + 1))


def test_stable_order_keeps_input_order_within_a_key(spark):
    df = spark.createDataFrame([("b", 1), ("a", 9), ("b", 0), ("a", 2)], "k string, v int").coalesce(1)
    assert [tuple(r) for r in stable_order(df.withColumn("place", F.monotonically_increasing_id()), ["k"], "place").collect()] == [("a", 9), ("a", 2), ("b", 1), ("b", 0)]


def test_contradictory_mappings_are_refused():
    a = MappedColumn("P1", "t", "m", True, 2011)
    by_table([a, MappedColumn("P2", "t", "m", True, 2016)])
    for other in (
        MappedColumn("P2", "t", "m", True, 2011),
        MappedColumn("P1", "t", "n", True, 2011),
        MappedColumn("P2", "t", "m", False, 2016),
        MappedColumn("P3", "x/y", "m", True, 2011),
    ):
        rows_ = [a, other, MappedColumn("P4", "x_y", "m", True, 2011)]
        with pytest.raises(ValueError):
            by_table(rows_)


def save(folder, name, text):
    with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
        f.write(text)
    return f"{folder}/{name}"


def test_indicator_files(spark, folder):
    mapping = save(
        folder, "mapping.csv",
        "source_code;target_table;canonical_metric;data_type;available_years\n"
        "P11_POP;demo/pop;population;NUM;2011\nP16_POP;demo/pop; population ;num;2016\n"
        "C16_LABEL;demo/pop;label;CHAR;2016\nP99_MISSING;demo/pop;other;NUM;2011\n"
        "P16_POP2;demo/pop;x;NUM;n.a.\nX;other;y;NUM;2016.0\n;demo/pop;z;NUM;2011\n",
    )
    raw = save(
        folder, "raw.csv",
        "CODGEO;P11_POP;P16_POP;C16_LABEL;X;UNUSED\n"
        "01004;1 234,5;10;aa;1;u\n2A004;s;NA;;2;u\n99999;1;2;b;3;u\n",
    )
    meta = save(folder, "meta.csv", "COD_VAR;LIB\nP11_POP;p\nP16_POP;q\nX;x\n")
    geo = save(folder, "geo.csv", "code_commune;z\n 01004 ;1\n2A004;2\n;3\n")
    built = I.reshape_files(spark, raw, mapping, meta, geo)
    assert sorted(built.tables) == ["demo_pop", "other"]
    assert built.missing_in_raw == ["P99_MISSING"] and built.missing_in_meta == ["C16_LABEL"]
    pop = built.tables["demo_pop"]
    assert pop.dtypes == [
        ("CODGEO", "string"), ("annee", "bigint"), ("population", "double"), ("label", "string"),
    ]
    assert [tuple(r) for r in pop.collect()] == [
        ("01004", 2011, 1234.5, None), ("01004", 2016, 10.0, "aa"),
        ("2A004", 2011, None, None), ("2A004", 2016, None, None),
    ]
    with pytest.raises(ValueError):
        I.reshape_files(spark, geo, mapping)


def test_limit_keeps_any_so_many_rows(spark, folder):
    with open(f"{folder}/raw.csv", "w") as out:
        out.write("CODGEO;P1\n" + "".join(f"{k:05d};{k}\n" for k in range(50)))
    with open(f"{folder}/mapping.csv", "w") as out:
        out.write("source_code;target_table;canonical_metric;data_type;available_years\nP1;t;m;NUM;2011\n")
    built = I.reshape_files(spark, f"{folder}/raw.csv", f"{folder}/mapping.csv", limit=7)
    found = built.tables["t"].collect()
    assert len(found) == 7 and all(int(r.CODGEO) == r.m for r in found)
    assert [r.CODGEO for r in found] == sorted(r.CODGEO for r in found)
    assert [tuple(r) for r in built.counts.report(spark).collect()] == [
        ("mapping", "usable", 1, 1, 0), ("wide", "read", None, 7, None), ("table", "t", None, 7, None)
    ]


def test_joins_on_several_keys_sort_by_a_hash_first(spark):
    left = spark.createDataFrame([("a", 1, 7), (None, 1, 8), ("a", None, 9), ("b", 2, 10)], "k string, n int, v int")
    right = left.select("k", "n", (F.col("v") * 10).alias("w"), F.lit(1).alias("rows")).filter("v <> 10").hint("merge")
    found = lookup(left, right, ["k", "n"], weight="rows")
    assert rows(found) == sorted([("a", 1, 7, 70), (None, 1, 8, 80), ("a", None, 9, 90), ("b", 2, 10, None)], key=repr)
    assert "__digest" in found._jdf.queryExecution().optimizedPlan().toString()
    # The two zeros are equal but have different hashes.
    floats = spark.createDataFrame([("a", -0.0)], "k string, x double")
    table = spark.createDataFrame([("a", 0.0, 5, 1)], "k string, x double, w int, rows int")
    assert [r.w for r in lookup(floats, table, ["k", "x"], weight="rows").collect()] == [5]


@pytest.mark.parametrize("limit", [500_000, 2, -1])
def test_present_rows_stay_where_they_are(spark, monkeypatch, limit):
    data = [(n, k, p) for n in range(3) for k in "abcde" for p in (1, 2) if k != "b" or p == 1] + [(9, None, 1), (9, "a", None)]
    df = spark.createDataFrame(data, "n int, k string, p int")
    monkeypatch.setattr(periods, "BROADCAST_KEYS", limit)
    for frame, whole in ((df, "acde"), (df.filter("p = 1 or k = 'a'"), "a")):
        for scope in (None, [1, 2]):
            got = present_in_all(frame, "k", "p", scope)
            assert got.columns == ["n", "k", "p"]
            assert rows(got) == sorted([(n, k, p) for n, k, p in rows(frame) if k in set(whole) and p is not None], key=repr)
            assert limit < 0 or "Exchange hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()
