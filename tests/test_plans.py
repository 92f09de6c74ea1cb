"""Physical plans: no single-task exchange over data, no Python, no products, pruned scans."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from scrutin.catalog.views import ballot_lines
from scrutin.functions import lenient_long, localised_double, padded_code, star_commune_code, stripped
from scrutin.operators import integrity, rollup
from scrutin.scratch import staged
from scrutin.sources.tables import read_table

SMALL = entry.SMOKE_DIR


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["q_rollup_units", "q_rollup_null_keys", "q_group_max", "q_present_in_all", "q_first_per_key",
     "q_finalize", "q_blocks_fixed", "q_wide_to_long", "q_layout_2014", "q_fact_results", "q_dense_id"],
)
def test_plan_stays_distributed(spark, name):
    text = plan(entry.queries()[name](spark, SMALL))
    assert "SinglePartition" not in text
    assert not re.search(r"Python|CartesianProduct|BroadcastNestedLoopJoin", text)


def test_scans_are_pruned(spark, folder, monkeypatch):
    written = []

    def recorded(df, *args):
        written.append(plan(df))
        return staged(df, *args)

    monkeypatch.setattr(integrity, "staged", recorded)
    monkeypatch.setattr(rollup, "staged", recorded)
    entry.queries()["q_grain_check"](spark, SMALL)
    # The uniqueness rules of both tables: pruned scans, one shuffle.
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in written[0]
    assert "ReadSchema: struct<o_orderkey:bigint>" in written[0] and written[0].count("Exchange hashpartitioning") == 1
    # Both grains of a rollup: one scan of the rows.
    entry.queries()["q_finalize"](spark, SMALL)
    assert written[-1].count("Location: InMemoryFileIndex") == written[-1].count("FileScan parquet")
    assert written[-1].count("lineitem.parquet") == 1 and "SinglePartition" not in written[-1]
    with open(f"{folder}/w.csv", "w") as f:
        f.write("a;b;c\n1;2;3\n")
    assert "ReadSchema: struct<b:string>" in plan(read_table(spark, f"{folder}/w.csv", columns=["b"]))


def test_every_query_with_sql_has_both(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize(
    "text, whole, real",
    [
        (" 12 ", 12, 12.0), ("12.0", 12, 12.0), ("1e3", 1000, 1000.0), ("12.5", None, 12.5),
        ("1d", None, None), ("NaN", None, None), ("inf", None, None), ("", None, None),
        ("1 234,5", None, 1234.5), ("+5", 5, 5.0), ("s", None, None), (None, None, None),
        ("1 234", None, None), (".", None, None), ("e5", None, None),
    ],
)
def test_lenient_numbers(spark, text, whole, real):
    df = spark.createDataFrame([(text,)], "v string")
    assert tuple(df.select(lenient_long("v"), localised_double("v")).first()) == (whole, real)


def test_codes_and_whitespace(spark):
    df = spark.createDataFrame([("123456",), ("-12",), ("　é x\u001f",), ("1\n",)], "v string")
    got = [tuple(r) for r in df.select(padded_code("v", 5), star_commune_code("v"), stripped("v")).collect()]
    assert got == [
        ("123456", "123456", "123456"), ("-12", "-0012", "-12"),
        ("É X", "00é x", "é x"), ("00001", "00001", "1"),
    ]
    assert df.select(F.count("v")).first()[0] == 4


def test_orders_meet_customers_before_lines(spark):
    text = ballot_lines(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("(l_orderkey#") < text.index("(o_custkey#")
