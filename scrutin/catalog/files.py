"""File layouts: table rows are written in a layout and read back through its reader."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrutin.catalog.views import table
from scrutin.catalog.writing import line_of, write_files
from scrutin.operators.blocks import any_filled, unpivot_blocks
from scrutin.operators.project import fields_at
from scrutin.plans.nuances import stage_nuances
from scrutin.plans.star import read_flat
from scrutin.scratch import new_path
from scrutin.sinks.files import write_delimited, write_flat
from scrutin.sinks.versions import read_periods, write_periods
from scrutin.sources import lines as text
from scrutin.sources.records import records
from scrutin.sources.tables import (
    read_keys,
    read_objects,
    read_table,
)


def sections(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        F.when(F.col("o_orderpriority") < "3", 1).otherwise(2).alias("part"),
        line_of(
            4,
            {
                0: F.col("o_orderkey"),
                1: F.concat(F.lit("é"), F.col("o_orderstatus")),
                3: F.col("o_orderpriority"),
            },
            ";",
        ).alias("line"),
    )
    heads = {0: ["preamble;é;;"], 1: [" Tour1 ", "h;h;h;h"], 2: ["Tour2", "h;h;h;h"]}
    path = write_files(spark, orders, "sectioned", heads, "ISO-8859-1")
    rows = text.sectioned(text.read_lines(spark, path, "latin-1"), ["Tour1", "Tour2"], "tour")
    rows = text.delimited(rows, ";", 4)
    return rows.select(
        "tour", *fields_at("fields", {"orderkey": 0, "status": 1, "priority": 3})
    )


SECTIONS_SQL = """
select cast(case when o_orderpriority < '3' then 1 else 2 end as bigint) as tour,
       cast(o_orderkey as varchar) as orderkey, 'é' || o_orderstatus as status,
       o_orderpriority as priority
from orders
"""


def commented(spark: SparkSession, folder: str) -> DataFrame:
    line = line_of(5, {0: F.col("o_orderkey"), 1: F.col("o_orderstatus"), 4: F.lit("extra")}, ";")
    shaped = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("  -- "), line))
        .when(F.col("o_orderpriority") == "1-URGENT", F.concat_ws(";", F.lit("short"), "o_orderkey"))
        .otherwise(F.concat(F.lit("  "), line))
    )
    orders = table(spark, folder, "orders").select(F.lit(1).alias("part"), shaped.alias("line"))
    path = write_files(spark, orders, "commented", {1: ["-- head", "", "   "]})
    rows = text.delimited(
        text.read_lines(spark, path, "utf-8"), ";", 4, comment="--", keep_fields=4
    )
    return rows.select(
        F.size("fields").cast("bigint").alias("width"),
        *fields_at("fields", {"orderkey": 0, "status": 1, "blank": 2}),
    )


COMMENTED_SQL = """
select cast(4 as bigint) as width, cast(o_orderkey as varchar) as orderkey,
       o_orderstatus as status, '' as blank
from orders where o_orderstatus <> 'F' and o_orderpriority <> '1-URGENT'
"""


def trailing(spark: SparkSession, folder: str) -> DataFrame:
    """Two files with their own separators, headers, blank blocks and empty line ends."""
    rounds = []
    for number, (name, sep) in enumerate((("orders", "\t"), ("customer", ";")), start=1):
        key, label, code = (
            ("o_orderkey", "o_orderpriority", "o_orderstatus")
            if name == "orders"
            else ("c_custkey", "c_mktsegment", "c_nationkey")
        )
        cells = {0: F.col(key), 1: F.lit("x"), 2: F.lit("1"), 3: F.col(label), 6: F.lit("2"), 7: F.col(code)}
        # prefix of 2, blocks of 3: a full one, a blank one, one cut by empty line ends
        line = line_of(12, {k: v for k, v in cells.items() if k < 6}, sep)
        longer = line_of(12, {**cells, 8: F.lit("z")}, sep)
        lines = table(spark, folder, name).select(
            F.lit(number).alias("part"),
            F.when(F.col(label).startswith("1") | F.col(label).startswith("B"), line)
            .otherwise(longer)
            .alias("line"),
        )
        path = write_files(spark, lines, "trailing", {number: [sep.join("header head".split())]})
        read = text.without_header(text.read_lines(spark, path, "utf-8"))
        fields = text.delimited(read, sep, 2, drop_empty="all")
        fields = fields.select(
            F.lit(number).cast("bigint").alias("tour"), *fields_at("fields", {"id": 0}), "fields"
        )
        blocks = unpivot_blocks(fields, "fields", 2, 3)
        rounds.append(
            blocks.select("tour", "id", *fields_at("block", {"a": 0, "b": 1, "c": 2}))
            .filter(any_filled([F.col("b"), F.col("c")]))
        )
    return reduce(DataFrame.unionByName, rounds)


# Fields: id, x | 1, label, '' | '', 2, code | z. Dropping the empty ends leaves the first block
# incomplete on short lines, complete on long ones.
TRAILING_SQL = """
with lines as (
    select cast(1 as bigint) as tour, cast(o_orderkey as varchar) as id, o_orderpriority as label,
           o_orderstatus as code, starts_with(o_orderpriority, '1') as short from orders
    union all
    select 2, cast(c_custkey as varchar), c_mktsegment, cast(c_nationkey as varchar),
           starts_with(c_mktsegment, 'B') from customer)
select tour, id, '1' as a, label as b, '' as c from lines where not short
union all
select tour, id, '', '2', code from lines where not short
"""


def quoted_lines(spark: SparkSession, folder: str) -> DataFrame:
    people = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.concat(F.lit('a;"'), F.col("c_name"), F.lit('" ')).alias("name"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("segment"),
        F.col("c_nationkey").cast("string").alias("nation"),
    )
    path = new_path(spark, "quoted")
    write_delimited(people, path)
    rows = text.quoted(text.without_header(records(text.read_lines(spark, path, "utf-8"))), 6)
    return rows.select(
        F.col("present").cast("bigint").alias("present"),
        *fields_at("fields", {"id": 0, "name": 1, "segment": 2, "nation": 3, "beyond": 5}),
    )


QUOTED_LINES_SQL = """
select cast(4 as bigint) as present, cast(c_custkey as varchar) as id, 'a;"' || c_name || '" ' as name,
       nullif(c_mktsegment, 'BUILDING') as segment, cast(c_nationkey as varchar) as nation,
       cast(null as varchar) as beyond
from customer
"""


#: Bytes of a file block of the quoted texts: small, so that records cross blocks at every scale.
MULTILINE_BLOCK = 256 << 10


def quoted_multiline(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts with their line breaks as quoted fields, read by one task per file block."""
    documents = table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("id"), "text", "lang"
    )
    path = new_path(spark, "multiline")
    write_delimited(documents, path)
    lines = records(text.read_lines(spark, path, "utf-8", MULTILINE_BLOCK))
    rows = text.quoted(text.without_header(lines), 3)
    return rows.select(
        F.col("present").cast("bigint").alias("present"),
        F.get("fields", F.lit(0)).cast("bigint").alias("doc_id"),
        F.md5(F.get("fields", F.lit(1))).alias("digest"),
        F.get("fields", F.lit(2)).alias("lang"),
    )


QUOTED_MULTILINE_SQL = """
select cast(3 as bigint) as present, doc_id, md5(text) as digest, lang from documents
"""


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    people = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.concat(F.lit("  \""), F.col("c_name"), F.lit("; é→ ")).alias("name"),
        F.when(F.col("c_mktsegment") == "BUILDING", "NA")
        .when(F.col("c_mktsegment") == "MACHINERY", "")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "#N/A")
        .otherwise(F.col("c_mktsegment"))
        .alias("segment"),
    )
    path = new_path(spark, "flat")
    write_flat(people, path, "csv", "latin-1")
    return read_flat(spark, path)


CSV_ROUNDTRIP_SQL = """
select cast(c_custkey as varchar) as id, '  "' || c_name || '; é? ' as name,
       case when c_mktsegment in ('BUILDING', 'MACHINERY', 'HOUSEHOLD') then null
            else c_mktsegment end as segment
from customer
"""


def pruned_columns(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "wide")
    write_delimited(table(spark, folder, "lineitem"), path)
    rows = read_table(spark, path, columns=["l_orderkey", "l_returnflag"])
    return rows.groupBy("l_returnflag").agg(
        F.count("l_orderkey").alias("lines"), F.sum(F.col("l_orderkey").cast("bigint")).alias("keys")
    )


PRUNED_COLUMNS_SQL = """
select l_returnflag, count(*) as lines, cast(sum(l_orderkey) as bigint) as keys
from lineitem group by l_returnflag
"""


def key_list(spark: SparkSession, folder: str) -> DataFrame:
    padded = F.concat(F.lit(" "), F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")), F.lit(" "))
    path = new_path(spark, "keys")
    write_delimited(table(spark, folder, "customer").select(padded.alias("code"), "c_name"), path)
    return read_keys(spark, path, "code")


KEY_LIST_SQL = "select distinct c_mktsegment as code from customer where c_mktsegment <> 'BUILDING'"


def by_period(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").cast("bigint").alias("annee_election")
    )
    uri = new_path(spark, "periods")
    write_periods(orders, uri)
    write_periods(orders.filter("annee_election = 1996").withColumn("o_custkey", F.lit(0).cast("bigint")), uri)
    chosen = read_periods(spark, uri, "annee_election", [1996, 1998])
    return chosen.withColumn("annee_election", F.col("annee_election").cast("bigint"))


BY_PERIOD_SQL = """
select o_orderkey, case when year(o_orderdate) = 1996 then 0 else o_custkey end as o_custkey,
       cast(year(o_orderdate) as bigint) as annee_election
from orders where year(o_orderdate) in (1996, 1998)
"""


def objects(spark: SparkSession, folder: str) -> DataFrame:
    people, makers = new_path(spark, "object"), new_path(spark, "object")
    table(spark, folder, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment")
    ).write.parquet(people)
    table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")
    ).write.parquet(makers)
    return read_objects(spark, [people, makers]).select("key", "segment", "name")


OBJECTS_SQL = """
select c_custkey as key, c_mktsegment as segment, cast(null as varchar) as name from customer
union all select s_suppkey, null, s_name from supplier
"""


def reference_list(spark: SparkSession, folder: str) -> DataFrame:
    listing = table(spark, folder, "part").select(
        F.col("p_partkey").alias(" P_PartKey "), F.col("p_name").alias("P_NAME"), F.col("p_size").alias(" p_size")
    )
    csv, uri = new_path(spark, "list"), new_path(spark, "list-object")
    write_delimited(listing, csv, sep=",")
    stored = stage_nuances(spark, csv, uri)
    # Whole numbers come back as inferred integers; bigint keeps them comparable.
    return stored.select(
        F.col("p_partkey").cast("bigint").alias("p_partkey"),
        "p_name",
        (F.col("p_size") + 1).cast("bigint").alias("p_size"),
    )


REFERENCE_LIST_SQL = """
select p_partkey, p_name, cast(p_size + 1 as bigint) as p_size from part
"""

QUERIES = {
    "q_sectioned": (sections, SECTIONS_SQL),
    "q_commented": (commented, COMMENTED_SQL),
    "q_blocks_trailing": (trailing, TRAILING_SQL),
    "q_quoted_csv": (quoted_lines, QUOTED_LINES_SQL),
    "q_quoted_multiline": (quoted_multiline, QUOTED_MULTILINE_SQL),
    "q_flat_csv_roundtrip": (csv_roundtrip, CSV_ROUNDTRIP_SQL),
    "q_pruned_columns": (pruned_columns, PRUNED_COLUMNS_SQL),
    "q_key_list": (key_list, KEY_LIST_SQL),
    "q_parquet_by_year": (by_period, BY_PERIOD_SQL),
    "q_objects": (objects, OBJECTS_SQL),
    "q_reference_list": (reference_list, REFERENCE_LIST_SQL),
}
