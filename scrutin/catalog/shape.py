"""Rollups, periods, keys, joins, projections and reshapes on in-memory frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrutin.catalog.views import FLAT_SQL, flat, table
from scrutin.operators.blocks import any_filled, unpivot_blocks
from scrutin.operators.keys import dense_id, first_per_key
from scrutin.operators.lookup import lookup, semi
from scrutin.operators.periods import present_in_all
from scrutin.operators.project import Patch, conform, fields_at, patch_cells, stack, with_unknown_member
from scrutin.operators.reshape import MappedColumn
from scrutin.operators.rollup import rollup_units, spread_max
from scrutin.plans.indicators import (
    Reshape,
    clean_mapping,
    removed_counts,
    reshape_files,
    reshape_table,
    write_reshape,
)
from scrutin.scratch import new_path
from scrutin.sinks.files import write_delimited
from scrutin.sources.lines import delimited
from scrutin.sources.tables import read_table

# --- rollups -----------------------------------------------------------------------------------


def rollup(spark: SparkSession, folder: str) -> DataFrame:
    return rollup_units(flat(spark, folder), ["yr", "geo"], ["tot"], ["cand"], "votes", unit="unit")


def _rollup_sql(flat_sql: str) -> str:
    return f"""
with flat as ({flat_sql}),
u as (select yr, geo, unit, max(tot) as tot from flat group by all),
g as (select yr, geo, cast(coalesce(sum(tot), 0) as bigint) as tot from u group by all),
s as (select yr, geo, cand, cast(sum(votes) as bigint) as votes from flat group by all)
select s.yr, s.geo, s.cand, s.votes, g.tot
from s left join g on s.yr is not distinct from g.yr and s.geo is not distinct from g.geo
"""


def rollup_no_unit(spark: SparkSession, folder: str) -> DataFrame:
    return rollup_units(flat(spark, folder), ["yr", "geo"], ["tot"], ["cand"], "votes")


ROLLUP_NO_UNIT_SQL = f"""
with flat as ({FLAT_SQL}),
g as (select yr, geo, max(tot) as tot from flat group by all),
s as (select yr, geo, cand, cast(sum(votes) as bigint) as votes from flat group by all)
select s.*, g.tot from s join g using (yr, geo)
"""


def rollup_null_keys(spark: SparkSession, folder: str) -> DataFrame:
    rows = flat(spark, folder).select(
        "yr",
        F.nullif(F.col("geo"), F.lit("NATION_7")).alias("geo"),
        "unit",
        F.when(F.col("geo") != "NATION_3", F.col("tot")).alias("tot"),
        "cand",
        F.when(F.col("cand") != "Brand#7", F.col("votes")).alias("votes"),
    )
    return rollup_units(rows, ["yr", "geo"], ["tot"], ["cand"], "votes", unit="unit")


_NULL_FLAT = f"""
select yr, nullif(geo, 'NATION_7') as geo, unit,
       case when geo <> 'NATION_3' then tot end as tot, cand,
       case when cand <> 'Brand#7' then votes end as votes
from ({FLAT_SQL})
"""


def group_max(spark: SparkSession, folder: str) -> DataFrame:
    rows = flat(spark, folder).withColumn("own", F.col("votes"))
    return spread_max(rows, ["yr", "geo", "cand"], ["tot", "votes"]).withColumn(
        "rest", F.col("tot") - F.col("votes")
    )


GROUP_MAX_SQL = f"""
with m as (
    select yr, geo, unit, cand, votes as own,
           max(tot) over (partition by yr, geo, cand) as tot,
           max(votes) over (partition by yr, geo, cand) as votes
    from ({FLAT_SQL}))
select *, tot - votes as rest from m
"""

# --- periods -----------------------------------------------------------------------------------


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").cast("bigint").alias("yr")
    )


def present_some(spark: SparkSession, folder: str) -> DataFrame:
    return present_in_all(_orders(spark, folder), "o_custkey", "yr", [1995, 1996, 1997])


_ORDERS = "select o_orderkey, o_custkey, cast(year(o_orderdate) as bigint) as yr from orders"
PRESENT_SOME_SQL = f"""
with o as (select * from ({_ORDERS}) where yr in (1995, 1996, 1997))
select * from o where o_custkey in
    (select o_custkey from o group by o_custkey having count(distinct yr) = 3)
"""


def present_every(spark: SparkSession, folder: str) -> DataFrame:
    return present_in_all(_orders(spark, folder), "o_custkey", "yr")


PRESENT_EVERY_SQL = f"""
with o as ({_ORDERS})
select * from o where o_custkey in
    (select o_custkey from o group by o_custkey
     having count(distinct yr) = (select count(distinct yr) from o))
"""


# --- keys and joins ----------------------------------------------------------------------------


def first_row(spark: SparkSession, folder: str) -> DataFrame:
    return first_per_key(flat(spark, folder), ["cand"], ["yr", "geo", "unit", "tot", "votes"])


FIRST_ROW_SQL = f"""
select yr, geo, unit, tot, cand, votes from (
    select *, row_number() over (
        partition by cand order by yr nulls last, geo nulls last, unit nulls last,
                                   tot nulls last, votes nulls last) as n
    from ({FLAT_SQL}))
where n = 1
"""


def numbered(spark: SparkSession, folder: str) -> DataFrame:
    groups = (
        flat(spark, folder)
        .withColumn("geo", F.nullif(F.col("geo"), F.lit("NATION_7")))
        .groupBy("geo", "unit", "cand")
        .agg(F.sum("votes").alias("votes"))
    )
    return dense_id(groups, ["geo", "unit", "cand"], "id")[0]


NUMBERED_SQL = f"""
with g as (
    select nullif(geo, 'NATION_7') as geo, unit, cand, cast(sum(votes) as bigint) as votes
    from ({FLAT_SQL}) group by all)
select cast(row_number() over (
           order by geo nulls last, unit nulls last, cand nulls last) as bigint) as id,
       geo, unit, cand, votes
from g
"""


def _buyers(spark: SparkSession, folder: str) -> tuple[DataFrame, int]:
    buyers = table(spark, folder, "orders").groupBy("o_custkey").agg(F.count("*").alias("orders"))
    return dense_id(buyers, ["o_custkey"], "buyer_sk")


def unknown_fact(spark: SparkSession, folder: str) -> DataFrame:
    buyers, size = _buyers(spark, folder)
    people = table(spark, folder, "customer").select("c_custkey", F.col("c_custkey").alias("o_custkey"))
    joined = lookup(
        people, buyers.select("o_custkey", "buyer_sk"), ["o_custkey"], right_rows=size, checked="buyers"
    )
    return joined.select("c_custkey", F.coalesce("buyer_sk", F.lit(0)).alias("buyer_sk"))


_BUYERS = """
select cast(row_number() over (order by o_custkey) as bigint) as buyer_sk,
       cast(o_custkey as varchar) as buyer_nk, cast(orders as bigint) as orders, o_custkey
from (select o_custkey, count(*) as orders from orders group by o_custkey)
"""
UNKNOWN_FACT_SQL = f"""
with buyers as ({_BUYERS})
select c_custkey, coalesce(buyer_sk, 0) as buyer_sk
from customer left join buyers on o_custkey = c_custkey
"""


def unknown_member(spark: SparkSession, folder: str) -> DataFrame:
    buyers, _ = _buyers(spark, folder)
    members = buyers.select("buyer_sk", F.col("o_custkey").cast("string").alias("buyer_nk"), "orders")
    return with_unknown_member(members, "buyer_sk", "buyer_nk", "UNKNOWN")


UNKNOWN_MEMBER_SQL = f"""
select buyer_sk, buyer_nk, orders from ({_BUYERS})
union all select 0, 'UNKNOWN', null
"""


def allowed_keys(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return semi(table(spark, folder, "customer"), orders, ["c_custkey"]).select("c_custkey", "c_name")


ALLOWED_KEYS_SQL = """
select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders)
"""

# --- lines, blocks, projections ----------------------------------------------------------------


def blocks_fixed(spark: SparkSession, folder: str) -> DataFrame:
    line = F.concat_ws(
        ";",
        *[
            F.col(c).cast("string")
            for c in ("l_orderkey", "l_linenumber", "l_shipdate")
        ],
        F.col("l_returnflag"), F.col("l_quantity").cast("bigint").cast("string"),
        F.lit(""), F.lit(" "),
        F.col("l_linestatus"), F.col("l_suppkey").cast("string"),
        # an incomplete third block, then the separator that ends the line
        F.lit("cut"), F.lit(""),
    )
    lines = table(spark, folder, "lineitem").select(line.alias("line"))
    rows = delimited(lines, ";", 3, drop_empty="one")
    rows = rows.select(*fields_at("fields", {"l_orderkey": 0, "l_linenumber": 1}), "fields")
    rows = unpivot_blocks(rows, "fields", 3, 2)
    rows = rows.select("l_orderkey", "l_linenumber", *fields_at("block", {"kind": 0, "amount": 1}))
    return rows.filter(any_filled([F.col("kind"), F.col("amount")]))


BLOCKS_FIXED_SQL = """
select cast(l_orderkey as varchar) as l_orderkey, cast(l_linenumber as varchar) as l_linenumber,
       l_returnflag as kind, cast(cast(l_quantity as bigint) as varchar) as amount from lineitem
union all
select cast(l_orderkey as varchar), cast(l_linenumber as varchar), l_linestatus,
       cast(l_suppkey as varchar) from lineitem
"""


def patched(spark: SparkSession, folder: str) -> DataFrame:
    heavy = Patch(
        (F.col("geo") == "NATION_3") & F.col("cand").isin("Brand#7", "Brand#8"),
        {"votes": F.lit(0).cast("bigint"), "tot": F.col("votes")},
    )
    return patch_cells(flat(spark, folder), [heavy])


PATCHED_SQL = f"""
with flagged as (select *, geo = 'NATION_3' and cand in ('Brand#7', 'Brand#8') as hit from ({FLAT_SQL}))
select yr, geo, unit, case when hit then votes else tot end as tot, cand,
       case when hit then 0 else votes end as votes
from flagged
"""

_CONFORMED = T.StructType(
    [
        T.StructField("key", T.LongType()),
        T.StructField("nation", T.LongType()),
        T.StructField("segment", T.StringType()),
        T.StructField("note", T.StringType()),
    ]
)


def conformed(spark: SparkSession, folder: str) -> DataFrame:
    people = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("key"),
        F.col("c_nationkey").cast("string").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
        "c_acctbal",
    )
    makers = table(spark, folder, "supplier").select(
        F.col("s_nationkey").cast("string").alias("nation"), F.col("s_suppkey").alias("key")
    )
    return conform(stack([people, makers]), _CONFORMED)


CONFORMED_SQL = """
select c_custkey as key, cast(c_nationkey as bigint) as nation, c_mktsegment as segment,
       cast(null as varchar) as note from customer
union all
select s_suppkey, cast(s_nationkey as bigint), null, null from supplier
"""

# --- wide to long ------------------------------------------------------------------------------

_WIDE_MAPPING = [
    MappedColumn("P11_QTY", "demo/volume", "quantity", True, 2011),
    MappedColumn("P16_QTY", "demo/volume", "quantity", True, 2016),
    MappedColumn("P16_TAX", "demo/volume", "tax", True, 2016),
    MappedColumn("C11_FLAG", "demo/state", "flag", False, 2011),
    MappedColumn("C16_FLAG", "demo/state", "flag", False, 2016),
    MappedColumn("C16_ABSENT", "demo/state", "other", False, 2016),
]


def _wide(spark: SparkSession, folder: str) -> DataFrame:
    amount = F.col("l_quantity").cast("bigint").cast("string")
    return table(spark, folder, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("CODGEO"),
        F.concat(amount, F.lit(" 000,5")).alias("P11_QTY"),
        F.when(F.col("l_linestatus") == "O", F.lit("s")).otherwise(amount).alias("P16_QTY"),
        F.concat(F.lit("0,"), F.lpad(F.rint(F.col("l_tax") * 100).cast("int").cast("string"), 2, "0")).alias("P16_TAX"),
        F.col("l_returnflag").alias("C11_FLAG"),
        F.col("l_linestatus").alias("C16_FLAG"),
        F.col("l_shipdate").cast("string").alias("UNUSED"),
    )


def _hundredths(column: str):
    return F.rint(F.col(column) * 100).cast("bigint").alias(column)


_TOPICS = {"demo_volume": ("quantity", "tax"), "demo_state": ("flag",)}


def _all_topics(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of all topic tables, under the name of their table."""
    volume, state = tables["demo_volume"], tables["demo_state"]
    volume = volume.withColumns({c: _hundredths(c) for c in ("quantity", "tax")})
    named = [t.withColumn("topic", F.lit(n)) for n, t in (("demo_volume", volume), ("demo_state", state))]
    return stack(named).select("topic", "CODGEO", "annee", "quantity", "tax", "flag")


def wide_topics(spark: SparkSession, folder: str) -> DataFrame:
    """All tables of the whole mapping, in their order."""
    return _all_topics(reshape_table(_wide(spark, folder), _WIDE_MAPPING).tables)


def _topics_sql(kept: str = "true") -> str:
    return f"""
with w as (
    select l_orderkey || '-' || l_linenumber as "CODGEO", cast(l_quantity as bigint) as q,
           cast(round(l_tax * 100) as bigint) as t, l_linestatus, l_returnflag from lineitem),
a as (select * from w where {kept})
select 'demo_volume' as topic, "CODGEO", cast(2011 as bigint) as annee, q * 100000 + 50 as quantity,
       cast(null as bigint) as tax, cast(null as varchar) as flag from a
union all
select 'demo_volume', "CODGEO", 2016, case when l_linestatus = 'O' then null else q * 100 end, t, null from a
union all
select 'demo_state', "CODGEO", 2011, null, null, l_returnflag from a
union all
select 'demo_state', "CODGEO", 2016, null, null, l_linestatus from a
"""


def _allowed_keys(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").filter("l_quantity > 25").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("CODGEO")
    )


def wide_state(spark: SparkSession, folder: str) -> DataFrame:
    allowed = _allowed_keys(spark, folder)
    return reshape_table(_wide(spark, folder), _WIDE_MAPPING, allowed=allowed).tables["demo_state"]


WIDE_STATE_SQL = """
with w as (
    select l_orderkey || '-' || l_linenumber as "CODGEO", l_quantity, l_returnflag, l_linestatus
    from lineitem),
a as (select * from w where "CODGEO" in (select "CODGEO" from w where l_quantity > 25))
select "CODGEO", cast(2011 as bigint) as annee, l_returnflag as flag from a
union all
select "CODGEO", 2016, l_linestatus from a
"""


def _raw_mapping(spark: SparkSession, folder: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    return table(spark, folder, "part").select(
        F.concat(F.lit(" P"), F.col("p_partkey").cast("string")).alias("source_code"),
        F.concat(F.lower("p_type"), F.lit("/x ")).alias("target_table"),
        F.nullif(F.col("p_name"), F.lit("red widget")).alias("canonical_metric"),
        F.when(F.col("p_retailprice") > 1500, " num").otherwise("Char ").alias("data_type"),
        F.when(F.col("p_type") == "ECONOMY", F.lit("n.a."))
        .when(F.col("p_type") == "PROMO", F.concat(F.lit("20"), F.lpad(size, 2, "0"), F.lit(".0")))
        .otherwise(F.concat(F.lit(" 20"), F.lpad(size, 2, "0")))
        .alias("available_years"),
        F.col("p_brand").alias("ignored"),
    )


def mapping_clean(spark: SparkSession, folder: str) -> DataFrame:
    return clean_mapping(_raw_mapping(spark, folder))


MAPPING_CLEAN_SQL = """
select 'P' || cast(p_partkey as varchar) as source_code, lower(p_type) || '/x' as target_table,
       p_name as canonical_metric, case when p_retailprice > 1500 then 'NUM' else 'CHAR' end as data_type,
       '20' || lpad(cast(p_size as varchar), 2, '0') || case when p_type = 'PROMO' then '.0' else '' end
       as available_years,
       cast(2000 + p_size as bigint) as year
from part where p_name <> 'red widget' and p_type <> 'ECONOMY'
"""


def removed(spark: SparkSession, folder: str) -> DataFrame:
    return removed_counts(_raw_mapping(spark, folder), _wide(spark, folder), _allowed_keys(spark, folder))


REMOVED_SQL = """
with w as (select l_orderkey || '-' || l_linenumber as key, l_quantity from lineitem)
select 'mapping' as step, count(*) as rows_in,
       count(*) filter (where p_name = 'red widget' or p_type = 'ECONOMY') as removed from part
union all
select 'keys', count(*), count(*) filter (where key not in (select key from w where l_quantity > 25)) from w
"""

def _ordered(block_bytes: int):
    """Topic rows of keys that repeat, numbered in the order of the written file."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        columns = ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax"]
        lines, _ = dense_id(table(spark, folder, "lineitem").select(*columns), columns, "line")
        base = new_path(spark, "ordered")
        wide = lines.select((F.col("l_orderkey") % 500).cast("string").alias("CODGEO"), F.col("line").alias("P11"), (F.col("line") * 2).alias("P16"), "line")
        write_delimited(wide.repartitionByRange("line").sortWithinPartitions("line").drop("line"), f"{base}/raw.csv")
        mapping = [("P11", "t", "line", "NUM", "2011"), ("P16", "t", "line", "NUM", "2016")]
        names = "source_code string, target_table string, canonical_metric string, data_type string, available_years string"
        write_delimited(spark.createDataFrame(mapping, names), f"{base}/mapping.csv")
        built = reshape_files(spark, f"{base}/raw.csv", f"{base}/mapping.csv", block_bytes=block_bytes)
        write_reshape(built, f"{base}/topics")
        back = read_table(spark, f"{base}/topics/t.csv", position="place", block_bytes=block_bytes)
        nth = F.row_number().over(Window.partitionBy("CODGEO", "annee").orderBy("place")).cast("bigint")
        return back.select("CODGEO", F.col("annee").cast("bigint"), nth.alias("nth"), F.col("line").cast("double").cast("bigint").alias("line"))

    return run


ORDERED_SQL = """
with n as (
    select l_orderkey % 500 as code, row_number() over (order by l_extendedprice, l_orderkey, l_linenumber, l_partkey,
           l_suppkey, l_quantity, l_discount, l_tax) as line from lineitem),
pairs as (select code, 2011 as annee, line from n union all select code, 2016, line * 2 from n)
select cast(code as varchar) as "CODGEO", cast(annee as bigint) as annee,
       row_number() over (partition by code, annee order by line) as nth, line from pairs
"""

# --- the job from files to files ----------------------------------------------------------------


def _reshaped(spark: SparkSession, folder: str) -> tuple[Reshape, str]:
    """The wide table, its mapping, dictionary and allowed keys as files; the topic tables written below a folder."""
    base = new_path(spark, "reshape")
    write_delimited(_wide(spark, folder), f"{base}/raw.csv")
    kinds = {True: "num", False: " char"}
    rows = [(f" {m.source}", m.table, m.metric, kinds[m.numeric], f"{m.period}.0") for m in _WIDE_MAPPING]
    rows += [("P16_TAX", "demo/volume", "tax", "num", "soon"), (None, "demo/volume", "tax", "num", "2016")]
    names = "source_code string, target_table string, canonical_metric string, data_type string, available_years string"
    write_delimited(spark.createDataFrame(rows, names).coalesce(1), f"{base}/mapping.csv")
    write_delimited(spark.createDataFrame([("P11_QTY",), ("P16_QTY",), ("C11_FLAG",)], "COD_VAR string"), f"{base}/meta.csv")
    allowed = _allowed_keys(spark, folder).withColumnRenamed("CODGEO", "code_commune")
    write_delimited(allowed, f"{base}/geo.csv")
    built = reshape_files(spark, *[f"{base}/{n}.csv" for n in ("raw", "mapping", "meta", "geo")])
    write_reshape(built, f"{base}/topics")
    return built, f"{base}/topics"


def reshape_job(spark: SparkSession, folder: str) -> DataFrame:
    """Every topic table of the job, read back from its files."""
    built, path = _reshaped(spark, folder)
    if built.missing_in_raw != ["C16_ABSENT"] or built.missing_in_meta != ["C16_FLAG", "P16_TAX"]:
        raise AssertionError(f"unmatched codes: {built.missing_in_raw}, {built.missing_in_meta}")
    back = {n: read_table(spark, f"{path}/{n}.csv") for n in built.tables}
    typed = {
        n: t.select("CODGEO", F.col("annee").cast("bigint"), *[F.col(c).cast("double") if n == "demo_volume" else F.col(c) for c in _TOPICS[n]])
        for n, t in back.items()
    }
    return _all_topics(typed)


def reshape_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows in, out and removed per step of the job, counted in its own passes."""
    return _reshaped(spark, folder)[0].counts.report(spark)


RESHAPE_COUNTS_SQL = """
with w as (select l_orderkey || '-' || l_linenumber as key, l_quantity from lineitem),
k as (select count(*) as n, count(*) filter (where key in (select key from w where l_quantity > 25)) as kept from w)
select 'mapping' as part, 'usable' as step, cast(8 as bigint) as rows_in, cast(6 as bigint) as rows_out, cast(2 as bigint) as removed
union all
select 'wide', 'allowed keys', n, kept, n - kept from k
union all
select 'wide', 'read', null, kept, null from k
union all
select 'table', 'demo/state', null, 2 * kept, null from k
union all
select 'table', 'demo/volume', null, 2 * kept, null from k
"""

QUERIES = {
    "q_rollup_units": (rollup, _rollup_sql(FLAT_SQL)),
    "q_rollup_no_unit": (rollup_no_unit, ROLLUP_NO_UNIT_SQL),
    "q_rollup_null_keys": (rollup_null_keys, _rollup_sql(_NULL_FLAT)),
    "q_group_max": (group_max, GROUP_MAX_SQL),
    "q_present_in_all": (present_some, PRESENT_SOME_SQL),
    "q_present_in_every_period": (present_every, PRESENT_EVERY_SQL),
    "q_first_per_key": (first_row, FIRST_ROW_SQL),
    "q_dense_id": (numbered, NUMBERED_SQL),
    "q_unknown_fact": (unknown_fact, UNKNOWN_FACT_SQL),
    "q_unknown_member": (unknown_member, UNKNOWN_MEMBER_SQL),
    "q_allowed_keys": (allowed_keys, ALLOWED_KEYS_SQL),
    "q_blocks_fixed": (blocks_fixed, BLOCKS_FIXED_SQL),
    "q_patch_cells": (patched, PATCHED_SQL),
    "q_conform": (conformed, CONFORMED_SQL),
    "q_wide_to_long": (wide_topics, _topics_sql()),
    "q_wide_to_long_filtered": (wide_state, WIDE_STATE_SQL),
    "q_mapping_clean": (mapping_clean, MAPPING_CLEAN_SQL),
    "q_removed_counts": (removed, REMOVED_SQL),
    "q_stable_order": (_ordered(1 << 16), ORDERED_SQL),
    "q_stable_order_large_blocks": (_ordered(1 << 22), ORDERED_SQL),
    "q_reshape_files": (reshape_job, _topics_sql('"CODGEO" in (select "CODGEO" from w where q > 25)')),
    "q_reshape_counts": (reshape_counts, RESHAPE_COUNTS_SQL),
}
