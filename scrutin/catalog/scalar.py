"""Codes, labels and numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scrutin.catalog.views import table
from scrutin.functions import (
    blank_to_null,
    candidate_key,
    commune_code,
    election_key,
    is_overseas,
    label_or_unclassified,
    lenient_long,
    localised_double,
    null_missing_fields,
    padded_code,
    star_commune_code,
    stripped,
    stripped_upper,
)
from scrutin.operators.rules import keep_mainland


def _by_segment(choices: dict[str, Column], otherwise: Column) -> Column:
    out = otherwise
    for segment, value in choices.items():
        out = F.when(F.col("c_mktsegment") == segment, value).otherwise(out)
    return out


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _dirty_code() -> Column:
    return _by_segment(
        {
            "BUILDING": F.concat(F.lit("  "), _text("c_custkey"), F.lit("\t")),
            "MACHINERY": F.concat(F.lit(" a"), _text("c_nationkey")),
            "HOUSEHOLD": F.lit(" nan "),
            "AUTOMOBILE": F.lit("   "),
        },
        _text("c_nationkey"),
    )


_DIRTY_CODE = """
case c_mktsegment when 'BUILDING' then '  ' || cast(c_custkey as varchar) || chr(9)
     when 'MACHINERY' then ' a' || cast(c_nationkey as varchar)
     when 'HOUSEHOLD' then ' nan ' when 'AUTOMOBILE' then '   '
     else cast(c_nationkey as varchar) end
"""


def _padded_sql(value: str, width: int) -> str:
    text = f"upper(trim({value}, ' ' || chr(9)))"
    return (
        f"case when {text} is null or {text} in ('', 'NA', 'NAN', 'NONE') then null "
        f"when regexp_full_match({text}, '[0-9]+') and length({text}) < {width} "
        f"then lpad({text}, {width}, '0') else {text} end"
    )


def normalize_code(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        "c_custkey",
        padded_code(_dirty_code(), 2).alias("code2"),
        padded_code(_dirty_code(), 5).alias("code5"),
    )


NORMALIZE_CODE_SQL = f"""
select c_custkey, {_padded_sql(_DIRTY_CODE, 2)} as code2, {_padded_sql(_DIRTY_CODE, 5)} as code5
from customer
"""


def commune(spark: SparkSession, folder: str) -> DataFrame:
    com = _by_segment(
        {
            "BUILDING": F.concat(F.lit("0"), _text("c_custkey")),
            "MACHINERY": F.concat(_text("c_custkey"), F.lit("ar01")),
            "HOUSEHOLD": F.lit("None"),
            "AUTOMOBILE": F.concat(F.lit("-"), _text("c_nationkey")),
        },
        _text("c_custkey"),
    )
    return table(spark, folder, "customer").select(
        "c_custkey",
        commune_code(_text("c_nationkey"), com).alias("commune"),
        star_commune_code(com).alias("star_commune"),
    )


_COMMUNE = """
case c_mktsegment when 'BUILDING' then '0' || cast(c_custkey as varchar)
     when 'MACHINERY' then cast(c_custkey as varchar) || 'ar01'
     when 'HOUSEHOLD' then 'None' when 'AUTOMOBILE' then '-' || cast(c_nationkey as varchar)
     else cast(c_custkey as varchar) end
"""
COMMUNE_SQL = f"""
with raw as (select c_custkey, cast(c_nationkey as varchar) as dep, {_COMMUNE} as com from customer),
     parts as (select c_custkey, com, upper(com) as up,
                      case when length(dep) < 2 then '0' || dep else dep end as dep from raw)
select c_custkey,
       case when up = 'NONE' then null
            when regexp_full_match(up, '[0-9]{{1,3}}') then dep || lpad(up, 3, '0')
            else up end as commune,
       case when length(com) >= 5 then com
            when starts_with(com, '-') then '-' || lpad(substr(com, 2), 4, '0')
            else lpad(com, 5, '0') end as star_commune
from parts
"""


def nuance(spark: SparkSession, folder: str) -> DataFrame:
    label = _by_segment(
        {
            "BUILDING": F.lit(" ldvd\u00a0"),
            "MACHINERY": F.lit("\u2003"),
            "HOUSEHOLD": F.lit("na"),
        },
        F.lower("c_mktsegment"),
    )
    return table(spark, folder, "customer").select(
        "c_custkey",
        label_or_unclassified(label).alias("label"),
        stripped(label).alias("plain"),
        stripped_upper(label).alias("capitals"),
        blank_to_null(label).alias("cleaned"),
    )


NUANCE_SQL = """
with raw as (
    select c_custkey,
           case c_mktsegment when 'BUILDING' then ' ldvd' || chr(160) when 'MACHINERY' then chr(8195)
                when 'HOUSEHOLD' then 'na' else lower(c_mktsegment) end as label
    from customer),
texts as (select c_custkey, trim(label, ' ' || chr(160) || chr(8195)) as plain from raw)
select c_custkey,
       case when upper(plain) in ('', 'NA', 'NAN', 'NONE') then 'NC' else upper(plain) end as label,
       plain, upper(plain) as capitals, nullif(plain, '') as cleaned
from texts
"""


def overseas(spark: SparkSession, folder: str) -> DataFrame:
    code = _by_segment(
        {
            "BUILDING": F.concat(F.lit(" 9"), F.lpad(_text("c_nationkey"), 2, "0")),
            "MACHINERY": F.concat(F.lit("z"), F.substring("c_name", 18, 1)),
            "HOUSEHOLD": F.lit(None).cast("string"),
        },
        _text("c_nationkey"),
    )
    codes = table(spark, folder, "customer").select("c_custkey", code.alias("code_departement"))
    return keep_mainland(codes).withColumn("overseas", is_overseas("code_departement"))


OVERSEAS_SQL = """
with codes as (
    select c_custkey,
           case c_mktsegment when 'BUILDING' then ' 9' || lpad(cast(c_nationkey as varchar), 2, '0')
                when 'MACHINERY' then 'z' || substr(c_name, 18, 1)
                when 'HOUSEHOLD' then null else cast(c_nationkey as varchar) end as code_departement
    from customer),
flagged as (
    select *, coalesce(regexp_full_match(upper(trim(code_departement)), 'Z.|9[0-9][0-9]'), false)
              as overseas
    from codes)
select c_custkey, code_departement, overseas from flagged where not overseas
"""


def to_int(spark: SparkSession, folder: str) -> DataFrame:
    size, kind = _text("p_size"), F.col("p_type")
    dirty = (
        F.when(kind == "ECONOMY", F.concat(F.lit(" "), size, F.lit("\t")))
        .when(kind == "STANDARD", F.concat(size, F.lit(".0")))
        .when(kind == "PROMO", F.concat(size, F.lit("e3")))
        .when(kind == "LARGE", F.concat(F.lit("-"), size))
        .when(kind == "MEDIUM", F.concat(size, F.lit(".5")))
        .otherwise(F.concat(size, F.lit("d")))
    )
    return table(spark, folder, "part").select("p_partkey", lenient_long(dirty).alias("number"))


TO_INT_SQL = """
select p_partkey,
       cast(case p_type when 'ECONOMY' then p_size when 'STANDARD' then p_size
                 when 'PROMO' then p_size * 1000 when 'LARGE' then -p_size else null end as bigint)
       as number
from part
"""


def locale_number(spark: SparkSession, folder: str) -> DataFrame:
    cents = F.rint(F.col("l_extendedprice") * 100).cast("bigint")
    whole, rest = F.floor(cents / 100).cast("bigint"), F.pmod(cents, F.lit(100))
    grouped = F.concat(
        F.floor(whole / 1000).cast("bigint"),
        F.lit(" "),
        F.lpad(F.pmod(whole, F.lit(1000)).cast("string"), 3, "0"),
        F.lit(","),
        F.lpad(rest.cast("string"), 2, "0"),
    )
    written = F.when(F.col("l_returnflag") == "R", F.lit("s")).otherwise(grouped)
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.rint(localised_double(written) * 100).cast("bigint").alias("cents"),
    )


LOCALE_NUMBER_SQL = """
select l_orderkey, l_linenumber,
       case when l_returnflag = 'R' then null
            else cast(round(l_extendedprice * 100) as bigint) end as cents
from lineitem
"""


def text_clean(spark: SparkSession, folder: str) -> DataFrame:
    padded = F.concat(F.lit("\n\u3000"), F.col("text"), F.lit("\u00a0\t"))
    return table(spark, folder, "documents").select(
        "doc_id",
        F.md5(stripped(padded)).alias("plain"),
        F.length(blank_to_null("text")).cast("bigint").alias("chars"),
        null_missing_fields("lang").alias("lang"),
    )


_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(133) || chr(160) || chr(12288) || chr(8232) || chr(8233) || chr(8239) || chr(8195) || chr(8201)"
TEXT_CLEAN_SQL = f"""
select doc_id, md5(trim(text, {_SPACES})) as plain,
       cast(length(nullif(trim(text, {_SPACES}), '')) as bigint) as chars, lang
from documents
"""


def natural_keys(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey",
        election_key(F.year("o_orderdate"), F.substring("o_orderpriority", 1, 1)).alias("election_nk"),
        candidate_key(
            F.nullif(F.col("o_orderstatus"), F.lit("F")),
            F.lower("o_orderpriority"),
            F.lit(None),
            F.lit(" "),
        ).alias("candidat_nk"),
    )


NATURAL_KEYS_SQL = """
select o_orderkey,
       cast(year(o_orderdate) as varchar) || '|T' || substr(o_orderpriority, 1, 1) as election_nk,
       coalesce(nullif(o_orderstatus, 'F'), 'NC') || '|' || upper(o_orderpriority) || '|UNKNOWN|'
       as candidat_nk
from orders
"""

QUERIES = {
    "q_normalize_code": (normalize_code, NORMALIZE_CODE_SQL),
    "q_commune_code": (commune, COMMUNE_SQL),
    "q_nuance": (nuance, NUANCE_SQL),
    "q_overseas": (overseas, OVERSEAS_SQL),
    "q_to_int": (to_int, TO_INT_SQL),
    "q_locale_number": (locale_number, LOCALE_NUMBER_SQL),
    "q_text_clean": (text_clean, TEXT_CLEAN_SQL),
    "q_natural_keys": (natural_keys, NATURAL_KEYS_SQL),
}
