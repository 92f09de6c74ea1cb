"""Filters and reports driven by rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrutin.catalog.views import BALLOTS_SQL, ballots, table
from scrutin.operators.integrity import Reference, Unique
from scrutin.operators.rules import (
    count_keys,
    count_label_variants,
    count_violations,
    flat_rules,
    keep_valid,
    not_negative,
    turnout_rules,
)

# Totals are pulled apart so that each rule is hit: registered voters shrink with the votes, the
# department keeps its raw spelling.
_RULE_COLUMNS = (
    "code_departement", "code_commune", "inscrits", "abstentions", "votants", "blancs_nuls",
    "exprimes", "voix",
)


def _strained(spark: SparkSession, folder: str) -> DataFrame:
    rows = ballots(spark, folder)
    return rows.select(
        "annee_election",
        "tour",
        F.nullif(F.col("code_departement"), F.lit("7")).alias("code_departement"),
        F.lpad("code_commune", 5, "0").alias("code_commune"),
        (F.col("inscrits") - F.col("voix") * 2).alias("inscrits"),
        (F.col("abstentions") - 20).alias("abstentions"),
        F.when(F.col("voix") == 3, F.lit(0)).otherwise(F.col("votants")).cast("bigint").alias("votants"),
        F.when(F.col("voix") == 49, F.col("votants") + 1).otherwise(F.col("blancs_nuls")).alias("blancs_nuls"),
        F.col("exprimes"),
        (F.col("voix") - 5).alias("voix"),
    )


_STRAINED = f"""
select annee_election, tour, nullif(code_departement, '7') as code_departement,
       lpad(code_commune, 5, '0') as code_commune,
       inscrits - voix * 2 as inscrits, abstentions - 20 as abstentions,
       case when voix = 3 then 0 else votants end as votants,
       case when voix = 49 then votants + 1 else blancs_nuls end as blancs_nuls,
       exprimes, voix - 5 as voix
from ({BALLOTS_SQL})
"""


def valid_rows(spark: SparkSession, folder: str) -> DataFrame:
    return keep_valid(_strained(spark, folder), flat_rules()).select(*_RULE_COLUMNS)


VALID_ROWS_SQL = f"""
select {", ".join(_RULE_COLUMNS)} from ({_STRAINED})
where annee_election is not null and tour is not null and code_commune is not null
  and regexp_full_match(code_departement, '[0-9A-Z]{{2,3}}')
  and regexp_full_match(code_commune, '[0-9A-Z]{{5}}')
  and inscrits >= 0 and votants >= 0 and exprimes >= 0 and voix >= 0
  and votants <= inscrits and exprimes <= votants and voix <= exprimes and votants <> 0
"""


def report(spark: SparkSession, folder: str) -> DataFrame:
    rows = _strained(spark, folder)
    parts = [
        count_violations(rows, turnout_rules(), "turnout"),
        count_violations(rows, [not_negative("voix")], "votes"),
    ]
    return reduce(DataFrame.unionByName, parts)


_TURNOUT_CHECKS = {
    "inscrits < 0": "inscrits < 0",
    "abstentions < 0": "abstentions < 0",
    "votants < 0": "votants < 0",
    "blancs_nuls < 0": "blancs_nuls < 0",
    "exprimes < 0": "exprimes < 0",
    "votants > inscrits": "votants > inscrits",
    "exprimes > votants": "exprimes > votants",
    "blancs_nuls > votants": "blancs_nuls > votants",
}
REPORT_SQL = (
    f"with rows_ as ({_STRAINED}) "
    + " union all ".join(
        f"select '{name}' as rule, 'turnout' as \"table\", count(*) filter (where {test}) as violations from rows_"
        for name, test in _TURNOUT_CHECKS.items()
    )
    + " union all select 'voix < 0', 'votes', count(*) filter (where voix < 0) from rows_"
)


def dangling(spark: SparkSession, folder: str) -> DataFrame:
    """References of two tables, in one pass over the bits of their keys."""
    lines, orders, supplier = (table(spark, folder, n) for n in ("lineitem", "orders", "supplier"))
    without = lines.withColumn("l_suppkey", F.nullif(F.col("l_suppkey"), F.lit(7)))
    references = [
        Reference(orders, "o_orderkey", lines, "orders", "l_orderkey"),
        Reference(lines, "l_orderkey", orders, "lineitem", "o_orderkey"),
        Reference(without, "l_suppkey", supplier, "lineitem", "s_suppkey"),
    ]
    return count_keys([], references)


DANGLING_SQL = """
select 'o_orderkey has no match' as rule, 'orders' as "table", count(*) as violations
from orders where o_orderkey not in (select l_orderkey from lineitem)
union all
select 'l_orderkey has no match', 'lineitem', count(*)
from lineitem where l_orderkey not in (select o_orderkey from orders)
union all
select 'l_suppkey has no match', 'lineitem', count(*) from lineitem where l_suppkey = 7
"""


def grain(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of two tables, in one shuffle of their hashes."""
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    return count_keys([Unique(lines, ("l_orderkey", "l_linenumber"), "lineitem"), Unique(orders, ("o_orderkey",), "orders")])


GRAIN_SQL = """
select '(l_orderkey, l_linenumber) is not unique' as rule, 'lineitem' as "table", count(*) as violations
from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)
union all
select '(o_orderkey) is not unique', 'orders', count(*)
from (select 1 from orders group by o_orderkey having count(*) > 1)
"""


def spellings(spark: SparkSession, folder: str) -> DataFrame:
    return count_label_variants(
        table(spark, folder, "orders"), ["o_custkey"], "o_orderpriority", "orders"
    )


SPELLINGS_SQL = """
select 'o_orderpriority has several spellings' as rule, 'orders' as "table", count(*) as violations
from (select 1 from orders group by o_custkey having count(distinct o_orderpriority) > 1)
"""

QUERIES = {
    "q_invalid_rows": (valid_rows, VALID_ROWS_SQL),
    "q_quality_report": (report, REPORT_SQL),
    "q_fk_check": (dangling, DANGLING_SQL),
    "q_grain_check": (grain, GRAIN_SQL),
    "q_label_variants": (spellings, SPELLINGS_SQL),
}
