"""Views of the driver's tables that play the roles of the election data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# `unit` plays the polling station, `geo` the commune, `yr` the year and `cand` the candidate;
# `tot` repeats on each line of an order as turnout does on each candidate row.
FLAT_SQL = """
select cast(year(o_orderdate) as bigint) as yr, n_name as geo, o_orderkey as unit,
       cast(round(o_totalprice * 100) as bigint) as tot, p_brand as cand,
       cast(l_quantity as bigint) as votes
from lineitem
join orders on l_orderkey = o_orderkey
join customer on o_custkey = c_custkey
join nation on c_nationkey = n_nationkey
join part on l_partkey = p_partkey
"""


def flat(spark: SparkSession, folder: str) -> DataFrame:
    def t(name: str) -> DataFrame:
        return table(spark, folder, name)

    return (
        t("lineitem")
        .join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.year("o_orderdate").cast("bigint").alias("yr"),
            F.col("n_name").alias("geo"),
            F.col("o_orderkey").alias("unit"),
            F.rint(F.col("o_totalprice") * 100).cast("bigint").alias("tot"),
            F.col("p_brand").alias("cand"),
            F.col("l_quantity").cast("bigint").alias("votes"),
        )
    )


# One line per lineitem with two candidates: a polling station is an order, a commune a supplier,
# a department a nation. Two departments are overseas; the second candidate has no label.
# Totals differ within a station.
BALLOT_LINES_SQL = """
select cast(year(o_orderdate) as bigint) as annee_election,
       cast(case when o_orderpriority < '3' then 1 else 2 end as bigint) as tour,
       case n_name when 'NATION_24' then 'ZA' when 'NATION_23' then ' 971 '
            else cast(n_nationkey + 1 as varchar) end as code_departement,
       n_name as libelle_departement,
       case when l_suppkey < 1000 then cast(l_suppkey as varchar)
            else lpad(cast(l_suppkey as varchar), 5, '0') end as code_commune,
       s_name as libelle_commune,
       cast(o_orderkey as varchar) as code_bureau_vote,
       cast(floor(o_totalprice) as bigint) + 3 * l_linenumber as inscrits,
       cast(floor(o_totalprice) as bigint) - 10 * l_linenumber as votants,
       cast(floor(o_totalprice) as bigint) - 11 * l_linenumber - 2 as exprimes,
       cast(l_linenumber as bigint) as blancs,
       cast(2 as bigint) as nuls,
       cast(13 * l_linenumber as bigint) as abstentions,
       p_brand as nuance_a, p_type as nom_a, p_name as prenom_a, l_returnflag as liste_a,
       cast(l_quantity as bigint) as voix_a,
       o_orderstatus as nom_b, o_orderpriority as liste_b, cast(l_linenumber as bigint) as voix_b
from lineitem
join orders on l_orderkey = o_orderkey
join customer on o_custkey = c_custkey
join nation on c_nationkey = n_nationkey
join part on l_partkey = p_partkey
join supplier on l_suppkey = s_suppkey
"""


def ballot_lines(spark: SparkSession, folder: str) -> DataFrame:
    def t(name: str) -> DataFrame:
        return table(spark, folder, name)

    base = F.floor("o_totalprice").cast("bigint")
    number = F.col("l_linenumber").cast("bigint")
    supplier = F.col("l_suppkey").cast("string")
    # Orders meet customers first: where neither is broadcast, the many lines are not shuffled once more for it.
    placed = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return (
        t("lineitem")
        .join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.year("o_orderdate").cast("bigint").alias("annee_election"),
            F.when(F.col("o_orderpriority") < "3", 1).otherwise(2).cast("bigint").alias("tour"),
            F.when(F.col("n_name") == "NATION_24", "ZA")
            .when(F.col("n_name") == "NATION_23", " 971 ")
            .otherwise((F.col("n_nationkey") + 1).cast("string"))
            .alias("code_departement"),
            F.col("n_name").alias("libelle_departement"),
            F.when(F.col("l_suppkey") < 1000, supplier)
            .otherwise(F.lpad(supplier, 5, "0"))
            .alias("code_commune"),
            F.col("s_name").alias("libelle_commune"),
            F.col("o_orderkey").cast("string").alias("code_bureau_vote"),
            (base + 3 * number).alias("inscrits"),
            (base - 10 * number).alias("votants"),
            (base - 11 * number - 2).alias("exprimes"),
            number.alias("blancs"),
            F.lit(2).cast("bigint").alias("nuls"),
            (13 * number).alias("abstentions"),
            F.col("p_brand").alias("nuance_a"),
            F.col("p_type").alias("nom_a"),
            F.col("p_name").alias("prenom_a"),
            F.col("l_returnflag").alias("liste_a"),
            F.col("l_quantity").cast("bigint").alias("voix_a"),
            F.col("o_orderstatus").alias("nom_b"),
            F.col("o_orderpriority").alias("liste_b"),
            number.alias("voix_b"),
        )
    )


_PLACE = (
    "annee_election, tour, code_departement, libelle_departement, code_commune, "
    "libelle_commune, code_bureau_vote"
)
_TURNOUT = "inscrits, abstentions, votants, blancs + nuls as blancs_nuls, exprimes"

# One row per candidate.
BALLOTS_SQL = f"""
with ballot_lines as ({BALLOT_LINES_SQL})
select {_PLACE}, {_TURNOUT}, nuance_a as code_nuance, nom_a as nom, prenom_a as prenom,
       liste_a as liste, voix_a as voix
from ballot_lines
union all
select {_PLACE}, {_TURNOUT}, '' as code_nuance, nom_b as nom, '' as prenom,
       liste_b as liste, voix_b as voix
from ballot_lines
"""


def ballots(spark: SparkSession, folder: str) -> DataFrame:
    lines = ballot_lines(spark, folder)
    candidates = F.array(
        F.struct(
            F.col("nuance_a").alias("code_nuance"),
            F.col("nom_a").alias("nom"),
            F.col("prenom_a").alias("prenom"),
            F.col("liste_a").alias("liste"),
            F.col("voix_a").alias("voix"),
        ),
        F.struct(
            F.lit("").alias("code_nuance"),
            F.col("nom_b").alias("nom"),
            F.lit("").alias("prenom"),
            F.col("liste_b").alias("liste"),
            F.col("voix_b").alias("voix"),
        ),
    )
    return lines.select(
        *[c.strip() for c in _PLACE.split(",")],
        "inscrits",
        "abstentions",
        "votants",
        (F.col("blancs") + F.col("nuls")).alias("blancs_nuls"),
        "exprimes",
        F.inline(candidates),
    )
