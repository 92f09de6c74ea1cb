"""Declared schemas and column groups.

The names, orders and token lists in this module are fixed values: results are
only comparable when they are spelled exactly like this.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- flat result table -----------------------------------------------------------------------

FLAT = T.StructType(
    [
        T.StructField("annee_election", T.LongType()),
        T.StructField("tour", T.LongType()),
        T.StructField("code_departement", T.StringType()),
        T.StructField("libelle_departement", T.StringType()),
        T.StructField("code_commune", T.StringType()),
        T.StructField("libelle_commune", T.StringType()),
        T.StructField("inscrits", T.LongType()),
        T.StructField("abstentions", T.LongType()),
        T.StructField("votants", T.LongType()),
        T.StructField("blancs_nuls", T.LongType()),
        T.StructField("exprimes", T.LongType()),
        T.StructField("code_nuance", T.StringType()),
        T.StructField("nom", T.StringType()),
        T.StructField("prenom", T.StringType()),
        T.StructField("liste", T.StringType()),
        T.StructField("voix", T.LongType()),
    ]
)

COMMUNE_KEY = (
    "annee_election",
    "tour",
    "code_departement",
    "libelle_departement",
    "code_commune",
    "libelle_commune",
)
CANDIDATE_KEY = ("code_nuance", "nom", "prenom", "liste")
TURNOUT = ("inscrits", "abstentions", "votants", "blancs_nuls", "exprimes")
VOTES = "voix"
POLLING_STATION = "code_bureau_vote"

# A flat row missing one of these cannot be trusted.
REQUIRED = (
    "annee_election",
    "tour",
    "code_departement",
    "code_commune",
    "inscrits",
    "votants",
    "exprimes",
    "voix",
)

# What the four year layouts yield before aggregation: the flat columns plus the polling
# station, every field still as it was in the file.
BALLOT_COLUMNS = (
    *COMMUNE_KEY,
    POLLING_STATION,
    *TURNOUT,
    *CANDIDATE_KEY,
    VOTES,
)

# --- star schema -----------------------------------------------------------------------------

STAR_COLUMNS = {
    "dim_geographie": (
        "geo_sk",
        "code_commune",
        "code_departement",
        "libelle_departement",
        "libelle_commune",
    ),
    "dim_election": ("election_sk", "election_nk", "annee_election", "tour"),
    "dim_candidat_liste": ("candidat_sk", "candidat_nk", "code_nuance", "nom", "prenom", "liste"),
    "fact_participation": ("participation_id", "election_sk", "geo_sk", *TURNOUT),
    "fact_resultats_liste": ("resultat_liste_id", "election_sk", "geo_sk", "candidat_sk", VOTES),
}

# --- indicator reshape -----------------------------------------------------------------------

MAPPING_COLUMNS = (
    "source_code",
    "target_table",
    "canonical_metric",
    "data_type",
    "available_years",
)
GEO_CODE = "CODGEO"
PERIOD = "annee"
META_CODE = "COD_VAR"

# --- spelling of "missing" -------------------------------------------------------------------

# Texts that stand for a missing code or label, compared after trimming and upper-casing.
MISSING_CODES = ("", "NA", "NAN", "NONE")

# Texts a delimited file may hold in place of a missing value (compared as they are).
MISSING_FIELDS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)
