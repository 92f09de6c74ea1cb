"""Star schema of three dimensions and two facts from the flat result table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrutin.functions.codes import candidate_of, election_of, star_commune_of
from scrutin.functions.text import stripped
from scrutin.operators.integrity import Reference, Unique
from scrutin.operators.keys import dense_id, first_per_key
from scrutin.operators.lookup import HOT_ROWS, lookup
from scrutin.operators.project import parse_longs, with_unknown_member
from scrutin.operators.rules import (
    assert_valid,
    count_keys,
    count_violations,
    not_negative,
    require_columns,
    turnout_rules,
)
from scrutin.schemas import CANDIDATE_KEY, COMMUNE_KEY, FLAT, STAR_COLUMNS, TURNOUT, VOTES
from scrutin.scratch import staged
from scrutin.sources.tables import read_table

ROWS = "__rows"

# Order of the flat table, which decides whose spelling a dimension row keeps: that of the
# earliest election.
FLAT_ORDER = (*COMMUNE_KEY, *CANDIDATE_KEY)

# Natural keys of the unknown members.
UNKNOWN_LABELS = {
    "dim_geographie": "UNKNOWN",
    "dim_election": "ELECTION_UNKNOWN",
    "dim_candidat_liste": "CANDIDAT_UNKNOWN",
}


def read_flat(
    spark: SparkSession, path: str, sep: str = ";", encoding: str = "latin-1"
) -> DataFrame:
    """A written flat table, every column as text."""
    return read_table(spark, path, sep, encoding)


def prepare(flat: DataFrame) -> DataFrame:
    """Trimmed texts, parsed numbers, natural keys, and the raw order of the rows."""
    names = [f.name for f in FLAT.fields]
    require_columns(flat, names, "flat table")
    texts = [f.name for f in FLAT.fields if f.dataType.typeName() == "string"]
    types = dict(flat.dtypes)
    raw = {_raw(t): F.col(t) for t in texts}
    # Cleaned first, then combined: each text is trimmed once.
    rows = flat.select(*names).withColumns({**raw, **{t: stripped(t) for t in texts}})
    year, round_ = (
        stripped(c) if types[c] == "string" else F.col(c).cast("string")
        for c in ("annee_election", "tour")
    )
    rows = rows.withColumns(
        {
            "election_nk": election_of(year, round_),
            "candidat_nk": candidate_of(*[F.col(c) for c in CANDIDATE_KEY]),
            "code_commune": star_commune_of(F.col("code_commune")),
        }
    )
    rows = parse_longs(rows, [n for n in names if n not in texts])
    # Raw spellings only decide an order; they are kept where they differ from the cleaned text.
    return rows.withColumns(
        {_raw(t): F.when(~F.col(_raw(t)).eqNullSafe(F.col(t)), F.col(_raw(t))) for t in texts}
    )


def _raw(column: str) -> str:
    return f"raw_{column}"


def _in_flat_order(rows: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Rows with the columns ``order0, …`` that sort them like the flat table.

    The order ends where it has settled the attributes.
    """
    needed = max(FLAT_ORDER.index(c) for c in attributes) + 1
    return rows.withColumns(
        {
            f"order{i}": F.coalesce(_raw(c), c) if _raw(c) in rows.columns else F.col(c)
            for i, c in enumerate(FLAT_ORDER[:needed])
        }
    )


# Table -> natural key and surrogate key.
DIMENSIONS = {
    "dim_geographie": ("code_commune", "geo_sk"),
    "dim_election": ("election_nk", "election_sk"),
    "dim_candidat_liste": ("candidat_nk", "candidat_sk"),
}


@dataclass(frozen=True)
class Members:
    """A numbered dimension, its natural and surrogate key, and its size.

    ``keys`` holds the two keys and ``__rows``, the source rows of each member. It is apart from the
    attributes, so that resolving references does not compute these.
    """

    frame: DataFrame
    keys: DataFrame
    natural: str
    key: str
    size: int


def dimension(rows: DataFrame, table: str) -> Members:
    """Distinct members of prepared rows, numbered 1..n in the order of their natural key.

    A member keeps the attributes of its first row in flat order. Members with one spelling, found
    by counting, need no order; only the rows of the others are compared.
    """
    natural, key = DIMENSIONS[table]
    attributes = [c for c in STAR_COLUMNS[table] if c not in (natural, key)]
    spellings = rows.groupBy(natural, *attributes).agg(F.count(F.lit(1)).alias(ROWS))
    members = spellings.groupBy(natural).agg(
        F.count(F.lit(1)).alias("__spellings"),
        F.min(F.struct(*attributes)).alias("__only"),
        F.sum(ROWS).alias(ROWS),
    )
    numbered, size = dense_id(members, [natural], key)
    keys = numbered.select(natural, key, ROWS)
    several = numbered.filter("__spellings > 1").select(natural, F.col(ROWS).alias("__several"))
    ambiguous = several.count()
    only = {c: F.col(f"__only.{c}") for c in attributes}
    if ambiguous:
        compared = lookup(
            rows,
            several.withColumn("__weight", F.col("__several")),
            [natural],
            weight="__weight",
            right_rows=ambiguous,
        ).filter(F.col("__several").isNotNull())
        ordered = _in_flat_order(compared, attributes)
        order = [c for c in ordered.columns if c.startswith("order")]
        # Equal rows are dropped by hashing before the sort-based comparison.
        distinct = ordered.select(natural, *attributes, *order).distinct()
        firsts = first_per_key(distinct, [natural], order, attributes).select(
            natural, F.struct(*attributes).alias("__first")
        )
        numbered = lookup(numbered, firsts, [natural], right_rows=ambiguous)
        only = {c: F.coalesce("__first", "__only")[c] for c in attributes}
    frame = numbered.select(key, natural, *[v.alias(c) for c, v in only.items()])
    return Members(frame, keys, natural, key, size)


def resolve(
    fact: DataFrame, members: Members, unknown_members: bool = False, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add the surrogate key of a dimension; with an unknown member, unresolved rows get 0."""
    out = lookup(
        fact,
        members.keys,
        [members.natural],
        weight=ROWS,
        right_rows=members.size,
        hot_rows=hot_rows,
    )
    if not unknown_members:
        return out
    return out.withColumn(members.key, F.coalesce(members.key, F.lit(0).cast("bigint")))


def _fact(
    grouped: DataFrame,
    grain: Sequence[str],
    key: str,
    members: Sequence[Members],
    unknown_members: bool,
    hot_rows: int,
) -> DataFrame:
    """Rows of a fact with the keys of their members, numbered in the order of these.

    Keys of members have the order of the natural ones, so the natural ones need not travel. A row without a member
    comes after those with one, and keeps its natural key to be told from others.
    """
    for m in members:
        grouped = resolve(grouped, m, hot_rows=hot_rows)
    lost = {m.key: F.when(F.col(m.key).isNull(), F.col(m.natural)).alias(f"__lost_{m.key}") for m in members}
    keyed = grouped.select(*[c for c in grouped.columns if c not in grain], *lost.values())
    order = [c for m in members for c in (m.key, f"__lost_{m.key}")]
    fact = dense_id(keyed, order, key)[0].drop(*[f"__lost_{k}" for k in lost])
    if unknown_members:
        fact = fact.withColumns({k: F.coalesce(k, F.lit(0).cast("bigint")) for k in lost})
    return fact


def fact_participation(
    rows: DataFrame,
    geo: Members,
    election: Members,
    unknown_members: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Turnout per commune and election: the maximum of each measure."""
    grain = (geo.natural, election.natural)
    turnout = rows.groupBy(*grain).agg(*[F.max(m).alias(m) for m in TURNOUT])
    fact = _fact(
        turnout, grain, "participation_id", [geo, election], unknown_members, hot_rows
    )
    return fact.select(*STAR_COLUMNS["fact_participation"])


def fact_results(
    rows: DataFrame,
    geo: Members,
    election: Members,
    candidate: Members,
    unknown_members: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Votes per commune, election and candidate; null where no row has any."""
    grain = (geo.natural, election.natural, candidate.natural)
    votes = rows.groupBy(*grain).agg(F.sum(VOTES).alias(VOTES))
    fact = _fact(
        votes, grain, "resultat_liste_id", [geo, election, candidate], unknown_members, hot_rows
    )
    return fact.select(*STAR_COLUMNS["fact_resultats_liste"])


def build_star(
    flat: DataFrame,
    unknown_members: bool = False,
    validate: bool = True,
    hot_rows: int = HOT_ROWS,
) -> dict[str, DataFrame]:
    """The five star tables.

    Tables that feed several others are written to the shared folder once. With
    ``unknown_members`` every dimension gets a row 0 and unresolved references point to it.
    """
    rows = staged(prepare(flat), "star-stage", small=True)
    members = {table: dimension(rows, table) for table in DIMENSIONS}
    geo, election, candidate = members.values()
    tables = {t: m.frame.select(*STAR_COLUMNS[t]) for t, m in members.items()}
    if unknown_members:
        for table, m in members.items():
            tables[table] = with_unknown_member(
                tables[table], m.key, m.natural, UNKNOWN_LABELS[table]
            )
    tables["fact_participation"] = fact_participation(
        rows, geo, election, unknown_members, hot_rows
    )
    tables["fact_resultats_liste"] = fact_results(
        rows, geo, election, candidate, unknown_members, hot_rows
    )
    if validate:
        assert_valid(star_report(tables))
    return tables


def star_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(rule, table, violations)`` for keys, grains, references and measures of a star."""
    geo, election, candidate = (
        tables["dim_geographie"],
        tables["dim_election"],
        tables["dim_candidat_liste"],
    )
    turnout, votes = tables["fact_participation"], tables["fact_resultats_liste"]
    uniques = [
        Unique(geo, ("geo_sk",), "dim_geographie"),
        Unique(election, ("election_sk",), "dim_election"),
        Unique(candidate, ("candidat_sk",), "dim_candidat_liste"),
        Unique(turnout, ("election_sk", "geo_sk"), "fact_participation"),
        Unique(votes, ("election_sk", "geo_sk", "candidat_sk"), "fact_resultats_liste"),
    ]
    references = [
        Reference(turnout, "geo_sk", geo, "fact_participation"),
        Reference(turnout, "election_sk", election, "fact_participation"),
        Reference(votes, "geo_sk", geo, "fact_resultats_liste"),
        Reference(votes, "election_sk", election, "fact_resultats_liste"),
        Reference(votes, "candidat_sk", candidate, "fact_resultats_liste"),
    ]
    lines = [
        count_keys(uniques, references),
        count_violations(turnout, turnout_rules(), "fact_participation"),
        count_violations(votes, [not_negative(VOTES)], "fact_resultats_liste"),
    ]
    return reduce(DataFrame.unionByName, lines)
