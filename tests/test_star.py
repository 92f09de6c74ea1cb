"""Star schema: keys, spellings, unknown members, validation, sinks."""

from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from scrutin.operators.keys import dense_id
from scrutin.operators.rules import assert_valid
from scrutin.plans import star
from scrutin.plans.star import build_star, read_flat, star_report
from scrutin.schemas import FLAT, STAR_COLUMNS
from scrutin.sinks import jdbc
from scrutin.sinks.files import output_path, register_views, write_flat, write_tables
from scrutin.sources.tables import read_table

DATA = [
    (2014, 1, "01", None, "01004", "Newer", 90, 30, 60, 5, 55, "LDVD", "dupont", "Jean", "1", 30),
    (2008, 1, "01", "AIN", "01004", " Older ", 100, 40, 60, 5, 55, "LDVD", "DUPONT", "Jean", "1", 20),
    (2008, 1, "01", "AIN", "01004", " Older ", 100, 40, 60, 5, 55, "NC", "MARTIN", None, "", 10),
    (2008, 1, "2A", "CORSE", "4", "Aj", 10, 0, 10, 0, 10, "NC", "MARTIN", None, "", None),
]


def flat(spark, data=DATA):
    return spark.createDataFrame(data, FLAT)


def test_star_tables(spark):
    star = build_star(flat(spark))
    assert rows(star["dim_geographie"]) == [
        (1, "00004", "2A", "CORSE", "Aj"), (2, "01004", "01", "AIN", "Older"),
    ]
    assert rows(star["dim_election"]) == [(1, "2008|T1", 2008, 1), (2, "2014|T1", 2014, 1)]
    assert rows(star["dim_candidat_liste"]) == [
        (1, "LDVD|DUPONT|JEAN|1", "LDVD", "DUPONT", "Jean", "1"),
        (2, "NC|MARTIN|UNKNOWN|", "NC", "MARTIN", None, ""),
    ]
    assert rows(star["fact_participation"]) == [
        (1, 1, 1, 10, 0, 10, 0, 10), (2, 1, 2, 100, 40, 60, 5, 55), (3, 2, 2, 90, 30, 60, 5, 55),
    ]
    assert rows(star["fact_resultats_liste"]) == [
        (1, 1, 1, 2, None), (2, 1, 2, 1, 20), (3, 1, 2, 2, 10), (4, 2, 2, 1, 30),
    ]
    assert {n: tuple(t.columns) for n, t in star.items()} == STAR_COLUMNS


def test_null_commune_is_a_member(spark):
    data = [(*DATA[0][:4], None, *DATA[0][5:])]
    star = build_star(flat(spark, data), unknown_members=True)
    assert rows(star["dim_geographie"]) == sorted(
        [(0, "UNKNOWN", None, None, None), (1, None, "01", None, "Newer")], key=repr
    )
    assert star["fact_participation"].first().geo_sk == 1


@pytest.mark.parametrize(
    "table, change, rule",
    [
        ("dim_geographie", lambda d: d.withColumn("geo_sk", F.lit(1)), "geo_sk"),
        ("fact_participation", lambda d: d.unionByName(d), "election_sk, geo_sk"),
        ("fact_participation", lambda d: d.withColumn("geo_sk", F.lit(99)), "geo_sk has no match"),
        ("fact_resultats_liste", lambda d: d.withColumn("candidat_sk", F.lit(None).cast("bigint")), "candidat_sk"),
        ("fact_participation", lambda d: d.withColumn("abstentions", F.lit(-1)), "abstentions < 0"),
        ("fact_participation", lambda d: d.withColumn("blancs_nuls", F.lit(99)), "blancs_nuls > votants"),
        ("fact_resultats_liste", lambda d: d.withColumn("voix", F.lit(-1)), "voix < 0"),
    ],
)
def test_broken_stars_are_reported(spark, table, change, rule):
    star = build_star(flat(spark), validate=False)
    assert_valid(star_report(star))
    with pytest.raises(ValueError, match=rule.replace("(", r"\(")):
        assert_valid(star_report({**star, table: change(star[table])}))


def test_missing_columns_fail_early(spark):
    with pytest.raises(ValueError, match="voix"):
        build_star(flat(spark).drop("voix"))


def test_written_tables_read_back(spark, folder):
    write_flat(flat(spark), f"{folder}/flat.csv", "csv", "latin-1")
    back = read_flat(spark, f"{folder}/flat.csv")
    assert set(back.dtypes) == {(f.name, "string") for f in FLAT.fields}
    star = build_star(back)
    write_tables(star, f"{folder}/star")
    again = read_table(spark, f"{folder}/star/dim_election.csv")
    assert rows(again) == [("1", "2008|T1", "2008", "1"), ("2", "2014|T1", "2014", "1")]
    register_views(star)
    assert spark.sql("select count(*) from fact_resultats_liste join dim_election using (election_sk)").first()[0] == 4
    assert output_path(None, None, "csv") == "processed_data/elections_flat.csv"
    assert output_path(None, "out/", "parquet") == "out/elections_flat.parquet"
    assert output_path("x", "out", "csv") == "x"


def test_database_gets_dimensions_before_facts(monkeypatch):
    written = []
    monkeypatch.setattr(jdbc, "write_jdbc", lambda df, url, table, properties: written.append(table))
    jdbc.write_star({name: None for name in reversed(STAR_COLUMNS)}, "jdbc:x")
    assert written == [f"public.{n}" for n in STAR_COLUMNS]


def test_facts_are_numbered_without_natural_keys(spark, monkeypatch):
    seen = []

    def recorded(df, order, name):
        seen.append((name, df.columns))
        return dense_id(df, order, name)

    prepared = star.prepare(flat(spark))
    members = [star.dimension(prepared, name) for name in star.DIMENSIONS]
    monkeypatch.setattr(star, "dense_id", recorded)
    few = [m if k < 2 else replace(m, keys=m.keys.filter("candidat_sk <> 1")) for k, m in enumerate(members)]
    assert rows(star.fact_results(prepared, *members)) == [(1, 1, 1, 2, None), (2, 1, 2, 1, 20), (3, 1, 2, 2, 10), (4, 2, 2, 1, 30)]
    # Rows without a member come last among those with the same other keys.
    assert rows(star.fact_results(prepared, *few, unknown_members=True)) == [(1, 1, 1, 2, None), (2, 1, 2, 2, 10), (3, 1, 2, 0, 20), (4, 2, 2, 0, 30)]
    assert [c for _, columns in seen for c in columns if c in ("code_commune", "election_nk", "candidat_nk")] == []
