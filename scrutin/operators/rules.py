"""Row filters and data-quality rules.

A rule is a condition that a bad row fulfils. The same rule list drives a filter, a counted
report and an assertion. A comparison with null is not a violation.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrutin.functions.codes import is_overseas
from scrutin.operators.integrity import Reference, Unique, dangling, repeats
from scrutin.operators.lookup import count_missing
from scrutin.schemas import REQUIRED

REPORT = "rule string, table string, violations bigint"

# Fixed values.
DEPARTMENT_SHAPE = r"\A[0-9A-Z]{2,3}\z"
COMMUNE_SHAPE = r"\A[0-9A-Z]{5}\z"


@dataclass(frozen=True)
class Rule:
    name: str
    violated: Column


def not_null(column: str) -> Rule:
    return Rule(f"{column} is null", F.col(column).isNull())


def has_shape(column: str, shape: str, name: str) -> Rule:
    return Rule(f"{column} is not a {name}", ~F.col(column).rlike(shape))


def not_negative(column: str) -> Rule:
    return Rule(f"{column} < 0", F.col(column) < 0)


def at_most(column: str, limit: str) -> Rule:
    return Rule(f"{column} > {limit}", F.col(column) > F.col(limit))


def flat_rules(
    required: Sequence[str] = REQUIRED,
    department: str | None = "code_departement",
    commune: str | None = "code_commune",
    registered: str = "inscrits",
    voters: str = "votants",
    valid: str = "exprimes",
    votes: str = "voix",
) -> list[Rule]:
    """What makes a flat result row unusable."""
    rules = [not_null(c) for c in required]
    if department:
        rules.append(has_shape(department, DEPARTMENT_SHAPE, "department code"))
    if commune:
        rules.append(has_shape(commune, COMMUNE_SHAPE, "commune code"))
    rules += [not_negative(c) for c in (registered, voters, valid, votes)]
    rules += [at_most(voters, registered), at_most(valid, voters), at_most(votes, valid)]
    rules.append(Rule(f"{voters} = 0", F.col(voters) == 0))
    return rules


def turnout_rules(
    registered: str = "inscrits",
    abstentions: str = "abstentions",
    voters: str = "votants",
    blank: str = "blancs_nuls",
    valid: str = "exprimes",
) -> list[Rule]:
    """What makes a turnout fact inconsistent."""
    rules = [not_negative(c) for c in (registered, abstentions, voters, blank, valid)]
    return rules + [at_most(voters, registered), at_most(valid, voters), at_most(blank, voters)]


def keep_mainland(df: DataFrame, department: str = "code_departement") -> DataFrame:
    """Drop overseas rows; a null department stays. Works on codes as they are in the source."""
    if department not in df.columns:
        return df
    return df.filter(~is_overseas(department))


def keep_valid(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that violate none of the rules."""
    broken = [F.coalesce(r.violated, F.lit(False)) for r in rules]
    return df.filter(~reduce(lambda a, b: a | b, broken))


def count_violations(df: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    """One row per rule with the number of violating rows, from a single aggregate."""
    counts = df.agg(*[F.count_if(r.violated).alias(f"r{i}") for i, r in enumerate(rules)])
    lines = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.lit(table).alias("table"),
            F.col(f"r{i}").cast("bigint").alias("violations"),
        )
        for i, r in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*lines)))


def _line(counted: DataFrame, rule: str, table: str) -> DataFrame:
    return counted.select(
        F.lit(rule).alias("rule"), F.lit(table).alias("table"), F.col("violations")
    )


def count_keys(uniques: Sequence[Unique], references: Sequence[Reference] = ()) -> DataFrame:
    """One report row per rule: repeated keys of all tables, and rows whose foreign key is null or unknown.

    The rules of a kind share one shuffle (see :mod:`scrutin.operators.integrity`); references by other keys than
    whole numbers are counted per key before an anti join.
    """
    spark = (uniques[0] if uniques else references[0]).frame.sparkSession
    lines = [(u.rule, u.table, n) for u, n in zip(uniques, repeats(uniques) if uniques else [], strict=True)]
    whole = [r for r in references if r.whole]
    found = dict(zip(map(id, whole), dangling(whole) if whole else [], strict=True))
    for r in references:
        if id(r) not in found:
            found[id(r)] = count_missing(r.frame, r.dimension, r.key, r.dimension_key).first()["violations"]
        lines.append((r.rule, r.table, found[id(r)]))
    return spark.createDataFrame(lines, REPORT)


def count_label_variants(
    df: DataFrame, keys: Sequence[str], label: str, table: str = "flat"
) -> DataFrame:
    """One report row: keys that carry more than one spelling of a label.

    Labels are part of the commune key, so a second spelling splits a commune in two.
    """
    spellings = df.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("__n"))
    varied = spellings.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    return _line(
        varied.agg(F.count(F.lit(1)).alias("violations")), f"{label} has several spellings", table
    )


def assert_valid(report: DataFrame) -> None:
    """Raise ``ValueError`` naming the rules that were violated."""
    # One line per rule, whatever the size of the tables.
    failed = report.filter(F.col("violations") > 0).collect()
    if failed:
        text = "; ".join(
            f"{r['table']}: {r['rule']} ({r['violations']} rows)"
            for r in sorted(failed, key=lambda r: (r["table"], r["rule"]))
        )
        raise ValueError(f"invalid data: {text}")


def require_columns(df: DataFrame, columns: Sequence[str], what: str) -> None:
    """Fail at plan time when columns are missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns: {', '.join(missing)}")
