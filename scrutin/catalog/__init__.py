"""Queries over the driver's tables, one per operator family, with the SQL each must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scrutin.catalog import election, files, quality, scalar, shape

Query = Callable[[SparkSession, str], DataFrame]

_PARTS = (scalar, shape, quality, files, election)


def queries() -> dict[str, Query]:
    return {name: run for part in _PARTS for name, (run, _) in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, (_, sql) in part.QUERIES.items() if sql}
