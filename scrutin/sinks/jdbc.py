"""Star tables and reference lists into a relational database."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from scrutin.schemas import STAR_COLUMNS

# Fixed value.
NUANCE_TABLE = "dim_nuance_politique"
SCHEMA = "public"

# Connections a database is asked for unless the caller says otherwise.
CONNECTIONS = 16


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    connections: int = CONNECTIONS,
) -> None:
    """Replace one table. At most ``connections`` tasks write at once, each its rows in batches."""
    options = {"numPartitions": str(connections), **dict(properties or {})}
    df.write.mode("overwrite").jdbc(url, table, properties=options)


def write_star(
    tables: Mapping[str, DataFrame],
    url: str,
    properties: Mapping[str, str] | None = None,
    schema: str = SCHEMA,
) -> None:
    """Replace the star tables, dimensions before the facts that refer to them."""
    for name in STAR_COLUMNS:
        write_jdbc(tables[name], url, f"{schema}.{name}", properties)


def write_nuances(
    df: DataFrame,
    url: str,
    properties: Mapping[str, str] | None = None,
    schema: str = SCHEMA,
) -> None:
    write_jdbc(df, url, f"{schema}.{NUANCE_TABLE}", properties)
