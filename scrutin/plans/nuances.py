"""The reference list of political labels: file, parquet object, database dimension."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from scrutin.sinks.jdbc import write_nuances
from scrutin.sources.tables import read_objects, read_reference_list


def stage_nuances(spark: SparkSession, csv_path: str, object_uri: str) -> DataFrame:
    """Read the list and keep it as a parquet object; returns the stored list."""
    read_reference_list(spark, csv_path).write.mode("overwrite").parquet(object_uri)
    return read_objects(spark, object_uri)


def publish_nuances(
    spark: SparkSession,
    object_uri: str,
    url: str,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Replace the database dimension with the stored list."""
    write_nuances(read_objects(spark, object_uri), url, properties)
