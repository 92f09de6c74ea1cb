"""Delimited text and parquet output. Every table is a folder with one file per task."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from scrutin.scratch import small_tasks
from scrutin.sources.lines import charset

DEFAULT_STEM = "elections_flat"
DEFAULT_FOLDER = "processed_data"


def output_path(output: str | None, folder: str | None, file_format: str) -> str:
    """The explicit path, else the default name in the given or the default folder."""
    return output or f"{(folder or DEFAULT_FOLDER).rstrip('/')}/{DEFAULT_STEM}.{file_format}"


def write_delimited(df: DataFrame, path: str, sep: str = ";", encoding: str = "utf-8") -> None:
    """Delimited text with a header; characters the encoding lacks become ``?``."""
    df.write.mode("overwrite").options(
        sep=sep,
        header=True,
        encoding=charset(encoding),
        quote='"',
        escape='"',
        emptyValue="",
        nullValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)


def write_flat(df: DataFrame, path: str, file_format: str = "csv", encoding: str = "latin-1") -> None:
    """The flat table as delimited text in the given encoding, or as parquet."""
    if file_format == "csv":
        write_delimited(df, path, ";", encoding)
    elif file_format == "parquet":
        df.write.mode("overwrite").parquet(path)
    else:
        raise ValueError(f"unknown format: {file_format}")


def write_tables(
    tables: Mapping[str, DataFrame], folder: str, sep: str = ";", encoding: str = "utf-8"
) -> None:
    """One delimited dataset per table."""
    for name, table in tables.items():
        with small_tasks(table.sparkSession):
            write_delimited(table, f"{folder.rstrip('/')}/{name}.csv", sep, encoding)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make the tables available to SQL under their names."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
