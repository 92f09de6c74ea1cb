"""Delimited tables with a header, and parquet datasets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from scrutin.functions.text import null_missing_fields, stripped
from scrutin.operators.project import clean_header, quoted_name
from scrutin.sources.lines import block_reader, charset, reading_tasks, row_in_block

# Small file blocks in one task at most: each holds a parser's buffers until the task ends.
SHARED_BLOCKS = 64


def _reader(spark: SparkSession, sep: str, encoding: str) -> DataFrameReader:
    return spark.read.options(
        sep=sep, header=True, encoding=charset(encoding), quote='"', escape='"'
    )


def header_names(
    spark: SparkSession, path: str, sep: str = ";", encoding: str = "utf-8"
) -> list[str]:
    """Column names of a delimited file; reads its first line only."""
    return _reader(spark, sep, encoding).csv(path).columns


def read_table(
    spark: SparkSession,
    path: str,
    sep: str = ";",
    encoding: str = "utf-8",
    columns: Sequence[str] | None = None,
    limit: int | None = None,
    missing_fields: bool = True,
    position: str | None = None,
    block_bytes: int | None = None,
) -> DataFrame:
    """A delimited file with every column as text.

    ``columns`` prunes the scan, ``limit`` keeps any so many rows, ``missing_fields`` turns the
    usual spellings of a missing field into null. ``position`` names a column with the place of each row in the
    source: a struct ``(file, block, row)`` that sorts in the order of the files, whatever the number of tasks, and
    stays true through stages, shuffles and joins. Its file is a number, as sorts hold the path of a row uncompressed.
    ``block_bytes`` is the size of its blocks; up to ``SHARED_BLOCKS`` small ones share a task.
    """
    reader = block_reader(spark, block_bytes) if position else spark
    table = _reader(reader, sep, encoding).csv(path)
    names = list(columns) if columns is not None else table.columns
    absent = [c for c in names if c not in table.columns]
    if absent:
        raise ValueError(f"{path} lacks columns: {', '.join(absent)}")
    cells = [F.col(quoted_name(c)) for c in names]
    if missing_fields:
        cells = [null_missing_fields(c) for c in cells]
    kept = [cell.alias(name) for cell, name in zip(cells, names)]
    out = table.select(*kept) if position is None else _placed(spark, reader, table, path, kept, names, position)
    return out.limit(limit) if limit is not None else out


def file_numbers(spark: SparkSession, path: str) -> DataFrame:
    """``(__path, __file)``: the files of a table, numbered in the order of their paths; reads none of them."""
    listed = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("__path"))
    # No more rows than the file listing the driver holds anyway.
    paths = sorted(row[0] for row in listed.collect())
    return spark.createDataFrame(list(enumerate(paths)), "__file int, __path string")


def _placed(
    spark: SparkSession, reader: SparkSession, table: DataFrame, path: str, cells: Sequence[Column], names: Sequence[str], position: str
) -> DataFrame:
    """The cells with their position; rows are numbered in their own block, whichever blocks share a task."""
    parts = {"__path": F.col("_metadata.file_path"), "__block": F.col("_metadata.file_block_start"), "__row": row_in_block()}
    rows = table.select(*cells, *[part.alias(name) for name, part in parts.items()])
    tasks = max(reading_tasks(spark, [path]), -(-reading_tasks(reader, [path]) // SHARED_BLOCKS))
    rows = rows.coalesce(max(tasks, 4 * spark.sparkContext.defaultParallelism))
    found = rows.join(F.broadcast(file_numbers(reader, path)), "__path", "left")
    number = F.coalesce("__file", F.raise_error(F.concat(F.lit("not listed: "), "__path")).cast("int"))
    place = F.struct(number.alias("file"), F.col("__block").alias("block"), F.col("__row").alias("row"))
    return found.select(*[F.col(quoted_name(n)) for n in names], place.alias(position))


def read_keys(
    spark: SparkSession, path: str, column: str, sep: str = ";", encoding: str = "utf-8"
) -> DataFrame:
    """Distinct trimmed non-null values of one column."""
    table = read_table(spark, path, sep, encoding, [column])
    return table.select(stripped(column).alias(column)).filter(F.col(column).isNotNull()).distinct()


def read_reference_list(
    spark: SparkSession, path: str, sep: str = ",", encoding: str = "utf-8"
) -> DataFrame:
    """A small reference list: inferred types, header names trimmed and in lower case."""
    return clean_header(_reader(spark, sep, encoding).option("inferSchema", True).csv(path))


def read_objects(spark: SparkSession, uris: str | Sequence[str]) -> DataFrame:
    """Parquet datasets under any Hadoop URI; objects with other columns are merged by name."""
    paths = [uris] if isinstance(uris, str) else list(uris)
    return spark.read.option("mergeSchema", len(paths) > 1).parquet(*paths)
