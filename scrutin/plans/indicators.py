"""Census-style indicators: a very wide table into long topic tables, driven by a mapping."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrutin.functions.numbers import lenient_double
from scrutin.functions.text import stripped, stripped_upper
from scrutin.operators.counting import Counts, counted
from scrutin.operators.keys import stable_order
from scrutin.operators.lookup import count_missing, semi
from scrutin.operators.reshape import MappedColumn, by_table, file_safe, wide_to_long
from scrutin.operators.rules import require_columns
from scrutin.schemas import GEO_CODE, MAPPING_COLUMNS, META_CODE, PERIOD
from scrutin.scratch import staged
from scrutin.sinks.files import write_tables
from scrutin.sources.tables import header_names, read_keys, read_table

# Fixed value: the data type whose metrics are parsed as numbers.
NUMERIC = "NUM"
POSITION = "__position"


def clean_mapping(raw: DataFrame) -> DataFrame:
    """Mapping rows with every needed value, trimmed, and a whole-number ``year``.

    Rows without a usable year are dropped.
    """
    require_columns(raw, MAPPING_COLUMNS, "mapping")
    needed = [c for c in MAPPING_COLUMNS if c != "data_type"]
    year = lenient_double("available_years").try_cast("bigint")
    return (
        raw.dropna(subset=needed)
        .select(
            *[
                (stripped_upper(c) if c == "data_type" else stripped(c)).alias(c)
                for c in MAPPING_COLUMNS
            ],
            year.alias("year"),
            *[c for c in raw.columns if c == "position"],
        )
        .filter(F.col("year").isNotNull())
    )


def collect_mapping(mapping: DataFrame) -> list[MappedColumn]:
    """A cleaned mapping as driver metadata, in file order when it carries a position.

    A mapping describes columns, which a plan has to name; it does not grow with the rows of the data.
    """
    rows = mapping.collect()
    if "position" in mapping.columns:
        rows = sorted(rows, key=lambda r: r["position"])
    return [
        MappedColumn(
            r["source_code"],
            r["target_table"],
            r["canonical_metric"],
            r["data_type"] == NUMERIC,
            r["year"],
        )
        for r in rows
    ]


def read_mapping(
    spark: SparkSession, path: str, sep: str = ";", encoding: str = "utf-8", counts: Counts | None = None
) -> DataFrame:
    """The mapping file, cleaned, with the position of its rows."""
    raw = read_table(spark, path, sep, encoding, position="position")
    return counted(counts, raw, "mapping", "usable", clean_mapping)


@dataclass(frozen=True)
class Reshape:
    """The topic tables, and the source codes that could not be matched."""

    tables: dict[str, DataFrame]
    #: Rows of each step; complete once all tables have been written.
    counts: Counts = field(default_factory=Counts)
    missing_in_raw: list[str] = field(default_factory=list)
    missing_in_meta: list[str] = field(default_factory=list)


def reshape_table(
    raw: DataFrame,
    mapping: list[MappedColumn],
    key: str = GEO_CODE,
    period: str = PERIOD,
    allowed: DataFrame | None = None,
    limit: int | None = None,
    sanitize: bool = True,
    ordered: bool = True,
    counts: Counts | None = None,
    position: str | None = None,
) -> Reshape:
    """Topic tables of a wide table, by key and period unless not ``ordered``.

    ``position`` names the column of ``raw`` that tells the source order of its rows, which decides between rows of
    one key and period. Without it the order of the scan does.

    Only the key and the mapped columns are read. ``allowed`` restricts the keys. The pruned and
    filtered input is written to the shared folder once, so that the wide source is parsed, and its rows are
    counted, a single time; one table alone is not staged unless ``counts`` are asked for.
    """
    if key not in raw.columns:
        raise ValueError(f"wide table lacks {key}")
    present = set(raw.columns)
    missing = sorted({m.source for m in mapping} - present)
    used = [m for m in mapping if m.source in present]
    if not used:
        raise ValueError("no mapped column is in the wide table")
    topics = by_table(used)
    columns = list(dict.fromkeys([key, *[m.source for m in used]]))
    if ordered and position is None:
        raw, position = raw.withColumn(POSITION, F.monotonically_increasing_id()), POSITION
    carried = [position] if ordered and position else []
    rows = raw.select(*[raw[f"`{c}`"] for c in columns], *carried)
    if limit is not None:
        rows = rows.limit(limit)
    if allowed is not None:
        rows = counted(counts, rows, "wide", "allowed keys", lambda rows: semi(rows, allowed, [key]))
    if len(topics) > 1 or counts is not None:
        rows = staged(rows if counts is None else counts.leaving(rows, "wide", "read"), "wide", small=True)
    tables = {}
    for name, columns_of in topics.items():
        table = wide_to_long(rows, key, period, columns_of, carried)
        if ordered:
            table = stable_order(table, [key, period], position)
        if counts is not None:
            # Above the sort, whose sample would be counted too.
            table = counts.leaving(table, "table", name)
        tables[file_safe(name) if sanitize else name] = table
    return Reshape(tables, counts or Counts(), missing)


def reshape_files(
    spark: SparkSession,
    raw_path: str,
    mapping_path: str,
    meta_path: str | None = None,
    geo_path: str | None = None,
    sep: str = ";",
    encoding: str = "utf-8",
    limit: int | None = None,
    sanitize: bool = True,
    ordered: bool = True,
    block_bytes: int | None = None,
) -> Reshape:
    """Topic tables from files: wide data, mapping, optional dictionary and allowed communes."""
    counts = Counts()
    mapping = collect_mapping(read_mapping(spark, mapping_path, sep, encoding, counts))
    header = header_names(spark, raw_path, sep, encoding)
    if GEO_CODE not in header:
        raise ValueError(f"{raw_path} lacks {GEO_CODE}")
    codes = {m.source for m in mapping}
    columns = [c for c in header if c == GEO_CODE or c in codes]
    place = POSITION if ordered else None
    raw = read_table(spark, raw_path, sep, encoding, columns, position=place, block_bytes=block_bytes)
    allowed = None
    if geo_path is not None:
        allowed = read_keys(spark, geo_path, "code_commune", sep, encoding).withColumnRenamed(
            "code_commune", GEO_CODE
        )
    built = reshape_table(
        raw, mapping, allowed=allowed, limit=limit, sanitize=sanitize, ordered=ordered, counts=counts, position=place
    )
    unknown: list[str] = []
    if meta_path is not None:
        meta = read_table(spark, meta_path, sep, encoding)
        if META_CODE in meta.columns:
            unknown = missing_codes(spark, sorted(codes & set(header)), meta, META_CODE)
    return Reshape(built.tables, counts, built.missing_in_raw, unknown)


def removed_counts(raw_mapping: DataFrame, rows: DataFrame, allowed: DataFrame, key: str = GEO_CODE) -> DataFrame:
    """``(step, rows_in, removed)``: what cleaning the mapping and restricting the keys leave out.

    Keys are counted before they are compared, so a frequent key travels once per task.
    """
    cleaned = clean_mapping(raw_mapping).agg(F.count(F.lit(1)).alias("left"))
    mapping = raw_mapping.agg(F.count(F.lit(1)).alias("rows_in")).join(cleaned, how="cross")
    mapping = mapping.select(F.lit("mapping").alias("step"), "rows_in", (F.col("rows_in") - F.col("left")).alias("removed"))
    total = rows.agg(F.count(F.lit(1)).alias("rows_in"))
    missing = count_missing(rows, allowed.select(key).distinct(), key).withColumnRenamed("violations", "removed")
    keys = total.join(missing, how="cross").select(F.lit("keys").alias("step"), "rows_in", "removed")
    return mapping.unionByName(keys)


def missing_codes(
    spark: SparkSession, codes: list[str], dictionary: DataFrame, column: str
) -> list[str]:
    """Codes that the dictionary does not hold."""
    if not codes:
        return []
    wanted = spark.createDataFrame([(c,) for c in codes], f"`{column}` string")
    # At most as many rows as the wide table has columns.
    rows = wanted.join(dictionary.select(column), column, "left_anti").collect()
    return sorted(r[0] for r in rows)


def write_reshape(built: Reshape, folder: str, sep: str = ";", encoding: str = "utf-8") -> None:
    write_tables(built.tables, folder, sep, encoding)
