"""Text files as lines with a stable position.

The position ``(file, block, row)`` is the same in every scan, which makes headers and section
markers addressable: the reader below always cuts a file into blocks of
``spark.sql.files.maxPartitionBytes`` and gives each block its own task, whatever the number of
cores at the time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scrutin.functions.text import is_filled, stripped
from scrutin.operators.keys import ROW_BITS
from scrutin.scratch import COMPILED_BYTES, staged

LINE = "line"
POSITION = ("file", "block", "row")
MAX_BROADCAST_FILES = 10_000

# Bytes of text in a byte of a compressed file, about; such a file is one block, whatever its size.
COMPRESSED = 8

# Names the engine's decoder knows.
CHARSETS = {
    "latin-1": "ISO-8859-1",
    "latin1": "ISO-8859-1",
    "iso-8859-1": "ISO-8859-1",
    "utf-8": "UTF-8",
    "utf8": "UTF-8",
    "us-ascii": "US-ASCII",
    "utf-16": "UTF-16",
}


def charset(encoding: str) -> str:
    return CHARSETS.get(encoding.lower(), encoding)


def block_reader(spark: SparkSession, block_bytes: int | None) -> SparkSession:
    """A session whose file scans hold exactly one file block per task."""
    reader = spark.newSession()
    # Everything derived from these lines runs in the new session, so it gets the caller's settings.
    for row in spark.sql("SET").collect():
        if spark.conf.isModifiable(row["key"]):
            reader.conf.set(row["key"], row["value"])
    # A wanted number of partitions would pack several blocks into one task.
    reader.conf.unset("spark.sql.files.maxPartitionNum")
    reader.conf.unset("spark.sql.files.minPartitionNum")
    if block_bytes:
        reader.conf.set("spark.sql.files.maxPartitionBytes", str(block_bytes))
    # Opening a file counts as much as a full block, so two blocks never share a task and the
    # block size does not depend on the parallelism.
    reader.conf.set(
        "spark.sql.files.openCostInBytes", reader.conf.get("spark.sql.files.maxPartitionBytes")
    )
    reader.conf.set("spark.sql.codegen.hugeMethodLimit", str(COMPILED_BYTES))
    return reader


def row_in_block() -> Column:
    """The number of a row within its task, which a block reader's scan makes that within its block."""
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1))


def read_lines(
    spark: SparkSession,
    path: str | Sequence[str],
    encoding: str = "latin-1",
    block_bytes: int | None = None,
) -> DataFrame:
    """``(line, file, block, row)`` for every line; ``row`` counts within the block."""
    paths = [path] if isinstance(path, str) else list(path)
    name = charset(encoding)
    line = F.col("value")
    if name != "UTF-8":
        # The text reader itself does not decode.
        line = F.decode(line.cast("binary"), name)
    reader = block_reader(spark, block_bytes)
    lines = reader.read.text(paths).select(
        line.alias(LINE),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        row_in_block().alias("row"),
    )
    # Every task behind the scan writes to all partitions of a shuffle, so blocks of small files share tasks.
    # Rows are numbered below this, in each block by itself.
    return lines.coalesce(max(reading_tasks(reader, paths), 4 * spark.sparkContext.defaultParallelism))


def reading_tasks(reader: SparkSession, paths: Sequence[str]) -> int:
    """Tasks that hold the files at no more than some block's bytes each.

    Compressed files count by the text in them. A folder is taken to hold files of one kind.
    """
    jvm, conf = reader.sparkContext._jvm, reader.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    held = 0
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        fs = path.getFileSystem(conf)
        for found in fs.globStatus(path) or []:
            length = fs.getContentSummary(found.getPath()).getLength()
            names = [f.getPath() for f in fs.listStatus(found.getPath())] if found.isDirectory() else [found.getPath()]
            held += length * (COMPRESSED if any(codecs.getCodec(n) is not None for n in names) else 1)
    block = int(jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(reader.conf.get("spark.sql.files.maxPartitionBytes")))
    return -(-held // block)


def without_header(lines: DataFrame) -> DataFrame:
    """Lines except the first one of each file."""
    return lines.filter(~((F.col("block") == 0) & (F.col("row") == 0)))


def header_counts(lines: DataFrame, sep: str = ";", quote: str = '"') -> DataFrame:
    """``(file, columns)``: how many fields the first line of each file has."""
    first = lines.filter((F.col("block") == 0) & (F.col("row") == 0))
    return staged(first.select("file", field_count(F.col(LINE), sep, quote).alias("columns")), "headers")


def section_marks(lines: DataFrame, markers: Sequence[str]) -> DataFrame:
    """Per file, the positions of the first line of each marker and of the line behind it.

    Columns ``file, mark0, head0, mark1, head1, …``; positions are structs ``(block, row)``, null
    where a marker (or a line behind it) does not exist.
    """
    # Few lines hold a marker at all; only those are trimmed.
    firsts = [
        F.min(
            F.when(F.contains(F.col(LINE), F.lit(marker)) & (stripped(LINE) == marker), F.col("row"))
        ).alias(f"row{i}")
        for i, marker in enumerate(markers)
    ]
    # One row per file block: as many as the scan has tasks.
    blocks = lines.groupBy("file", "block").agg(F.max("row").alias("last"), *firsts)
    follow = Window.partitionBy("file").orderBy("block")
    blocks = blocks.withColumn("next", F.lead("block").over(follow))
    marks = []
    for i in range(len(markers)):
        here = F.col(f"row{i}")
        position = F.when(here.isNotNull(), F.struct("block", here.alias("row")))
        behind = F.when(
            here < F.col("last"), F.struct("block", (here + 1).alias("row"))
        ).when(
            F.col("next").isNotNull(),
            F.struct(F.col("next").alias("block"), F.lit(0).cast("bigint").alias("row")),
        )
        marks.append(F.min(position).alias(f"mark{i}"))
        marks.append(F.min_by(behind, position).alias(f"head{i}"))
    return blocks.groupBy("file").agg(*marks)


def sectioned(lines: DataFrame, markers: Sequence[str], section: str = "section") -> DataFrame:
    """Lines of marked sections, numbered 1, 2, … in the order of ``markers``.

    A line equal to a marker after trimming opens its section; that line and the one behind it (a
    header) are left out, as is everything before the first marker. Each file has its own
    sections. Raises when a file lacks a marker or has them in another order.
    """
    marks = section_marks(lines, markers)
    # One small row per file, no more than the file listing the driver holds anyway.
    found = marks.collect()
    if not found:
        raise ValueError(f"markers {', '.join(markers)} not found")
    for row in found:
        places = [row[f"mark{i}"] for i in range(len(markers))]
        missing = [m for m, p in zip(markers, places) if p is None]
        if missing:
            raise ValueError(f"marker {', '.join(missing)} not found in {row['file']}")
        if places != sorted(places):
            raise ValueError(f"markers out of order in {row['file']}")
    table = lines.sparkSession.createDataFrame(found, marks.schema)
    if len(found) <= MAX_BROADCAST_FILES:
        table = F.broadcast(table)
    here = F.struct("block", "row")
    number = F.lit(None).cast("bigint")
    skipped = F.lit(False)
    for i in range(len(markers)):
        number = F.when(here > F.col(f"mark{i}"), F.lit(i + 1).cast("bigint")).otherwise(number)
        skipped = (
            skipped
            | (here == F.col(f"mark{i}"))
            | F.coalesce(here == F.col(f"head{i}"), F.lit(False))
        )
    return (
        lines.join(table, "file")
        .withColumn(section, number)
        .filter(F.col(section).isNotNull() & ~skipped)
        .select(*[F.col(c) for c in lines.columns], section)
    )


# --- splitting -------------------------------------------------------------------------------


def _literal_pattern(sep: str) -> str:
    return r"\Q" + sep + r"\E" if set(sep) & set(r"\^$.|?*+()[]{}") else sep


def _without_trailing(text: Column, sep: str, drop_empty: str) -> Column:
    if drop_empty == "one":
        shorter = F.left(text, F.length(text) - F.lit(len(sep)))
        return F.when(F.endswith(text, F.lit(sep)), shorter).otherwise(text)
    if drop_empty == "all":
        return F.rtrim(text, F.lit(sep))
    if drop_empty == "none":
        return text
    raise ValueError(f"drop_empty: {drop_empty}")


def _count_fields(text: Column, sep: str) -> Column:
    gaps = F.length(text) - F.length(F.replace(text, F.lit(sep), F.lit("")))
    return (gaps / F.lit(len(sep))).cast("int") + 1


def delimited(
    lines: DataFrame,
    sep: str,
    min_fields: int,
    drop_empty: str = "none",
    comment: str | None = None,
    keep_fields: int | None = None,
    fields: str = "fields",
) -> DataFrame:
    """Lines split into the array column ``fields``; lines with fewer than ``min_fields`` left out.

    ``drop_empty`` removes ``none``, ``one`` or ``all`` empty fields at the end of a line.
    With ``comment``, lines are trimmed first and those starting with it are left out.
    """
    text = F.col(LINE)
    if comment is not None:
        lines = lines.withColumn(LINE, stripped(LINE))
        lines = lines.filter(~F.startswith(text, F.lit(comment)))
    text = _without_trailing(text, sep, drop_empty)
    cut = F.split(text, _literal_pattern(sep), -1)
    if keep_fields:
        cut = F.slice(cut, 1, keep_fields)
    # Counting separators is cheaper than splitting a line twice, once to filter, once to keep.
    return (
        lines.filter(_count_fields(text, sep) >= min_fields).withColumn(fields, cut).drop(LINE)
    )


def _quoted_field(quote: str) -> str:
    """A quoted field: runs of other characters between doubled quotes, matched without stepping back."""
    return f"{quote}[^{quote}]*+(?:{quote}{quote}[^{quote}]*+)*+{quote}"


def field_count(record: Column, sep: str, quote: str = '"') -> Column:
    """Number of fields of a quoted record: separators outside quotes, plus one.

    A quote opens a field at its beginning only; elsewhere it is text.
    """
    opened = f"(^|{_literal_pattern(sep)}){_quoted_field(quote)}"
    bare = F.regexp_replace(record, opened, "$1")
    return F.when(F.contains(record, F.lit(quote)), _count_fields(bare, sep)).otherwise(_count_fields(record, sep))


def is_cut(line: Column, sep: str, quote: str = '"') -> Column:
    """True when a quoted field is still open at the end of the line."""
    mark = _literal_pattern(sep)
    rest = f"(?:(?!{mark})[\\s\\S])*+" if len(sep) > 1 else f"[^\\Q{sep}\\E]*+"
    field = f"(?:{_quoted_field(quote)}{rest}|(?!{quote}){rest})"
    return F.contains(line, F.lit(quote)) & ~line.rlike(f"\\A{field}(?:{mark}{field})*+\\z")


def quoted(
    lines: DataFrame,
    columns: int,
    sep: str = ";",
    quote: str = '"',
    fields: str = "fields",
    present: str = "present",
) -> DataFrame:
    """Lines of quoted fields as an array of ``columns`` texts.

    Short lines are padded with nulls and long ones cut; ``present`` is the number of fields the
    line really has. A line must hold a whole record: ``records`` joins those with line breaks.
    """
    names = [f"c{i}" for i in range(columns)]
    schema = ", ".join(f"{n} string" for n in names)
    options = {"sep": sep, "quote": quote, "escape": quote}
    return (
        lines.filter(is_filled(LINE))
        .withColumn("__record", F.from_csv(LINE, schema, options))
        .withColumn(present, F.least(field_count(F.col(LINE), sep, quote), F.lit(columns)))
        .withColumn(fields, F.array(*[F.col(f"__record.{n}") for n in names]))
        .drop(LINE, "__record")
    )
