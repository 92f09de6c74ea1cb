"""Records of quoted files whose fields may hold line breaks, from splittable scans.

A line maps the state at its begin (inside quotes or not) to the state at its end. Each block of a file composes
the maps of its lines, both ways, a prefix over the blocks of a file tells where each begins, and with that every
line knows whether it goes on with a record of an earlier line, in its own block or another. Only positions
take part in this. The text of a line moves only if its record has several lines, and a file without such
records is left as it was scanned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrutin.operators.keys import ROW_BITS, dense_id
from scrutin.scratch import staged
from scrutin.sources.lines import LINE, MAX_BROADCAST_FILES, POSITION, is_cut

#: Lines of a record at most. Beyond that a quote is taken for one that was never closed.
MAX_LINES = 100_000
#: Words of 64 lines each (some 80 bytes) that are broadcast; more are joined by a shuffle.
BROADCAST_LINES = 500_000
#: Bytes of rows with a file's path that are broadcast; path and numbers stand in the key and in the row.
BROADCAST_BYTES = 16 << 20


class OpenQuoteError(ValueError):
    """A quoted field that does not end."""


def line_map(line: Column, sep: str, quote: str) -> tuple[Column, Column]:
    """Whether a line ends inside quotes, if it begins outside and if it begins inside."""
    plain = ~F.contains(line, F.lit(quote))
    outside = F.when(plain, F.lit(False)).otherwise(is_cut(line, sep, quote))
    inside = F.when(plain, F.lit(True)).otherwise(is_cut(F.concat(F.lit(quote), line), sep, quote))
    return outside, inside


def with_states(df: DataFrame, group: Sequence[str], order: str, outside: str, inside: str) -> DataFrame:
    """Add ``s0`` and ``s1``: the state before each row if its group begins outside, or inside, quotes.

    A map is constant, a swap or nothing at all, so a state is that of the last constant before, turned round by the
    swaps since.
    """
    before = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    constant = F.col(outside) == F.col(inside)
    swap = (F.col(outside) & ~F.col(inside)).cast("int")
    df = df.withColumn("__swaps", F.coalesce(F.sum(swap).over(before), F.lit(0)))
    last = F.last(F.when(constant, F.struct(F.col(outside).alias("state"), F.col("__swaps").alias("swaps"))), ignorenulls=True)
    df = df.withColumn("__last", last.over(before))
    since = F.col("__swaps") - F.coalesce(F.col("__last.swaps"), F.lit(0))
    turned = since % 2 == 1
    begun = lambda state: F.coalesce(F.col("__last.state"), F.lit(state)) != turned
    return df.withColumn("s0", begun(False)).withColumn("s1", begun(True)).drop("__swaps", "__last")


def _few(df: DataFrame) -> DataFrame:
    """``df``, one row per file block, to be broadcast if its rows are small altogether."""
    held = df.agg(F.sum(2 * F.octet_length("file") + F.lit(100))).first()[0] or 0
    return F.broadcast(df) if held <= BROADCAST_BYTES else df


def continued(lines: DataFrame, sep: str = ";", quote: str = '"') -> DataFrame:
    """Positions of all lines of records with several lines, or with a quote that is never closed.

    Columns ``file, block, row`` of the line and ``head_block, head_row`` of the record's first line. The result is
    written to the shared folder. Files without such lines cost one narrow scan.
    """
    opened = lines.filter(F.contains(LINE, F.lit(quote)) & is_cut(F.col(LINE), sep, quote))
    # One row per file block with an open line end, then per file.
    files = staged(opened.select("file").distinct(), "cut-files")
    known = files.count()
    if not known:
        none = lines.select(*POSITION, F.col("block").alias("head_block"), F.col("row").alias("head_row"))
        return lines.sparkSession.createDataFrame([], none.schema)
    concerned = F.broadcast(files) if known <= MAX_BROADCAST_FILES else files
    outside, inside = line_map(F.col(LINE), sep, quote)
    maps = lines.join(concerned, "file", "left_semi").select(*POSITION, outside.alias("o"), inside.alias("i"))
    states = staged(with_states(maps, ["file", "block"], "row", "o", "i"), "line-states")

    end = lambda state: F.when(F.col(state), F.col("i")).otherwise(F.col("o"))
    ends = F.max_by(F.struct(end("s0").alias("o"), end("s1").alias("i")), "row").alias("end")
    blocks = states.groupBy("file", "block").agg(ends).select("file", "block", "end.o", "end.i")
    # A file has as many of these rows as blocks.
    begins = staged(with_states(blocks, ["file"], "block", "o", "i").select("file", "block", F.col("s0").alias("begun")), "block-states")
    begins = _few(begins)
    placed = states.join(begins, ["file", "block"]).select(
        *POSITION, "o", F.when(F.col("begun"), F.col("s1")).otherwise(F.col("s0")).alias("goes_on")
    )
    upto = Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    headed = placed.withColumn("here", F.max(F.when(~F.col("goes_on"), F.col("row"))).over(upto))
    wanted = staged(headed.filter(F.col("goes_on") | F.col("o")), "cut-lines")
    # Where the record began in an earlier block, its first line is that block's last record.
    last = placed.groupBy("file", "block").agg(F.max(F.when(~F.col("goes_on"), F.col("row"))).alias("row"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    head = F.when(F.col("row").isNotNull(), F.struct("block", "row"))
    heads = last.select("file", "block", F.last(head, ignorenulls=True).over(earlier).alias("before"))
    heads = _few(staged(heads, "block-heads"))
    found = wanted.join(heads, ["file", "block"], "left").select(
        *POSITION,
        F.when(F.col("here").isNotNull(), F.col("block")).otherwise(F.col("before.block")).alias("head_block"),
        F.coalesce("here", "before.row").alias("head_row"),
    )
    return staged(found, "cut-records")


def records(lines: DataFrame, sep: str = ";", quote: str = '"', max_lines: int = MAX_LINES) -> DataFrame:
    """One row per record, with the columns of ``lines`` and the position of its first line.

    The line breaks inside quotes come back as line feeds. A quote opens a field at its beginning only. A quote
    that is still open at the end of a file is closed there; a record of more than ``max_lines`` lines is
    refused, because a quote that never ends would make the rest of its file one record.
    """
    cut = continued(lines, sep, quote)
    n = cut.count()
    if not n:
        return lines
    record = ["file", "head_block", "head_row"]
    longest = cut.groupBy(*record).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max_lines).first()
    if longest:
        raise OpenQuoteError(
            f"{longest['file']}: the record at block {longest['head_block']}, line {longest['head_row']} has {longest['n']} lines"
        )
    # A path is told once per block, and 64 lines of a block share a word, so that what is broadcast stays small.
    blocks, _ = dense_id(cut.select("file", "block").distinct(), ["file", "block"], "__id")
    blocks = _few(staged(blocks, "cut-blocks"))
    words = staged(_words(cut, blocks), "cut-words")
    if words.count() <= BROADCAST_LINES:
        words = F.broadcast(words)
    # Lines of other blocks get numbers that match nothing and differ, so that a shuffle spreads them.
    at = F.coalesce(_place(F.col("__id"), F.shiftright("row", 6)), -1 - F.col("row"))
    placed = lines.join(blocks, ["file", "block"], "left").withColumn("__at", at).join(words, "__at", "left")
    placed = placed.withColumn("__record", _record_of())
    parts = F.array_sort(F.collect_list(F.struct("__id", "row", LINE)))
    whole = F.concat_ws("\n", F.transform(parts, lambda x: x[LINE])).alias(LINE)
    joined = placed.filter(F.col("__record").isNotNull()).groupBy("__record").agg(whole)
    closed = F.when(is_cut(F.col(LINE), sep, quote), F.concat(LINE, F.lit(quote))).otherwise(F.col(LINE))
    row = F.col("__record").bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("row")
    joined = joined.withColumn("__id", F.shiftright("__record", ROW_BITS)).join(blocks, "__id")
    joined = joined.select(closed.alias(LINE), "file", "block", row)
    return placed.filter(F.col("__record").isNull()).select(*joined.columns).union(joined)


def _place(block: Column, row: Column) -> Column:
    """Block and row in one number, which sorts like both."""
    return F.shiftleft(block, ROW_BITS).bitwiseOR(row)


def _shift(value: Column, by: Column) -> Column:
    return F.call_function("shiftleft", value, by.cast("int"))


def _words(cut: DataFrame, blocks: DataFrame) -> DataFrame:
    """64 lines of a block in a row: bits of those in ``cut`` and of those that begin a record.

    ``__before`` is the place of the record of the first of them. It holds for all lines before the first that begins one.
    """
    heads = blocks.select("file", F.col("block").alias("head_block"), F.col("__id").alias("__head_id"))
    numbered = cut.join(blocks, ["file", "block"]).join(heads, ["file", "head_block"])
    bit = _shift(F.lit(1).cast("bigint"), F.col("row").bitwiseAND(F.lit(63)))
    begins = (F.col("block") == F.col("head_block")) & (F.col("row") == F.col("head_row"))
    return numbered.groupBy(_place(F.col("__id"), F.shiftright("row", 6)).alias("__at")).agg(
        F.bit_or(bit).alias("__lines"),
        F.bit_or(F.when(begins, bit).otherwise(F.lit(0).cast("bigint"))).alias("__begins"),
        F.min_by(_place(F.col("__head_id"), F.col("head_row")), "row").alias("__before"),
    )


def _record_of() -> Column:
    """The place of a line's record by the word of the line; null for a line that is a record by itself."""
    above = F.lit(63) - F.col("row").bitwiseAND(F.lit(63))
    # The line's own bit is moved to the top, so the length of the rest tells how far back its record began.
    held = _shift(F.col("__lines"), above) < 0
    begun = _shift(F.col("__begins"), above)
    head = _place(F.col("__id"), F.col("row") + F.length(F.bin(begun)) - 64)
    return F.when(held, F.when(begun != 0, head).otherwise(F.col("__before")))
