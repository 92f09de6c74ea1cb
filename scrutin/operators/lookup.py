"""Many-to-one joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrutin.operators.integrity import require_unique
from scrutin.scratch import staged

WEIGHT = "__rows"

# A key with this many rows is answered from a broadcast table instead of a shuffle. With N rows
# in total there are at most N / HOT_ROWS such keys, which bounds the broadcast: 10^12 rows give
# at most 100,000 entries.
HOT_ROWS = 10_000_000

# A lookup table of at most this many rows is broadcast whole.
BROADCAST_ROWS = 100_000


# Buckets of key hashes in which rows are counted to find the hot keys, at least.
BUCKETS = 1 << 16

# Bits of a key in the bitmap that a semi join broadcasts, and words of 64 bits of the bitmap at most (16 bytes each).
BITS_PER_KEY = 16
BITMAP_WORDS = 1 << 21

# Types whose values are equal just when their bytes are.
HASHED = ("boolean", "tinyint", "smallint", "int", "bigint", "date", "string")

# Shares that hot rows are spread over in the shuffle of the other rows.
SPREAD = 1 << 20


def _same_key(keys: Sequence[str], other: Callable[[str], str], null_safe: bool) -> Column:
    pairs = [(F.col(k), F.col(other(k))) for k in keys]
    tests = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    return reduce(lambda a, b: a & b, tests)


def _digest(columns: Sequence[str]) -> Column:
    # 32 bits are enough to order the rows of a task, and half the traffic of 64.
    return F.hash(*columns)


def _hashes_agree(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> bool:
    """Whether equal keys of both sides have equal hashes: one type each, and no floats with their two zeros."""
    a, b = dict(left.dtypes), dict(right.dtypes)
    return all(a[k] == b[k] and a[k] in HASHED for k in keys)


def _other(name: str) -> str:
    return f"__table_{name}"


def _hot(name: str) -> str:
    return f"__hot_{name}"


def lookup(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    *,
    weight: str | None = None,
    null_safe: bool = True,
    right_rows: int | None = None,
    hot_rows: int = HOT_ROWS,
    checked: str | None = None,
) -> DataFrame:
    """Left join of ``left`` to ``right``, which holds at most one row per key.

    A table that comes out of an aggregate on the keys does; ``checked`` has any other one checked first, and names
    it in the ``ValueError`` that a repeated key raises.

    ``null_safe`` makes a null key match a null key. ``weight`` names a column of ``right`` that
    counts the rows of each key on the left (or an upper bound of it); keys that reach
    ``hot_rows`` are joined by broadcast, the others by shuffle, so that no task receives a hot
    key. Without it the hot keys are found by :func:`heavy_keys`, which reads the keys of ``left`` once or
    twice more. ``right_rows`` is the known size of ``right``; a small one is broadcast whole.
    The weight column is not part of the result.
    """
    if checked is not None:
        require_unique(right, keys, checked)
    values = [c for c in right.columns if c not in keys and c != weight]
    out = [*left.columns, *values]
    renamed = right.select(
        *[F.col(k).alias(_other(k)) for k in keys], *[F.col(c) for c in right.columns if c not in keys]
    )
    if right_rows is not None and right_rows <= BROADCAST_ROWS:
        return left.join(F.broadcast(renamed), _same_key(keys, _other, null_safe), "left").select(*out)
    if weight is None:
        heavy = heavy_keys(left, keys, hot_rows)
        if heavy is None:
            return left.join(renamed, _same_key(keys, _other, null_safe), "left").select(*out)
        weight = WEIGHT
        renamed = _weighed(renamed, heavy, keys)

    # A hash in front decides nearly all comparisons of the join's sorts; without it they walk through the keys.
    digest = len(keys) > 1 and _hashes_agree(left, right, keys)
    hot = renamed.filter(F.col(weight) >= hot_rows).select(
        *[F.col(_other(k)).alias(_hot(k)) for k in keys],
        *[F.col(v).alias(_hot(v)) for v in values],
        F.col(weight).alias(_hot(weight)),
    )
    answered = F.col(_hot(weight)).isNotNull()
    # Hot rows have their answer; in the second join they are spread evenly and match nothing.
    # Row content and input partition are the same when a task is run again.
    spread = 2 + F.pmod(F.xxhash64(F.spark_partition_id(), *left.columns), F.lit(SPREAD))
    tagged = left.join(F.broadcast(hot), _same_key(keys, _hot, null_safe), "left").withColumn(
        "__side", F.when(answered, spread).otherwise(F.lit(0).cast("bigint"))
    )
    # Both joins read the same columns of the table, so its shuffle is computed once.
    sided = renamed.withColumn("__table_side", (F.col(weight) >= hot_rows).cast("bigint"))
    same = _same_key(keys, _other, null_safe) & (F.col("__side") == F.col("__table_side"))
    if digest:
        tagged = tagged.withColumn("__digest", _digest(keys))
        sided = sided.withColumn("__table_digest", _digest([_other(k) for k in keys]))
        same = (F.col("__digest") == F.col("__table_digest")) & same
    return tagged.join(sided, same, "left").select(
        *left.columns,
        *[F.when(answered, F.col(_hot(v))).otherwise(F.col(v)).alias(v) for v in values],
    )


def _weighed(renamed: DataFrame, heavy: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table with the column ``WEIGHT``: the rows of heavy keys, 0 for all others."""
    told = heavy.select(*[F.col(k).alias(f"__heavy_{k}") for k in keys], F.col(WEIGHT).alias("__heavy"))
    same = reduce(lambda a, b: a & b, [F.col(_other(k)).eqNullSafe(F.col(f"__heavy_{k}")) for k in keys])
    joined = renamed.join(F.broadcast(told), same, "left")
    return joined.select(*renamed.columns, F.coalesce("__heavy", F.lit(0)).alias(WEIGHT))


def heavy_keys(df: DataFrame, keys: Sequence[str], rows: int = HOT_ROWS) -> DataFrame | None:
    """The keys that hold ``rows`` rows or more, with ``__rows``, their number; None if there are none.

    A count of rows by buckets of key hashes, which is small whatever the number of keys, tells the buckets that can
    hold such a key. Only the keys of those are counted themselves, so the answer is exact. N rows have at
    most N / ``rows`` such keys.
    """
    total = df.agg(F.count(F.lit(1))).first()[0]
    if total < rows:
        return None
    # With more buckets than full ones, most buckets stay below the limit even when all keys are rare.
    buckets = max(BUCKETS, 16 * total // rows)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("__bucket")
    full = df.select(bucket).groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= rows)
    full = staged(full.select("__bucket"), "full-buckets")
    if full.isEmpty():
        return None
    among = df.select(*keys, bucket).join(F.broadcast(full), "__bucket", "left_semi")
    heavy = among.groupBy(*keys).agg(F.count(F.lit(1)).alias(WEIGHT)).filter(F.col(WEIGHT) >= rows)
    heavy = staged(heavy, "heavy-keys")
    return None if heavy.isEmpty() else heavy


def _place(keys: Sequence[str], words: int) -> tuple[Column, Column]:
    """The word of a key's hash, and its two bits there."""
    h = F.xxhash64(*keys)
    bit = lambda by: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(h, by).bitwiseAND(F.lit(63)).cast("int"))
    word = F.shiftrightunsigned(h, 16).bitwiseAND(F.lit(words - 1))
    return word.alias("__word"), bit(0).bitwiseOR(bit(6))


def _may_match(left: DataFrame, allowed: DataFrame, n: int, keys: Sequence[str]) -> DataFrame:
    """``left`` without rows whose key's bits are not all set; ``left`` itself where the bitmap would be too large."""
    words = 1 << max(0, (n * BITS_PER_KEY // 64 - 1).bit_length())
    if words > BITMAP_WORDS:
        return left
    word, bits = _place(keys, words)
    bitmap = allowed.select(word, bits.alias("__bits")).groupBy("__word").agg(F.bit_or("__bits").alias("__bits"))
    met = left.withColumn("__word", word).join(F.broadcast(bitmap), "__word")
    return met.filter(F.col("__bits").bitwiseAND(bits) == bits).select(*left.columns)


def semi(left: DataFrame, right: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows of ``left`` whose key is in ``right``. A null key never matches.

    The distinct keys are written once. Few of them are broadcast. Of more, a bitmap of their hashes is (at most
    32 MB), which takes out most other rows before they are shuffled; what passes is compared exactly, and hot keys
    do not meet in one task.
    """
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    allowed = staged(right.select(*keys).filter(present).distinct(), "allowed-keys")
    n = allowed.count()
    if n <= BROADCAST_ROWS:
        return left.join(F.broadcast(allowed), list(keys), "left_semi")
    rows = _may_match(left.filter(present), allowed, n, keys)
    found = lookup(rows, allowed.withColumn("__found", F.lit(True)), keys, null_safe=False, hot_rows=hot_rows)
    return found.filter("__found").select(*left.columns)


def count_missing(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None) -> DataFrame:
    """One row ``(violations)``: rows of ``left`` whose key, null included, is not in ``right``.

    Rows are counted per key before the join, so a frequent key travels once per task.
    """
    per_key = left.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__n"))
    known = right.select(F.col(right_key or key).alias("__key"))
    return (
        per_key.join(known, "__key", "left_anti")
        .agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("violations"))
    )
