"""Licence scan: canonical digest lookup of entire texts, in built-in expressions only.

A text's canonical form is lower case, without copyright lines and the title lines above it, with every run of
characters that are neither letters nor digits as one space, and with equivalent spellings replaced. Its digest is hash-joined
to the digests of known texts. The lookup table has one row per known licence, so it is broadcast; the
documents are not shuffled and lines of one document are looked up within its row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scrutin.llm.license_texts import NOTICES, SPELLINGS, TEXTS, TITLES
from scrutin.llm.tables import pinned

#: A line that claims a copyright: the word or sign, then a year (or its place in a form), a sign or a name on the same line.
COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n]*(copyright\b\s*(\(c\)|©|\d{4}|by\b|[\[{<]\s*(yyyy|year)\b)|\(c\)\s*\d{4}|©|all rights reserved)[^\n]*$"
#: Licence tables beyond this many texts are joined by hash over the network instead of by broadcast.
BROADCAST_TEXTS = 10_000


def lines_of(text: Column) -> Column:
    """Canonical lines before spelling: lower case, no copyright lines, words parted by single spaces."""
    lower = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    # The word is looked for first: most texts have no such line.
    bare = F.when(lower.rlike(r"copyright|\(c\)|©|all rights"), F.regexp_replace(lower, COPYRIGHT_LINE, "")).otherwise(lower)
    plain = F.regexp_replace(bare, r"[^\p{L}\p{N}\n]+", " ")
    # A function of two arguments would be given the line's number too, as the characters to trim.
    return F.filter(F.transform(F.split(plain, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def spelled(words: Column) -> Column:
    """Words with equivalent spellings replaced."""
    same = F.create_map(*[F.lit(x) for pair in SPELLINGS.items() for x in pair])
    return F.transform(words, lambda w: F.coalesce(F.try_element_at(same, w), w))


def canonical(spark: SparkSession, lines: Sequence[str]) -> list[str]:
    """Canonical forms of a few single lines, in their order."""
    rows = spark.createDataFrame(list(enumerate(lines)), "i int, text string")
    done = rows.select("i", F.array_join(spelled(F.split(F.array_join(lines_of(F.col("text")), " "), " ")), " ").alias("line"))
    return [r["line"] for r in sorted(done.collect())]


def shortened(lines: Column, longest: int) -> Column:
    """Lines of which the spelled form can have ``longest`` characters."""
    return F.filter(lines, lambda x: F.char_length(x) <= longest + 2 * max(map(len, SPELLINGS)))


def untitled(lines: Column, titles: Sequence[str]) -> Column:
    """``lines`` from the first on that is no title; few texts begin with one, so others pay for one line."""
    longest = max(map(len, titles), default=0) + 2 * max(map(len, SPELLINGS))
    is_title = lambda x: (F.char_length(x) <= longest) & F.array_join(spelled(F.split(x, " ")), " ").isin(list(titles))
    place = F.array_position(F.transform(lines, is_title), F.lit(False)).cast("int")
    left = F.when(place > 0, F.slice(lines, F.greatest(place, F.lit(1)), F.size(lines))).otherwise(F.slice(lines, 1, 0))
    return F.when(F.coalesce(is_title(F.get(lines, F.lit(0))), F.lit(False)), left).otherwise(lines) if titles else lines


def known_texts(
    spark: SparkSession, texts: Mapping[str, str | Sequence[str]] = TEXTS, titles: Sequence[str] = TITLES
) -> DataFrame:
    """``license_id``, ``n_words`` and ``digest`` of known entire texts, one row per digest."""
    pairs = [(name, t) for name, found in texts.items() for t in ([found] if isinstance(found, str) else found)]
    rows = spark.createDataFrame(pairs, "license_id string, text string")
    rows = rows.withColumn("lines", lines_of(F.col("text")))
    words = F.split(F.array_join(untitled(F.col("lines"), canonical(spark, titles) if titles else []), " "), " ")
    rows = rows.select("license_id", F.size(words).alias("n_words"), F.sha2(F.array_join(spelled(words), " "), 256).alias("digest"))
    return rows.groupBy("digest").agg(F.min("license_id").alias("license_id"), F.first("n_words").alias("n_words"))


def scan(
    docs: DataFrame,
    text: str = "text",
    texts: Mapping[str, str | Sequence[str]] = TEXTS,
    notices: Mapping[str, str] = NOTICES,
    titles: Sequence[str] = TITLES,
) -> DataFrame:
    """``docs`` with ``license_words`` (long, canonical words), ``license_digest``, ``license_id`` and ``license_notices``.

    ``license_digest`` is that of the entire canonical text. It is taken where the number of words is
    that of a known text (spelling never changes it; titles are left out of both), since no other text can match, and null elsewhere.
    ``license_id`` is null for a text that is no known licence. ``license_notices`` holds the sorted
    licences that whole lines of the text name, empty if none. Null and empty texts have no words and
    no licence. All rows are kept, repeated ones too; columns of these names are replaced.
    """
    spark = docs.sparkSession
    known = known_texts(spark, texts, titles)
    # One small row per known wording of a licence.
    side = [tuple(r) for r in known.select("digest", "license_id", "n_words").collect()]
    lengths = sorted({n for _, _, n in side})
    by_line = dict(zip(canonical(spark, list(notices)), notices.values(), strict=True)) if notices else {}
    taken = ("license_words", "license_digest", "license_id", "license_notices")
    df = docs.drop(*taken).withColumn("__lines", lines_of(F.col(text)))
    df = df.withColumn("__canonical", F.array_join(untitled(F.col("__lines"), canonical(spark, titles) if titles else []), " "))
    n = F.when(F.col("__canonical") == "", 0).otherwise(F.char_length("__canonical") - F.char_length(F.replace("__canonical", F.lit(" "))) + 1)
    df = df.withColumn("license_words", pinned(n.cast("bigint")))
    whole = F.sha2(F.array_join(spelled(F.split("__canonical", " ")), " "), 256)
    named = F.transform(shortened(F.col("__lines"), max(map(len, by_line), default=0)), lambda x: F.array_join(spelled(F.split(x, " ")), " "))
    names = F.create_map(*[F.lit(x) for pair in by_line.items() for x in pair]) if by_line else F.create_map().cast("map<string,string>")
    found = F.array_compact(F.transform(named, lambda x: F.try_element_at(names, x)))
    df = df.withColumns(
        {
            "license_digest": pinned(F.when(F.col("license_words").isin(lengths), whole) if lengths else F.lit(None).cast("string")),
            "license_notices": pinned(F.array_sort(F.array_distinct(found))),
        }
    ).drop("__lines", "__canonical")
    known = spark.createDataFrame([r[:2] for r in side], "license_digest string, license_id string")
    if len(side) <= BROADCAST_TEXTS:
        known = F.broadcast(known)
    return df.join(known, "license_digest", "left").select(*[c for c in docs.columns if c not in taken], *taken)
