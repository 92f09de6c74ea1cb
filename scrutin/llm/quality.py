"""Quality rules: a table of thresholds, compiled into one row-wise Spark projection.

No user function, no shuffle: the measures are built-in expressions over the words and lines of one
text, the rules compare them with the table, and a row keeps all its columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrutin.llm.tables import pinned

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
#: Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in is that it for on with as at by this are was be or an from not have "
    "le la les des du de un une et est que qui dans pour par sur au aux en ne pas plus avec "
    "der die das und ist den von zu mit sich auf für nicht ein eine im dem auch es an "
    "el los las del y que se por con una su para al lo como más o pero sus"
).split()


class Rule(NamedTuple):
    """A text passes when ``low <= measure <= high``; a missing bound holds always."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: Measures are SQL over the columns that ``measures`` makes; texts without words have no ratios, null instead,
#: and a null passes no rule (``/`` would end the query on them).
RULES: tuple[Rule, ...] = (
    Rule("word_length", "try_divide(word_chars, n_words)", 1.5, 25.0),
    Rule("symbols", "try_divide(n_symbols, n_words)", None, 0.25),
    Rule("stop_words", "try_divide(n_stop_words, n_words)", 0.01, None),
    Rule("repeated_lines", "try_divide(n_dup_lines, n_lines)", None, 0.7),
)


def _covered(words: str, keys: str, mask: str) -> tuple[Column, Column]:
    """Positions whose window's hash occurs again, and a window with its position for each of those."""
    last = F.size(keys) - 1
    same = lambda x, y: F.bitwise_not(F.col(mask)).bitwiseAND(x.bitwiseXOR(y)) == 0
    again = F.transform(
        F.filter(
            keys,
            lambda x, i: ((i > 0) & same(x, F.get(keys, i - 1))) | ((i < last) & same(x, F.get(keys, i + 1))),
        ),
        lambda x: x.bitwiseAND(F.col(mask)).cast("int"),
    )
    window = lambda p: F.concat_ws(" ", F.get(words, p), F.get(words, p + 1), F.get(words, p + 2))
    return again, F.transform("__again", lambda p: F.struct(window(p).alias("t"), p.alias("p")))


def measures(docs: DataFrame, text: str = "text", stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """``docs`` with the counts that rules compare.

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_lines`` (lines with a word),
    ``n_dup_lines`` (equal to an earlier one), ``n_repeat_words`` (words in 3-word windows that occur
    twice or more) and ``n_stop_words``, all long. Null and empty texts have zeros. Columns of these
    names are replaced.

    Repeated windows are found by sorting longs, hash above and position below; the windows that share
    a hash are then compared as texts, so the count is exact.
    """
    extra = ("__text", "__words", "__lines", "__mask", "__keys", "__again", "__windows")
    words, n = F.col("__words"), F.size("__words")
    key = lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(3)))
    df = docs.withColumn("__text", F.coalesce(F.col(text).cast("string"), F.lit("")))
    df = df.withColumns(
        {
            "__words": F.array_remove(F.split("__text", SPACE), ""),
            "__lines": F.filter(F.split("__text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        }
    )
    df = df.withColumn("__mask", F.expr("shiftleft(1L, cast(ceil(log2(size(__words) + 2)) as int)) - 1L"))
    df = df.withColumn(
        "__keys",
        F.sort_array(
            F.when(
                n >= 3,
                F.transform(
                    F.sequence(F.lit(0), n - 3),
                    lambda i: key(i).bitwiseAND(F.bitwise_not(F.col("__mask"))).bitwiseOR(i.cast("bigint")),
                ),
            ).otherwise(F.array().cast("array<bigint>"))
        ),
    )
    again, windows = _covered("__words", "__keys", "__mask")
    df = df.withColumn("__again", again).withColumn("__windows", F.sort_array(windows))
    last = F.size("__windows") - 1
    text_at = lambda i: F.get("__windows", i)["t"]
    repeated = F.filter(
        "__windows",
        lambda x, i: ((i > 0) & (x["t"] == text_at(i - 1))) | ((i < last) & (x["t"] == text_at(i + 1))),
    )
    positions = F.flatten(F.transform(repeated, lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2)))
    counts = {
        "n_words": n,
        "word_chars": F.char_length(F.array_join("__words", "")),
        "n_symbols": F.char_length("__text") - F.char_length(F.regexp_replace("__text", SYMBOLS, "")),
        "n_lines": F.size("__lines"),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": F.size(F.array_distinct(positions)),
        "n_stop_words": F.size(F.filter("__words", lambda w: F.lower(w).isin(list(stop_words)))),
    }
    return df.withColumns({k: pinned(v.cast("bigint")) for k, v in counts.items()}).drop(*extra)


def passes(rule: Rule) -> Column:
    value = F.expr(rule.measure)
    held = F.lit(True)
    if rule.low is not None:
        held = held & (value >= F.lit(rule.low))
    if rule.high is not None:
        held = held & (value <= F.lit(rule.high))
    return F.coalesce(held, F.lit(False))


def judge(measured: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Add ``base_failed``, ``failed_rules`` (names, in table order) and ``kept``."""
    names = F.array(*[F.when(~passes(r), F.lit(r.name)) for r in rules]).cast("array<string>")
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    df = measured.withColumn("base_failed", base).withColumn("failed_rules", F.array_compact(names))
    return df.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def quality_rules(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Every row of ``docs`` with its measures and verdict; an empty table stays empty."""
    return judge(measures(docs, text), rules)
