"""Token counts of whole texts; huge texts by overlapping chunks that are spliced where both agree.

A chunk of a huge text is encoded with offsets, together with some of what precedes and follows it.
Two neighbours are spliced at a place in their overlap where a token begins in both, and which no
pre-token can span (after white space, or before a single space if the tokenizer keeps spaces). Where
the overlap holds no such place it is doubled and both chunks are encoded again; in the end that is the
whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrutin.llm.tokens import Encoder, encoder

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 512
_AFTER_SPACE = re.compile(r"(?<=[ \n])(?=\S)")
_BEFORE_SPACE = re.compile(r"(?<=\S)(?= \S)")


def _starts(code: Encoder, text: str, low: int, high: int) -> np.ndarray:
    """Where the tokens of ``text[low:high]`` begin, as places in ``text``."""
    found = code.tokenizer.encode(text[low:high], add_special_tokens=False).offsets
    return np.array([a for a, _ in found], dtype=np.int64) + low


def _splice(code: Encoder, text: str, left: np.ndarray, right: np.ndarray, low: int, high: int) -> int | None:
    """The place nearest to the middle of ``low:high`` at which both encodings may be cut."""
    rule = _AFTER_SPACE if code.drops_space else _BEFORE_SPACE
    firm = np.array([m.start() for m in rule.finditer(text, low + 1, high - 1)], dtype=np.int64)
    firm = firm[np.isin(firm, left) & np.isin(firm, right)]
    return int(firm[np.argmin(np.abs(firm - (low + high) // 2))]) if len(firm) else None


def count_huge(code: Encoder, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> int:
    """Tokens of ``text``, encoding about ``chunk`` characters at a time."""
    total, begin, edge, reach = 0, 0, chunk, overlap
    n = len(text)
    start = _starts(code, text, 0, min(n, edge + reach))
    low = 0  # where the current window begins; tokens before ``begin`` are counted
    while edge + reach < n:
        right_low = max(low, edge - reach)
        right_high = min(n, edge + chunk + overlap)
        right = _starts(code, text, right_low, right_high)
        at = _splice(code, text, start, right, right_low, min(n, edge + reach))
        if at is None or at <= begin:
            reach *= 2
            start = _starts(code, text, low, min(n, edge + reach))
            continue
        total += int(np.searchsorted(start, at) - np.searchsorted(start, begin))
        begin, low, start, edge, reach = at, right_low, right, edge + chunk, overlap
    return total + int(len(start) - np.searchsorted(start, begin))


def count_tokens(
    docs: DataFrame,
    text: str = "text",
    tokenizer: str = "word_bpe_49k.json",
    limit: int = 2048,
    chunk: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8) and ``n_tokens`` (long) and ``over_limit`` (more than ``limit``).

    Null and empty texts have no bytes and no tokens. Rows are kept as they are, repeated ones too;
    columns of these names are replaced. Special strings inside a text count as the library takes them.
    """

    def count(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        code = encoder(tokenizer)
        for column in columns:
            sizes = pc.fill_null(pc.binary_length(column), 0).cast(pa.int64())
            counts = []
            for value in column:
                t = value.as_py() or ""
                counts.append(count_huge(code, t, chunk, overlap) if len(t) > 2 * chunk else len(code.ids(t)) // 4)
            yield pa.StructArray.from_arrays([sizes, pa.array(counts, pa.int64())], ["n_bytes", "n_tokens"])

    counted = F.arrow_udf(count, "struct<n_bytes: bigint, n_tokens: bigint>").asNondeterministic()
    found = docs.withColumn("__found", counted(F.col(text).cast("string")))
    return found.withColumns(
        {
            "n_bytes": F.col("__found.n_bytes"),
            "n_tokens": F.col("__found.n_tokens"),
            "over_limit": F.col("__found.n_tokens") > limit,
        }
    ).drop("__found")
