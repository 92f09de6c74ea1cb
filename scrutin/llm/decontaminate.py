"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of ``window`` words of benchmark items (an item with fewer words is one window).
Words are the symbols: a block is the last two words under the search position. A shift table, indexed by a
hash of the block, tells how far the position may move because no window can end before; where it says
zero, the windows that end with this block are looked up by the block's hash, and their words are compared,
first as hashes and then byte by byte. Many positions, in lanes over all texts of a slice, move at once.

Benchmarks are cut into parts of a bounded size, each broadcast by itself and searched for after the other.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrutin.llm import text as T
from scrutin.llm.workers import emptied

WINDOW = 13
#: Bytes of benchmark text that are broadcast at once.
PART_BYTES = 16 << 20
LANE = 256
_FOUND = "struct<n_words: bigint, hits: array<struct<start: bigint, end: bigint>>, items: array<string>>"


class Patterns(NamedTuple):
    """The windows of one length: words' hashes, where their bytes lie, items, and the search tables."""

    length: int
    words: np.ndarray
    start: np.ndarray
    end: np.ndarray
    items: list[list[str]]
    shift: np.ndarray
    suffixes: np.ndarray
    buckets: np.ndarray


class Benchmark(NamedTuple):
    data: np.ndarray
    classes: list[Patterns]


def blocks(hashes: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words that end at each position."""
    out = hashes[at]
    if width == 2:
        out = out + hashes[at - 1] * T.U64(0x9E3779B97F4A7C15)
    return T.mix(out)


def compile_patterns(ids: list[str | None], texts: pa.Array, window: int) -> Benchmark:
    """Search tables of the distinct windows of some items."""
    data, found = [], {}
    base = 0
    for piece in T.slices(texts):
        words = T.words(piece, T.LETTERS)
        hashes = T.word_hashes(piece, words)
        low = T.LOWER[piece.data]
        data.append(low)
        for i in range(piece.rows):
            a, b = int(words.bounds[i]), int(words.bounds[i + 1])
            n = min(window, b - a)
            for k in range(a, b - n + 1) if n else ():
                key = (n, hashes[k : k + n].tobytes())
                held = found.setdefault(key, (words.start[k : k + n] + base, words.end[k : k + n] + base, set()))
                held[2].add(ids[piece.first + i])
        base += len(low)
    classes = []
    for n in sorted({n for n, _ in found}):
        mine = [(np.frombuffer(w, T.U64), *rest) for (m, w), rest in found.items() if m == n]
        words = np.stack([m[0] for m in mine])
        width = min(2, n)
        bits = max(12, min(22, int(np.ceil(np.log2(len(mine) * n + 1))) + 4))
        shift = np.full(1 << bits, n - width + 1, dtype=np.int64)
        for j in range(width - 1, n):
            ends = blocks(words.reshape(-1), np.arange(len(mine)) * n + j, width)
            np.minimum.at(shift, (ends >> T.U64(64 - bits)).astype(np.int64), n - 1 - j)
        last = blocks(words.reshape(-1), np.arange(len(mine)) * n + n - 1, width)
        order = np.argsort(last, kind="stable")
        suffixes, first = np.unique(last[order], return_index=True)
        mine = [mine[k] for k in order]
        classes.append(
            Patterns(
                n, words[order], np.stack([m[1] for m in mine]), np.stack([m[2] for m in mine]),
                [sorted(x for x in m[3] if x is not None) for m in mine], shift, suffixes, np.append(first, len(mine)),
            )
        )
    return Benchmark(np.concatenate(data) if data else np.zeros(0, np.uint8), classes)


def same_bytes(a: np.ndarray, at_a: np.ndarray, b: np.ndarray, at_b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether the spans of ``n`` bytes are equal, each by itself."""
    ends = np.cumsum(n)
    within = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n)
    equal = a[np.repeat(at_a, n) + within] == b[np.repeat(at_b, n) + within]
    return np.diff(np.concatenate([[0], np.cumsum(equal)])[np.concatenate([[0], ends])]) == n


def occurrences(piece: T.Slice, words: T.Words, hashes: np.ndarray, bench: Benchmark, p: Patterns) -> tuple[np.ndarray, np.ndarray]:
    """Last word and pattern of every occurrence of the windows of one length."""
    n, width = p.length, min(2, p.length)
    bits = T.U64(64 - int(np.log2(len(p.shift))))
    first, stop = words.bounds[:-1] + n - 1, words.bounds[1:]
    lanes = np.maximum(0, -(-(stop - first) // LANE))
    inner = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    at = np.repeat(first, lanes) + inner * LANE
    until = np.minimum(at + LANE, np.repeat(stop, lanes))
    places, patterns = [], []
    while len(at):
        block = blocks(hashes, at, width)
        move = p.shift[(block >> bits).astype(np.int64)]
        zero = np.flatnonzero(move == 0)
        if len(zero):
            k = np.searchsorted(p.suffixes, block[zero])
            k = np.minimum(k, len(p.suffixes) - 1)
            hit = p.suffixes[k] == block[zero]
            k, here = k[hit], at[zero[hit]]
            sizes = p.buckets[k + 1] - p.buckets[k]
            here = np.repeat(here, sizes)
            which = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(p.buckets[k], sizes)
            offsets = np.arange(n) - n + 1
            for low in range(0, len(here), 1 << 16):
                h, w = here[low : low + (1 << 16)], which[low : low + (1 << 16)]
                good = (hashes[h[:, None] + offsets] == p.words[w]).all(axis=1)
                places.append(h[good])
                patterns.append(w[good])
            move[zero] = 1
        at = at + move
        live = at < until
        at, until = at[live], until[live]
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place, which = np.concatenate(places), np.concatenate(patterns)
    spans = place[:, None] + np.arange(n) - n + 1
    at_doc, at_item = words.start[spans].reshape(-1), p.start[which].reshape(-1)
    sizes = (words.end[spans].reshape(-1)) - at_doc
    same = sizes == (p.end[which].reshape(-1) - at_item)
    same[same] = same_bytes(T.LOWER[piece.data], at_doc[same], bench.data, at_item[same], sizes[same])
    good = same.reshape(-1, n).all(axis=1)
    return place[good], which[good]


def _search(column: pa.Array, before: pa.Array, bench: Benchmark) -> Iterator[pa.Array]:
    """The words, hits and items of each text, joined to those found ``before``."""
    for piece in T.slices(column):
        words = T.words(piece, T.LETTERS)
        hashes = T.word_hashes(piece, words)
        cover = np.zeros(len(hashes) + 1, dtype=np.int64)
        items: dict[int, set[str]] = {}
        for p in bench.classes:
            place, which = occurrences(piece, words, hashes, bench, p)
            np.add.at(cover, place - p.length + 1, 1)
            np.add.at(cover, place + 1, -1)
            rows = np.searchsorted(words.bounds, place, "right") - 1
            for row, pattern in set(zip(rows.tolist(), which.tolist(), strict=True)):
                items.setdefault(row, set()).update(p.items[pattern])
        past = before.slice(piece.first, piece.rows) if before is not None else None
        if past is not None:
            for row, value in enumerate(past.to_pylist()):
                if value["hits"]:
                    for span in value["hits"]:
                        cover[words.bounds[row] + span["start"]] += 1
                        cover[words.bounds[row] + span["end"]] -= 1
                if value["items"]:
                    items.setdefault(row, set()).update(value["items"])
        hit = np.cumsum(cover)[:-1] > 0
        edge = np.zeros(len(hit) + 1, dtype=bool)
        edge[words.bounds] = True
        start = np.flatnonzero(hit & (~np.concatenate([[False], hit[:-1]]) | edge[:-1]))
        end = np.flatnonzero(hit & (~np.concatenate([hit[1:], [False]]) | edge[1:])) + 1
        row = np.searchsorted(words.bounds, start, "right") - 1
        spans = pa.StructArray.from_arrays(
            [pa.array(start - words.bounds[row]), pa.array(end - words.bounds[row])], ["start", "end"]
        )
        bounds = np.searchsorted(start, words.bounds).astype(np.int32)
        listed = [sorted(items.get(i, ())) for i in range(piece.rows)]
        yield pa.StructArray.from_arrays(
            [
                pa.array(np.diff(words.bounds)),
                pa.ListArray.from_arrays(pa.array(bounds), spans),
                pa.array(listed, pa.list_(pa.string())),
            ],
            ["n_words", "hits", "items"],
        )


def _empty() -> pa.Array:
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    return pa.array([], pa.struct([("n_words", pa.int64()), ("hits", pa.list_(span)), ("items", pa.list_(pa.string()))]))


def _searched(text: Column, before: Column | None, shared) -> Column:
    def first(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in emptied(columns):
            yield pa.concat_arrays([*_search(column, None, shared.value)] or [_empty()])

    def later(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for column, past in emptied(columns):
            yield pa.concat_arrays([*_search(column, past, shared.value)] or [_empty()])

    if before is None:
        return F.arrow_udf(first, _FOUND).asNondeterministic()(text)
    return F.arrow_udf(later, _FOUND).asNondeterministic()(text, before)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``docs`` with what occurs of ``benchmark``; every row is kept.

    Adds ``n_words``, ``hits`` (spans of hit words, from 0), ``items`` (their ids as sorted strings), ``n_hit``,
    ``n_items``, ``items_sha256`` (of the ids, comma-joined) and ``contaminated`` (n_hit > 0 and
    20 * n_hit >= n_words). Null and empty texts have no words and no hits; items without words match
    nothing; items with a null id hit words but are not listed; repeated ids count once. Columns of these
    names are replaced.
    """
    items = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-size // part_bytes)
    found = None
    df = docs
    for k in range(parts):
        # About ``part_bytes``, whatever the benchmark.
        some = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == k).toArrow()
        bench = compile_patterns(some["id"].to_pylist(), some["text"], window)
        shared = docs.sparkSession.sparkContext.broadcast(bench)
        df = df.withColumn("__found", _searched(F.col(text).cast("string"), found, shared))
        found = F.col("__found")
    if found is None:
        shared = docs.sparkSession.sparkContext.broadcast(Benchmark(np.zeros(0, np.uint8), []))
        df = df.withColumn("__found", _searched(F.col(text).cast("string"), None, shared))
    df = df.withColumns({c: F.col(f"__found.{c}") for c in ("n_words", "hits", "items")})
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, x: n + x["end"] - x["start"])
    df = df.drop("__found").withColumns(
        {
            "n_hit": n_hit,
            "n_items": F.size("items").cast("bigint"),
            "items_sha256": F.sha2(F.array_join(F.array_sort("items"), ","), 256),
        }
    )
    return df.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
