"""Best-fit packing of documents into sequences of a fixed number of tokens.

The lengths of all pieces are a histogram of at most ``capacity`` numbers, whatever the corpus, and the
packing is decided on it: first Martello-Toth dominance fixes sets that no other choice can beat, then
best-fit decreasing packs the rest, many equal bins in one step. The result is a table of runs ("the
pieces of length s with ranks from r on go to these sequences at this offset"). Ranks of pieces within
their length need no sort: every task numbers its own, shifted by the counts of the tasks before it.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scrutin.llm.tables import kept
from scrutin.llm.tokens import encoder
from scrutin.llm.workers import emptied

CAPACITY = 4096
END_ID = 1
_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"


class Group(list):
    """``bins`` bins with the same content, as (size, copies) in order."""

    def __init__(self, bins: int, content=()):
        super().__init__(content)
        self.bins = bins


def dominant(left: dict[int, int], size: int, capacity: int) -> int | None:
    """The partner that an item of ``size`` may be fixed with: 0 for none, None if nothing is proven.

    ``left`` counts the items that are not packed, this one included. A pair is fixed if it fills the bin,
    if no two items fit beside the first, or if at most two do and their sum never exceeds the partner.
    """
    room = capacity - size
    others = sorted(s for s, n in left.items() if s <= room and n - (s == size) > 0)
    if not others:
        return 0
    partner = others[-1]
    if partner == room:
        return partner
    least = [s for s in others[:3] for _ in range(min(3, left[s] - (s == size)))][:3]
    if len(least) < 2 or least[0] + least[1] > room:
        return partner
    if len(least) == 3 and sum(least) <= room:
        return None
    best, i, j = 0, 0, len(others) - 1
    while i <= j:
        if others[i] + others[j] > room or i == j and left[others[i]] - (others[i] == size) < 2:
            j -= 1
        else:
            best, i = max(best, others[i] + others[j]), i + 1
    return partner if best <= partner else None


def reduce_instance(left: dict[int, int], capacity: int) -> list[Group]:
    """Fix dominant sets, taking their items out of ``left``, until no item has one."""
    fixed, changed = [], True
    while changed:
        changed = False
        for size in sorted(left, reverse=True):
            while left.get(size):
                partner = dominant(left, size, capacity)
                if partner is None:
                    break
                n = left[size]
                bins = n if not partner else n // 2 if partner == size else min(n, left[partner])
                fixed.append(Group(bins, [(size, 2)] if partner == size else [(size, 1)] + [(partner, 1)] * bool(partner)))
                for s in (size, partner) if partner else (size,):
                    left[s] -= bins
                    if not left[s]:
                        del left[s]
                changed = True
    return fixed


def best_fit(left: dict[int, int], capacity: int) -> list[Group]:
    """Best-fit decreasing: each item goes where it leaves least room. Equal bins are filled in one step."""
    open_bins: dict[int, list[Group]] = {}
    rooms: list[int] = []

    def put(group: Group, room: int) -> None:
        if room not in open_bins:
            open_bins[room] = []
            insort(rooms, room)
        open_bins[room].append(group)

    for size in sorted(left, reverse=True):
        n = left[size]
        while n:
            k = bisect_left(rooms, size)
            if k < len(rooms):
                room = rooms[k]
                group = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room]
                    rooms.pop(k)
            else:
                room, group = capacity, Group(n)
            each = room // size
            full = min(group.bins, n // each)
            if full:
                put(Group(full, [*group, (size, each)]), room - each * size)
            n -= full * each
            spare = group.bins - full
            if spare and n and full * each + n < group.bins * each:
                put(Group(1, [*group, (size, n)]), room - n * size)
                spare, n = spare - 1, 0
            if spare and group:
                put(Group(spare, group), room)
    return [g for groups in open_bins.values() for g in groups]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Runs sorted by (size, rank): ``key``, ``copies``, ``sequence``, ``offset``; and how many sequences."""
    left = {s: n for s, n in counts.items() if n}
    groups = reduce_instance(left, capacity)
    groups += best_fit(left, capacity)
    used: dict[int, int] = {}
    runs, sequence = [], 0
    for group in groups:
        offset = 0
        for size, copies in group:
            runs.append((size, used.get(size, 0), copies, sequence, offset))
            used[size] = used.get(size, 0) + copies * group.bins
            offset += size * copies
        sequence += group.bins
    runs.sort()
    column = lambda i: np.array([r[i] for r in runs], dtype=np.int64)
    return {"size": column(0), "rank": column(1), "copies": column(2), "sequence": column(3), "offset": column(4)}


_RANK_BITS = 48


def _place(batches: Iterator[pa.RecordBatch], runs: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    keys = (runs["size"] << _RANK_BITS) + runs["rank"]
    for batch in emptied(batches):
        length = batch.column("length").to_numpy()
        rank = batch.column("rank").to_numpy()
        at = np.searchsorted(keys, (length << _RANK_BITS) + rank, "right") - 1
        nth = rank - runs["rank"][at]
        sequence = runs["sequence"][at] + nth // runs["copies"][at]
        offset = runs["offset"][at] + nth % runs["copies"][at] * length
        kept_columns = batch.drop_columns(["rank"])
        yield kept_columns.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))


def pieces(docs: DataFrame, text: str, tokenizer: str, capacity: int, end_id: int, key: str) -> DataFrame:
    """One row per piece of a document; only documents above ``capacity`` are cut."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, seen, part = encoder(tokenizer), {}, TaskContext.get().partitionId()
        for batch in batches:
            rows = []
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = code.ids(value.as_py() or "") + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    piece = ids[at : at + 4 * capacity]
                    n = len(piece) // 4
                    seen[n] = seen.get(n, -1) + 1
                    rows.append((doc, k, at // 4, n, zlib.crc32(piece), part, seen[n]))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(types)
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return docs.select(F.col(key).cast("bigint"), F.col(text).cast("string")).mapInArrow(cut, _PIECES)


def pack(
    docs: DataFrame,
    text: str = "text",
    tokenizer: str = "word_bpe_49k.json",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    key: str = "doc_id",
) -> DataFrame:
    """Pieces of all documents with ``sequence_id`` and ``offset`` (no gaps, from 0), all long but ``piece``.

    Null and empty texts hold the end id alone. Every row of ``docs`` is packed, repeated ones and those
    with a null key too; other columns are not carried. No row gives no sequence.
    """
    cut = kept(pieces(docs, text, tokenizer, capacity, end_id, key), "pieces")
    counts = kept(cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    # At most ``capacity`` rows, whatever the corpus.
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = cut.join(base, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank")
    )
    runs = plan(totals, capacity)
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    shared = docs.sparkSession.sparkContext.broadcast(runs)
    return ranked.mapInArrow(lambda batches: _place(batches, shared.value), schema)
