"""Suffix-array dedup: bytes covered by strings of a fixed length that start at two places or more.

Strings that can be equal are brought together first, then compared by suffix arrays:

1. Every string of ``size`` bytes is named by the smallest hash among its 32-byte grams. Equal strings have
   equal names, and neighbouring strings mostly share one, so a text falls into runs of strings with one
   name: segments, a few hundred bytes each. Only names and digests of segments are shuffled.
2. Segments whose name occurs once, in one place, hold no repeated string. The others' distinct texts are dealt by name
   into shards of a bounded size. A name with very many distinct segments is split over several shards.
3. A shard sorts its suffixes by Larsson-Sadakane refinement (only groups that are not sorted yet are sorted
   again, by ranks at doubled distance) and takes common prefixes by Kasai's rule, in lanes. Neighbours with
   ``size`` bytes in common are repeats. The shards of a split name are merged by sorted runs of their
   strings' hashes: a range of hashes sees all runs and tells which hashes several shards have, and each shard finds
   its own strings among those by binary search. Bytes are not compared across shards. So a name costs in
   proportion to its segments, however many.
4. The spans go back to all places with the same segment.

Equal segments of one task are combined before they are shuffled, and equal texts are one text, all of which
is repeated. Texts and segments are taken for equal when 64-bit hashes are.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrutin.llm import text as T
from scrutin.llm.tables import kept, partitions
from scrutin.llm.workers import emptied

SIZE = 200
GRAM = 32
#: Strings of one name in a row that make up a segment at most.
RUN = 8192
#: Bytes of a shard, and distinct segments of one name in one shard.
SHARD_BYTES = 1 << 20
NAME_SEGMENTS = 4096
SEEN_TEXTS = 1_000_000
LANE = 64
_FRAGMENT_BYTES = 24 << 20


class Segments(NamedTuple):
    row: np.ndarray
    start: np.ndarray  # within the text
    length: np.ndarray
    name: np.ndarray
    digest: np.ndarray
    #: Whether one string may start at two places within the segment.
    loops: np.ndarray


def least_of(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    low, have = x, 1
    while 2 * have <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    return np.minimum(low[: len(low) - (width - have)], low[width - have :]) if width > have else low


def segments(piece: T.Slice, size: int = SIZE) -> Segments:
    """The segments of all texts of a slice; texts below ``size`` bytes have none."""
    gram = min(GRAM, size)
    n = len(piece.data)
    lengths = np.diff(piece.offsets)
    counts = np.maximum(0, lengths - size + 1)
    if not counts.sum():
        none = np.zeros(0, np.int64)
        return Segments(none, none, none, none.astype(T.U64), none.astype(T.U64), none.astype(bool))
    total = T.sums(piece.data)
    at = np.arange(n - gram + 1)
    grams = T.span_hash(total, at, at + gram)
    names = least_of(grams, size - gram + 1)
    row = np.repeat(np.arange(piece.rows), counts)
    first = np.cumsum(counts) - counts
    place = np.arange(len(row)) - first[row] + piece.offsets[:-1][row]
    name = names[place]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (name[1:] != name[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(new)
    run = np.diff(np.append(begin, len(row)))
    if run.max() > RUN:
        parts = -(-run // RUN)
        inner = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = np.repeat(begin, parts) + inner * RUN
        run = np.diff(np.append(begin, len(row)))
    start = place[begin]
    end = start + run - 1 + size
    digest = T.span_hash(total, start, end)
    # If equal strings start at p and q = p + d of a segment, its naming gram lies at two places. Either two
    # of its places are first (or last) grams of strings, or one is first and another is last.
    reach = size - gram
    first_is = grams[place] == name
    last_is = grams[place + reach] == name
    n_first, n_last = np.add.reduceat(first_is.astype(np.int64), begin), np.add.reduceat(last_is.astype(np.int64), begin)
    at_first, at_last = np.add.reduceat(first_is * place, begin), np.add.reduceat(last_is * (place + reach), begin)
    one = (n_first == 1) & (n_last == 1) & (at_first == at_last)
    loops = (n_first + n_last > 1) & ~one
    return Segments(row[begin], start - piece.offsets[:-1][row[begin]], end - start, name[begin], digest, loops)


class Shard:
    """A suffix array over some segments, each followed by an end of its own."""

    def __init__(self, texts: list[bytes], size: int = SIZE):
        self.size = size
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.start = np.cumsum(lengths + 1) - lengths - 1
        self.data = np.frombuffer(b"\0".join(texts) + b"\0" * 17, np.uint8)
        self.n = int((lengths + 1).sum())
        self.owner = np.repeat(np.arange(len(texts), dtype=np.int32), lengths + 1)
        #: Bytes from each place to the end of its segment.
        self.left = (self.start + lengths)[self.owner] - np.arange(self.n)
        self.words = np.lib.stride_tricks.sliding_window_view(self.data, 8)[: self.n + 8].copy().view(np.uint64).reshape(-1)
        self.order = self._sorted()

    def _sorted(self) -> np.ndarray:
        """Larsson-Sadakane: places in the order of their suffixes."""
        # Seven bytes and how many of them lie in the segment, in one number that sorts like the bytes.
        depth = 7
        whole = np.minimum(self.left, depth)
        key = self.words[: self.n].byteswap()
        gone = (np.uint64(8) * (np.uint64(8) - whole.astype(np.uint64))).astype(np.uint64)
        key = np.where(whole > 0, (key >> np.minimum(gone, np.uint64(63))) << np.minimum(gone, np.uint64(63)), np.uint64(0))
        key |= whole.astype(np.uint64)
        order = np.argsort(key)
        rank = np.zeros(self.n + 1, dtype=np.int64)
        slots = np.arange(self.n)
        slots = self._ranked(order, rank, slots, key[order])
        # Suffixes that end within the first bytes differ by their segments' ends.
        done = self.left[order[slots]] < depth
        short = slots[done]
        second = self.owner[order[short]]
        self._refined(order, rank, short, second)
        slots = slots[~done]
        while len(slots):
            slots = self._refined(order, rank, slots, rank[order[slots] + depth])
            depth *= 2
        return order

    def _refined(self, order: np.ndarray, rank: np.ndarray, slots: np.ndarray, second: np.ndarray) -> np.ndarray:
        key = (rank[order[slots]] << 32) + second
        by = np.argsort(key)
        order[slots] = order[slots[by]]
        return self._ranked(order, rank, slots, key[by])

    @staticmethod
    def _ranked(order: np.ndarray, rank: np.ndarray, slots: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Give equal keys the number of their first slot; returns the slots of groups of two and more."""
        if not len(slots):
            return slots
        new = np.ones(len(slots), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        heads = np.flatnonzero(new)
        sizes = np.diff(np.append(heads, len(slots)))
        rank[order[slots]] = np.repeat(slots[heads], sizes)
        return slots[np.repeat(sizes > 1, sizes)]

    def common(self, a: np.ndarray, b: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Bytes that the suffixes at ``a`` and ``b`` share, up to ``size``; ``known`` are."""
        most = np.minimum(np.minimum(self.left[a], self.left[b]), self.size)
        found = np.minimum(known, most)
        live = np.flatnonzero(found < most)
        while len(live):
            at = found[live]
            x = self.words[a[live] + at] ^ self.words[b[live] + at]
            low = np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)).astype(np.int64) >> 3
            found[live] = np.minimum(at + np.where(x == 0, 8, low), most[live])
            live = live[(x == 0) & (found[live] < most[live])]
        return found

    def prefixes(self) -> np.ndarray:
        """Kasai: what each suffix shares with the one before it, by place, in text order within lanes."""
        before = np.full(self.n, -1, dtype=np.int64)
        before[self.order[1:]] = self.order[:-1]
        out = np.zeros(self.n, dtype=np.int64)
        lanes = np.arange(0, self.n, LANE)
        held = np.zeros(len(lanes), dtype=np.int64)
        for step in range(min(LANE, self.n)):
            at = lanes + step
            at = at[at < self.n]
            held = np.maximum(held[: len(at)] - 1, 0)
            real = before[at] >= 0
            held[~real] = 0
            held[real] = self.common(at[real], before[at[real]], held[real])
            out[at] = held
        return out

    def repeated(self) -> np.ndarray:
        """Places at which a string starts that starts elsewhere in the shard too."""
        shared = self.prefixes()[self.order] >= self.size
        out = np.zeros(self.n, dtype=bool)
        out[self.order[shared]] = True
        out[self.order[:-1][shared[1:]]] = True
        return out

    def starts(self) -> np.ndarray:
        return np.flatnonzero(self.left >= self.size)


def _spans(shard: Shard, repeated: np.ndarray, whole: np.ndarray) -> list[list[tuple[int, int]]]:
    """Per segment the spans of its repeated strings; ``whole`` marks segments that occur twice."""
    strings = shard.left >= shard.size
    marked = (repeated | whole[shard.owner]) & strings
    edge = np.diff(np.concatenate([[False], marked, [False]]).astype(np.int8))
    # A place that starts no string lies between two segments, so no run spans two.
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    out: list[list[tuple[int, int]]] = [[] for _ in shard.start]
    for a, b in zip(begin.tolist(), end.tolist(), strict=True):
        k = int(shard.owner[a])
        base = int(shard.start[k])
        out[k].append((a - base, b - 1 - base + shard.size))
    return out


_PLACES = "frag bigint, names binary, digests binary, texts binary, starts binary, lengths binary, weights binary, loops binary"
_SPAN = "array<struct<s: bigint, e: bigint>>"


def _dealt(found: dict[str, np.ndarray]) -> pa.RecordBatch:
    order = np.argsort(found["frag"], kind="stable")
    frags, cuts = np.unique(found["frag"][order], return_index=True)
    cuts = [*cuts.tolist(), len(order)]
    cells = {k: v[order] for k, v in found.items() if k != "frag"}
    pieces = {k: pa.array([v[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()) for k, v in cells.items()}  # noqa: B905
    return pa.RecordBatch.from_arrays([pa.array(frags.astype(np.int64)), *pieces.values()], names=["frag", *pieces])


def _places(rows: DataFrame, size: int, fragments: int) -> DataFrame:
    """Places of segments in blobs by fragment. Equal segments of a task's slice are one place with its weight.

    The further places of such a segment are known to be repeated; they pass through fragments of their own,
    dealt by text, with weight 0.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in emptied(batches):
            names = batch.column(1).to_numpy()
            for piece in T.slices(batch.column(0)):
                fresh = np.zeros(piece.rows, dtype=bool)
                for k, name in enumerate(names[piece.first : piece.first + piece.rows].tolist()):
                    if name not in seen:
                        seen.add(name)
                        fresh[k] = True
                if len(seen) > SEEN_TEXTS:
                    seen.clear()
                s = segments(piece, size)
                some = fresh[s.row]
                s = Segments(*[x[some] for x in s])
                if not len(s.row):
                    continue
                text = names[piece.first + s.row]
                _, first, where, counts = np.unique(s.digest, return_index=True, return_inverse=True, return_counts=True)
                weight = np.zeros(len(s.row), dtype=np.int64)
                weight[first] = counts
                frag = ((s.name >> T.U64(32)) % T.U64(fragments)).astype(np.int64)
                frag = np.where(weight > 0, frag, fragments + text.view(T.U64).astype(np.uint64) % T.U64(fragments))
                yield _dealt(
                    {
                        "frag": frag.astype(np.int64), "names": s.name, "digests": s.digest, "texts": text,
                        "starts": s.start.astype(np.int64), "lengths": s.length.astype(np.int64), "weights": weight, "loops": s.loops.astype(np.int64),
                    }
                )

    return rows.select("text", "name").mapInArrow(find, _PLACES)


def _repeated_names(fragments: int):
    """Places whose name occurs again; of each distinct segment, one is the ``model`` whose text is compared."""

    def run(table: pa.Table) -> pa.Table:
        whole = lambda c, t=np.int64: np.frombuffer(b"".join(table[c].to_pylist()), t)
        frag = table["frag"][0].as_py()
        names, digests, texts = whole("names"), whole("digests"), whole("texts")
        starts, lengths, weights, loops = whole("starts"), whole("lengths"), whole("weights"), whole("loops")
        model = np.zeros(len(names), dtype=bool)
        if frag < fragments:
            order = np.lexsort((starts, texts, digests, names))
            names, digests, texts, starts = names[order], digests[order], texts[order], starts[order]
            lengths, weights, loops = lengths[order], weights[order], loops[order]
            _, where = np.unique(names, return_inverse=True)
            again = np.bincount(where, weights=weights + loops)[where] > 1
            model[:] = True
            model[1:] = (names[1:] != names[:-1]) | (digests[1:] != digests[:-1])
            heads = np.flatnonzero(model)
            weights = np.where(model, np.repeat(np.add.reduceat(weights, heads), np.diff(np.append(heads, len(names)))), 0)
        else:
            again = np.ones(len(names), dtype=bool)
        columns = {"name": names, "digest": digests, "text": texts, "start": starts, "length": lengths, "weight": weights, "model": model}
        return pa.table({k: v[again] for k, v in columns.items()})

    return run


_KIND = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))


def _found_spans(table: pa.Table, shard: Shard, repeated: np.ndarray) -> pa.Table:
    """Spans of the repeated strings of a shard's segments, as far as there are any."""
    spans = _spans(shard, repeated, table["weight"].to_numpy() > 1)
    some = pa.array([k for k, x in enumerate(spans) if x], pa.int64())
    cells = [[{"s": a, "e": b} for a, b in x] for x in spans if x]
    return pa.table({"name": table["name"].take(some), "digest": table["digest"].take(some), "spans": pa.array(cells, _KIND)})


def _compare(size: int):
    def run(table: pa.Table) -> pa.Table:
        shard = Shard(table["bytes"].to_pylist(), size)
        return _found_spans(table, shard, shard.repeated())

    return run


def string_hashes(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all strings of some segments, and their places in a shard of these segments."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    counts = lengths - size + 1
    data = np.frombuffer(b"\0".join(texts), np.uint8)
    start = np.cumsum(lengths + 1) - lengths - 1
    at = np.arange(counts.sum()) + np.repeat(start - (np.cumsum(counts) - counts), counts)
    return T.span_hash(T.sums(data), at, at + size), at


_RUNS = "range int, shard bigint, hashes binary"


def _runs(size: int, ranges: int):
    """A shard's distinct strings as sorted runs of hashes, one for each range."""

    def run(table: pa.Table) -> pa.Table:
        hashes = np.unique(string_hashes(table["bytes"].to_pylist(), size)[0])
        of = ((hashes >> T.U64(40)) * T.U64(ranges) >> T.U64(24)).astype(np.int64)
        cuts = np.searchsorted(of, np.arange(ranges + 1))
        some = np.flatnonzero(np.diff(cuts)).tolist()
        cells = [hashes[cuts[r] : cuts[r + 1]].tobytes() for r in some]
        return pa.table({"range": pa.array(some, pa.int32()), "shard": [table["shard"][0].as_py()] * len(some), "hashes": pa.array(cells, pa.binary())})

    return run


def _merge(table: pa.Table) -> pa.Table:
    """Per shard, which hashes of its run other shards have too."""
    runs = [np.frombuffer(x, T.U64) for x in table["hashes"].to_pylist()]
    every, counts = np.unique(np.concatenate(runs), return_counts=True)
    shared = every[counts > 1]
    found = []
    for run in runs:
        at = np.searchsorted(run, shared)
        at = np.minimum(at, len(run) - 1)
        found.append(shared[run[at] == shared].tobytes())
    return pa.table({"shard": table["shard"], "found": pa.array(found, pa.binary())})


def _compare_split(size: int):
    def run(key, table: pa.Table, merged: pa.Table) -> pa.Table:
        texts = table["bytes"].to_pylist()
        shard = Shard(texts, size)
        repeated = shard.repeated()
        elsewhere = np.sort(np.frombuffer(b"".join(merged["found"].to_pylist()), T.U64))
        hashes, at = string_hashes(texts, size)
        if len(elsewhere):
            k = np.minimum(np.searchsorted(elsewhere, hashes), len(elsewhere) - 1)
            repeated[at[elsewhere[k] == hashes]] = True
        return _found_spans(table, shard, repeated)

    return run


def _texts_of(models: DataFrame, rows: DataFrame, texts: DataFrame) -> DataFrame:
    """``models`` with the ``bytes`` of their segments."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in emptied(batches):
            for value, wanted, of in zip(batch.column("text"), batch.column("wanted"), batch.column("of").to_pylist(), strict=True):
                # Rows with one id and text meet in one task, or in as many as read them; one of them is enough.
                if of in seen:
                    continue
                if len(seen) >= SEEN_TEXTS:
                    seen.clear()
                seen.add(of)
                data = value.as_py().encode()
                w = wanted.values
                starts, lengths = w.field("start").to_pylist(), w.field("length").to_pylist()
                cells = pa.array([data[a : a + n] for a, n in zip(starts, lengths, strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [w.field("name"), w.field("digest"), w.field("weight"), cells], names=["name", "digest", "weight", "bytes"]
                )

    wanted = models.groupBy(F.col("text").alias("of")).agg(F.collect_list(F.struct("name", "digest", "weight", "start", "length")).alias("wanted"))
    placed = wanted.join(texts.select("name", "id"), F.col("of") == F.col("name")).select("id", "of", "wanted")
    both = rows.join(placed, (rows["id"].eqNullSafe(placed["id"])) & (F.col("name") == F.col("of"))).select("text", "wanted", "of")
    return both.mapInArrow(cut, "name bigint, digest bigint, weight bigint, bytes binary")


def repeats(rows: DataFrame, size: int) -> DataFrame:
    """``name`` of a text, and the ``cuts`` (spans of repeated strings) in it. ``rows``: id, text, name."""
    spark = rows.sparkSession
    counted = kept(
        rows.groupBy("name").agg(F.count(F.lit(1)).alias("copies"), F.first(F.octet_length("text")).alias("n"), F.min("id").alias("id")),
        "suffix-texts",
    )
    total = counted.agg(F.sum("n")).first()[0] or 0
    fragments = max(partitions(spark), int(total // _FRAGMENT_BYTES) + 1)
    shape = "name bigint, digest bigint, text bigint, start bigint, length bigint, weight bigint, model boolean"
    places = kept(_places(rows, size, fragments).groupBy("frag").applyInArrow(_repeated_names(fragments), shape), "suffix-places")
    models = places.filter("model")
    volume = models.agg(F.sum("length")).first()[0] or 0
    shards = max(partitions(spark), int(volume // SHARD_BYTES) + 1)
    crowded = models.groupBy("name").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > NAME_SEGMENTS)
    crowded = crowded.select("name", F.ceil(F.col("m") / NAME_SEGMENTS).cast("int").alias("parts"))
    compared = _texts_of(models, rows, counted).join(crowded, "name", "left")
    part = F.pmod(F.xxhash64("digest"), F.col("parts"))
    shard = F.when(F.col("parts").isNull(), F.pmod(F.xxhash64("name"), F.lit(shards)).cast("bigint")).otherwise(F.xxhash64("name", part))
    compared = compared.select(shard.alias("shard"), "name", "digest", "weight", "bytes", F.col("parts").isNotNull().alias("split"))
    compared = kept(compared, "suffix-segments")
    shape = f"name bigint, digest bigint, spans {_SPAN}"
    whole, split = compared.filter("not split"), compared.filter("split")
    runs = split.groupBy("shard").applyInArrow(_runs(size, partitions(spark)), _RUNS)
    merged = runs.groupBy("range").applyInArrow(_merge, "shard bigint, found binary")
    across = split.groupBy("shard").cogroup(merged.groupBy("shard")).applyInArrow(_compare_split(size), shape)
    spans = kept(whole.groupBy("shard").applyInArrow(_compare(size), shape).union(across), "suffix-spans")
    marked = places.join(spans, ["name", "digest"]).select(
        F.col("text").alias("name"),
        F.transform("spans", lambda x: F.struct((x["s"] + F.col("start")).alias("s"), (x["e"] + F.col("start")).alias("e"))).alias("cuts"),
    )
    copied = counted.filter((F.col("copies") > 1) & (F.col("n") >= size))
    copied = copied.select("name", F.array(F.struct(F.lit(0).cast("bigint").alias("s"), F.col("n").cast("bigint").alias("e"))).alias("cuts"))
    cuts = marked.union(copied).groupBy("name").agg(F.flatten(F.collect_set("cuts")).alias("cuts"))
    return kept(cuts, "suffix-cuts")


def _kept_bytes(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, cuts in emptied(columns):
        left, removed, runs, texts_left = [], [], [], []
        for value, spans in zip(texts, cuts, strict=True):
            data = (value.as_py() or "").encode()
            if not spans.is_valid or not len(spans.values):
                left.append(data)
                removed.append(0)
                runs.append(0)
                texts_left.append(None)
                continue
            s, e = spans.values.field("s").to_numpy(), spans.values.field("e").to_numpy()
            order = np.argsort(s, kind="stable")
            s, e = s[order], np.maximum.accumulate(e[order])
            new = np.concatenate([[True], s[1:] > e[:-1]])
            begin, end = s[new], e[np.append(np.flatnonzero(new)[1:] - 1, len(e) - 1)]
            outs = zip([0, *end.tolist()], [*begin.tolist(), len(data)], strict=True)
            left.append(b"".join(data[a:b] for a, b in outs))
            # The input is UTF-8, so only characters that a removal cut are left out here.
            texts_left.append(left[-1].decode(errors="ignore"))
            removed.append(int((end - begin).sum()))
            runs.append(len(begin))
        columns = [pa.array(left, pa.binary()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(texts_left, pa.string())]
        yield pa.StructArray.from_arrays(columns, ["kept", "n_removed", "n_spans", "kept_text"])


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = SIZE) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``n_spans`` (long), ``kept_bytes`` (binary) and ``kept_text`` (string).

    Every byte that lies in a string of ``size`` bytes which starts at two places or more, in one text or in
    two, is removed; strings are judged on the input. Null and empty texts keep nothing and lose nothing.
    Rows are all kept; repeated rows are copies of each other and so lose everything from ``size`` bytes on.
    Removal may cut a character, so ``kept_bytes`` is not always UTF-8; ``kept_text`` leaves out what is cut in part,
    and is null where nothing was removed. Columns of these names are replaced.
    """
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).cast("bigint").alias("id"), value.alias("text")).withColumn("name", F.xxhash64("text"))
    cuts = repeats(rows, size).withColumnRenamed("name", "__name").withColumnRenamed("cuts", "__cuts")
    joined = docs.withColumn("__text", value).withColumn("__name", F.xxhash64("__text")).join(cuts, "__name", "left")
    run = F.arrow_udf(_kept_bytes, "struct<kept: binary, n_removed: bigint, n_spans: bigint, kept_text: string>").asNondeterministic()
    found = joined.withColumn("__found", run("__text", "__cuts")).withColumns(
        {
            "n_bytes": F.octet_length("__text").cast("bigint"),
            "n_removed": F.col("__found.n_removed"),
            "n_spans": F.col("__found.n_spans"),
            "kept_bytes": F.col("__found.kept"),
            "kept_text": F.col("__found.kept_text"),
        }
    )
    return found.drop("__text", "__name", "__cuts", "__found")
