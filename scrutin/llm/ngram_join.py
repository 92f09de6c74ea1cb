"""N-gram Jaccard join by vertical partitioning.

The global order of n-grams is cut into fragments; a text's set falls into segments, and what two or more
texts share is counted in every fragment by itself and then summed: per text, to drop all texts of which
too little occurs elsewhere, and per pair, to verify candidates. The steps:

1. Equal sets are one node. A node's name is a 64-bit hash of its set; only names are shuffled.
2. Fragments of hashes count, per node, the n-grams that another node has, and the counts are summed by ranges of
   nodes. A node of which less than the threshold is shared can have no link. Most of a corpus ends here. N-grams
   that several nodes of a task have are counted there; of each, a fragment gets one entry per task, without a
   node, so a very frequent n-gram makes no fragment larger.
3. The rest gets the exact order (frequency, hash). Two sets that link share an n-gram among the first
   ``n - ceil(t * n) + 1`` of each (prefix filter), so such n-grams are the candidate lists.
4. Every node of a list is paired with the list's most central node, which joins most large groups with as
   many pairs as members. Lists that still span several components are compared node by node, in blocks
   of a bounded size, by parity sketches: the bits in which two sketches differ never exceed the symmetric
   difference of the sets, so no link is lost, and pairs within one component are left out.
5. Pairs are verified by the sums of their overlaps in all fragments, and links give components.

Texts, sets and n-grams are told apart by 64-bit hashes: two given ones share a name with a probability of 2**-64, and
no way of building texts is known that makes it higher.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrutin.llm import text as T
from scrutin.llm.tables import components, kept, partitions, to_one
from scrutin.llm.workers import emptied

#: N-grams of a fragment in the first pass, about. More than that only slows a task down.
FRAGMENT_ITEMS = 2_000_000
#: N-grams that a task counts among themselves before it deals them; some ten arrays of their length are held.
DEALT_ITEMS = 500_000
#: N-grams of a fragment when those that remain are counted.
LEFT_ITEMS = 1_000_000
#: Nodes of a range for which the counts of all fragments are summed in one task.
RANGE_NODES = 8192
#: Ids of at most so many remaining texts are broadcast (24 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Fragments of the sets that are verified.
SEGMENTS = 4
#: Nodes of a candidate list that are compared in one block.
BLOCK = 2048
#: Names of sets that a task remembers to leave out copies.
SEEN_SETS = 1_000_000


def sets_of(piece: T.Slice, n: int) -> list[np.ndarray]:
    """The distinct n-gram names of each text, sorted; texts of fewer words are one n-gram."""
    words = T.words(piece)
    hashes = T.word_hashes(piece, words)
    grams = T.chain(hashes, n)
    out = []
    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True):
        if b - a < n:
            out.append(T.chain(hashes[a:b], b - a) if b > a else np.zeros(0, T.U64))
            continue
        found = np.sort(grams[a : b - n + 1])
        out.append(found[np.concatenate([[True], found[1:] != found[:-1]])])
    return out


def name_of(items: np.ndarray) -> int:
    """A set's 64-bit name."""
    total = T.mix(items ^ T.U64(0x5851F42D4C957F2D)).sum(dtype=T.U64) + T.U64(len(items))
    return int(T.mix(np.array([total]))[0].astype(np.int64))


def needed(n: int, percent: int) -> int:
    """The least overlap of a set of ``n`` with any set that it links to."""
    return -(-percent * n // 100)


def _named(n: int):
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in emptied(columns):
            found = [s for p in T.slices(column) for s in sets_of(p, n)]
            sizes = pa.array([len(s) for s in found], pa.int64())
            names = pa.array([name_of(s) if len(s) else None for s in found], pa.int64())
            yield pa.StructArray.from_arrays([sizes, names], ["n", "node"])

    return F.arrow_udf(run, "struct<n: bigint, node: bigint>").asNondeterministic()


_DEALT = "frag int, nodes binary, sizes binary, counts binary, items binary"


def _by_range(nodes: np.ndarray, sizes: np.ndarray, counts: np.ndarray, ranges: int) -> list[tuple[int, bytes, bytes, bytes]]:
    """Counts of nodes as one row per range of nodes."""
    of = (T.mix(nodes.view(T.U64)) % T.U64(ranges)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    cuts = np.searchsorted(of[order], np.arange(ranges + 1))
    cells = [(x[order], t) for x, t in ((nodes, np.int64), (sizes, np.int32), (counts, np.int32))]
    return [(r, *[x[cuts[r] : cuts[r + 1]].astype(t).tobytes() for x, t in cells]) for r in np.flatnonzero(np.diff(cuts)).tolist()]


def _deal_counts(rows: list[tuple[int, np.ndarray]], fragments: int, ranges: int) -> pa.RecordBatch:
    """As ``_deal``, but for n-grams of several nodes, which are counted here: rows with ``frag`` -1 - range."""
    nodes = np.array([r[0] for r in rows], dtype=np.int64)
    sizes = np.array([len(r[1]) for r in rows], dtype=np.int64)
    items, owner = np.concatenate([r[1] for r in rows]), np.repeat(np.arange(len(rows)), sizes)
    order = np.argsort(items)
    items, owner = items[order], owner[order]
    new = np.ones(len(items), dtype=bool)
    new[1:] = items[1:] != items[:-1]
    alone = new & np.append(new[1:], True)
    counts = np.bincount(owner[~alone], minlength=len(rows))
    some = counts > 0
    known = [(-1 - r, n, s, c, b"") for r, n, s, c in _by_range(nodes[some], sizes[some], counts[some], ranges)]
    # An entry of a node nobody has stands for those that are counted.
    stand_in = items[new & ~alone]
    mine = [items[alone][np.argsort(owner[alone], kind="stable")], stand_in]
    ends = np.bincount(owner[alone], minlength=len(rows))
    dealt = _cut(
        np.append(nodes, 0), np.append(sizes, 0), np.append(ends, len(stand_in)), np.concatenate(mine), fragments, True
    )
    return _batch(dealt + known)


def _deal(rows: list[tuple[int, np.ndarray]], fragments: int, low_only: bool) -> pa.RecordBatch:
    """Segments of sets by fragment. ``low_only``: the lower halves of names, enough within a fragment."""
    nodes = np.array([r[0] for r in rows], dtype=np.int64)
    sizes = np.array([len(r[1]) for r in rows], dtype=np.int64)
    items = np.concatenate([r[1] for r in rows]) if rows else np.zeros(0, T.U64)
    return _batch(_cut(nodes, sizes, sizes, items, fragments, low_only))


def _cut(nodes: np.ndarray, sizes: np.ndarray, held: np.ndarray, items: np.ndarray, fragments: int, low_only: bool) -> list[tuple]:
    """Rows of a fragment each; ``held``: how many of the items each node has."""
    frag = ((items >> T.U64(32)) % T.U64(fragments)).astype(np.int64)
    owner = np.repeat(np.arange(len(nodes)), held)
    order = np.argsort(frag, kind="stable")
    frag, owner, items = frag[order], owner[order], items[order]
    cuts = np.searchsorted(frag, np.arange(fragments + 1))
    out = []
    for f in np.flatnonzero(np.diff(cuts)).tolist():
        mine, some = owner[cuts[f] : cuts[f + 1]], items[cuts[f] : cuts[f + 1]]
        who, counts = np.unique(mine, return_counts=True)
        some = (some & T.U64(0xFFFFFFFF)).astype(np.uint32) if low_only else some
        out.append((f, nodes[who].tobytes(), sizes[who].astype(np.int32).tobytes(), counts.astype(np.int32).tobytes(), some.tobytes()))
    return out


def _batch(out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out, strict=True)) if out else [[]] * 5
    types = [pa.int32()] + [pa.binary()] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["frag", "nodes", "sizes", "counts", "items"]
    )


def _joined(table: pa.Table, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All segments of a fragment: nodes, sizes of their sets, the owner of each item, items."""
    whole = lambda c, t: np.frombuffer(b"".join(table[c].to_pylist()), t)
    counts = whole("counts", np.int32)
    return whole("nodes", np.int64), whole("sizes", np.int32), np.repeat(np.arange(len(counts)), counts), whole("items", kind)


def _frequencies(items: np.ndarray) -> np.ndarray:
    _, where, counts = np.unique(items, return_inverse=True, return_counts=True)
    return counts[where]


_COUNTED = "range int, nodes binary, sizes binary, counts binary"


def _shared_counts(ranges: int):
    """How many items of the fragment another node has, by node and packed by range of nodes."""

    def run(table: pa.Table) -> pa.Table:
        frag = table["frag"][0].as_py()
        if frag < 0:
            cells = {c: table[c] for c in ("nodes", "sizes", "counts")}
            return pa.table({"range": pa.array([-1 - frag] * len(table), pa.int32()), **cells})
        nodes, sizes, owner, items = _joined(table, np.uint32)
        shared = np.bincount(owner[_frequencies(items) > 1], minlength=len(nodes))
        some = (shared > 0) & (sizes > 0)
        rows = _by_range(nodes[some], sizes[some], shared[some], ranges)
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
        types = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.table({c: pa.array(v, t) for c, v, t in zip(("range", "nodes", "sizes", "counts"), columns, types, strict=True)})

    return run


def _able(percent: int):
    """Nodes of a range that share as much as a link takes."""

    def run(table: pa.Table) -> pa.Table:
        nodes, sizes, counts = (
            np.frombuffer(b"".join(table[c].to_pylist()), t) for c, t in (("nodes", np.int64), ("sizes", np.int32), ("counts", np.int32))
        )
        nodes, first, where = np.unique(nodes, return_index=True, return_inverse=True)
        total = np.bincount(where, weights=counts, minlength=len(nodes))
        enough = 100 * total >= percent * sizes[first].astype(np.int64)
        return pa.table({"node": nodes[enough]})

    return run


def _shared_items(table: pa.Table) -> pa.Table:
    """Per node, the items of the fragment that another node has, with their frequencies."""
    nodes, sizes, owner, items = _joined(table, T.U64)
    df = _frequencies(items)
    many = np.flatnonzero(df > 1)
    # A node's segments of a fragment are one row.
    nodes, first, of = np.unique(nodes, return_index=True, return_inverse=True)
    sizes, owner = sizes[first], of[owner]
    many = many[np.argsort(owner[many], kind="stable")]
    owner, items, df = owner[many], items[many], df[many].astype(np.int64)
    cuts = np.searchsorted(owner, np.arange(len(nodes) + 1))
    rows = np.flatnonzero(np.diff(cuts)).tolist()
    pick = lambda x: [x[cuts[k] : cuts[k + 1]].tobytes() for k in rows]
    return pa.table(
        {
            "node": pa.array(nodes[rows], pa.int64()),
            "n": pa.array(sizes[rows].astype(np.int64)),
            "items": pa.array(pick(items), pa.binary()),
            "df": pa.array(pick(df), pa.binary()),
        }
    )


def sketch(items: np.ndarray) -> bytes:
    """Parities of the numbers of items in 1024 buckets, more for sets of over 512."""
    bits = max(1024, 1 << int(2 * len(items) - 1).bit_length())
    odd = np.bincount((items >> T.U64(7)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _close(a: pa.Table, b: pa.Table, same: bool, percent: int) -> Iterator[tuple[int, int]]:
    """Pairs of different components whose sketches leave a link possible."""
    read = lambda t: (t["node"].to_numpy(), t["n"].to_numpy(), t["root"].to_numpy(), t["sketch"].to_pylist())
    nodes_a, sizes_a, roots_a, sketches_a = read(a)
    nodes_b, sizes_b, roots_b, sketches_b = read(b)
    by_bits: dict[int, np.ndarray] = {}
    for bits in {len(s) for s in sketches_b}:
        by_bits[bits] = np.array([k for k, s in enumerate(sketches_b) if len(s) == bits])
    matrix = {bits: np.stack([np.frombuffer(sketches_b[k], T.U64) for k in rows]) for bits, rows in by_bits.items()}

    def fold(x: np.ndarray, words: int) -> np.ndarray:
        while x.shape[-1] > words:
            x = x[..., : x.shape[-1] // 2] ^ x[..., x.shape[-1] // 2 :]
        return x

    for i in range(len(nodes_a)):
        mine = np.frombuffer(sketches_a[i], T.U64)
        for bits, rows in by_bits.items():
            ok = (roots_b[rows] != roots_a[i]) & (100 * np.minimum(sizes_b[rows], sizes_a[i]) >= percent * np.maximum(sizes_b[rows], sizes_a[i]))
            if same:
                ok &= rows > i
            picked = np.flatnonzero(ok)
            if not len(picked):
                continue
            words = min(len(mine), bits // 8)
            apart = np.bitwise_count(fold(matrix[bits][picked], words) ^ fold(mine, words)).sum(axis=1)
            total = sizes_b[rows[picked]] + sizes_a[i]
            least = -(-percent * total // (100 + percent))
            for k in rows[picked[apart <= total - 2 * least]].tolist():
                yield int(nodes_a[i]), int(nodes_b[k])


def jaccard_groups(
    docs: DataFrame, n: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``doc_id``, ``n_shingles`` (size of the text's set) and ``component_id``, one row per row of ``docs``.

    Words are parted by ASCII white space, A-Z count as lower case, and a text's set holds its distinct
    n-grams, or all its words as one if there are fewer. Two texts link when 100 * intersection >=
    percent * union; ``component_id`` is the smallest id that is reachable. Null and empty texts have no set
    and are linked with nothing: their component is themselves. Equal texts link at any length. Rows with
    one id may hold different texts; each row follows its own text. A text whose rows all have a null id links and
    joins others as any text does, but a null id is never a component, unless no other is reachable. ``key``
    must be an integer, or text that reads as one.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent must be in 1..100")
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    named = rows.withColumn("s", _named(n)("text")).select("doc_id", "hash", F.col("s.n").alias("n"), F.col("s.node").alias("node"))
    named = kept(named, "ngram-names")
    links = _links(rows, named, n, percent)
    roots = components(links, "ngram-components")
    nodes = named.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    rooted = nodes.join(roots, "node", "left").select("node", "doc_id", F.coalesce("root", "node").alias("root"))
    rooted = kept(rooted, "ngram-roots")
    least = kept(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")), "ngram-least")
    placed = kept(to_one(rooted, least, "root").select("node", "component_id"), "ngram-placed")
    return to_one(named, placed, "node").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def _links(rows: DataFrame, named: DataFrame, n: int, percent: int) -> DataFrame:
    """Links between nodes, enough of them for the components."""
    spark = rows.sparkSession
    size = named.agg(F.sum("n").alias("items"), F.count(F.lit(1)).alias("rows")).first()
    fragments = max(partitions(spark), (size["items"] or 0) // FRAGMENT_ITEMS + 1)
    ranges = size["rows"] // RANGE_NODES + 1

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        waiting, held = {}, 0
        for batch in emptied(batches):
            for piece in T.slices(batch.column(0)):
                for items in sets_of(piece, n):
                    if not len(items) or (node := name_of(items)) in seen:
                        continue
                    if len(seen) >= SEEN_SETS:
                        seen.clear()
                    seen.add(node)
                    # A set that is forgotten may come again, and must not meet itself.
                    waiting[node] = items
                    held += len(items)
                    if held > DEALT_ITEMS:
                        yield _deal_counts(list(waiting.items()), fragments, ranges)
                        waiting, held = {}, 0
        if waiting:
            yield _deal_counts(list(waiting.items()), fragments, ranges)

    # A copy of a set in another task counts as sharing, so this keeps more than it must, never less.
    counted = rows.select("text").mapInArrow(deal, _DEALT).groupBy("frag").applyInArrow(_shared_counts(ranges), _COUNTED)
    enough = counted.groupBy("range").applyInArrow(_able(percent), "node bigint")
    # One row of each node gives its set. Ids may repeat or be null, so the text's hash goes along.
    first = named.filter("n > 0").groupBy("node").agg(F.min(F.struct("doc_id", "hash")).alias("row"))
    able = kept(enough.join(first, "node").select("row.doc_id", "row.hash", "node"), "ngram-able")
    sets = _sets(rows, able, n)
    lists = _lists(sets, percent)
    star = _verified(_star(lists, percent), sets, percent)
    star = kept(star, "ngram-star-links")
    roots = components(star, "ngram-star-components")
    rest = _verified(_rest(lists, roots, sets, percent), sets, percent)
    return kept(star.union(rest), "ngram-links")


def _sets(rows: DataFrame, able: DataFrame, n: int) -> DataFrame:
    """One row per node and segment: ``node``, ``n``, ``seg``, ``items`` and, in segment 0, the ``sketch``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in emptied(batches):
            want = batch.column(1).to_pylist()
            for piece in T.slices(batch.column(0)):
                out = []
                for k, items in enumerate(sets_of(piece, n)):
                    if not len(items) or name_of(items) != want[piece.first + k]:
                        continue  # a text with another's id and hash
                    ends = np.searchsorted(items >> T.U64(62), np.arange(SEGMENTS + 1).astype(T.U64))
                    for seg in range(SEGMENTS):
                        held = items[ends[seg] : ends[seg + 1]].astype(np.int64)
                        out.append((want[piece.first + k], len(items), seg, held, sketch(items) if not seg else None))
                columns = list(zip(*out, strict=True)) if out else [[]] * 5
                types = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["node", "n", "seg", "items", "sketch"]
                )

    mine = able.select(F.col("doc_id").alias("__id"), F.col("hash").alias("__hash"), "node")
    if able.count() <= BROADCAST_IDS:
        mine = F.broadcast(mine)
    wanted = rows.join(mine, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("hash") == F.col("__hash"))).select("text", "node")
    found = wanted.mapInArrow(cut, "node bigint, n bigint, seg int, items array<bigint>, sketch binary")
    return kept(found.dropDuplicates(["node", "seg"]), "ngram-sets")


def _lists(sets: DataFrame, percent: int) -> DataFrame:
    """Prefixes in the order (frequency, name): ``item``, ``node``, ``n`` and ``alone``, the node's items that no other has."""
    total = sets.filter("seg = 0").agg(F.sum("n")).first()[0] or 0
    fragments = total // LEFT_ITEMS + 1

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in emptied(batches):
            sizes = batch.column("n").to_pylist()
            rows = list(zip(batch.column("node").to_pylist(), batch.column("items"), strict=True))
            dealt = _deal([(node, v.values.to_numpy().astype(T.U64)) for node, v in rows], fragments, False)
            # The sizes are those of segments here; the whole sets' sizes go along by node.
            by_node = dict(zip(batch.column("node").to_pylist(), sizes, strict=True))
            whole = [
                np.array([by_node[k] for k in np.frombuffer(v, np.int64).tolist()], np.int32).tobytes() for v in dealt.column("nodes").to_pylist()
            ]
            yield dealt.set_column(2, "sizes", pa.array(whole, pa.binary()))

    def prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in emptied(batches):
            out = []
            for row in batch.to_pylist():
                items = np.frombuffer(b"".join(p["items"] for p in row["parts"]), T.U64)
                df = np.frombuffer(b"".join(p["df"] for p in row["parts"]), np.int64)
                size, least = row["n"], needed(row["n"], percent)
                alone = size - len(items)
                if len(items) < least:
                    continue
                for k in np.lexsort((items, df))[: max(0, size - least + 1 - alone)].tolist():
                    out.append((int(items[k].astype(np.int64)), row["node"], size, alone))
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item", "node", "n", "alone"])

    shared = sets.select("node", "n", "items").mapInArrow(deal, _DEALT)
    shared = shared.groupBy("frag").applyInArrow(_shared_items, "node bigint, n bigint, items binary, df binary")
    by_node = shared.groupBy("node", "n").agg(F.collect_list(F.struct("items", "df")).alias("parts"))
    return kept(by_node.mapInArrow(prefix, "item bigint, node bigint, n bigint, alone bigint"), "ngram-lists")


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _star(lists: DataFrame, percent: int) -> DataFrame:
    """Each node of a list with the list's most central one: the one with the fewest items of its own."""
    centre = kept(lists.groupBy("item").agg(F.min(F.struct("alone", "node", "n")).alias("c")), "ngram-centres")
    paired = to_one(lists, centre, "item").filter(F.col("node") != F.col("c.node"))
    fits = 100 * F.least("n", "c.n") >= percent * F.greatest("n", "c.n")
    return paired.filter(fits).select(*_pair("node", "c.node")).distinct()


def _rest(lists: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs across components within a list, as far as sketches leave them possible."""
    placed = lists.join(roots, "node", "left").select("item", "node", F.coalesce("root", "node").alias("root"))
    open_lists = placed.groupBy("item").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("size"))
    open_lists = open_lists.filter("low <> high").select("item", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    open_lists = kept(open_lists, "ngram-open")
    mine = to_one(placed, open_lists, "item").filter("blocks is not null").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # A list of one block is compared once; a larger one, every pair of blocks in a group of its own.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    mine = mine.select("item", "node", "root", "block", other.alias("other"))
    mine = mine.select(
        "item", "node", "root", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block"
    )
    described = sets.filter("seg = 0").select("node", "n", "sketch")
    full = mine.join(described, "node")

    def compare(table: pa.Table) -> pa.Table:
        low, high, block = (table[c].to_numpy() for c in ("low", "high", "block"))
        same = low[0] == high[0]
        a = table if same else table.filter(pa.array(block == low[0]))
        b = table if same else table.filter(pa.array(block == high[0]))
        pairs = list(_close(a, b, bool(same), percent))
        ordered = np.sort(np.array(pairs, dtype=np.int64).reshape(-1, 2), axis=1)
        return pa.table({"a": ordered[:, 0], "b": ordered[:, 1]})

    return full.groupBy("item", "low", "high").applyInArrow(compare, "a bigint, b bigint").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that link, by the sums of their overlaps in all segments."""
    side = lambda x: sets.select(F.col("node").alias(x), F.col("seg"), F.col("n").alias(f"n_{x}"), F.col("items").alias(f"items_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), ["b", "seg"])
    partial = both.select("a", "b", "n_a", "n_b", F.size(F.array_intersect("items_a", "items_b")).alias("overlap"))
    total = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("overlap").alias("overlap"))
    union = F.col("n_a") + F.col("n_b") - F.col("overlap")
    return total.filter(100 * F.col("overlap") >= percent * union).select("a", "b")
