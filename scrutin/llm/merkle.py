"""Merkle manifest of a data set, with leaf coordinates from ranks in bitmaps.

Every row is a leaf, every group (a source) a tree over its leaves in the order of their ids, and the groups'
roots, ordered by group, are the leaves of one tree above. No leaf is sorted to find its coordinate:

1. The ids of a group are a bitmap of words of 64, of which only those with an id exist. Tasks build their
   own and merge them by OR; a directory holds the popcounts before each word, in two levels (containers
   of 1,024 words, words of a container). Sums over containers run over ranges of the directory, so a
   group may have any number of them.
2. A leaf's rank is the count before its word plus the popcount of the bits below its own.
3. Ranks key fixed arrays of slots (``BLOCK`` of them): a task fills a block by slot and reduces it level by
   level to one node, which is a slot of a block of the next tier. A tier divides the leaves by ``BLOCK``,
   so a group that holds most rows is as many tasks as it has blocks.
4. Paths come back down tier by tier: a block's path to the root is one row, and its leaves' proofs are made
   from it and the block itself.

Written tables between the tiers cut lineage. Only single digests, and one row per range of a directory,
come to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrutin.llm.tables import kept, partitions

FANOUT = 3
#: Levels and slots of a block.
DEPTH = 7
BLOCK = FANOUT**DEPTH
WORDS = 1024
#: Rows of a word of 64 ids from which it is joined by broadcast: repeated ids, at most one word in so many rows.
HOT_ROWS = 100_000
#: Copies of one row that are made from one array.
COPIES = 4096


def leaf_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of ``-`` for null, else byte length, colon and value of each field."""
    told = []
    for field in fields:
        value = field.cast("string")
        told.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*told).cast("binary"), 256))


def _digest(run: Sequence[bytes]) -> bytes:
    return hashlib.sha256(b"".join(run)).hexdigest().encode()


def depth(n: int) -> int:
    """Levels from ``n`` nodes to one."""
    found = 0
    while n > 1:
        n, found = -(-n // FANOUT), found + 1
    return found


def climb(nodes: list[bytes], levels: int) -> list[list[bytes]]:
    """Each level of the tree above ``nodes``, the nodes (hex) first."""
    out = [nodes]
    for _ in range(levels):
        nodes = [_digest(nodes[k : k + FANOUT]) for k in range(0, len(nodes), FANOUT)]
        out.append(nodes)
    return out


def _slots(at: Sequence[int], nodes: Sequence[bytes]) -> tuple[list[int], list[list[bytes]]]:
    """The slots of a block's rows, and the block's levels."""
    slots = [k % BLOCK for k in at]
    held: list[bytes | None] = [None] * len(slots)
    for slot, node in zip(slots, nodes, strict=True):
        if slot >= len(held) or held[slot] is not None:
            raise RuntimeError("ranks of leaves are not dense")
        held[slot] = node.hex().encode()
    # A block that is not the first, or is full, belongs to a larger tree.
    return slots, climb(held, DEPTH if at and at[0] >= BLOCK else depth(len(held)))


def _steps(levels: list[list[bytes]]) -> list[list[tuple[bytes, bytes]]]:
    """For each level but the last and each node, what lies left and right of it in its run."""
    out = []
    for nodes in levels[:-1]:
        row = []
        for k in range(len(nodes)):
            first = k - k % FANOUT
            row.append((b"".join(nodes[first:k]), b"".join(nodes[k + 1 : first + FANOUT])))
        out.append(row)
    return out


def pack_path(steps: Sequence[tuple[bytes, bytes]]) -> bytes:
    """Steps as bytes: two counts of hex digests and the digests."""
    return b"".join(bytes([len(a) // 64, len(b) // 64]) + bytes.fromhex((a + b).decode()) for a, b in steps)


def unpack_path(packed: bytes) -> list[tuple[bytes, bytes]]:
    out, at = [], 0
    while at < len(packed):
        a, b = packed[at] * 32, packed[at + 1] * 32
        at += 2
        out.append((packed[at : at + a].hex().encode(), packed[at + a : at + a + b].hex().encode()))
        at += a + b
    return out


def fold(leaf: bytes, path: Sequence[tuple[bytes, bytes]]) -> bytes:
    """The root that a leaf (hex) and its path give."""
    for left, right in path:
        leaf = _digest([left, leaf, right])
    return leaf


def running(df: DataFrame, group: Sequence[str], order: Sequence[str], weight: str, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``weight`` over the rows of its group before it, nulls first.

    Rows are dealt by ranges of group and order; a task sums up its range, and what a range takes over from
    those before it is decided on the driver from one row per range. (group, order) must identify a row.
    """
    spark = df.sparkSession
    by = [F.col(c).asc_nulls_first() for c in (*group, *order)]
    columns = df.columns
    own = ["__local", "__nth", "__slot", "__part"]
    schema = df.select("*", *[F.lit(0).cast("bigint").alias(c) for c in own]).schema

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total, nth, slot, last = TaskContext.get().partitionId(), 0, 0, 0, None
        for batch in batches:
            keys = list(zip(*(batch.column(columns.index(c)).to_pylist() for c in group), strict=True)) if group else [()] * batch.num_rows
            local, number = [], []
            for key, w in zip(keys, batch.column(columns.index(weight)).to_pylist(), strict=True):
                if last is not None and key != last:
                    total, nth = 0, nth + 1
                last = key
                local.append(total)
                number.append(nth)
                total += w
            slots = range(slot, slot + batch.num_rows)
            slot += batch.num_rows
            extra = [pa.array(v, pa.int64()) for v in (local, number, slots, [part] * batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*columns, *own])

    dealt = df.repartitionByRange(partitions(spark), *by).sortWithinPartitions(*by)
    placed = kept(dealt.mapInArrow(add_up, schema), "merkle-running")
    key = F.struct(F.lit(0), *group)
    ends = placed.groupBy("__part").agg(
        F.min_by(key, "__slot").alias("first"), F.max_by(key, "__slot").alias("last"), F.max("__nth").alias("nth"),
        F.max_by(F.col("__local") + F.col(weight), "__slot").alias("sum"),
    )
    carry, before, shifts = 0, None, []
    for row in sorted(ends.collect(), key=lambda r: r["__part"]):
        taken = carry if before == row["first"] else 0
        shifts.append((row["__part"], taken))
        carry, before = row["sum"] + (taken if row["nth"] == 0 else 0), row["last"]
    shift = F.broadcast(spark.createDataFrame(shifts, "__part bigint, __taken bigint"))
    value = F.col("__local") + F.when(F.col("__nth") == 0, F.col("__taken")).otherwise(F.lit(0))
    return placed.join(shift, "__part").select(*columns, value.cast("bigint").alias(name))


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, null being equal to null; the keys of ``a`` stay."""
    renamed = b.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in b.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return a.join(renamed, on, how).drop(*[f"__{k}" for k in keys])


def directory(leaves: DataFrame) -> DataFrame:
    """Words of the groups' bitmaps: ``tree``, ``word``, ``bits``, ``rows`` and ``before``, the leaves of the tree before the word."""
    words = leaves.groupBy("tree", "word").agg(
        F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"), F.count(F.lit(1)).alias("rows")
    )
    words = kept(words.withColumn("box", F.expr(f"word div {WORDS} - int(word % {WORDS} < 0)")), "merkle-words")
    boxes = running(words.groupBy("tree", "box").agg(F.sum("rows").alias("n")), ["tree"], ["box"], "n", "start")
    inside = Window.partitionBy("tree", "box").orderBy("word").rowsBetween(Window.unboundedPreceding, -1)
    counted = words.withColumn("inside", F.coalesce(F.sum("rows").over(inside), F.lit(0)))
    found = _same(counted, boxes.select("tree", "box", "start"), ["tree", "box"])
    return kept(found.select("tree", "word", "bits", "rows", (F.col("start") + F.col("inside")).alias("before")), "merkle-directory")


def ranked(leaves: DataFrame) -> DataFrame:
    """``leaves`` with ``at``, their places in their trees. Rows of one id are ordered by their digests."""
    names = leaves.columns
    words = directory(leaves)
    crowded = F.col("rows") > F.bit_count("bits")
    below = F.expr("bit_count(bits & ~shiftleft(-1L, bit))").cast("bigint")
    hot = kept(words.filter(F.col("rows") > HOT_ROWS), "merkle-hot")
    rows, repeats = leaves, []
    if not hot.isEmpty():
        marked = _same(leaves, F.broadcast(hot), ["tree", "word"], "left")
        rows, repeats = marked.filter("rows is null").select(*names), [marked.filter("rows is not null")]
    met = _same(rows, words, ["tree", "word"])
    plain = met.filter(~crowded).select(*names, (F.col("before") + below).alias("at"))
    if words.filter(crowded).isEmpty():
        return kept(plain, "merkle-places")
    repeats.append(met.filter(crowded))
    several = repeats[0] if len(repeats) == 1 else repeats[0].unionByName(repeats[1])
    equal = several.groupBy(*names, "before").agg(F.count(F.lit(1)).alias("copies"))
    # Copies are alike in all columns, so any of them may take any of their places.
    spread = running(equal, ["tree", "word"], ["id", "leaf", "changed"], "copies", "inside")
    many = spread.withColumn("from", F.explode(F.sequence(F.lit(0), F.col("copies") - 1, F.lit(COPIES)))).repartition(partitions(leaves.sparkSession))
    last = F.least(F.col("from") + COPIES, F.col("copies")) - 1
    each = many.withColumn("copy", F.explode(F.sequence(F.col("from"), last)))
    return kept(plain.unionByName(each.select(*names, (F.col("before") + F.col("inside") + F.col("copy")).alias("at"))), "merkle-places")


def _block() -> Column:
    return F.expr(f"at div {BLOCK}").alias("block")


def _up(nodes: DataFrame) -> DataFrame:
    """One node per block: the slots of the next tier."""

    def reduce(table: pa.Table) -> pa.Table:
        at = table["at"].to_pylist()
        top = _slots(at, table["node"].to_pylist())[1][-1][0]
        return pa.table({"tree": table["tree"].slice(0, 1), "at": pa.array([at[0] // BLOCK], pa.int64()), "node": pa.array([bytes.fromhex(top.decode())])})

    keyed = nodes.select("tree", "at", "node", _block())
    return kept(keyed.groupBy("tree", "block").applyInArrow(reduce, "tree string, at bigint, node binary"), "merkle-tier")


def _tiers(nodes: DataFrame) -> list[DataFrame]:
    """Tiers of nodes; the last has one node per tree."""
    out = [nodes, _up(nodes)]
    while not out[-1].filter("at > 0").isEmpty():
        out.append(_up(out[-1]))
    return out


def _with_paths(nodes: DataFrame, above: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``run`` on each block of ``nodes`` and the one row of ``above`` for the block's node."""
    left = nodes.select("*", _block()).groupBy("tree", "block")
    right = above.withColumnRenamed("at", "block").groupBy("tree", "block")
    return left.cogroup(right).applyInArrow(run, schema)


_PATHS = "tree string, at bigint, subroot binary, path binary"


def _down(table: pa.Table, above: pa.Table) -> pa.Table:
    """Paths of a block's nodes."""
    slots, levels = _slots(table["at"].to_pylist(), table["node"].to_pylist())
    rest, steps = above["path"][0].as_py(), _steps(levels)
    paths = [pack_path([row[s // FANOUT**k] for k, row in enumerate(steps)]) + rest for s in slots]
    subroots = pa.array([above["subroot"][0].as_py()] * len(slots), pa.binary())
    return pa.table({"tree": table["tree"], "at": table["at"], "subroot": subroots, "path": pa.array(paths, pa.binary())})


def _proofs(root: str, with_proof: bool) -> Callable:
    def run(table: pa.Table, above: pa.Table) -> pa.Table:
        slots, levels = _slots(table["at"].to_pylist(), table["leaf"].to_pylist())
        tail = unpack_path(above["path"][0].as_py())
        steps = _steps(levels)
        # What lies beside a node and the nodes above it, from the top down: each is made once.
        beside = [b"".join(a + b for a, b in tail)] * len(levels[-1])
        for row in reversed(steps):
            beside = [a + b + beside[k // FANOUT] for k, (a, b) in enumerate(row)]
        changed = table["changed"].to_pylist()
        now = [levels[0][s] if c is None else c.hex().encode() for s, c in zip(slots, changed, strict=True)]
        at = list(slots)
        for row in steps:
            now = _fold_level(now, [row[k] for k in at], at)
            at = [k // FANOUT for k in at]
        for step in tail:
            now = _fold_level(now, [step] * len(now), at)
        names = lambda values: pa.array([v.decode() for v in values], pa.string())
        whole = lambda value: pa.array([value] * len(slots), pa.string())
        out = {
            "id": table["id"], "tree": table["tree"], "at": table["at"], "leaf": names(levels[0][s] for s in slots),
            "subroot": whole(above["subroot"][0].as_py().hex()), "root": whole(root),
        }
        if with_proof:
            out["proof"] = names(beside[s] for s in slots)
        return pa.table({**out, "folded_root": names(now), "verified": pa.array([v.decode() == root for v in now])})

    return run


def _fold_level(now: list[bytes], steps: list[tuple[bytes, bytes]], at: list[int]) -> list[bytes]:
    """One step for all leaves of a block; equal nodes at equal places are hashed once."""
    known: dict[tuple[int, bytes], bytes] = {}
    out = []
    for node, (left, right), k in zip(now, steps, at, strict=True):
        key = (k, node)
        if key not in known:
            known[key] = _digest([left, node, right])
        out.append(known[key])
    return out


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    key: str = "doc_id",
    group: str = "source",
    altered: dict[str, Column] | None = None,
    with_proof: bool = True,
) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``group``, ``rank``, ``leaf``, ``subroot``, ``root``, ``proof``, ``folded_root``, ``verified``.

    Digests are lowercase hex; ``proof`` is the text of the siblings' digests from the leaf's run to the root,
    left to right. ``altered`` replaces fields before the check: ``folded_root`` is what the altered leaf and
    the original siblings give, and ``verified`` whether that is the root.

    A null id comes before all others of its group, a null group before all groups. Rows of one id are ordered by
    their leaf digests, each row a leaf of its own. Texts are hashed whole, null being different from empty.
    An empty table gives no rows. Columns that are not named have no effect. ``key`` must be an integer.
    """
    altered = altered or {}
    spark = docs.sparkSession
    id_ = F.col(key).cast("bigint")
    before = leaf_digest([F.col(f) for f in fields])
    after = leaf_digest([altered.get(f, F.col(f)) for f in fields]) if altered else F.lit(None).cast("binary")
    rows = docs.select(id_.alias("id"), F.col(group).cast("string").alias("tree"), before.alias("leaf"), after.alias("changed"))
    leaves = kept(
        rows.select(
            "id", "tree", "leaf", F.when(F.col("changed") != F.col("leaf"), F.col("changed")).alias("changed"),
            F.expr("shiftright(id, 6)").alias("word"), F.expr("coalesce(int(id & 63), 0)").alias("bit"),
        ),
        "merkle-leaves",
    )
    places = ranked(leaves)
    tiers = _tiers(places.select("tree", "at", F.col("leaf").alias("node")))
    roots = tiers[-1].select(F.col("tree").alias("name"), F.col("node"), F.lit(1).cast("bigint").alias("one"))
    numbered = running(roots, [], ["name"], "one", "at")
    top = kept(numbered.select(F.lit(None).cast("string").alias("tree"), "at", "node", "name"), "merkle-top")
    upper = _tiers(top.select("tree", "at", "node"))
    found = upper[-1].first()
    root = found["node"].hex() if found else ""

    nothing = F.lit(b"").cast("binary")
    paths = upper[-1].select("tree", "at", nothing.alias("subroot"), nothing.alias("path"))
    for tier in reversed(upper[:-1]):
        paths = kept(_with_paths(tier, paths, _down, _PATHS), "merkle-paths")
    by_tree = top.join(paths.select("at", "path"), "at")
    paths = by_tree.select(F.col("name").alias("tree"), F.lit(0).cast("bigint").alias("at"), F.col("node").alias("subroot"), "path")
    for tier in reversed(tiers[1:-1]):
        paths = kept(_with_paths(tier, paths, _down, _PATHS), "merkle-paths")
    proof = "proof string, " if with_proof else ""
    schema = f"id bigint, tree string, at bigint, leaf string, subroot string, root string, {proof}folded_root string, verified boolean"
    out = _with_paths(places.select("id", "tree", "at", "leaf", "changed"), paths, _proofs(root, with_proof), schema)
    named = {"id": key, "tree": group, "at": "rank"}
    return out.select(*[F.col(c).alias(named.get(c, c)) for c in out.columns])
