"""Hard negatives by score bounds along a spanning tree of anchors.

The anchors are dealt into blocks, and the anchors of a block joined by a minimum spanning tree. With the score of
a parent known to lie in an interval, that of a child lies in it widened by edge length times candidate norm
(Cauchy-Schwarz), so a candidate whose interval misses the child's window of scores need not be scored. What
overlaps is scored exactly, which makes the interval a point again for the nodes below. A window is open above
for positives, from the worst of the best found so far; for negatives it is what their positives' scores allow.

Anchors against all rows is a grid of blocks: a task gets one block of candidates and a few blocks of anchors,
whatever the numbers of both, and sends on the best of each anchor. Those meet in steps of ``MERGED``, so no task
holds more than so many blocks' results. How much the tree saves depends on how close the anchors lie; the
results never do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scrutin.llm.tables import kept

#: Rows of a block of candidates, columns of it that are scored at once, and anchors of a block.
CANDIDATES, COLUMNS, ANCHORS = 8192, 2048, 512
#: Blocks of anchors that meet a block of candidates in one task.
TOGETHER = 16
#: Results that one merging step takes.
MERGED = 128
#: Anchors of one tree level that are scored at once.
TILE = 64

_BLOCK = "block bigint, n int, ids binary, rows binary, labels binary, kind string, vectors binary"
_FOUND = "anchors bigint, block bigint, keys binary, scores binary, ids binary, rows binary"
_SCHEMA = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


class Best:
    """The first ``k`` entries of each key by falling score, then rising id."""

    def __init__(self, keys: int, k: int):
        self.n, self.k = keys, k
        self.key, self.score, self.id, self.row = (np.zeros(0, np.int64) for _ in range(4))

    def add(self, key: np.ndarray, score: np.ndarray, id_: np.ndarray, row: np.ndarray) -> None:
        parts = ((self.key, key), (self.score, score), (self.id, id_), (self.row, row))
        key, score, id_, row = (np.concatenate([a, np.asarray(b, np.int64)]) for a, b in parts)
        # The complement turns the order of integers round, at both ends too.
        order = np.lexsort((row, id_, ~score, key))
        key = key[order]
        starts = np.searchsorted(key, key)
        order = order[np.arange(len(key)) - starts < self.k]
        self.key, self.score, self.id, self.row = np.sort(key[np.arange(len(key)) - starts < self.k]), score[order], id_[order], row[order]

    def floor(self) -> np.ndarray:
        """The score that an entry of each key must reach; minus infinity where fewer than ``k`` are known."""
        out = np.full(self.n, -np.inf)
        full = np.bincount(self.key, minlength=self.n) == self.k
        last = np.searchsorted(self.key, np.arange(self.n), "right") - 1
        out[full] = np.nextafter(self.score[last[full]].astype(np.float64), -np.inf)
        return out

    def columns(self) -> dict[str, list[bytes]]:
        return {c: [v.tobytes()] for c, v in (("keys", self.key), ("scores", self.score), ("ids", self.id), ("rows", self.row))}

    def add_packed(self, table: pa.Table) -> Best:
        held = [[np.frombuffer(v, np.int64) for v in table[c].to_pylist()] for c in ("keys", "scores", "ids", "rows")]
        self.add(*(np.concatenate(v) if v else np.zeros(0, np.int64) for v in held))
        return self


class Block:
    """Rows of a packed block: ``ids``, ``rows``, ``labels``, ``vectors`` (integers as doubles) and their ``norms``."""

    def __init__(self, row: dict, dims: int):
        self.ids, self.rows, self.labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "rows", "labels"))
        self.vectors = np.frombuffer(row["vectors"], row["kind"]).reshape(row["n"], dims).astype(np.float64)
        with np.errstate(over="ignore"):
            self.norms = np.sqrt((self.vectors**2).sum(axis=1))
        self.largest = float(np.abs(self.vectors).max(initial=0.0))


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order (parents first, level by level), parent of each node (the root's is -1) and length of the edge to it.

    A minimum spanning tree by Prim's method, rooted in the first node.
    """
    n = len(vectors)
    with np.errstate(over="ignore", invalid="ignore"):
        squares = (vectors**2).sum(axis=1)
        apart = squares[:, None] + squares[None, :] - 2 * (vectors @ vectors.T)
    apart = np.maximum(np.nan_to_num(apart, nan=np.inf), 0.0)
    parent, near, level = np.zeros(n, np.int64), apart[0].copy(), np.zeros(n, np.int64)
    parent[:1] = -1
    outside = np.ones(n, bool)
    outside[:1] = False
    for _ in range(n - 1):
        k = int(np.flatnonzero(outside)[np.argmin(near[outside])])
        outside[k] = False
        level[k] = level[parent[k]] + 1
        closer = outside & (apart[k] < near)
        near[closer], parent[closer] = apart[k][closer], k
    with np.errstate(over="ignore", invalid="ignore"):
        edges = np.sqrt(((vectors - vectors[np.maximum(parent, 0)]) ** 2).sum(axis=1))
    return np.argsort(level, kind="stable"), parent, edges


def _levels(order: np.ndarray, parent: np.ndarray) -> Iterator[np.ndarray]:
    """Nodes in tiles whose parents all come before."""
    level = np.zeros(len(order), np.int64)
    for k in order.tolist():
        level[k] = level[parent[k]] + 1 if parent[k] >= 0 else 0
    cuts = np.flatnonzero(np.diff(level[order])) + 1
    for nodes in np.split(order, cuts):
        for at in range(0, len(nodes), TILE):
            yield nodes[at : at + TILE]


class Tree:
    """A block of anchors with its spanning tree. ``scored`` counts exact scores."""

    def __init__(self, anchors: Block):
        self.anchors = anchors
        order, self.parent, self.edges = spanning_tree(anchors.vectors)
        self.tiles = list(_levels(order, self.parent))
        self.scored = 0

    def exact(self, nodes: np.ndarray, vectors: np.ndarray, largest: float) -> np.ndarray:
        """Integer inner products."""
        self.scored += len(nodes) * len(vectors)
        mine = self.anchors.vectors[nodes]
        bound = self.anchors.largest * largest * max(1, vectors.shape[1])
        if bound < 2**24:
            return (mine.astype(np.float32) @ vectors.T.astype(np.float32)).astype(np.int64)
        if bound < 2**53:
            return (mine @ vectors.T).astype(np.int64)
        whole = lambda m: np.array([[int(v) for v in row] for row in m], object).reshape(m.shape)
        return (whole(mine) @ whole(vectors).T).astype(np.int64)

    def pairs(
        self, block: Block, columns: slice, allowed: np.ndarray, low: np.ndarray, high: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, column, score) of all allowed pairs whose score lies in the anchor's window."""
        vectors, norms = block.vectors[columns], block.norms[columns]
        n, m = len(vectors), len(self.anchors.ids)
        middle, spread = np.zeros((m, n)), np.zeros((m, n))
        # Beyond the integers that doubles hold, bounds do not count.
        certain = self.anchors.largest * block.largest * max(1, vectors.shape[1]) < 2**53
        out = []
        for nodes in self.tiles:
            up = self.parent[nodes]
            if up[0] < 0 or not certain:
                want = np.ones(n, bool)
            else:
                # The slack is far above what rounding can lose and below one point of score.
                near = middle[up]
                wide = spread[up] + (self.edges[nodes][:, None] * norms[None, :]) * (1 + 1e-9) + 1e-3
                meets = allowed[nodes] & (near + wide >= low[nodes][:, None]) & (near - wide <= high[nodes][:, None])
                want = meets.any(axis=0)
                middle[nodes], spread[nodes] = near, wide
            if not want.any():
                continue
            some = np.flatnonzero(want)
            scores = self.exact(nodes, vectors[some] if len(some) < n else vectors, block.largest)
            middle[np.ix_(nodes, some)], spread[np.ix_(nodes, some)] = scores, 0.0
            fits = allowed[np.ix_(nodes, some)] & (scores >= low[nodes][:, None]) & (scores <= high[nodes][:, None])
            row, column = np.nonzero(fits)
            out.append((nodes[row], some[column], scores[row, column]))
        if not out:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(v) for v in zip(*out, strict=True))


def best_positives(tree: Tree, block: Block, k: int) -> Best:
    """The first ``k`` other rows of the same label for each anchor."""
    anchors, best = tree.anchors, Best(len(tree.anchors.ids), k)
    for at in range(0, len(block.ids), COLUMNS):
        part = slice(at, at + COLUMNS)
        allowed = (anchors.labels[:, None] == block.labels[None, part]) & (anchors.rows[:, None] != block.rows[None, part])
        who, column, score = tree.pairs(block, part, allowed, best.floor(), np.full(best.n, np.inf))
        best.add(who, score, block.ids[part][column], block.rows[part][column])
    return best


def windows(scores: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest negative score with low * positive <= 100 * negative <= high * positive."""
    ends = np.iinfo(np.int64)
    exact = [(max(-(-low * s // 100), ends.min), min(high * s // 100, ends.max)) for s in scores.tolist()]
    both = np.array(exact, dtype=np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def best_negatives(tree: Tree, positives: Best, block: Block, k: int, low: int, high: int) -> Best:
    """The first ``k`` rows of other labels in each positive's window; keys are places of positives in ``positives``."""
    anchors, best = tree.anchors, Best(len(positives.key), k)
    least, most = windows(positives.score, low, high)
    m = len(anchors.ids)
    begin, end = np.searchsorted(positives.key, np.arange(m)), np.searchsorted(positives.key, np.arange(m), "right")
    for at in range(0, len(block.ids), COLUMNS):
        part = slice(at, at + COLUMNS)
        bottom = best.floor()
        # An anchor's window spans those of its positives that are not empty; doubles are rounded outwards.
        some = (least <= most) & (bottom <= most)
        lowest, highest = np.full(m, np.inf), np.full(m, -np.inf)
        np.minimum.at(lowest, positives.key[some], np.maximum(bottom, np.nextafter(least.astype(np.float64), -np.inf))[some])
        np.maximum.at(highest, positives.key[some], np.nextafter(most.astype(np.float64), np.inf)[some])
        allowed = (anchors.labels[:, None] != block.labels[None, part]) & (lowest <= highest)[:, None]
        who, column, score = tree.pairs(block, part, allowed, lowest, highest)
        for nth in range(positives.k):
            key = begin[who] + nth
            held = key < end[who]
            key, cols, value = key[held], column[held], score[held]
            inside = (value >= least[key]) & (value <= most[key]) & (value >= bottom[key])
            key, cols, value = key[inside], cols[inside], value[inside]
            best.add(key, value, block.ids[part][cols], block.rows[part][cols])
    return best


def _packed(rows: DataFrame, size: int, dims: int, scale: int) -> DataFrame:
    """Blocks of at most ``size`` rows, as their partitions hold them; ``block`` is not numbered without gaps."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        number = TaskContext.get().partitionId() << 33

        def one(rows: list[tuple]) -> pa.RecordBatch:
            matrix = np.zeros((len(rows), dims))
            for k, row in enumerate(rows):
                matrix[k, : len(row[3])] = row[3]
            with np.errstate(over="ignore"):
                matrix = np.floor(scale * matrix)
            if not np.isfinite(matrix).all():
                raise OverflowError("a component is too large to be scaled")
            small = np.abs(matrix).max(initial=0.0) < 1 << 15
            columns = [np.array([r[c] for r in rows], np.int64).tobytes() for c in (0, 1, 2)]
            values = [number, len(rows), *columns, "<i2" if small else "<f8", matrix.astype("<i2" if small else "<f8").tobytes()]
            types = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.string(), pa.binary()]
            names = ["block", "n", "ids", "rows", "labels", "kind", "vectors"]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=names)

        for batch in batches:
            values = batch.column(3)
            for k, (id_, row, label) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 1, 2)), strict=True)):
                held.append((id_, row, label, values[k].values.to_numpy(zero_copy_only=False)))
                if len(held) == size:
                    yield one(held)
                    held, number = [], number + 1
        if held:
            yield one(held)

    return rows.select("id", "row", "label", "vector").mapInArrow(pack, _BLOCK)


def _numbered(blocks: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Blocks numbered 0, 1, ...; one number per block comes to the driver."""
    blocks = kept(blocks, name)
    old = sorted(r["block"] for r in blocks.select("block").collect())
    spark = blocks.sparkSession
    new = spark.createDataFrame(list(zip(old, range(len(old)), strict=True)), "block bigint, number bigint")
    return blocks.join(F.broadcast(new), "block").drop("block").withColumnRenamed("number", "block"), len(old)


def _grid(candidates: DataFrame, n_candidates: int, anchors: DataFrame, n_anchors: int, run) -> DataFrame:
    """``run`` on each block of candidates with each few blocks of anchors."""
    groups = -(-n_anchors // TOGETHER)
    each = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<bigint>"))
    left = candidates.withColumn("side", each).withColumn("at", F.col("block")).groupBy("at", "side")
    every = F.explode(F.sequence(F.lit(0), F.lit(n_candidates - 1)).cast("array<bigint>"))
    right = anchors.withColumn("at", every).withColumn("side", F.expr(f"block div {TOGETHER}")).groupBy("at", "side")
    return left.cogroup(right).applyInArrow(run, _FOUND)


def _found(anchors: int, block: int, best: Best) -> pa.Table:
    return pa.table({"anchors": pa.array([anchors], pa.int64()), "block": pa.array([block], pa.int64())} | {k: pa.array(v, pa.binary()) for k, v in best.columns().items()})


def _merged(found: DataFrame, blocks: int, k: int, name: str) -> DataFrame:
    """One row per block of anchors."""
    step = MERGED

    def merge(table: pa.Table) -> pa.Table:
        keys = max((np.frombuffer(v, np.int64).max(initial=-1) for v in table["keys"].to_pylist()), default=-1) + 1
        return _found(table["anchors"][0].as_py(), table["block"][0].as_py() // step, Best(int(keys), k).add_packed(table))

    while True:
        found = kept(found.withColumn("to", F.expr(f"block div {step}")).groupBy("anchors", "to").applyInArrow(merge, _FOUND), name)
        blocks = -(-blocks // step)
        if blocks <= 1:
            return found


def mine(
    vectors: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    scale: int = 256,
    key: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Components count as floor(scale * x); a score is the integer inner product with the anchor. An anchor's
    positives are the first ``positives`` other rows of its label, by falling score and then rising id; for each,
    the first ``negatives`` rows of other labels with low * positive <= 100 * negative <= high * positive are
    returned, ranked from 1. ``anchor`` is a condition on the rows of ``vectors``.

    Rows with a null id, label or vector, or a null, NaN or infinite component take no part. A vector that is shorter
    than others counts as followed by zeros. Each row counts by itself: copies of a row are each other's positives, and
    a repeated anchor has rows for each copy. An empty table, or one without anchors, gives no rows. A score
    that no long holds, or a component too large to be scaled, ends the query. Other columns have no effect.
    """
    spark: SparkSession = vectors.sparkSession
    values = F.col(vector).cast("array<double>")
    clean = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    picked = vectors.select(
        F.col(key).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), values.alias("vector"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    )
    usable = picked.filter("id is not null and label is not null and vector is not null").filter(clean)
    rows = kept(usable.withColumn("row", F.monotonically_increasing_id()), "negatives-rows")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("anchors"), F.max(F.size("vector")).alias("dims")).first()
    if not size["anchors"]:
        return spark.createDataFrame([], _SCHEMA)
    dims = size["dims"]
    dealt = rows.repartition(-(-size["n"] // CANDIDATES))
    candidates, n_candidates = _numbered(_packed(dealt, 2 * CANDIDATES, dims, scale), "negatives-candidates")
    # Anchors of one label lie closer together, which shortens the edges.
    by_label = rows.filter("anchor").repartitionByRange(-(-size["anchors"] // ANCHORS), "label", "row").sortWithinPartitions("label", "row")
    anchors, n_anchors = _numbered(_packed(by_label, ANCHORS, dims, scale), "negatives-anchors")

    def first_pass(block: pa.Table, some: pa.Table) -> pa.Table:
        met = Block(block.to_pylist()[0], dims)
        out = [(a["block"], best_positives(Tree(Block(a, dims)), met, positives)) for a in some.to_pylist()]
        return pa.concat_tables([_found(a, block["block"][0].as_py(), best) for a, best in out])

    found = _merged(_grid(candidates, n_candidates, anchors, n_anchors, first_pass), n_candidates, positives, "negatives-positives")
    packed = F.struct("keys", "scores", "ids", "rows").alias("positives")
    known = kept(anchors.join(found.select(F.col("anchors").alias("block"), packed), "block"), "negatives-known")

    def read_positives(held: dict) -> Best:
        best = Best(0, positives)
        best.key, best.score, best.id, best.row = (np.frombuffer(held[c], np.int64) for c in ("keys", "scores", "ids", "rows"))
        return best

    def second_pass(block: pa.Table, some: pa.Table) -> pa.Table:
        met = Block(block.to_pylist()[0], dims)
        out = []
        for a in some.to_pylist():
            best = best_negatives(Tree(Block(a, dims)), read_positives(a["positives"]), met, negatives, low, high)
            out.append(_found(a["block"], block["block"][0].as_py(), best))
        return pa.concat_tables(out)

    found = _merged(_grid(candidates, n_candidates, known, n_anchors, second_pass), n_candidates, negatives, "negatives-found")
    ends = found.select(F.col("anchors").alias("block"), "keys", "scores", F.col("ids").alias("negative_ids"))
    together = known.select("block", F.col("ids").alias("anchor_ids"), "positives").join(ends, "block")

    def rank(table: pa.Table) -> pa.Table:
        row = table.to_pylist()[0]
        own, best = np.frombuffer(row["anchor_ids"], np.int64), read_positives(row["positives"])
        keys, scores, ids = (np.frombuffer(row[c], np.int64) for c in ("keys", "scores", "negative_ids"))
        place = np.arange(len(keys)) - np.searchsorted(keys, keys) + 1
        return pa.table(
            {
                "anchor_id": own[best.key[keys]], "positive_id": best.id[keys], "rank": place.astype(np.int32),
                "negative_id": ids, "positive_score": best.score[keys], "negative_score": scores,
            }
        )

    return together.groupBy("block").applyInArrow(rank, _SCHEMA)
