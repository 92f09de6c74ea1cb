"""Hard negatives against all scores computed one by one, and against their SQL."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from scrutin.llm import hard_negatives as H
from scrutin.llm import queries

COLUMNS = "vec_id long, embedding array<float>, label int, anchor string, row long, Block string"


def by_hand(rows, low=80, k=5):
    good = [r for r in rows if None not in r[:3] and all(x is not None and math.isfinite(x) for x in r[1])]
    vectors = [[math.floor(256 * x) for x in r[1]] for r in good]
    out = []
    for a, anchor in enumerate(good):
        if anchor[0] % 100:
            continue
        scored = []
        for b, other in enumerate(good):
            if a != b:
                scored.append((-sum(x * y for x, y in zip(vectors[a], vectors[b], strict=False)), other[0], other[2] == anchor[2]))
        scored.sort()
        for minus, positive, _ in [s for s in scored if s[2]][:k]:
            inside = [s for s in scored if not s[2] and low * -minus <= -100 * s[0] <= -100 * minus][:k]
            out += [(anchor[0], positive, n, s[1], -minus, -s[0]) for n, s in enumerate(inside, 1)]
    return sorted(out)


def random_rows(n, dims, spread, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    rows = []
    for k in range(n):
        at = centres[k % 6] + spread * rng.normal(size=dims)
        rows.append((k, [float(np.float32(x)) for x in at / np.linalg.norm(at)], int(rng.integers(0, 4)) if k % 3 else k % 2, "a", 5, "b"))
    return rows


def odd_rows():
    nan, inf = float("nan"), float("inf")
    return [
        (None, [0.5, 0.5], 1), (700, None, 1), (800, [0.1, None], 1), (900, [nan, 0.2], 1), (1000, [inf], 2), (1100, [0.3], None),
        (1200, [], 2), (1300, [0.0] * 8, 2), (1300, [0.0] * 8, 2), (1400, [-0.2, 0.1], 0), (-100, [0.25] * 8, 0), (100, [0.25] * 8, 1),
        *[(k, [0.25] * 8, k % 2) for k in range(2001, 2031)], (100, [0.25] * 8, 1), (1500, [3e3, 2.5] + [0.0] * 6, 1),
    ]


@pytest.mark.parametrize("blocks", [(H.CANDIDATES, H.ANCHORS, H.TOGETHER, H.MERGED), (40, 2, 2, 3)])
def test_equals_all_scores(spark, monkeypatch, blocks):
    for name, value in zip(("CANDIDATES", "ANCHORS", "TOGETHER", "MERGED"), blocks, strict=True):
        monkeypatch.setattr(H, name, value)
    rows = random_rows(600, 8, 0.4, 3) + [(*r, "a", 5, "b") for r in odd_rows()]
    random.Random(1).shuffle(rows)
    vectors = spark.createDataFrame(rows, COLUMNS).repartition(4)
    got = H.mine(vectors, F.col("vec_id") % 100 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = by_hand(rows)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 100


def test_tables_without_rows_or_anchors(spark):
    vectors = spark.createDataFrame([(*r, "a", 5, "b") for r in odd_rows()], COLUMNS)
    for some in (vectors.limit(0), vectors.filter("vec_id > 2000"), vectors.filter("vec_id is null"), vectors.filter("vec_id = 1200")):
        assert H.mine(some, F.col("vec_id") % 100 == 0).collect() == []


def test_query_equals_sql(spark, folder):
    rows = [r[:3] for r in random_rows(900, 16, 0.8, 4)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    db = duckdb.connect()
    db.sql(f"create view embeddings as from read_parquet('{folder}/embeddings.parquet/*.parquet')")
    want = db.sql(queries.NEGATIVES_SQL)
    got = queries.hard_negative_mining(spark, folder)
    assert got.columns == want.columns
    found = sorted(tuple(r) for r in got.collect())
    assert found == sorted(want.fetchall()) and found


def block(vectors, labels, first=0):
    n = len(vectors)
    columns = {"ids": np.arange(first, first + n), "rows": np.arange(first, first + n), "labels": np.array(labels)}
    packed = {c: v.astype(np.int64).tobytes() for c, v in columns.items()}
    return H.Block({**packed, "n": n, "kind": "<f8", "vectors": np.array(vectors, float).tobytes()}, len(vectors[0]))


def test_tree_is_minimal_and_bounds_save_scores():
    rng = np.random.default_rng(8)
    centres = rng.integers(-200, 200, (5, 12))
    anchors = block([centres[k % 5] + rng.integers(-2, 3, 12) for k in range(60)], [0] * 60)
    tree = H.Tree(anchors)
    apart = np.sqrt(((anchors.vectors[:, None] - anchors.vectors[None]) ** 2).sum(axis=2))
    # Kruskal: edges by length, each joining two parts.
    part, total = list(range(60)), 0.0
    for length, a, b in sorted((apart[a, b], a, b) for a in range(60) for b in range(a)):
        if part[a] != part[b]:
            total += length
            part = [part[a] if p == part[b] else p for p in part]
    assert np.isclose(tree.edges.sum(), total)
    others = block(rng.integers(-200, 200, (1500, 12)), [0] * 1500, 100)
    best = H.best_positives(tree, others, 5)
    scores = (anchors.vectors @ others.vectors.T).astype(int)
    for k in range(60):
        order = sorted(range(1500), key=lambda c: (-scores[k, c], c))[:5]
        assert best.id[best.key == k].tolist() == [100 + c for c in order]
    whole = 60 * 1500
    low = np.full(60, scores.max() * 0.9)
    tree.scored = 0
    who, column, value = tree.pairs(others, slice(0, 1500), np.ones((60, 1500), bool), low, np.full(60, np.inf))
    assert set(zip(who.tolist(), column.tolist(), strict=True)) == set(zip(*(v.tolist() for v in np.nonzero(scores >= low[0])), strict=True))
    assert (value == scores[who, column]).all() and tree.scored < whole / 3


def test_scores_beyond_doubles_are_exact():
    big = block([[2.0**40, 3.0], [2.0**40, 1.0]], [0, 0])
    assert H.Tree(big).exact(np.array([0, 1]), np.array([[2.0**22, 1.0]]), 2.0**22).tolist() == [[2**62 + 3], [2**62 + 1]]
    best = H.best_positives(H.Tree(big), block([[2.0**22, 1.0], [2.0**22, 2.0]], [0, 0], 10), 1)
    assert best.score.tolist() == [2**62 + 6, 2**62 + 2] and best.id.tolist() == [11, 11]
