"""The manifest against trees built by hand, level by level, and against its SQL."""

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from scrutin.llm import merkle, queries

COLUMNS = "doc_id bigint, source string, lang string, n_chars bigint, text string, tree string, at int, Root string"


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [*row[:4], text]
    return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(out[-1][k : k + 3]) for k in range(0, len(out[-1]), 3)])
    return out


def steps(tree, k):
    for nodes in tree[:-1]:
        first = k - k % 3
        yield nodes[first:k], nodes[k + 1 : first + 3]
        k //= 3


def by_hand(rows, altered):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf(row, row[4]), leaf(row, altered(row)), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: r[:3])
        trees[name] = levels([r[2] for r in groups[name]])
    top = levels([trees[n][-1][0] for n in names])
    out = []
    for g, name in enumerate(names):
        for k, (_, _, mine, now, row) in enumerate(groups[name]):
            proof = ""
            for left, right in [*steps(trees[name], k), *steps(top, g)]:
                proof += "".join(left + right)
                now = h([*left, now, *right])
            out.append((row[0], name, k, mine, trees[name][-1][0], top[-1][0], proof, now, now == top[-1][0]))
    return sorted(out, key=repr)


def fixture():
    rng = random.Random(7)
    rows = []
    for name, n in {"a": 1, "b": 2, "é": 3, "z": 4, None: 30, "": 28, "big": 5000, "full": merkle.BLOCK}.items():
        ids = rng.sample(range(-2 * n - 70, 2 * n + 70), n)
        for k in ids:
            text = rng.choice([None, "", "one line", f"two\nlines {k}\n", "é\n漢"])
            rows.append((k if n != 28 else k << 40, name, rng.choice([None, "fr"]), k % 7 if k % 5 else None, text, "x", 1, "y"))
    one = [(None, "a", "en", 1, t, "x", 1, "y") for t in ("n\n1", None, "n\n1")]
    many = [(11, "hot", "en", 1, f"text {k % 90}\n", "x", 1, "y") for k in range(400)]
    near = [(k, "hot", "en", 1, "t\n", "x", 1, "y") for k in (10, 12, 12, 200, 9_000_000)]
    return rows + one + many + near


@pytest.mark.parametrize("hot", [100_000, 50])
def test_equals_trees_by_hand(spark, monkeypatch, hot):
    monkeypatch.setattr(merkle, "HOT_ROWS", hot)
    monkeypatch.setattr(merkle, "COPIES", 3)
    rows = fixture()
    docs = spark.createDataFrame(rows, COLUMNS).repartition(5)
    altered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))

    def by_python(row):
        even = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0
        return row[4].replace("\n", "") if even and row[4] is not None else row[4]

    got = merkle.manifest(docs, altered={"text": altered})
    assert got.columns == ["doc_id", "source", "rank", "leaf", "subroot", "root", "proof", "folded_root", "verified"]
    found, want = sorted((tuple(r) for r in got.collect()), key=repr), by_hand(rows, by_python)
    assert found == want
    assert 0 < sum(r[-1] for r in want) < len(want)


def test_empty_table_and_single_rows(spark):
    docs = spark.createDataFrame(fixture()[:1], COLUMNS)
    only = merkle.manifest(docs).collect()[0]
    assert only["leaf"] == only["subroot"] == only["root"] == only["folded_root"] and only["proof"] == "" and only["verified"]
    assert merkle.manifest(docs.limit(0)).collect() == []
    assert "proof" not in merkle.manifest(docs, with_proof=False).columns


def test_query_equals_sql(spark, folder):
    rows = [r for r in {(r[0], r[1]): r for r in fixture() if r[0] is not None and r[1] != "big"}.values()]
    rows = list({r[0]: r for r in rows}.values())
    spark.createDataFrame(rows, COLUMNS).select("doc_id", "source", "lang", "n_chars", "text").write.parquet(f"{folder}/documents.parquet")
    db = duckdb.connect()
    db.sql(f"create view documents as from read_parquet('{folder}/documents.parquet/*.parquet')")
    want = db.sql(queries.MERKLE_SQL)
    got = queries.merkle_manifest(spark, folder)
    assert got.columns == want.columns
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want.fetchall(), key=repr)


def test_paths_fold_to_the_root():
    nodes = [h([str(k)]).encode() for k in range(11)]
    tree = merkle.climb(nodes, merkle.depth(11))
    paths = merkle._steps(tree)
    for k, node in enumerate(nodes):
        path = merkle.unpack_path(merkle.pack_path([row[k // 3**n] for n, row in enumerate(paths)]))
        assert merkle.fold(node, path) == tree[-1][0]
        assert merkle.fold(h(["other"]).encode(), path) != tree[-1][0]
