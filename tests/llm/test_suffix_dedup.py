"""Suffix arrays and removed bytes against brute force."""

import hashlib
from collections import Counter
from random import Random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scrutin.llm import suffix_dedup
from scrutin.llm.suffix_dedup import Shard, remove_repeats


def brute(docs, size):
    texts = [(t or "").encode() for _, t in docs]
    seen = Counter(t[k : k + size] for t in texts for k in range(len(t) - size + 1))
    out = []
    for (doc, _), t in zip(docs, texts, strict=True):
        gone = np.zeros(len(t) + 1, dtype=bool)
        for k in range(len(t) - size + 1):
            if seen[t[k : k + size]] > 1:
                gone[k : k + size] = True
        gone = gone[: len(t)]
        runs = int(np.sum(gone & ~np.concatenate([[False], gone[:-1]])))
        left = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((doc, len(t), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(6))
def test_shard_is_a_suffix_array(seed):
    rng = Random(seed)
    letters = [b"ab", b"a", bytes(range(256)), b"\x00\xff", b"abc"][seed % 5]
    texts = [bytes(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(20)] + [b"abab" * 20] * 2
    shard = Shard(texts, 12)
    key = {}
    for k, t in enumerate(texts):
        for i in range(len(t) + 1):
            key[int(shard.start[k]) + i] = (t[i:], k)
    assert shard.order.tolist() == sorted(key, key=lambda p: key[p])
    shared = shard.prefixes()
    for a, b in zip(shard.order[:-1].tolist(), shard.order[1:].tolist(), strict=True):
        x, y = key[a][0], key[b][0]
        n = next((i for i, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
        assert shared[b] == min(n, 12)
    strings = Counter(t[i : i + 12] for t in texts for i in range(len(t) - 11))
    again = shard.repeated()
    for p, (t, _) in key.items():
        assert again[p] == (len(t) >= 12 and strings[t[:12]] > 1)
    long = [t for t in texts if len(t) >= 12]
    hashes, at = suffix_dedup.string_hashes(long, 12)
    assert at.tolist() == Shard(long, 12).starts().tolist()
    assert len(set(hashes.tolist())) == len(strings)


def corpus(seed):
    rng = Random(seed)
    speak = lambda n: "".join(rng.choice("abcdé \n日") for _ in range(n))
    passages = [speak(rng.randint(30, 400)) for _ in range(8)]
    docs = []
    for i in range(150):
        parts = [speak(rng.randint(0, 120))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a, b = sorted((rng.randint(0, len(p)), rng.randint(0, len(p))))
            parts += [p[a:b], speak(rng.randint(0, 5))]
        docs.append((i, "".join(parts)))
    base = speak(200)
    docs += [(1000 + i, base[:i] + "X" + base[i + 1 :]) for i in range(40)]
    docs += [(2000, None), (2001, ""), (2002, "a" * 700), (2003, "ab" * 300), (2004, "x" + "ab" * 100), docs[3], docs[3]]
    docs += [(3000, "same " * 12), (3001, "same " * 12), (None, passages[0]), (docs[5][0], passages[1])]
    return docs


@pytest.mark.parametrize(("size", "crowd", "run"), [(50, 4096, 8192), (50, 8, 64), (20, 4096, 8192)])
def test_equals_brute_force(spark, monkeypatch, size, crowd, run):
    monkeypatch.setattr(suffix_dedup, "NAME_SEGMENTS", crowd)
    monkeypatch.setattr(suffix_dedup, "RUN", run)
    docs = corpus(size + crowd)
    frame = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id bigint, text string, name string").repartition(4)
    got = remove_repeats(frame, size=size).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs, size)


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_many_identical_rows_cost_no_more_than_a_few(spark):
    text = "".join(chr(97 + (k * k) % 23) for k in range(900))
    rows = [(7, text)] * 3000 + [(8, text[:300] + "#"), (9, "short"), (10, "x" + text[400:700])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    left = suffix_dedup.remove_repeats(docs)
    got = {tuple(r) for r in left.select("doc_id", "n_bytes", "n_removed", "n_spans").collect()}
    assert got == {(7, 900, 900, 1), (8, 301, 300, 1), (9, 5, 0, 0), (10, 301, 300, 1)}
    assert left.count() == len(rows)
