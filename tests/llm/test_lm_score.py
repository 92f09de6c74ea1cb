"""Counts, base score and model score against brute force; the weights make probabilities."""

import re
import zlib
from collections import Counter
from math import isclose, log10
from random import Random

import numpy as np
import pytest

from scrutin.llm import lm_score

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]


def corpus():
    rng = Random(1)
    vocabulary = ["the", "The", "of", "é", "x."] + [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choice(vocabulary[: rng.choice([5, 20, 65])]) for _ in range(rng.randint(0, 60)))) for i in range(400)]
    return docs + [(1000, None), (1001, ""), (1002, "the " * 5000), docs[3], docs[3], (None, "of the"), (5, "another")]


@pytest.mark.parametrize("shard", [8 << 20, 2000])
def test_equals_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(lm_score, "SHARD_BYTES", shard)
    docs = corpus()
    fold = lambda d: -1 if d is None else zlib.crc32(str(d).encode()) % 10
    learned = [tokens(t) for d, t in docs if fold(d) != 0]
    words = Counter(w for t in learned for w in t)
    context = Counter(w for t in learned for w in ["<s>", *t[:-1]])
    pairs = Counter(p for t in learned for p in zip(["<s>", *t[:-1]], t, strict=True))
    n, v = sum(words.values()), len(words)
    frame = spark.createDataFrame([(d, t, 0.5) for d, t in docs], "doc_id bigint, text string, score double").repartition(3)
    model = lm_score.train(frame)
    assert model.totals == (v, n, sum(len(t) for d, t in [(d, tokens(t)) for d, t in docs] if fold(d) not in (0, 1)))
    assert np.allclose(model.weights.sum(axis=1), 1) and (model.weights[:, 2] > 0).all() and model.weights[0, 0] == 0
    bucket = lambda c: int(lm_score.bucket_of(np.array([c]))[0])

    def chance(a, b):
        w = model.weights[bucket(context[a])]
        return w[0] * (pairs[a, b] / context[a] if context[a] else 0) + w[1] * words[b] / n + w[2] / (v + 1)

    for a in ("<s>", "the", "w7", "never seen"):
        assert isclose(sum(chance(a, b) for b in [*words, "some unknown word"]), 1)
    want = []
    for d, t in docs:
        own = tokens(t)
        base = sum(log10((words[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        score = sum(log10(chance(a, b)) for a, b in zip(["<s>", *own[:-1]], own, strict=True))
        want.append((d, fold(d) == 0, len(own), sum(words[w] > 0 for w in own), n, base, score))
    got = sorted((tuple(r) for r in lm_score.score(frame).collect()), key=repr)
    for g, w in zip(got, sorted(want, key=repr), strict=True):
        assert g[:5] == w[:5] and isclose(g[5], w[5], rel_tol=1e-9) and isclose(g[6], w[6], rel_tol=1e-9)
    held = [g for g in got if g[1]]
    assert sum(g[6] for g in held) > sum(g[5] for g in held)


def test_weights_are_the_maximum():
    rng = Random(2)
    rows = [(5, rng.randint(0, 20), rng.randint(5, 40), rng.randint(1, 50)) for _ in range(200)] + [(5, lm_score.FINE * lm_score.OCTAVES, 30, 400)]
    value = lambda k: 0.0 if k == lm_score.FINE * lm_score.OCTAVES else 2 ** (-k / lm_score.FINE)
    found = lm_score.learn_weights(rows, 999)[5]
    gain = lambda w: sum(n * np.log(w[0] * value(a) + w[1] * value(b) + w[2] / 1000) for _, a, b, n in rows)
    best = gain(found)
    for _ in range(200):
        other = np.abs(found + np.array([rng.gauss(0, 0.05) for _ in range(3)])) + 1e-9
        assert gain(other / other.sum()) <= best + 1e-3


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert lm_score.score(empty).count() == 0
    only_held = next(d for d in range(100) if zlib.crc32(str(d).encode()) % 10 == 0)
    got = lm_score.score(spark.createDataFrame([(only_held, "a b")], "doc_id bigint, text string")).collect()
    assert got[0].held_out and got[0].n_known == 0 and got[0].train_tokens == 0 and np.isfinite(got[0].score)
