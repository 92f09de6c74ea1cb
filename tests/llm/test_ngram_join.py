"""The join against all pairs on small tables."""

import re
from random import Random

import numpy as np
import pyarrow as pa
import pytest

from scrutin.llm import ngram_join, text

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, n, percent):
    sets = []
    for _, t in docs:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((doc, len(sets[i]), least.get(find(i))) for i, (doc, _) in enumerate(docs)), key=repr)


def corpus(seed):
    rng = Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["The", "the", "É", "x y"]
    speak = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    docs, passage = [], speak(60)
    for _ in range(12):
        base = speak(rng.choice([3, 4, 6, 40, 150]))
        for _ in range(rng.choice([1, 3, 25])):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(vocabulary)
            docs.append(w[rng.randint(0, 2) :])
    docs += [speak(40) + passage for _ in range(25)] + [passage + speak(5) for _ in range(10)]
    docs += [speak(3000)] * 2
    texts = [rng.choice([" ", "\n", "\t "]).join(w) for w in docs]
    ids = rng.sample(range(10_000), len(texts))
    rows = list(zip(ids, texts, strict=True))
    # A chain whose middle has no id, words that share nothing but how they are built, and one id of many texts.
    base = [f"b{k}" for k in range(80)]
    rows += [(20_010, " ".join(base)), (None, " ".join(base[1:])), (20_011, " ".join([*base[2:], "end"]))]
    morse = "".join("ab"[k.bit_count() & 1] for k in range(1024))
    rows += [(20_012, f"{morse} b c d"), (20_013, f"{morse.translate(str.maketrans('ab', 'ba'))} b c d")]
    rows += [(20_014, f"one id number {k % 400} of {k % 400} texts") for k in range(1000)]
    return rows + [(20_001, None), (20_002, ""), (20_003, " \n"), rows[0], rows[0], (rows[1][0], "repeated id"), (None, rows[2][1]), (None, "q")]


@pytest.mark.parametrize(("n", "percent", "block"), [(4, 85, 2048), (5, 80, 2048), (4, 50, 8), (4, 100, 2048)])
def test_equals_all_pairs(spark, monkeypatch, n, percent, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    docs = corpus(percent + block)
    frame = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id bigint, text string, node int").repartition(3)
    got = sorted((tuple(r) for r in ngram_join.jaccard_groups(frame, n, percent).collect()), key=repr)
    assert got == brute(docs, n, percent)


def test_empty_table(spark):
    assert ngram_join.jaccard_groups(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_word_names_tell_words_apart():
    rng = Random(2)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 80))) for _ in range(4000)} | {"a" * k for k in range(1, 200)}
    words = sorted(words)
    column = pa.array([" ".join(words), None, "x", " ".join(words).upper(), "x" * 63 + " " + "x" * 64 + " " + "x" * 65])
    names = []
    for piece in text.slices(column):
        names.append(text.word_hashes(piece, text.words(piece)))
    names = np.concatenate(names)
    n = len(words)
    assert len(set(names[:n].tolist())) == n and (names[:n] == names[n + 1 : 2 * n + 1]).all()
    assert len(set(names[-3:].tolist())) == 3
