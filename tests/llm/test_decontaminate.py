"""Wu-Manber search against a search for every window at every place."""

import hashlib
import re
from random import Random

import pytest

from scrutin.llm.decontaminate import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items, window):
    windows = {}
    for item, t in items:
        w = words(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[k : k + n]), set()).add(item)
    out = []
    for doc, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if ids := windows.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    found |= {str(i) for i in ids if i is not None}
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("part_bytes", [1 << 20, 300])
def test_equals_brute_force(spark, part_bytes):
    rng = Random(1)
    vocabulary = ["a", "B", "été", "x1", "ÀB", "日本", "it's", "a-b", "Zz"]
    speak = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, speak(rng.randint(1, 9))) for i in range(40)] + [(3, "a a B"), (7, None), (8, ""), (None, "zz Zz, zz"), (9, "!!")]
    docs = [(i, speak(rng.randint(0, 40))) for i in range(200)]
    docs += [(900, None), (901, ""), (902, speak(3000)), (2, docs[2][1]), (903, "B " * 700 + "zz zz zz")]
    frame = spark.createDataFrame([(d, t, "extra") for d, t in docs], "doc_id bigint, text string, items string").repartition(3)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate(frame, bench, window=5, part_bytes=part_bytes)
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert sorted(tuple(r) for r in got.select(*columns).collect()) == sorted(brute(docs, items, 5))


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate(docs, none).select("n_words", "n_hit", "contaminated").collect() == [(3, 0, False)]
    assert decontaminate(docs.limit(0), docs.withColumnRenamed("doc_id", "item_id")).count() == 0
