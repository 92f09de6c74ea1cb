"""The stages of the pipeline against brute force, one after the other."""

import os
import re
import zlib
from random import Random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"
SHAPE = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def lowered(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def corpus():
    rng = Random(3)
    speak = lambda n: " ".join(rng.choice(["ab", "cde", "éf", "Gh", "i.", "jkl,"]) + str(rng.randint(0, 400)) for _ in range(n))
    rows, labels = [], []
    for i in range(300):
        text = speak(rng.randint(20, 120))
        if i % 5 == 0:
            words = text.split()
            for bad in ("Grumble", "snarl", "hiss"):
                words.insert(rng.randrange(len(words)), bad)
            text = " ".join(words)
        labels.append((i, i % 2, int(i % 5 == 0)))
        rows.append((i, text))
    item, passage = speak(30), speak(60)
    rows += [(1000 + k, rows[1][1].rsplit(" ", k)[0]) for k in range(4)] + [(1010, rows[2][1]), (1011, rows[2][1].upper())]
    rows += [(1020 + k, f"{speak(40)} {passage} {speak(20)}") for k in range(5)]
    rows += [(1030, f"{speak(20)} {item} {speak(20)}"), (1031, f"{speak(900)} {' '.join(item.split()[:13])}"), (1032, item)]
    rows += [(1040, None), (1041, ""), (1042, " \n")]
    # Replacement characters of the input stay where a repeated passage (whose ends cut characters) goes.
    shared = "é" * 150
    rows += [(1050, f"a\ufffdb {shared} \ufffd c {speak(3)}"), (1051, f"{speak(30)} \ufffd {shared[:120]} d"), (1052, f"ç{shared}")]
    full = [(i, t, "xx", "s", None if t is None else len(t)) for i, t in rows]
    return full, labels, [(1, item), (2, None)]


def one_of_each(docs, n=5, percent=80):
    sets = []
    for r in docs:
        w = WORD.findall(lowered(r[1]))
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
    for i, r in enumerate(docs):
        least[find(i)] = min(r[0], least.get(find(i), r[0]))
    return [r for i, r in enumerate(docs) if least[find(i)] == r[0]]


def without_repeats(docs, size=200):
    texts = [(r[1] or "").encode() for r in docs]
    places = {}
    for i, t in enumerate(texts):
        for k in range(len(t) - size + 1):
            places.setdefault(t[k : k + size], []).append((i, k))
    gone = [np.zeros(len(t), dtype=bool) for t in texts]
    for spots in places.values():
        for i, k in spots if len(spots) > 1 else ():
            gone[i][k : k + size] = True
    out = []
    for r, t, g in zip(docs, texts, gone, strict=True):
        if not g.any():
            out.append(r)
            continue
        text = bytes(np.frombuffer(t, np.uint8)[~g]).decode(errors="ignore")
        out.append((*r[:1], text, *r[2:4], len(text)))
    return out


def clean(docs, items, window=13):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(t))
    found = set()
    for _, t in items:
        w = words(t)
        n = min(window, len(w))
        found |= {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if n else set()
    out = []
    for r in docs:
        w, hit = words(r[1]), set()
        for n in {len(x) for x in found}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in found:
                    hit |= set(range(k, k + n))
        if not hit or 20 * len(hit) < len(w):
            out.append(r)
    return out


def test_stages_one_after_the_other(spark, folder):
    docs, labels, items = corpus()
    spark.createDataFrame(docs, SHAPE).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    ordered = lambda rows: sorted((tuple(r) for r in rows), key=lambda r: r[0])
    frame, stages = spark.read.parquet(f"{folder}/documents.parquet"), dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "ngram_jaccard_join", "suffix_array_dedup", "benchmark_decontamination", "best_fit_packing"
    ]

    polite = stages["toxicity"](spark, frame, folder)
    assert polite.schema == frame.schema
    told = ordered(polite.collect())
    toxic = {i for i, _, y in labels if y}
    left = {r[0] for r in told}
    assert len(left & toxic) <= 2 and {r[0] for r in docs} - toxic <= left

    for name, brute in (("ngram_jaccard_join", one_of_each), ("suffix_array_dedup", without_repeats), ("benchmark_decontamination", lambda d: clean(d, items))):
        frame = spark.createDataFrame(told, SHAPE).repartition(3)
        got = stages[name](spark, frame, folder)
        assert got.columns == frame.columns
        want = ordered(brute(told))
        assert ordered(got.collect()) == want, name
        assert want != told
        told = want

    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for r in told:
        ids = np.array(plain.encode(r[1] or "", add_special_tokens=False).ids + [1], "<u4")
        want += [(r[0], k, zlib.crc32(ids[at : at + 4096].tobytes())) for k, at in enumerate(range(0, len(ids), 4096))]
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in corpus_pipeline.run(spark, folder).collect()) == sorted(want)


def test_rows_with_one_id_are_told_apart(spark, folder):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "other words are here now"), (None, "a b c d e f"), (None, None), (2, "")]
    docs = spark.createDataFrame([(i, t, "x", "y", 0) for i, t in rows], SHAPE)
    got = sorted((r.text or "" for r in corpus_pipeline.keep_one_of_each_group(spark, docs, folder).collect()))
    assert got == ["", "", "a b c d e f", "other words are here now"]


def test_a_repeated_id_does_not_change_what_other_groups_keep(spark, folder):
    rows = [(9, "g h i j k l"), (4, "g h i j k l"), (7, "g h i j k l"), (None, "m n o p q r"), (30, "m n o p q r"), (5, "one"), (5, "two")]
    docs = spark.createDataFrame([(i, t, "x", "y", 0) for i, t in rows], SHAPE).repartition(4)
    got = corpus_pipeline.keep_one_of_each_group(spark, docs, folder).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(4, "g h i j k l"), (5, "one"), (5, "two"), (30, "m n o p q r")]


def test_empty_tables(spark, folder):
    for name, shape in (("documents", SHAPE), ("labels", "doc_id bigint, quality int, toxic int"), ("benchmark", "item_id bigint, text string")):
        spark.createDataFrame([], shape).write.parquet(f"{folder}/{name}.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the synthetic tables")
def test_registered(spark):
    queries = __spark_entry__.queries()
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in queries if q.startswith("op")}
    assert queries["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(spark, SF).count() > 0
