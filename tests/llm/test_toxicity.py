"""Held-out accuracy of the classifier, and its defined results at the edges."""

from random import Random

import numpy as np
import pytest

from scrutin.llm import toxicity
from scrutin.llm.queries import toxicity_scores

SF = "/root/testdata/sf0.01"


def test_gradients_lower_the_loss_and_held_out_texts_are_told_apart(spark):
    rng = Random(1)
    plain = [f"w{i}" for i in range(3000)]
    bad = ["Grumble", "snarl", "hiss"]
    rows = []
    for i in range(1200):
        words = [rng.choice(plain) for _ in range(rng.randint(1, 120))]
        toxic = i % 4 == 0
        for _ in range(2 * toxic):
            words.insert(rng.randint(0, len(words)), rng.choice(bad))
        rows.append((i, " ".join(words), "xx", int(toxic)))
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id bigint, toxic int")
    got = {r.doc_id: r for r in toxicity.score(docs, labels).collect()}
    held = [r for r in rows if __import__("zlib").crc32(str(r[0]).encode()) % 4 == 2]
    assert len(held) > 200
    right = [(got[i].score >= 0.3) == bool(y) for i, _, _, y in held]
    assert np.mean(right) > 0.97
    assert np.mean([got[i].toxic == bool(y) for i, _, _, y in held]) > 0.97


def test_edges(spark):
    docs = spark.createDataFrame(
        [(1, None, "en", 7), (2, "", None, 7), (None, "a b", "zz", 7), (3, "x " * 50_000, "en", 7), (3, "x", "en", 7)],
        "doc_id bigint, text string, lang string, score int",
    )
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    got = toxicity.score(docs, none).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 and r.threshold == 0.3 and not r.toxic for r in got)
    one = spark.createDataFrame([(1, 1), (1, None), (3, 1), (None, 0)], "doc_id bigint, toxic int")
    assert all(r.score > 0.3 for r in toxicity.score(docs, one).collect())
    assert toxicity.score(docs.limit(0), one).count() == 0


def test_windows_stay_in_their_text():
    o = toxicity.Options(bits=4, half=2, filters=3)
    rng = np.random.default_rng(2)
    draw = lambda *shape: rng.normal(size=shape).astype(np.float32)
    model = toxicity.Model(o, draw(2, 16, 2), [draw(w, 4, 3) for w in o.widths], [draw(3) for _ in o.widths], draw(9), draw(1), {})
    sizes = [0, 1, 2, 5, 0, 3]
    texts = toxicity.Texts(rng.integers(0, 16, (2, sum(sizes))).astype(np.int32), np.concatenate([[0], np.cumsum(sizes)]))
    _, _, pooled = toxicity.convolve(model, texts)
    for i, n in enumerate(sizes):
        for k, width in enumerate(o.widths):
            best = np.zeros(3)
            for at in range(texts.bounds[i], texts.bounds[i + 1]):
                y = model.biases[k].astype(float)
                for j in range(min(width, texts.bounds[i + 1] - at)):
                    x = np.concatenate([model.table[h][texts.words[h, at + j]] for h in range(2)])
                    y = y + x @ model.kernels[k][j]
                best = np.maximum(best, y)
            assert np.allclose(pooled[i, k * 3 : k * 3 + 3], best if n else 0, atol=1e-5)


@pytest.mark.skipif(not __import__("os").path.isdir(SF), reason="needs the synthetic tables")
def test_query(spark):
    got = toxicity_scores(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    both = got.join(labels.withColumnRenamed("toxic", "label"), "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.label for r in both]) > 0.9


def test_thresholds_count_all_labelled_rows(spark, monkeypatch):
    rng, rows = Random(4), []
    for i in range(1500):
        words = [f"w{rng.randint(0, 300)}" for _ in range(20)]
        if i % 10 == 0 or i % 7 == 0:
            words.append("snarl")
        rows.append((i, " ".join(words), "xx" if i % 2 else None, int(i % 10 == 0)))
    docs = spark.createDataFrame([r[:3] for r in rows] + [rows[1][:3]], "doc_id bigint, text string, lang string").repartition(5)
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id bigint, toxic int")
    seen, real = [], toxicity.calibrate
    monkeypatch.setattr(toxicity, "calibrate", lambda counts, *rest: seen.append(counts) or real(counts, *rest))
    toxicity.score(docs, labels, options=toxicity.Options(positives=60, negatives=60, epochs=1)).collect()
    usable = [r for r in [*rows, rows[1]] if __import__("zlib").crc32(str(r[0]).encode()) % 4 != 2]
    want = {k: [sum((r[2] or "") == k and r[3] == y for r in usable) for y in (0, 1)] for k in ("", "xx")}
    assert {k: v.sum(axis=1).tolist() for k, v in seen[0].items()} == want


def test_threshold_of_best_f1():
    counts = np.zeros((2, toxicity.BINS), dtype=np.int64)
    counts[0, [100, 700]] = 500, 8
    counts[1, [700, 900]] = 5, 5
    assert toxicity.calibrate({"a": counts, "b": counts * [[1], [0]]}, 0.3) == {"a": (700 + 101) / 2 / toxicity.BINS}


def test_one_row_of_an_id_is_learned_from(spark, monkeypatch):
    rows = [(1, f"snarl w{i}") for i in range(400)] + [(i, f"plain v{i}") for i in range(2, 30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(i == 1)) for i in range(1, 30)], "doc_id bigint, toxic int")
    assert __import__("zlib").crc32(b"1") % 4 != 2
    sizes, real = [], toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda texts, y, *rest: sizes.append((len(y), int(y.sum()))) or real(texts, y, *rest))
    toxicity.score(docs, labels, lang=None).collect()
    usable = [i for i in range(1, 30) if __import__("zlib").crc32(str(i).encode()) % 4 != 2]
    assert sizes[-1] == (len(usable), 1)
