"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

Words are named by two hashes, each with an embedding table of its own, and a word's vector is both
together: words that share one bucket seldom share the other. Filters of several widths slide over the
words, the largest answer of each filter over the whole text goes to a logistic layer. Embeddings start
from the words' class log-odds, so that the largest answers point at telling words from the first step on.

The model is fitted on a bounded sample of labelled texts on the driver (``Options``); all texts are scored
whole, slice by slice, by tasks. Thresholds by language come from all rows with a usable label, in their true mix. Language, source and id are never inputs of a score; the language of a
row only chooses the threshold that its score is held against.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrutin.llm import text as T
from scrutin.llm.tables import small_batches
from scrutin.llm.workers import emptied


#: Models that thresholds are measured with, and equal ranges of scores that rows are counted in.
FOLDS = 3
BINS = 2000


class Options(NamedTuple):
    """Bounds of the training sample, and the shape and training of the model."""

    #: Labelled texts per class that are learned from, those with the smallest hashes of their ids.
    positives: int = 2000
    negatives: int = 5000
    #: Texts longer than this are scored like all others but not learned from.
    train_bytes: int = 200_000
    bits: int = 17
    half: int = 8
    filters: int = 8
    widths: tuple[int, ...] = (1, 2, 3)
    epochs: int = 8
    batch: int = 64
    rate: float = 0.05
    prior: float = 10.0
    threshold: float = 0.3


class Texts(NamedTuple):
    """Bucket numbers of all words, a column per hash, and where texts begin and end in them."""

    words: np.ndarray
    bounds: np.ndarray


class Model(NamedTuple):
    options: Options
    table: np.ndarray  # (2, buckets, half)
    kernels: list[np.ndarray]  # per width: (width, 2 * half, filters)
    biases: list[np.ndarray]
    weights: np.ndarray
    intercept: np.ndarray
    thresholds: dict[str, float]


def texts_of(piece: T.Slice, bits: int) -> Texts:
    words = T.words(piece, T.LETTERS)
    h = T.word_hashes(piece, words)
    low = h & T.U64((1 << bits) - 1)
    return Texts(np.stack([h >> T.U64(64 - bits), low]).astype(np.int32), words.bounds)


def convolve(model: Model, texts: Texts) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Vectors of the words, answers of the filters at each word by width, and the texts' largest answers.

    A window that passes the end of its text goes on with zeros; a text without words has answers of zero.
    """
    o = model.options
    x = np.concatenate([model.table[0][texts.words[0]], model.table[1][texts.words[1]]], axis=1)
    n, sizes = len(x), np.diff(texts.bounds)
    held = np.flatnonzero(sizes)
    stop = np.repeat(texts.bounds[1:], sizes)
    answers, pooled = [], np.zeros((len(sizes), len(o.widths) * o.filters), dtype=np.float32)
    for k, width in enumerate(o.widths):
        y = x @ model.kernels[k][0] + model.biases[k]
        for j in range(1, width):
            part = x[j:] @ model.kernels[k][j]
            part[np.arange(j, n) >= stop[: n - j]] = 0
            y[: n - j] += part
        np.maximum(y, 0, out=y)
        answers.append(y)
        if len(held):
            pooled[held, k * o.filters : (k + 1) * o.filters] = np.maximum.reduceat(y, texts.bounds[:-1][held], axis=0)
    return x, answers, pooled


def logits(model: Model, texts: Texts) -> np.ndarray:
    return convolve(model, texts)[2] @ model.weights + model.intercept[0]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def take(texts: Texts, rows: np.ndarray) -> Texts:
    sizes = np.diff(texts.bounds)[rows]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(bounds[-1], dtype=np.int32)
    at -= np.repeat((bounds[:-1] - texts.bounds[:-1][rows]).astype(np.int32), sizes)
    return Texts(texts.words[:, at], bounds)


def log_odds(texts: Texts, labels: np.ndarray, o: Options) -> np.ndarray:
    """Smoothed log-odds of the class by bucket, by how many texts of either class hold the bucket."""
    n, share = 1 << o.bits, labels.mean()
    ones, both = np.zeros((2, n)), np.zeros((2, n))
    for i, label in enumerate(labels):
        for k in range(2):
            held = np.unique(texts.words[k, texts.bounds[i] : texts.bounds[i + 1]])
            both[k, held] += 1
            ones[k, held] += label
    rate = (ones + o.prior * share) / (both + o.prior)
    return (np.log(rate / (1 - rate)) - np.log(share / (1 - share))).astype(np.float32)


def fit(texts: Texts, labels: np.ndarray, o: Options, share: float) -> Model:
    """Train on texts and their labels; ``share`` is that of ones among all labels, sampled or not."""
    rng = np.random.default_rng(0)
    dim, total = 2 * o.half, len(o.widths) * o.filters
    table = rng.normal(0, 0.02, (2, 1 << o.bits, o.half)).astype(np.float32)
    kernels = [rng.normal(0, 0.1, (w, dim, o.filters)).astype(np.float32) for w in o.widths]
    biases = [np.zeros(o.filters, dtype=np.float32) for _ in o.widths]
    weights = rng.normal(0, 0.1, total).astype(np.float32)
    intercept = np.array([np.log(max(share, 1e-3) / max(1 - share, 1e-3))], dtype=np.float32)
    model = Model(o, table, kernels, biases, weights, intercept, {})
    if len(labels) < 2 or labels.min() == labels.max():
        weights[:] = 0
        return model
    table[:, :, 0] = log_odds(texts, labels, o) / 4
    for kernel in kernels:
        kernel[0, [0, o.half], : o.filters // 2] = 0.5
    weights.reshape(len(o.widths), o.filters)[:, : o.filters // 2] += 0.2
    intercept[0] = np.log(labels.mean() / (1 - labels.mean()))
    states = [np.full_like(p, 1e-4) for p in (*kernels, *biases, weights, intercept)]
    seen = np.full(table.shape, 1e-4, dtype=np.float32)

    def step(p: np.ndarray, grad: np.ndarray, state: np.ndarray) -> None:
        state += grad * grad
        p -= o.rate * grad / np.sqrt(state)

    for _ in range(o.epochs):
        order = rng.permutation(len(labels))
        for rows in np.array_split(order, max(1, len(order) // o.batch)):
            some = take(texts, rows)
            x, answers, pooled = convolve(model, some)
            error = (sigmoid(pooled @ weights + intercept[0]) - labels[rows]).astype(np.float32) / len(rows)
            back = error[:, None] * weights
            owner = np.repeat(np.arange(len(rows)), np.diff(some.bounds))
            grads = [np.zeros_like(p) for p in (*kernels, *biases)]
            touched, pushed = [], []
            for k, width in enumerate(o.widths):
                cut = slice(k * o.filters, (k + 1) * o.filters)
                at, f = np.nonzero((answers[k] == pooled[:, cut][owner]) & (answers[k] > 0))
                g = back[:, cut][owner[at], f]
                np.add.at(grads[len(kernels) + k], f, g)
                for j in range(width):
                    inside = at + j < some.bounds[1:][owner[at]]
                    i, ff, gg = at[inside] + j, f[inside], g[inside]
                    flat = np.zeros((o.filters, dim), dtype=np.float32)
                    np.add.at(flat, ff, gg[:, None] * x[i])
                    grads[k][j] += flat.T
                    touched.append(i)
                    pushed.append(gg[:, None] * kernels[k][j][:, ff].T)
            i, push = np.concatenate(touched), np.concatenate(pushed)
            for half in range(2):
                bucket, where = np.unique(some.words[half][i], return_inverse=True)
                grad = np.zeros((len(bucket), o.half), dtype=np.float32)
                np.add.at(grad, where, push[:, half * o.half : (half + 1) * o.half])
                seen[half][bucket] += grad * grad
                table[half][bucket] -= o.rate * grad / np.sqrt(seen[half][bucket])
            grads += [pooled.T @ error + 1e-5 * weights, np.array([error.sum()], dtype=np.float32)]
            for p, grad, state in zip((*kernels, *biases, weights, intercept), grads, states, strict=True):
                step(p, grad, state)
    # The sample holds more ones than the corpus.
    odds = labels.mean() / (1 - labels.mean())
    intercept[0] -= np.log(odds / (share / (1 - share)))
    return model


def calibrate(counts: dict[str, np.ndarray], default: float) -> dict[str, float]:
    """Per language the threshold with the best F1, in the middle of its range and within 0.2 to 0.5.

    ``counts`` has, by language, the rows of either label in each of ``BINS`` equal ranges of scores. A language
    without labels of both classes keeps the default.
    """
    found = {}
    for lang, (zeros, ones) in sorted(counts.items()):
        if not zeros.sum() or not ones.sum():
            continue
        held = np.flatnonzero(zeros + ones)[::-1]
        hits = np.cumsum(ones[held])
        k = int(np.argmax(2 * hits / (np.cumsum((zeros + ones)[held]) + ones.sum())))
        low = held[k + 1] + 1 if k + 1 < len(held) else 0
        found[lang] = float(np.clip((held[k] + low) / 2 / BINS, min(0.2, default), max(0.5, default)))
    return found


def usable_labels(labels: DataFrame) -> DataFrame:
    """One row for each id whose label may be used; contradicting labels count as toxic."""
    usable = labels.filter("doc_id is not null and toxic is not null")
    usable = usable.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
    return usable.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))


def score_counts(rows: DataFrame, labels: DataFrame, models: list[Model]) -> dict[str, np.ndarray]:
    """``calibrate``'s counts over all rows with a usable label, each scored by the model that has not seen its text.

    Texts do not move: rows are scored where they are, and their ids with ranges of scores are counted and joined.
    """
    shared = rows.sparkSession.sparkContext.broadcast(models)
    bits = models[0].options.bits

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in emptied(batches):
            folds, at, found = batch["__fold"].to_numpy(), 0, np.zeros(batch.num_rows)
            for piece in T.slices(batch["__text"]):
                texts = texts_of(piece, bits)
                mine = folds[at : at + len(texts.bounds) - 1]
                for fold, model in enumerate(shared.value):
                    held = np.flatnonzero(mine == fold)
                    if len(held):
                        found[at + held] = sigmoid(logits(model, take(texts, held)).astype(np.float64))
                at += len(mine)
            bins = pa.array(np.minimum(found * BINS, BINS - 1).astype(np.int32))
            yield batch.select(["__id", "__lang"]).append_column("__bin", bins)

    fold = F.pmod(F.xxhash64("__text"), F.lit(FOLDS)).cast("int").alias("__fold")
    usable = usable_labels(labels).withColumnsRenamed({"doc_id": "__label_id", "toxic": "__toxic"})
    ids = rows.filter("doc_id is not null").select(F.col("doc_id").alias("__id"), "__lang", "__text", fold)
    kind = rows.schema["doc_id"].dataType.simpleString()
    binned = ids.mapInArrow(ranges, f"__id {kind}, __lang string, __bin int").groupBy("__id", "__lang", "__bin").agg(F.count(F.lit(1)).alias("n"))
    joined = binned.join(usable, F.col("__id") == F.col("__label_id"))
    # At most two rows for each language and range.
    with small_batches(rows.sparkSession):
        got = joined.groupBy("__lang", "__toxic", "__bin").agg(F.sum("n").alias("n")).collect()
    counts: dict[str, np.ndarray] = {}
    for r in got:
        counts.setdefault(r["__lang"] or "", np.zeros((2, BINS), dtype=np.int64))[int(r["__toxic"] > 0), r["__bin"]] += r["n"]
    return counts


def sample(docs: DataFrame, labels: DataFrame, o: Options) -> tuple[DataFrame, float]:
    """Labelled texts to learn from, and the share of ones among all labels that may be used."""
    usable = usable_labels(labels)
    ones, rows = usable.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    parts = [
        usable.filter(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        for k, n in ((1, o.positives), (0, o.negatives))
    ]
    chosen = parts[0].union(parts[1]).withColumnRenamed("toxic", "__toxic").withColumnRenamed("doc_id", "__id")
    # At most positives + negatives ids.
    texts = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("__id")).withColumn("__id", F.col("doc_id"))
    return texts.filter(F.octet_length("__text") <= o.train_bytes), (ones or 0) / rows if rows else 0.0


def train(docs: DataFrame, labels: DataFrame, o: Options, text: str, lang: str | None) -> Model:
    spoken = F.col(lang).cast("string") if lang else F.lit(None).cast("string")
    rows = docs.select(F.col("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"), spoken.alias("__lang"))
    found, share = sample(rows, labels, o)

    kind = rows.schema["doc_id"].dataType.simpleString()

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in emptied(batches):
            cells = []
            for piece in T.slices(batch.column(0)):
                t = texts_of(piece, o.bits)
                cells += [t.words[:, a:b].tobytes() for a, b in zip(t.bounds[:-1], t.bounds[1:], strict=True)]
            yield batch.drop_columns(["__text"]).append_column("words", pa.array(cells, pa.binary()))

    shape = f"__id {kind}, __toxic int, __hash bigint, words binary"
    got = found.select("__text", "__id", "__toxic", F.xxhash64("__text").alias("__hash")).mapInArrow(named, shape)
    # One row for each chosen id, that with the smallest hash.
    got = got.groupBy("__id").agg(F.min(F.struct("__hash", "__toxic", "words")).alias("row")).select("row.*")
    # Two numbers of four bytes for each word of the sample. Copies of a text are learned from once.
    with small_batches(docs.sparkSession):
        got = got.dropDuplicates(["__hash"]).toArrow().sort_by([("__hash", "ascending")])
    y = got["__toxic"].to_numpy().astype(np.float32)
    got_hash = got["__hash"].to_numpy()
    sizes = [len(c) // 8 for c in got["words"].to_pylist()]
    bounds = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    words = np.zeros((2, bounds[-1]), dtype=np.int32)
    for i, cell in enumerate(got["words"]):
        words[:, bounds[i] : bounds[i + 1]] = np.frombuffer(cell.as_buffer() or b"", np.int32).reshape(2, -1)
    texts = Texts(words, bounds)
    del got
    thresholds = {}
    if len(y) and y.min() != y.max():
        # Each text is held out of one model; copies of a text have one hash.
        fold = got_hash % FOLDS
        models = [fit(take(texts, np.flatnonzero(fold != k)), y[fold != k], o, share) for k in range(FOLDS)]
        thresholds = calibrate(score_counts(rows, labels, models), o.threshold)
    return fit(texts, y, o, share)._replace(thresholds=thresholds)


def score(
    docs: DataFrame, labels: DataFrame, text: str = "text", lang: str | None = "lang", options: Options = Options()
) -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``threshold`` (of the row's language) and ``toxic`` (score >= threshold).

    ``labels`` has ``doc_id`` and ``toxic``; labels of ids whose crc32 mod 4 is 2 are never learned from, nor
    are null labels; contradicting labels count as toxic. Without labels of both classes every score is the
    share of ones. Null and empty texts get the score of a text without words; rows with a language that has
    no calibration use ``options.threshold``. All rows are kept; columns of these names are replaced.
    """
    model = train(docs, labels, options, text, lang)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def apply(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in emptied(columns):
            found = [sigmoid(logits(shared.value, texts_of(p, options.bits)).astype(np.float64)) for p in T.slices(column)]
            yield pa.array(np.concatenate(found) if found else np.zeros(0))

    # A handful of languages, as the sample has them.
    names = [F.lit(x) for pair in sorted(model.thresholds.items()) for x in pair]
    own = F.try_element_at(F.create_map(*names), F.col(lang).cast("string")) if names and lang else F.lit(None).cast("double")
    df = docs.withColumn("score", F.arrow_udf(apply, "double").asNondeterministic()(F.col(text).cast("string")))
    df = df.withColumn("threshold", F.coalesce(own, F.lit(options.threshold)))
    return df.withColumn("toxic", F.col("score") >= F.col("threshold"))
