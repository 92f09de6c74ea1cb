"""Language-model scores by deleted interpolation of word bigrams, unigrams and a uniform share.

The probability of a token is a mixture of maximum-likelihood estimates whose weights depend on how often
the word before it occurred (buckets of doubling frequency). Training documents are parted: counts of the
main part give the estimates by which the tokens of the held-out part are predicted, and expectation
maximisation finds the weights for those; the final estimates count both parts.

Counting: texts are gathered in shards of a bounded size. A shard asks for the counts of its distinct words
and bigrams, once each, in fragments of the key space; a fragment sums what all shards counted and answers
with those counts that differ from the shard's own. So a frequent word costs a row per shard, and a bigram
that occurs in one shard only costs no answer. Words are exact up to 64-bit names; bigrams are told apart by
40 bits within a fragment of about half a million, of which one in two million meets another.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrutin.llm import text as T
from scrutin.llm.tables import kept, partitions

SHARD_BYTES = 2 << 20
FRAGMENT_BYTES = 3 << 20
#: Fold of the training documents (crc32 of the id modulo FOLDS) that only the weights are learned from at first.
FOLDS, SCORED_FOLD, DELETED_FOLD = 10, 0, 1
BUCKETS = 24
#: Bins of an estimate's logarithm, per octave, and octaves below one. The last bin means zero.
FINE, OCTAVES = 4, 40
ITERATIONS = 60
_START, _END = T.U64(0x3C6EF372FE94F82B), T.U64(0xA54FF53A5F1D36F1)
_LOW = T.U64((1 << 40) - 1)


class Totals(NamedTuple):
    """Distinct training words, training tokens, and those of the main part."""

    types: int
    tokens: int
    main: int


class Shard(NamedTuple):
    ids: np.ndarray
    folds: np.ndarray
    tokens: np.ndarray
    before: np.ndarray
    #: The tokens of document i are ``bounds[i]:bounds[i + 1]``.
    bounds: np.ndarray

    def part(self, fold: np.ndarray) -> np.ndarray:
        """For each token, whether its document is picked."""
        return np.repeat(fold, np.diff(self.bounds))


_SHARDS = "shard bigint, ids binary, folds binary, sizes binary, data binary, n bigint"
_ASKED = "frag int, shard bigint, words binary, word_main binary, word_dev binary, low binary, high binary, main binary, dev binary"
_ANSWERS = "shard bigint, frag int, word_at binary, word_main binary, word_dev binary, at binary, main binary, dev binary"
_ZSTD = pa.Codec("zstd", compression_level=1)


def _packed(x: np.ndarray) -> bytes:
    """A cell: small numbers shrink to a fraction before they are shuffled."""
    data = x.tobytes()
    return len(data).to_bytes(8, "little") + _ZSTD.compress(data, asbytes=True) if data else b""


def _unpacked(cell: bytes, kind: type) -> np.ndarray:
    if not cell:
        return np.zeros(0, kind)
    return np.frombuffer(_ZSTD.decompress(cell[8:], int.from_bytes(cell[:8], "little"), asbytes=True), kind)


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of about SHARD_BYTES of text each."""
    number, held, size = TaskContext.get().partitionId() << 32, [], 0

    def row() -> pa.RecordBatch:
        ids = np.concatenate([h[0] for h in held])
        folds = np.concatenate([h[1] for h in held])
        sizes = np.concatenate([h[2] for h in held])
        data = b"".join(h[3] for h in held)
        cells = [[number], [ids.tobytes()], [folds.tobytes()], [sizes.tobytes()], [_ZSTD.compress(data, asbytes=True)], [len(data)]]
        kinds = [pa.int64(), *[pa.binary()] * 4, pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(cells, kinds, strict=True)], names=["shard", "ids", "folds", "sizes", "data", "n"]
        )

    for batch in batches:
        ids = pa.compute.fill_null(batch.column(0), 0).to_numpy()
        folds = batch.column(1).to_numpy().astype(np.int8)
        for piece in T.slices(batch.column(2)):
            rows = slice(piece.first, piece.first + piece.rows)
            held.append((ids[rows], folds[rows], np.diff(piece.offsets), piece.data.tobytes()))
            size += len(piece.data) + 64 * piece.rows
            if size >= SHARD_BYTES:
                yield row()
                held, size, number = [], 0, number + 1
    if held:
        yield row()


def _shard(row: dict) -> Shard:
    sizes = np.frombuffer(row["sizes"], np.int64)
    data = np.frombuffer(_ZSTD.decompress(row["data"], row["n"], asbytes=True), np.uint8) if row["n"] else np.zeros(0, np.uint8)
    piece = T.Slice(0, data, np.concatenate([[0], np.cumsum(sizes)]))
    found = T.words(piece)
    docs = len(sizes)
    tokens = np.full(len(found.start) + docs, _END, dtype=T.U64)
    bounds = found.bounds + np.arange(docs + 1)
    ends = np.zeros(len(tokens), dtype=bool)
    ends[bounds[1:] - 1] = True
    tokens[~ends] = T.word_hashes(piece, found)
    before = np.concatenate([[_START], tokens[:-1]]).astype(T.U64)
    before[bounds[:-1]] = _START
    return Shard(np.frombuffer(row["ids"], np.int64), np.frombuffer(row["folds"], np.int8), tokens, before, bounds)


class Keys(NamedTuple):
    """Distinct keys in order, the key of each token, and where fragments begin in the keys."""

    keys: np.ndarray
    of: np.ndarray
    cuts: np.ndarray


def _words(s: Shard, fragments: int) -> Keys:
    """Words, with the start as a word that stands before each document."""
    both = np.concatenate([s.tokens, np.full(len(s.ids), _START, dtype=T.U64)])
    keys, of = np.unique(both, return_inverse=True)
    frag = ((keys >> T.U64(40)) * T.U64(fragments)) >> T.U64(24)
    return Keys(keys, of, np.searchsorted(frag, np.arange(fragments + 1).astype(T.U64)))


def _bigrams(s: Shard, fragments: int) -> Keys:
    key = T.mix(T.mix(s.before) * T.U64(0x9E3779B97F4A7C15) + s.tokens)
    frag = ((key >> T.U64(40)) * T.U64(fragments)) >> T.U64(24)
    keys, of = np.unique(frag << T.U64(40) | key & _LOW, return_inverse=True)
    return Keys(keys, of, np.searchsorted(keys >> T.U64(40), np.arange(fragments + 1).astype(T.U64)))


def _parts(s: Shard) -> tuple[np.ndarray, np.ndarray]:
    """Whether each document is counted in the main and in the deleted part."""
    dev = s.folds == DELETED_FOLD
    return (s.folds != SCORED_FOLD) & ~dev, dev


def _local(k: Keys, s: Shard, fold: np.ndarray, starts: bool) -> np.ndarray:
    weight = s.part(fold)
    weight = np.concatenate([weight, fold]) if starts else weight
    return np.bincount(k.of, weights=weight, minlength=len(k.keys)).astype(np.uint32)


def _ask(fragments: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                s = _shard(row)
                w, b = _words(s, fragments), _bigrams(s, fragments)
                main, dev = _parts(s)
                wm, wd = _local(w, s, main, True), _local(w, s, dev, True)
                bm, bd = _local(b, s, main, False), _local(b, s, dev, False)
                low, high = (b.keys & T.U64(0xFFFFFFFF)).astype(np.uint32), ((b.keys & _LOW) >> T.U64(32)).astype(np.uint8)
                cells: dict[str, list] = {"frag": [], "shard": []}
                arrays = {"words": (w, w.keys), "word_main": (w, wm), "word_dev": (w, wd)}
                arrays |= {"low": (b, low), "high": (b, high), "main": (b, bm), "dev": (b, bd)}
                some = np.flatnonzero((np.diff(w.cuts) > 0) | (np.diff(b.cuts) > 0)).tolist()
                cells = {name: [_packed(x[k.cuts[f] : k.cuts[f + 1]]) for f in some] for name, (k, x) in arrays.items()}
                columns = [pa.array(some, pa.int32()), pa.array([row["shard"]] * len(some), pa.int64())]
                columns += [pa.array(c, pa.binary()) for c in cells.values()]
                yield pa.RecordBatch.from_arrays(columns, names=["frag", "shard", *cells])

    return run


def _summed(keys: list[np.ndarray], main: list[bytes], dev: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[tuple[bytes, bytes, bytes]]]:
    """Sums over all shards by key, and for each shard where they differ from its own counts."""
    every = np.concatenate(keys)
    m, d = (np.concatenate([_unpacked(c, np.uint32) for c in cells]) for cells in (main, dev))
    _, of = np.unique(every, return_inverse=True)
    total_main, total_dev = np.bincount(of, weights=m), np.bincount(of, weights=d)
    all_main, all_dev = total_main[of].astype(np.int64), total_dev[of].astype(np.int64)
    changed = (all_main != m) | (all_dev != d)
    out, at = [], 0
    for k in keys:
        here = slice(at, at + len(k))
        where = np.flatnonzero(changed[here])
        gaps = np.diff(where, prepend=0).astype(np.uint32)
        out.append((_packed(gaps), _packed(all_main[here][where]), _packed(all_dev[here][where])))
        at += len(k)
    return total_main, total_dev, out


def _answer(table: pa.Table) -> pa.Table:
    col = {c: table[c].to_pylist() for c in table.column_names}
    words = [_unpacked(x, T.U64) for x in col["words"]]
    main, dev, answers = _summed(words, col["word_main"], col["word_dev"])
    bigrams = [
        _unpacked(h, np.uint8).astype(T.U64) << T.U64(32) | _unpacked(x, np.uint32).astype(T.U64)
        for h, x in zip(col["high"], col["low"], strict=True)
    ]
    _, _, pairs = _summed(bigrams, col["main"], col["dev"])
    # The start is no token.
    real = np.unique(np.concatenate(words)) != _START
    totals = np.array([((main + dev > 0) & real).sum(), (main + dev)[real].sum(), main[real].sum()], dtype=np.int64)
    frag = col["frag"][0]
    rows = [(s, frag, *a, *p) for s, a, p in zip(col["shard"], answers, pairs, strict=True)]
    rows.append((-1, frag, totals.tobytes(), b"", b"", b"", b"", b""))
    names = ["shard", "frag", "word_at", "word_main", "word_dev", "at", "main", "dev"]
    kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 6]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _counts(k: Keys, own: tuple[np.ndarray, np.ndarray], answers: pa.Table, names: tuple[str, str, str]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of all keys in the main and the deleted part of the corpus."""
    main, dev = own[0].astype(np.int64), own[1].astype(np.int64)
    at, m, d = (answers[c].to_pylist() for c in names)
    for f, places, x, y in zip(answers["frag"].to_pylist(), at, m, d, strict=True):
        where = k.cuts[f] + np.cumsum(_unpacked(places, np.uint32), dtype=np.int64)
        main[where], dev[where] = _unpacked(x, np.int64), _unpacked(y, np.int64)
    return main, dev


class Counted(NamedTuple):
    """Per token: how often its bigram, the word before it and itself occurred, by part (main, dev)."""

    pair: tuple[np.ndarray, np.ndarray]
    context: tuple[np.ndarray, np.ndarray]
    word: tuple[np.ndarray, np.ndarray]


def _counted(s: Shard, answers: pa.Table, fragments: int) -> Counted:
    w, b = _words(s, fragments), _bigrams(s, fragments)
    main, dev = _parts(s)
    words = _counts(w, (_local(w, s, main, True), _local(w, s, dev, True)), answers, ("word_at", "word_main", "word_dev"))
    pairs = _counts(b, (_local(b, s, main, False), _local(b, s, dev, False)), answers, ("at", "main", "dev"))
    of, start = w.of[: len(s.tokens)], w.of[-1]
    before = np.concatenate([[start], of[:-1]])
    before[s.bounds[:-1]] = start
    pick = lambda x, at: (x[0][at], x[1][at])
    return Counted(pick(pairs, b.of), pick(words, before), pick(words, of))


def bucket_of(count: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the whole part of its binary logarithm."""
    return np.minimum(np.frexp(count.astype(np.float64))[1], BUCKETS - 1)


def _bin(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        at = np.rint(-FINE * np.log2(p))
    return np.where(p > 0, np.minimum(at, FINE * OCTAVES - 1), FINE * OCTAVES).astype(np.int64)


def _estimates(pair: np.ndarray, context: np.ndarray, word: np.ndarray, tokens: int) -> tuple[np.ndarray, np.ndarray]:
    return pair / np.maximum(context, 1), word / max(tokens, 1)


def learn_weights(histogram: list[tuple[int, int, int, int]], types: int) -> np.ndarray:
    """Weights of bigram, unigram and uniform share by bucket, by expectation maximisation.

    ``histogram`` has (bucket, bin of the bigram estimate, bin of the unigram estimate, tokens). Buckets
    without tokens take the weights of the nearest bucket below that has some; unseen contexts have no
    bigram share.
    """
    value = np.append(2.0 ** (-np.arange(FINE * OCTAVES) / FINE), 0.0)
    weights = np.tile([0.4, 0.5, 0.1], (BUCKETS, 1))
    weights[0] = [0.0, 0.9, 0.1]
    rows = np.array(histogram, dtype=np.int64).reshape(-1, 4)
    for k in range(BUCKETS):
        mine = rows[rows[:, 0] == k]
        if not len(mine):
            weights[k] = weights[k - 1] if k > 1 else weights[k]
            continue
        p = np.stack([value[mine[:, 1]], value[mine[:, 2]], np.full(len(mine), 1 / (types + 1))], axis=1)
        for _ in range(ITERATIONS):
            share = p * weights[k]
            share /= share.sum(axis=1, keepdims=True)
            weights[k] = (share * mine[:, 3:]).sum(axis=0) / mine[:, 3].sum()
        # No share falls to zero, so that no token of positive probability gets none.
        weights[k, 2] = max(weights[k, 2], 1e-6)
        weights[k] /= weights[k].sum()
    return weights


class Model(NamedTuple):
    totals: Totals
    weights: np.ndarray
    answers: DataFrame
    shards: DataFrame
    fragments: int


def _predictions(fragments: int, totals: Totals):
    """Of the tokens of the deleted part, how often each combination of bucket and estimates occurs."""

    def run(key, answers: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[np.ndarray] = []
        for row in rows.to_pylist():
            s = _shard(row)
            mine = s.part(_parts(s)[1])
            if not mine.any():
                continue
            c = _counted(s, answers, fragments)
            pair, context, word = (x[0][mine] for x in c)
            p2, p1 = _estimates(pair, context, word, totals.main)
            out.append(np.stack([bucket_of(context), _bin(p2), _bin(p1)], axis=1))
        found, n = np.unique(np.concatenate(out), axis=0, return_counts=True) if out else (np.zeros((0, 3), np.int64), np.zeros(0, np.int64))
        return pa.table({"bucket": found[:, 0], "p2": found[:, 1], "p1": found[:, 2], "n": n.astype(np.int64)})

    return run


def train(docs: DataFrame, text: str = "text", key: str = "doc_id") -> Model:
    """Count all texts whose id's crc32 modulo 10 is not 0 (null ids too) and learn the weights."""
    spark = docs.sparkSession
    fold = F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS, F.lit(-1)).cast("int")
    rows = docs.select(F.col(key).cast("bigint").alias("id"), fold.alias("fold"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    shards = kept(rows.mapInArrow(_gather, _SHARDS), "lm-shards")
    size = shards.agg(F.sum("n")).first()[0] or 0
    fragments = max(partitions(spark), size // FRAGMENT_BYTES + 1)
    answers = kept(shards.mapInArrow(_ask(fragments), _ASKED).groupBy("frag").applyInArrow(_answer, _ANSWERS), "lm-counts")
    # One small row per fragment.
    sums = [np.frombuffer(r["word_at"], np.int64) for r in answers.filter("shard = -1").select("word_at").collect()]
    totals = Totals(*(int(x) for x in np.sum(sums, axis=0))) if sums else Totals(0, 0, 0)
    told = answers.filter("shard >= 0").groupBy("shard").cogroup(shards.groupBy("shard"))
    seen = told.applyInArrow(_predictions(fragments, totals), "bucket bigint, p2 bigint, p1 bigint, n bigint")
    # At most buckets times bins times bins.
    histogram = [tuple(r) for r in kept(seen.groupBy("bucket", "p2", "p1").agg(F.sum("n").alias("n")), "lm-estimates").collect()]
    return Model(totals, learn_weights(histogram, totals.types), answers, shards, fragments)


def score(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Tokens are the words between ASCII white space, A-Z in lower case, and one end. ``base_score`` is the
    sum of log10((c + 0.1) / (N + 0.1 (V + 1))), ``score`` the model's log10 probability of the text. Null
    and empty texts are an end alone; repeated rows count as often as they occur; null ids are learned from.
    Without training texts every estimate is the uniform share.
    """
    model = train(docs, text, key)
    totals, weights, fragments = model.totals, model.weights, model.fragments

    def run(_, answers: pa.Table, rows: pa.Table) -> pa.Table:
        tables = []
        for row in rows.to_pylist():
            s = _shard(row)
            pair, context, word = (x[0] + x[1] for x in _counted(s, answers, fragments))
            p2, p1 = _estimates(pair, context, word, totals.tokens)
            w = weights[bucket_of(context)]
            p = w[:, 0] * p2 + w[:, 1] * p1 + w[:, 2] / (totals.types + 1)
            base = np.log10((word + 0.1) / (totals.tokens + 0.1 * (totals.types + 1)))
            per_doc = lambda x, at=s.bounds: np.add.reduceat(x, at[:-1])
            tables.append(
                pa.table(
                    {
                        "doc_id": pa.array(s.ids, mask=s.folds < 0),
                        "held_out": s.folds == SCORED_FOLD,
                        "n_tokens": np.diff(s.bounds),
                        "n_known": per_doc((word > 0).astype(np.int64)),
                        "base_score": per_doc(base),
                        "score": per_doc(np.log10(p)),
                    }
                )
            )
        return pa.concat_tables(tables)

    told = model.answers.filter("shard >= 0").groupBy("shard").cogroup(model.shards.groupBy("shard"))
    shape = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    scored = told.applyInArrow(run, shape).withColumn("train_tokens", F.lit(totals.tokens).cast("bigint"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
