"""Token ids, counts, packing and files against the library and brute force."""

import zlib
from random import Random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scrutin.llm import packing, token_counts, token_files
from scrutin.llm.tokens import encoder

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")
BITS = [
    " ", "  ", "\n", "\n\n", " \n", "\n ", "\t", "\r\n", " ", "\u0085", "\x1c", "\x0b", " ", "<|endoftext|>",
    "<|startoftext|>", "don't", "I'll", "Foo", "bar,", "a.b", "...", "it's.", "12", "3,4", "é", "é", "́", "ΟΔΟΣ",
    "İ", "日本語", "🙂", "#", "x" * 50, "½.", "²,", "​", "$%", "'", ".", ",", "word", "Łódź",
]


def texts(n, seed):
    rng = Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 30))) for _ in range(n)]


@pytest.mark.parametrize("name", FILES)
def test_parts_give_the_ids_of_the_whole(name):
    plain, code = Tokenizer.from_file(public_tokenizers.path(name)), encoder(name)
    for t in texts(6000, 1) + [" ".join(x) for x in zip(texts(500, 2), texts(500, 3), strict=True)]:
        assert np.frombuffer(code.ids(t), "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("name", FILES)
def test_spliced_counts(name):
    plain, code = Tokenizer.from_file(public_tokenizers.path(name)), encoder(name)
    rng = Random(4)
    cases = ["", "x" * 900, " " * 500 + "y", "a " * 700, "\n".join(["ab cd"] * 150)]
    cases += ["".join(rng.choice(BITS) for _ in range(600)) for _ in range(40)]
    for t in cases:
        for chunk, overlap in ((64, 8), (200, 30), (1000, 10)):
            assert token_counts.count_huge(code, t, chunk, overlap) == len(plain.encode(t, add_special_tokens=False)), repr(t)


def rows_of(spark, values):
    return spark.createDataFrame([(i, t, "x", i) for i, t in values], "doc_id bigint, text string, n_tokens string, part int")


def test_count_tokens(spark):
    values = [(1, None), (2, ""), (3, "one two"), (3, "one two"), (None, "é" * 70_000)]
    got = token_counts.count_tokens(rows_of(spark, values), limit=1).collect()
    assert [(r.doc_id, r.n_bytes, r.over_limit, r.part) for r in got] == [
        (1, 0, False, 1), (2, 0, False, 2), (3, 7, True, 3), (3, 7, True, 3), (None, 140_000, True, None)
    ]
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert [r.n_tokens for r in got] == [len(plain.encode(t or "", add_special_tokens=False)) for _, t in values]
    assert token_counts.count_tokens(rows_of(spark, [])).count() == 0


def test_packing_is_a_partition_of_all_ids(spark):
    rng = Random(5)
    values = [(i, " ".join(["word"] * int(rng.paretovariate(0.7)))) for i in range(300)]
    values += [(300, None), (301, ""), (1, "again"), (None, "no key")]
    df = rows_of(spark, values).repartition(5)
    got = packing.pack(df, capacity=32).collect()
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, total = {}, 0
    for doc, t in values:
        ids = plain.encode(t or "", add_special_tokens=False).ids + [1]
        total += len(ids)
        for k, at in enumerate(range(0, len(ids), 32)):
            piece = np.array(ids[at : at + 32], "<u4")
            key = (doc, k, at, len(piece), zlib.crc32(piece.tobytes()))
            want[key] = want.get(key, 0) + 1
    have = {}
    for r in got:
        key = (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
        have[key] = have.get(key, 0) + 1
    assert have == want
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spots in places.values():
        end = 0
        for offset, length in sorted(spots):
            assert offset == end
            end += length
        assert end <= 32
    assert len(places) <= -(-total // 32) + 1
    assert packing.pack(rows_of(spark, [])).count() == 0


def fewest(sizes, capacity):
    """Fewest bins, by trying every choice."""
    best = len(sizes)

    def go(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(sizes):
            best = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + sizes[k] <= capacity:
                bins[i] += sizes[k]
                go(k + 1, bins)
                bins[i] -= sizes[k]
        go(k + 1, [*bins, sizes[k]])

    go(0, [])
    return best


def test_reduction_keeps_the_optimum():
    rng = Random(6)
    for _ in range(150):
        capacity = rng.randint(5, 20)
        sizes = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 9))), reverse=True)
        left = {s: sizes.count(s) for s in sizes}
        fixed = packing.reduce_instance(left, capacity)
        rest = [s for s, n in left.items() for _ in range(n)]
        assert sum(g.bins for g in fixed) + fewest(sorted(rest, reverse=True), capacity) == fewest(sizes, capacity)


def test_files_give_back_every_document(spark, folder):
    rng = Random(7)
    values = [(i, " ".join(["word"] * rng.randint(0, 90))) for i in rng.sample(range(10_000), 400)]
    values += [(50_000, None), (50_001, ""), (50_002, "x y " * 9000), (50_003, "same"), (50_003, "same")]
    df = rows_of(spark, values).repartition(5)
    files = token_files.write_files(df, folder, length=16)
    got = [tuple(r) for r in token_files.read_documents(files, folder).collect()]
    plain, start, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, []
    for doc, t in sorted(values, key=lambda v: v[0]):
        ids = np.array(plain.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(got) == sorted(want)
    name = files.select(F.max_by("name", "n_tokens")).first()[0]
    with token_files.ipc.open_file(token_files.pa.memory_map(f"{folder}/{name}.arrow")) as reader:
        batch = reader.get_batch(reader.num_record_batches - 1)
        assert batch.schema.field("ids").type.list_size == 16
        # The values are read where they lie in the mapped file.
        assert not batch.column("ids").values.to_numpy(zero_copy_only=True).flags.owndata
    assert token_files.token_files(rows_of(spark, [])).count() == 0
