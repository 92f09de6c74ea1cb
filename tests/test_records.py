"""Records with line breaks from blocks of files, against the csv module of the standard library."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from scrutin.sources import lines as L
from scrutin.sources import records as R


def cell(rng):
    kind = rng.random()
    text = "".join(rng.choice(["a", "b", "é", ";", "\n", '"', " ", "word "]) for _ in range(rng.randint(0, 12)))
    if kind < 0.25:
        return '"' + text.replace('"', '""') + '"'
    if kind < 0.3:
        return '"' + "line\n" * rng.randint(3, 40) + '"'
    return text.replace(";", "").replace("\n", "").strip('"')


def make(rng, rows):
    return "".join(";".join(["r", *(cell(rng) for _ in range(rng.randint(1, 4)))]) + "\n" for _ in range(rows))


def wanted(texts):
    out = []
    for text in texts.values():
        out += [tuple(r) for r in csv.reader(io.StringIO(text, newline=""), delimiter=";") if r]
    return sorted(out)


def read(spark, folder, block, width=5):
    rows = L.quoted(R.records(L.read_lines(spark, folder, "utf-8", block)), width)
    empty = lambda x: F.coalesce(x, F.lit(""))
    found = rows.select(F.transform(F.slice("fields", F.lit(1), F.col("present")), empty).alias("f")).collect()
    return sorted(tuple(r.f) for r in found)


@pytest.mark.parametrize("block", [50, 333, 4096, 1 << 20])
def test_equals_the_csv_module_at_every_block_size(spark, folder, block):
    rng = random.Random(11)
    texts = {f"f{k}.csv": make(rng, n) for k, n in enumerate((60, 1, 25))}
    texts["plain.csv"] = "".join(f'r;{k};a"b\n' for k in range(50))
    # A quote that is open at the end of its file, a file that ends inside a long record, and one that begins with one.
    texts["open.csv"] = 'r;1\nr;"never closed;x\nlast'
    texts["long.csv"] = 'r;"' + "x;y\n" * 300 + '"\nr;2'
    texts["first.csv"] = 'r;"a\nb";c\nr;"";""""\n'
    for name, text in texts.items():
        with open(f"{folder}/{name}", "w", encoding="utf-8", newline="") as out:
            out.write(text)
    assert read(spark, folder, block) == wanted(texts)
    lines = L.read_lines(spark, folder, "utf-8", block)
    if block < 1000:
        # More tasks than files: no file is read by one task because of its line breaks.
        assert lines.rdd.getNumPartitions() > 2 * len(texts)
        heads = R.records(lines).select("file", "block", "row").distinct().count()
        assert heads == len(wanted(texts))


def test_clean_files_are_left_as_they_are(spark, folder):
    with open(f"{folder}/a.csv", "w") as out:
        out.write('a;"b;c"\nd;e"f\n"";x\n')
    lines = L.read_lines(spark, folder, "utf-8")
    assert R.records(lines) is lines


def test_a_quote_that_never_ends_is_refused(spark, folder):
    with open(f"{folder}/a.csv", "w") as out:
        out.write('a;"b\n' + "line\n" * 200)
    lines = L.read_lines(spark, folder, "utf-8", 300)
    with pytest.raises(R.OpenQuoteError, match="201 lines"):
        R.records(lines, max_lines=100)
    assert R.records(lines, max_lines=201).count() == 1


def test_shuffled_positions_give_the_same(spark, folder, monkeypatch):
    rng = random.Random(5)
    texts = {"a.csv": make(rng, 80)}
    with open(f"{folder}/a.csv", "w", encoding="utf-8", newline="") as out:
        out.write(texts["a.csv"])
    monkeypatch.setattr(R, "BROADCAST_LINES", 0)
    assert read(spark, folder, 200) == wanted(texts)


def test_maps_compose(spark):
    kinds = [(False, False), (False, True), (True, False), (True, True)]
    rng = random.Random(1)
    rows, want = [], {}
    for group in range(6):
        out = {0: False, 1: True}
        for k in range(40):
            want[group, k] = (out[0], out[1])
            o, i = kinds[rng.choice([1, 1, 1, 2, 2, 0, 3]) if group else 1]
            out = {s: (i if v else o) for s, v in out.items()}
            rows.append((group, k, o, i))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g int, k int, o boolean, i boolean")
    got = {(r.g, r.k): (r.s0, r.s1) for r in R.with_states(df, ["g"], "k", "o", "i").collect()}
    assert got == want


def test_lines_of_records_are_told_apart_without_their_paths(spark, folder, monkeypatch):
    rng = random.Random(7)
    texts = {"a.csv": make(rng, 80), "plain.csv": "r;1\n" * 100}
    for name, text in texts.items():
        with open(f"{folder}/{name}", "w", encoding="utf-8", newline="") as out:
            out.write(text)
    found = R.records(L.read_lines(spark, folder, "utf-8", 200))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # Once by file and block, then by one number for 64 lines.
    assert "__lines" in plan and "head_row" not in plan
    # Neither do other sizes that are joined otherwise change the records.
    monkeypatch.setattr(R, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(R, "BROADCAST_LINES", 0)
    assert read(spark, folder, 200) == wanted(texts)
