"""What Python workers hold between the tasks of different steps."""

from pathlib import Path

import numpy as np
import pyarrow as pa

from scrutin.llm import packing, suffix_dedup, tokens, toxicity


def resident_mb():
    return int(Path("/proc/self/statm").read_text().split()[1]) * 4096 / 2**20


def test_other_steps_let_go_of_encoders():
    spans = pa.array([[]], pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())])))
    runs = {name: np.zeros(1, dtype=np.int64) for name in ("size", "rank", "copies", "sequence", "offset")}
    for step in (
        lambda: suffix_dedup._kept_bytes(iter([(pa.array(["a b"]), spans)])),
        lambda: packing._place(iter([]), runs),
    ):
        tokens.encoder("word_bpe_49k.json").ids("a b")
        list(step())
        assert not tokens._encoders
    assert tokens.encoder("word_bpe_49k.json").ids("a b") and tokens._encoders


def test_freed_memory_goes_back_to_the_system():
    from scrutin.llm.workers import emptied

    held = [bytes(1000) for _ in range(200_000)]
    marks = [held[k] for k in range(0, len(held), 2000)]  # keep the ends of the heap in use
    before = resident_mb()
    del held
    assert list(emptied(iter([1, 2]))) == [1, 2]
    assert before - resident_mb() > 100
    assert marks


def test_training_reads_small_batches(spark, monkeypatch):
    """The actions of the operator, which are no written steps, hand rows over by few bytes too."""
    seen = []
    inside = toxicity.small_batches

    def told(session):
        seen.append(session)
        return inside(session)

    monkeypatch.setattr(toxicity, "small_batches", told)
    texts = ["good words here"] * 20 + ["awful nasty words"] * 20
    docs = spark.createDataFrame([(k, f"{t} {k}", "en") for k, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, int(k >= 20)) for k in range(40)], "doc_id long, toxic int")
    assert toxicity.score(docs, labels).count() == 40
    assert len(seen) == 2
