"""A corpus made ready for training: clean of toxic texts, copies, repeated passages and benchmark items, then packed.

``STAGES`` are pairs of a name and a function of (spark, docs, folder of tables). Each works on all documents
that the one before kept, and all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrutin.llm import decontaminate, ngram_join, packing, suffix_dedup, toxicity
from scrutin.llm.tables import kept, read

_ROW = "__row"


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents below the threshold of their language; labels are learned from by the operator's rule."""
    scored = toxicity.score(docs, read(spark, folder, "labels"))
    return scored.filter(~F.col("toxic")).select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The document with the smallest id of each group of near copies: five-word shingles, 80 % Jaccard.

    Documents without words all stay. Of documents with one id, the first row stays; a null id comes after all others.
    """
    rows = kept(docs.withColumn(_ROW, F.monotonically_increasing_id()), "pipeline-rows")
    groups = ngram_join.jaccard_groups(rows, n=5, percent=80, key=_ROW).withColumnRenamed("doc_id", _ROW)
    members = kept(groups.join(rows.select(_ROW, "doc_id"), _ROW), "pipeline-groups")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", _ROW)).alias("first")
    keepers = members.groupBy("component_id").agg(first).select(F.col(f"first.{_ROW}").alias(_ROW))
    others = members.select(_ROW).join(keepers, _ROW, "left_anti")
    return rows.join(others, _ROW, "left_anti").select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without the bytes of strings of 200 that start at two places; characters cut in part go too.

    All documents stay, an entirely repeated one with an empty text. ``n_chars`` is that of the new text.
    """
    found = suffix_dedup.remove_repeats(docs)
    cut = found.withColumn("text", F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        chars = F.when(F.col("n_removed") > 0, F.char_length("text").cast(kind)).otherwise(F.col("n_chars"))
        cut = cut.withColumn("n_chars", chars)
    return cut.select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents of which fewer than one word in twenty lies in a 13-word window of a benchmark item."""
    found = decontaminate.decontaminate(docs, read(spark, folder, "benchmark"))
    return found.filter(~F.col("contaminated")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Places of all documents' pieces in sequences of at most 4096 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", keep_one_of_each_group),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack_sequences),
]

#: Trained models, tokenizer files and byte strings have no SQL; the tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again before the next."""
    docs = read(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, folder), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, folder)
