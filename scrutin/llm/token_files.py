"""Token ids in Arrow files: fixed-size lists of equal-length sequences and their masks.

Documents are dealt out by key ranges, and each task writes the ids of its range as one stream, cut into
sequences of ``length`` ids; the mask is false behind the last id of a file. Ids take the smallest unsigned
type that holds the vocabulary. A file of the places of documents lies beside each file of sequences, so any
document or sequence is read by mapping the file, without decoding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyarrow import fs, ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrutin.llm.tables import kept, partitions
from scrutin.llm.tokens import encoder
from scrutin.scratch import new_path

LENGTH = 2048
END_ID = 2
BATCH_SEQUENCES = 256


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder, and the folder's path there."""
    if uri.startswith("file:"):
        uri = "file:///" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def _schema(length: int, ids: pa.DataType) -> pa.Schema:
    return pa.schema([("ids", pa.list_(ids, length)), ("mask", pa.list_(pa.bool_(), length))])


INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class _Sequences:
    """Writes a stream of ids as sequences of one length."""

    def __init__(self, sink, length: int, kind: np.dtype):
        self.length, self.kind, self.waiting, self.n = length, kind, [], 0
        self.schema = _schema(length, pa.from_numpy_dtype(kind))
        self.writer = ipc.new_file(sink, self.schema)

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids.astype(self.kind))
        self.n += len(ids)
        if self.n >= BATCH_SEQUENCES * self.length:
            self.flush(self.n - self.n % (BATCH_SEQUENCES * self.length))

    def flush(self, n: int) -> None:
        """Write the first ``n`` waiting ids; the last sequence is padded."""
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, self.kind)
        self.waiting, self.n = [ids[n:]], self.n - n
        for at in range(0, n, BATCH_SEQUENCES * self.length):
            some = ids[at : min(n, at + BATCH_SEQUENCES * self.length)]
            padded = -(-len(some) // self.length) * self.length
            mask = np.zeros(padded, dtype=bool)
            mask[: len(some)] = True
            columns = (np.pad(some, (0, padded - len(some))), mask)
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(c), self.length) for c in columns]
            self.writer.write_batch(pa.record_batch(lists, schema=self.schema))

    def close(self) -> None:
        self.flush(self.n)
        self.writer.close()


def write_files(
    docs: DataFrame,
    folder: str,
    text: str = "text",
    tokenizer: str = "byte_bpe_50k.json",
    end_id: int = END_ID,
    length: int = LENGTH,
    key: str = "doc_id",
) -> DataFrame:
    """Write all documents in ascending order of ``key`` below ``folder``; one row per file.

    Columns ``part`` (order of the files), ``name``, ``n_docs``, ``n_tokens``. Null and empty texts hold
    the end id alone; null keys come first; rows of one key are ordered by a hash of their texts. A lost
    task writes under another name, and only the files that are named in the result count.
    """
    end = np.array([end_id], dtype=np.uint32)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer)
        size = max(code.tokenizer.get_vocab_size() - 1, end_id)
        kind = np.dtype(np.uint16 if size < 1 << 16 else np.uint32)
        task = TaskContext.get()
        name = f"{task.partitionId():06d}-{task.taskAttemptId()}"
        files, path = opened(folder)
        files.create_dir(path, recursive=True)
        places, start, docs_written = [], 0, 0
        with files.open_output_stream(f"{path}/{name}.arrow") as out, files.open_output_stream(f"{path}/{name}.index.arrow") as at:
            sequences = _Sequences(out, length, kind)
            index = ipc.new_file(at, INDEX)
            for batch in batches:
                for doc, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    ids = np.concatenate([np.frombuffer(code.ids(value.as_py() or ""), "<u4"), end])
                    sequences.add(ids)
                    places.append((doc, start, len(ids)))
                    start += len(ids)
                docs_written += len(places)
                columns = zip(*places, strict=True) if places else [[]] * 3
                index.write_batch(pa.record_batch([pa.array(c, pa.int64()) for c in columns], schema=INDEX))
                places = []
            sequences.close()
            index.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([task.partitionId()], pa.int32()), pa.array([name]), pa.array([docs_written]), pa.array([start])],
            names=["part", "name", "n_docs", "n_tokens"],
        )

    n = partitions(docs.sparkSession)
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text"))
    order = [F.col("key").asc_nulls_first(), F.xxhash64("text").asc()]
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    written = kept(dealt.mapInArrow(write, "part int, name string, n_docs bigint, n_tokens bigint"), "token-files")
    return written.filter("n_docs > 0")


def read_documents(manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids_crc32`` from the files."""

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = opened(folder)
        for batch in batches:
            for name, before in zip(batch.column("name").to_pylist(), batch.column("before").to_pylist(), strict=True):
                with files.open_input_file(f"{path}/{name}.arrow") as source, files.open_input_file(f"{path}/{name}.index.arrow") as at:
                    sequences, index = ipc.open_file(source), ipc.open_file(at)
                    held, ids, base = -1, np.zeros(0, np.uint16), 0
                    for k in range(index.num_record_batches):
                        places = index.get_batch(k)
                        sums = []
                        for start, n in zip(places.column("start").to_pylist(), places.column("n_tokens").to_pylist(), strict=True):
                            total, now = 0, start
                            while now < start + n:
                                while now >= base + len(ids):
                                    base, held = base + len(ids), held + 1
                                    ids = sequences.get_batch(held).column("ids").values.to_numpy()
                                some = ids[now - base : start + n - base]
                                total = zlib.crc32(some.astype("<u4").tobytes(), total)
                                now += len(some)
                            sums.append(total)
                        starts = pa.array(places.column("start").to_numpy() + before)
                        yield pa.RecordBatch.from_arrays(
                            [places.column("doc_id"), starts, places.column("n_tokens"), pa.array(sums, pa.int64())],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    spark = manifest.sparkSession
    # One row per file, of which there are as many as partitions.
    rows = sorted(manifest.select("part", "name", "n_tokens").collect())
    before = [0, *accumulate(r["n_tokens"] for r in rows)]
    listed = spark.createDataFrame([(r["name"], b) for r, b in zip(rows, before, strict=False)], "name string, before bigint")
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return listed.repartition(max(1, len(rows))).mapInArrow(load, schema)


def token_files(docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write the files (below ``folder``, else in the shared folder) and return the documents read from them."""
    folder = folder or new_path(docs.sparkSession, "token-sequences")
    return read_documents(write_files(docs, folder, **options), folder)
