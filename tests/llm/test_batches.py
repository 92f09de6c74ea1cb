"""Rows that written steps hand to Python workers at once."""

import pyarrow as pa
from pyspark.sql import functions as F

from scrutin.llm.tables import BATCH_BYTES, kept


def test_written_steps_hand_over_few_bytes_at_once(spark):
    def measure(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"bytes": pa.array([batch.nbytes] * batch.num_rows, pa.int64())})

    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    rows = spark.range(0, 2000, 1, 1).select(F.repeat(F.lit("x"), 10_000).alias("text"))
    seen = kept(rows.mapInArrow(measure, "bytes bigint"), "batches")
    assert seen.count() == 2000
    assert seen.agg(F.max("bytes")).first()[0] <= 1.5 * BATCH_BYTES
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
