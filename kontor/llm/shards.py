"""Shards: bounded runs of documents that a task works on together.

Operators that look up corpus-wide numbers for each document cut a task's
rows into shards, write what they made of them once, send each shard's
distinct keys through the shuffle and get one number per key back.  Shard
numbers come from the task's partition, so a task run again writes the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import _settings, scratch_path

SHARD_BYTES = 16 << 20  # text bytes of a shard; a longer text is a shard of its own
ROW = 64                # bytes that a row counts besides its text
SMALL_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def shards(batches: Iterator[pa.RecordBatch], text: str, at_most: int = SHARD_BYTES) -> Iterator[tuple[int, pa.Table]]:
    """(shard number, rows) with at most ``at_most`` bytes, or one row."""
    first, k = TaskContext.get().partitionId() << 32, 0
    held, size = [], 0
    for batch in batches:
        start, bytes_before = 0, size
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_pylist()
        for i, n in enumerate(lengths):
            n += ROW
            if bytes_before and bytes_before + n > at_most:
                if i > start:
                    held.append(batch.slice(start, i - start))
                yield first + k, pa.Table.from_batches(held)
                held, start, bytes_before, k = [], i, 0, k + 1
            bytes_before += n
        if start < batch.num_rows:
            held.append(batch.slice(start))
        size = bytes_before
    if held:
        yield first + k, pa.Table.from_batches(held)


def stored_small(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back; Python gets small batches, columns are packed with zstd."""
    path = scratch_path(df.sparkSession, name)
    conf = SMALL_BATCHES | {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    with _settings(df.sparkSession, conf):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
