"""Broadcast only what was measured.

Catalyst's estimate does not see through an explode, a filter or Parquet's
compression, so no broadcast is forced by it: rows and text bytes are counted
(``size_metrics``) on a job that runs anyway.  A dimension that is to be
broadcast whatever the fact table's size is *staged*: written once to the
shared scratch folder while it is counted on the write itself.
``measured_broadcast`` marks the staged copy for broadcast only when those
bytes are under the limit; beyond it the join stays a shuffle join.  Staging
also means the dimension's lineage runs once, not once to measure and once to
join.

The other way round, a table that grows with the data (accounts, balances,
turnover, the keys of a large batch) is marked by ``by_merge``: millions of
its rows are a few MB of Parquet, which Catalyst would broadcast on its own and
build whole in the driver's memory.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path, shuffles_dropped

DEFAULT_BROADCAST_LIMIT = 64 * 1024 * 1024
ROW_OVERHEAD = 32  # bytes of a row beside its values, in a broadcast hash table
STORED = "zstd"  # codec of what is staged or kept in the detail layer and the marts
PART_ROWS = 64_000_000  # rows of a slice table that are shuffled at once: some 1 to 1.5 GB of shuffle files


def size_metrics(df: DataFrame) -> list[Column]:
    """Rows and text bytes, as aggregates for an ``Observation`` (see ``size_of``)."""
    text = [F.octet_length(F.col(f"`{f.name}`")) for f in df.schema.fields
            if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    texts = sum((F.coalesce(c, F.lit(0)) for c in text), F.lit(0)).cast("long")
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(texts), F.lit(0)).alias("text")]


def size_of(metrics: dict, columns: int) -> int:
    """Uncompressed bytes of that many rows and text bytes in a broadcast hash table."""
    return int(metrics["rows"]) * (ROW_OVERHEAD + 16 * columns) + int(metrics["text"])


def measured_bytes(df: DataFrame) -> int:
    """One aggregate over ``df``; for frames that no other job counts."""
    with shuffles_dropped(df.sparkSession):
        return size_of(df.agg(*size_metrics(df)).first().asDict(), len(df.columns))


def parts_of(rows: Mapping, limit: int) -> list[list]:
    """The keys in their order, cut into runs of at most ``limit`` rows together; one with more is a run of its own."""
    runs: list[list] = []
    n = 0
    for key in sorted(rows):
        if not runs or n + rows[key] > limit:
            runs.append([])
            n = 0
        runs[-1].append(key)
        n += rows[key]
    return runs


class Staged(NamedTuple):
    df: DataFrame
    size: int   # uncompressed bytes
    path: str   # to be deleted by jobs that are done with it


def stage(df: DataFrame, name: str = "staged") -> Staged:
    """``df`` written to the shared scratch folder and read back, and its uncompressed bytes."""
    spark = df.sparkSession
    obs = Observation(name)
    path = scratch_path(spark, name)
    with shuffles_dropped(spark):
        df.observe(obs, *size_metrics(df)).write.option("compression", STORED).parquet(path)
    size = size_of(obs.get, len(df.columns))
    return Staged(spark.read.schema(df.schema).parquet(path), size, path)


def by_merge(df: DataFrame) -> DataFrame:
    """``df``, to be joined by a sort-merge join and never broadcast for the small files it has."""
    return df.hint("merge")


def measured_broadcast(df: DataFrame, limit: int = DEFAULT_BROADCAST_LIMIT, name: str = "dimension") -> DataFrame:
    staged = stage(df, name)
    return F.broadcast(staged.df) if staged.size <= limit else staged.df
