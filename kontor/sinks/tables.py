"""Catalog tables bucketed on a join key, for shuffle-free joins.

Form 101 joins accounts, opening balances and the turnover mart on
``account_rk``.  Stored as catalog tables bucketed (and sorted) on that key
with the same bucket count, the three sort-merge joins and the per-account
turnover aggregate need no exchange at all; only the final, tiny group-by
shuffles.  Joins that also carry the report month reuse the same buckets when
``spark.sql.requireAllClusterKeysForCoPartition`` is false.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def save_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int,
                  partition_by: Sequence[str] | None = None, mode: str = "overwrite") -> str:
    """``df`` as catalog table ``name``, bucketed and sorted by ``keys``."""
    w = df.write.mode(mode).format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
    return name
