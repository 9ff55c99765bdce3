"""Grouping operators.  All are hash aggregates with map-side partial
aggregation, so a key holding a third of the rows is collapsed on the map
side before anything is shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _not_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def collapse_by_key(df: DataFrame, keys: Sequence[str], measures: Sequence[str],
                    cast_to: str | None = None) -> DataFrame:
    """Sum measures per key; rows with a NULL key are dropped (a key column
    can not hold NULL).  One row per key, ready for a keyed upsert."""
    aggs = []
    for m in measures:
        s = F.sum(m)
        aggs.append((s.cast(cast_to) if cast_to else s).alias(m))
    return df.filter(_not_null(keys)).groupBy(*keys).agg(*aggs)


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Whole-row duplicate removal (an aggregate on all columns)."""
    return df.dropDuplicates()


def count_by(df: DataFrame, key: str | Column, name: str = "count") -> DataFrame:
    key_col = F.col(key) if isinstance(key, str) else key
    return df.groupBy(key_col).agg(F.count(F.lit(1)).alias(name))


def max_or_default(df: DataFrame, column: str, default=0, name: str | None = None) -> DataFrame:
    """One-row frame: max(column), or ``default`` when there are no rows."""
    return df.agg(F.coalesce(F.max(column), F.lit(default)).alias(name or f"max_{column}"))
