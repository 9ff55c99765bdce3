"""A literal dimension joined to counts from a fact table.

The source job generates a small dimension from literal rows, counts a
fact table per category, capitalises the dimension's names and keeps
the categories that have a count (left join + NULL drop, which Catalyst
turns into an inner join).  Here the fact table is ``events`` and the
categories are event types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.text import capitalise
from ..operators.aggregates import count_by

# Fixed literal dimension: event types (lower case) and their group.
EVENT_TYPE_ROWS = [
    (1, "view", "browse"),
    (2, "click", "browse"),
    (3, "signup", "account"),
    (4, "login", "account"),
    (5, "purchase", "order"),
    (6, "refund", "order"),
    (7, "error", "system"),
]
EVENT_TYPE_DDL = "row_id BIGINT, event_type STRING, category STRING"


def literal_dimension(spark: SparkSession, rows=EVENT_TYPE_ROWS, ddl: str = EVENT_TYPE_DDL) -> DataFrame:
    return spark.createDataFrame(rows, ddl)


def counts_per(facts: DataFrame, key: str) -> DataFrame:
    """Count per capitalised key (the fact side carries display names)."""
    return count_by(facts.select(capitalise(key).alias(key)), key)


def join_counts(dimension: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    dim = dimension.select(capitalise(key).alias(key), *[c for c in dimension.columns if c != key])
    return dim.join(counts, key, "left").na.drop(subset=["count"])
