"""Existence and non-emptiness tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def path_exists(spark: SparkSession, path: str) -> bool:
    """Filesystem test through Spark's own Hadoop configuration (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def nonempty_flags(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """(table_name, exists, has_rows) per named Parquet path.

    Existence is a metadata check; ``has_rows`` is computed on the cluster
    from at most one row of each table.
    """
    parts = []
    for name, path in tables.items():
        if path_exists(spark, path):
            one = spark.read.parquet(path).limit(1)
            parts.append(one.agg((F.count(F.lit(1)) > 0).alias("has_rows"))
                         .select(F.lit(name).alias("table_name"), F.lit(True).alias("exists"), "has_rows"))
        else:
            parts.append(spark.range(1).select(F.lit(name).alias("table_name"), F.lit(False).alias("exists"),
                                               F.lit(False).alias("has_rows")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
