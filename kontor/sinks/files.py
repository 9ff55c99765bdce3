"""File sinks: CSV and Parquet exports, empty clones, versioned tables and
idempotent slice replacement.

Slice replacement (``replace_slices``) reproduces "delete the day, then
insert" with a partitioned table: a dynamic partition overwrite replaces
exactly the partitions present in the new data, and a requested slice
whose new result is *empty* is deleted explicitly (dynamic overwrite would
leave the old rows).  Which slices came out empty is known from an
``Observation`` on the write itself -- no second pass over the data.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, sep: str = ";", header: bool = True, mode: str = "overwrite",
              single_file: bool = False, date_format: str | None = None, encoding: str | None = None) -> str:
    """CSV export.  ``single_file`` (one part file) only for small results."""
    out = df.coalesce(1) if single_file else df
    w = out.write.mode(mode).options(header=header, sep=sep)
    if date_format:
        w = w.option("dateFormat", date_format)
    if encoding:
        w = w.option("encoding", encoding)
    w.csv(path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Iterable[str] | None = None) -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def append_parquet(df: DataFrame, path: str) -> str:
    return write_parquet(df, path, mode="append")


def clone_empty(df: DataFrame) -> DataFrame:
    """Same schema, no rows."""
    return df.sparkSession.createDataFrame([], df.schema)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def _partition_value(v) -> str:
    """Directory value of a partition: dates as yyyy-MM-dd."""
    if isinstance(v, _dt.date) and not isinstance(v, _dt.datetime):
        return v.isoformat()
    return str(v)


@dataclass
class SliceWrite:
    """Outcome of ``replace_slices``: rows written, slices replaced, slices deleted."""
    rows: int
    written: set
    deleted: list


def replace_slices(df: DataFrame, path: str, partition_col: str, slices: Iterable) -> SliceWrite:
    """Replace the given partition values of a table with ``df``'s rows.

    Rows are rebalanced on the slice: adaptive execution splits a large slice
    over as many writers as its bytes ask for and merges small ones.  A row
    outside ``slices`` fails its task, and a failed write commits nothing, so
    no slice is touched.  Which requested slices received rows is observed on
    the write itself (a set bounded by the requested slices); the others are
    deleted.
    """
    slices = list(slices)
    inside = F.coalesce(F.col(partition_col).isin(*slices), F.lit(False))
    refused = F.raise_error(F.concat(F.lit(f"row outside the requested slices of {path}: "),
                                     F.coalesce(F.col(partition_col).cast("string"), F.lit("NULL"))))
    checked = df.withColumn(partition_col, F.when(inside, F.col(partition_col))
                            .otherwise(refused.cast(df.schema[partition_col].dataType)))
    obs = Observation("replace_slices")
    metrics = [F.count(F.lit(1)).alias("_total"), F.collect_set(partition_col).alias("_written")]
    (checked.hint("rebalance", partition_col).observe(obs, *metrics)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path))
    m = obs.get
    written = set(m.get("_written") or [])
    deleted = [v for v in slices if v not in written]
    for v in deleted:
        delete_path(df.sparkSession, f"{path.rstrip('/')}/{partition_col}={_partition_value(v)}")
    return SliceWrite(int(m.get("_total") or 0), written, deleted)


# ---- copy-on-write versions: root/v=N ------------------------------------------

FINISHED = "_finished"  # our own marker: Spark's depends on a setting of the cluster


def finish_version(spark: SparkSession, path: str) -> str:
    """Marks a version whose write has returned; from now on it counts."""
    p, fs = _fs(spark, f"{path.rstrip('/')}/{FINISHED}")
    fs.create(p, True).close()
    return path


def _versions(spark: SparkSession, root: str) -> dict[int, bool]:
    """Version number -> whether its write finished: our marker, or Spark's where the version has none."""
    p, fs = _fs(spark, root)
    if not fs.exists(p):
        return {}
    out = {}
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("v=") and name[2:].isdigit():
            out[int(name[2:])] = any(fs.exists(st.getPath().suffix(f"/{m}")) for m in (FINISHED, "_SUCCESS"))
    return out


def next_version(spark: SparkSession, root: str) -> str:
    """A version folder never used before, finished or not: nothing being read is written over."""
    return f"{root.rstrip('/')}/v={max(_versions(spark, root), default=0) + 1}"


def latest_version(spark: SparkSession, root: str) -> str | None:
    """The newest version whose write finished; a failed write does not count."""
    done = [n for n, finished in _versions(spark, root).items() if finished]
    return f"{root.rstrip('/')}/v={max(done)}" if done else None


def drop_old_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete all but the ``keep`` newest finished versions, and what failed writes
    before the newest one left.  Readers of the version before the newest go on."""
    found = _versions(spark, root)
    done = sorted(n for n, finished in found.items() if finished)
    if not done:
        return []
    gone = [n for n, finished in found.items()
            if (finished and n in done[:-keep]) or (not finished and n < done[-1])]
    paths = [f"{root.rstrip('/')}/v={n}" for n in sorted(gone)]
    for path in paths:
        delete_path(spark, path)
    return paths
