"""Shared pieces: reading a table, hold-out splits, tables written to the shared folder."""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def workers_find_package(spark: SparkSession) -> None:
    """Python workers import this package by the same path as the driver does."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_find_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id counts as empty text."""
    written = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(written.cast("binary")), F.lit(modulus))


@contextmanager
def _settings(spark: SparkSession, conf: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    This cuts the lineage (a lost executor costs no recomputation beyond
    the running stage) and lets Spark drop the shuffle files behind it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with _settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        df.write.option("compression", compression).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = (path, None)
    return out


def stored_by_key(df: DataFrame, key: str, buckets: int, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written once, bucketed on ``key``: later joins and groupings on
    the key move only the other side."""
    spark = df.sparkSession
    path, table = scratch_path(spark, name), f"kontor_{name}_{uuid.uuid4().hex[:12]}".replace("-", "_")
    with _settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        (df.repartition(buckets, key).write.bucketBy(buckets, key).option("path", path)
         .option("compression", compression).format("parquet").saveAsTable(table))
    out = spark.table(table)
    out.stored_at = (path, table)
    return out


def release(*stored_copies: DataFrame) -> None:
    """Deletes what ``stored`` or ``stored_by_key`` wrote, once nothing reads it any more."""
    for df in stored_copies:
        spark, (path, table) = df.sparkSession, df.stored_at
        if table:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, at_most: int, modulus: int = 5,
                    held_out: int = 0) -> DataFrame:
    """(doc_id, text, label, fold) of labelled documents outside the held-out fold.

    ``at_most`` bounds the expected number of labelled rows: above it a
    hash of the id draws them.  The drawn labels are therefore few enough
    to broadcast.  Rows without a label are left out; of several labels of
    one id the largest counts.
    """
    fold = id_remainder(F.col("doc_id"), modulus)
    known = (labels.select("doc_id", F.col(label).cast("int").alias("label")).dropna()
             .withColumn("fold", fold).filter(F.col("fold") != held_out))
    total = known.agg(F.approx_count_distinct("doc_id", 0.02)).first()[0]
    if total > at_most:
        share = int(at_most / total * (1 << 30))
        known = known.filter(F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) < share)
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"), F.first("fold").alias("fold"))
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(known), "doc_id")
