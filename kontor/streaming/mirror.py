"""Delta mirror as a Structured Streaming job.

The numbered delta folders are a file stream: each micro-batch holds the
files that arrived since the last one, the batch number is read from the
file path, and ``foreachBatch`` merges the batch into the mirror with
``merge_newer`` -- keyed on the business key, keeping the newest
``delta_id`` -- so the result does not depend on arrival order.  The
stream's checkpoint (in the shared checkpoint folder) replaces the
high-water mark of the batch job: a restarted query resumes after the
last committed micro-batch, and a micro-batch that failed is replayed.

Each micro-batch writes a new version of the mirror (copy-on-write) and
never overwrites the version it reads; a version counts once its write has
finished, so a failed micro-batch is replayed on the version before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.deltas import merge_newer
from ..sinks.files import drop_old_versions, finish_version, latest_version, next_version
from ..sources.csv import DELTA_DIR_PATTERN


def delta_stream(spark: SparkSession, root: str, schema: T.StructType, sep: str = ";",
                 date_format: str | None = None, max_files_per_trigger: int | None = None,
                 id_col: str = "delta_id") -> DataFrame:
    # a stream has one schema: a file whose header differs from it, or a bad value, fails the batch
    r = spark.readStream.schema(schema).options(header=True, sep=sep, recursiveFileLookup=True,
                                                pathGlobFilter="*.csv", enforceSchema=False, mode="FAILFAST")
    if date_format:
        r = r.option("dateFormat", date_format)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.csv(root)
    batch = F.regexp_extract(F.col("_metadata.file_path"), DELTA_DIR_PATTERN, 1).cast("int")
    return df.select(batch.alias(id_col), *schema.fieldNames())


def run_mirror_stream(spark: SparkSession, deltas_root: str, mirror_root: str, checkpoint: str,
                      schema: T.StructType, pk: Sequence[str], sep: str = ";",
                      date_format: str | None = None, max_files_per_trigger: int | None = None,
                      id_col: str = "delta_id") -> str | None:
    """Process every delta file available now, then stop; returns the mirror's latest version."""
    pk = list(pk)
    mirror_schema = T.StructType([T.StructField(id_col, T.IntegerType())] + list(schema.fields))

    def apply(batch: DataFrame, epoch: int) -> None:
        if batch.isEmpty():
            return
        current = latest_version(spark, mirror_root)
        mirror = (spark.read.schema(mirror_schema).parquet(current) if current
                  else spark.createDataFrame([], mirror_schema))
        merged = merge_newer(mirror, batch.select(*mirror_schema.fieldNames()), pk, id_col)
        out = next_version(spark, mirror_root)
        merged.write.parquet(out)
        finish_version(spark, out)
        drop_old_versions(spark, mirror_root)

    stream = delta_stream(spark, deltas_root, schema, sep, date_format, max_files_per_trigger, id_col)
    q = (stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return latest_version(spark, mirror_root)
