"""A mirror stored by buckets of its key, of which a MERGE rewrites the touched ones only.

Rows go to bucket ``pmod(xxhash64(key), buckets)``; each bucket is a slice of a
``SliceTable``.  A batch is hashed alike and stored by bucket, and its rows and
text bytes are counted per bucket (one row per bucket reaches the driver).
Touched buckets are taken together as long as their part of the batch stays
under the broadcast limit: such a group reads only its buckets of the mirror,
streams them past the broadcast part, and writes them beside the old ones, so
the mirror is neither shuffled nor sorted by key, however large the batch as a
whole is.  (A single bucket whose part alone is over the limit is merged by a
shuffle of that bucket; more buckets avoid it.)  One commit switches all of
them; the files of other buckets are not opened.

The number of buckets and the key are noted in the table's commits and can't be
changed by a merge.  Choose buckets of some hundred MB.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from ..sinks.files import SliceWrite, delete_path
from ..sinks.slices import SliceTable
from .sizing import DEFAULT_BROADCAST_LIMIT, size_metrics, size_of
from .upsert import check_batch_keys, check_columns, merge

BUCKET = "_bucket"


def bucket_of(pk: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*pk), F.lit(buckets)).cast("int")


class BucketMirror:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, pk: Sequence[str], buckets: int = 64):
        self.spark, self.schema, self.pk, self.buckets = spark, schema, list(pk), buckets
        self.table = SliceTable(spark, root, BUCKET, T.StructType(schema.fields + [T.StructField(BUCKET, T.IntegerType())]))
        noted = self.table.commit().notes
        if noted and (noted["buckets"], noted["keys"]) != (buckets, self.pk):
            raise ValueError(f"{root} has {noted['buckets']} buckets of {noted['keys']}")

    def read(self) -> DataFrame:
        return self.table.read().drop(BUCKET)

    def merge(self, batch: DataFrame, broadcast_limit: int = DEFAULT_BROADCAST_LIMIT, check: bool = True) -> SliceWrite:
        """MERGE of ``batch``: matched rows take its values, the others are inserted (NULL keys always are)."""
        check_columns(self.spark.createDataFrame([], self.schema), batch, self.pk)
        path = scratch_path(self.spark, "batch-buckets")
        (batch.withColumn(BUCKET, bucket_of(self.pk, self.buckets)).hint("rebalance", BUCKET)
         .write.partitionBy(BUCKET).parquet(path))
        stored = T.StructType([self.schema[c] for c in batch.columns] + [T.StructField(BUCKET, T.IntegerType())])
        try:
            staged = self.spark.read.schema(stored).parquet(path)
            if check:
                check_batch_keys(staged, self.pk, null_keys="insert")
            parts = [(self._merged(staged, group, size), group)
                     for group, size in self._groups(staged, broadcast_limit)]
            notes = {"buckets": self.buckets, "keys": self.pk}
            # written as read: the rows of a bucket stay in the tasks that scanned them
            return self.table.replace_all(parts, notes, rebalance=False)
        finally:
            delete_path(self.spark, path)

    def _groups(self, staged: DataFrame, limit: int) -> list[tuple[list[int], int]]:
        """Touched buckets together while their part of the batch is under the limit, with its bytes."""
        found = staged.groupBy(BUCKET).agg(*size_metrics(staged)).orderBy(BUCKET).collect()  # a row per bucket
        groups: list[tuple[list[int], int]] = []
        for row in found:
            size = size_of(row.asDict(), len(staged.columns))
            if groups and groups[-1][1] + size <= limit:
                groups[-1] = (groups[-1][0] + [row[BUCKET]], groups[-1][1] + size)
            else:
                groups.append(([row[BUCKET]], size))
        return groups

    def _merged(self, staged: DataFrame, group: list[int], size: int) -> DataFrame:
        part = staged.filter(F.col(BUCKET).isin(group))
        # equal keys have equal buckets: the bucket in the key keeps the join exact and lets inserts carry it
        return merge(self.table.read(group), part, [*self.pk, BUCKET], check=False, size=size)
