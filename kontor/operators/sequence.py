"""Consecutive ids in a global order, without a single-task window.

``row_number() OVER (ORDER BY ...)`` with no partition pulls every row
into one task.  Instead:

1. range-partition the rows on the order columns and sort inside each
   partition (one shuffle, balanced by sampling);
2. ``monotonically_increasing_id`` then equals (partition << 33) + position;
3. per-partition row counts (one row per partition -- bounded by the
   partition count, so broadcasting it is safe) give each partition's
   offset by a prefix sum;
4. id = start + offset(partition) + position.

The frame is checkpointed to the shared checkpoint folder between steps
2 and 3 so both reads see the same partitioning, and lineage is cut.

``scan_order_ids`` numbers rows in the order of their scan instead, with no
shuffle at all, and ``Sequence`` hands out ranges of a shared sequence.

The order columns must be unique (a key): ties would make the ids depend
on the partitioning, and equal values cannot be split across ranges.

With ``weight`` each row reserves ``weight`` consecutive ids (a document
that splits into n pieces reserves n), so pieces can be numbered after
the ids are assigned, without shuffling the pieces themselves.
"""

from __future__ import annotations

from collections.abc import Callable
from collections.abc import Sequence as Names

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root
from ..sinks.publish import load, publish, published


def sequential_ids(df: DataFrame, order_cols: Names[str], start: int | F.Column = 1,
                   name: str = "record_id", weight: str | None = None,
                   partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    checkpoint_root(spark)  # make sure a (shared) checkpoint folder is set
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    w = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    tagged = ranged.select(
        "*",
        F.spark_partition_id().alias("_pid"),
        F.monotonically_increasing_id().alias("_mono"),
        w.alias("_w"),
    )
    tagged = tagged.checkpoint(eager=True)
    if weight is None:
        # position inside the partition, straight from the id layout: no shuffle
        local = tagged.withColumn("_local", F.col("_mono") - F.shiftleft(F.col("_pid").cast("long"), 33))
    else:
        # running weight inside the partition (a shuffle of the small weight rows)
        in_part = Window.partitionBy("_pid").orderBy("_mono").rowsBetween(Window.unboundedPreceding, -1)
        local = tagged.withColumn("_local", F.coalesce(F.sum("_w").over(in_part), F.lit(0)))
    sizes = tagged.groupBy("_pid").agg(F.sum("_w").alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    start_col = start if isinstance(start, F.Column) else F.lit(start)
    out = local.join(F.broadcast(offsets), "_pid").withColumn(
        name, (start_col + F.col("_off") + F.col("_local")).cast("long"))
    return out.drop("_pid", "_mono", "_w", "_local", "_off")


def scan_order_ids(df: DataFrame, start: int | Callable[[int], int] = 1, name: str = "record_id") -> DataFrame:
    """``df`` with consecutive ids in the order of its scan; no row is shuffled.

    ``monotonically_increasing_id`` has a row's partition and its place there.
    A first pass counts the rows of each partition -- one number per partition,
    which is what is broadcast -- and a prefix sum makes them offsets.  Both
    passes must see the same partitions: ``df`` is a scan of files or local
    rows with projections, filters and generators over it, no shuffle.
    ``start`` may be a function from the number of ids to the first of them.
    """
    spark = df.sparkSession
    place = F.monotonically_increasing_id()
    sizes = (df.select(F.shiftrightunsigned(place, 33).cast("int").alias("_pid")).groupBy("_pid")
             .agg(F.count(F.lit(1)).alias("_n")).collect())  # a row per partition
    offsets, total = [], 0
    for pid, n in sorted(map(tuple, sizes)):
        offsets.append((pid, total))
        total += n
    first = start(total) if callable(start) else start
    offsets = spark.createDataFrame(offsets, "_pid int, _off long")
    placed = df.withColumn("_place", place).withColumn("_pid", F.shiftrightunsigned("_place", 33).cast("int"))
    here = F.col("_place") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (placed.join(F.broadcast(offsets), "_pid")
            .withColumn(name, (F.lit(first) + F.col("_off") + here).cast("long")).drop("_pid", "_off", "_place"))


class Sequence:
    """A sequence that many writers draw ranges from, kept as small files in a shared folder.

    A reservation is the next numbered file with the range it takes; the file
    is published at most once (``sinks.publish``), so of two writers that ask
    at once one finds the number taken and asks again above it.  A range that
    is not used up leaves a gap, as a database sequence does.  Nothing is read
    but the folder's listing and its last file.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def last(self) -> int | None:
        """The highest id reserved so far, or None before the first reservation."""
        found = published(self.spark, self.path)
        return load(self.spark, found[max(found)])["last"] if found else None

    def reserve(self, n: int, above: Callable[[], int] | None = None) -> int:
        """The first of ``n`` ids that nobody else gets.  ``above`` gives the highest id used before there was a
        sequence; it is asked at the first reservation only."""
        while True:
            found = published(self.spark, self.path)
            last = load(self.spark, found[max(found)])["last"] if found else above() if above else 0
            number = max(found, default=0) + 1
            if publish(self.spark, f"{self.path}/{number}.json", {"first": last + 1, "last": last + n}):
                return last + 1
