"""Mixing sources to target weights by Poisson replication, in DataFrame operations only.

A source's *rate* is the mean number of times each of its documents is
wanted: its share of the target weights, times the text wanted in all
(``epochs`` times the input, in bytes), over its own text.  A document's
number of copies inverts the Poisson distribution of that mean at a uniform
number drawn from a seeded hash of its id, so that a rerun, a lost executor
or another partitioning gives the same mixture.  Copies are exploded and
dealt out by a hash of id and copy number, and ordered by it in each
partition: a global shuffle without a sampling pass.

The cumulative probabilities are one array per source.  It begins and ends so
far from the rate that what is left is below the resolution of the uniform
number, so it grows with the root of the rate; each probability comes from its
logarithm by itself, and a window adds them up, a row each.  The arrays are
broadcast in blocks of sources, as many as keep each under ``TABLE_VALUES``
numbers; a document meets the block of its source, and no text is shuffled on
its source.

Null sources are a source of their own.  Null and empty texts have no bytes;
the documents of a source without any text are kept once.  Repeated rows get
equal numbers of copies.  A column already called ``copy`` is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

RESOLUTION = 48  # bits of the uniform number
TABLE_VALUES = 2_000_000  # probabilities broadcast at a time: 16 MB


def uniform(seed: str, doc_id: Column) -> Column:
    """A number in [0, 1) from the seed and the id, with ``RESOLUTION`` bits."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1,
                         RESOLUTION // 4)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(1 << RESOLUTION))


def rates(docs: DataFrame, weights: dict | None = None, temper: float = 0.5, epochs: float = 1.0) -> DataFrame:
    """(source, rate).  Without ``weights`` a source's target weight is its size to the power ``temper``;
    with them, sources not named have weight 0."""
    sizes = docs.groupBy("source").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).cast("double").alias("size"))
    if weights is None:
        weighted = sizes.withColumn("weight", F.pow("size", F.lit(temper)))
    else:
        named = [F.when(F.col("source").eqNullSafe(F.lit(s)), F.lit(float(w))) for s, w in weights.items()]
        weighted = sizes.withColumn("weight", F.coalesce(*named, F.lit(0.0)))
    totals = weighted.agg(F.sum("size").alias("all_size"), F.sum("weight").alias("all_weight"))
    wanted = F.col("weight") / F.col("all_weight") * F.lit(epochs) * F.col("all_size") / F.col("size")
    return (weighted.crossJoin(F.broadcast(totals))  # one row of totals
            .select("source", F.when(F.col("size") > 0, wanted).alias("rate")))


def _reach() -> tuple[Column, Column]:
    """The first and the last number of copies that a ``rate`` can give, at the resolution; none for a rate of 0."""
    far = 12 * F.sqrt("rate") + 30
    return (F.greatest(F.floor(F.col("rate") - far), F.lit(0)).cast("int"),
            F.when(F.col("rate") > 0, F.ceil(F.col("rate") + far)).otherwise(F.lit(0)).cast("int"))


def _log_mass(rate: Column, k: Column) -> Column:
    """log P(X = k) of a Poisson distribution; beyond 20 by Stirling's series, whose rest is below 1e-12."""
    series = (k * F.log(rate / k) + (k - rate) - F.log(F.lit(2 * math.pi) * k) / 2
              - 1 / (12 * k) + 1 / (360 * k * k * k) - 1 / (1260 * k * k * k * k * k))
    few = -rate + k * F.log(rate) - F.log(F.factorial(F.least(k, F.lit(20)).cast("int")))
    return F.when(k <= 20, few).otherwise(series)


def cumulative(rates: DataFrame) -> DataFrame:
    """(source, rate, first, below): P(X <= k) for k = first, first + 1, ...; [1] for a rate of 0, null for none."""
    low, high = _reach()
    k = F.col("k").cast("double")
    each = rates.select("source", "rate", F.explode(F.sequence(low, high)).alias("k")).withColumn(
        "p", F.when(F.col("rate") > 0, F.exp(_log_mass(F.col("rate"), k))).otherwise(F.lit(1.0)))
    so_far = Window.partitionBy("source").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    added = each.withColumn("c", F.sum("p").over(so_far)).groupBy("source", "rate").agg(
        F.min("k").alias("first"), F.array_sort(F.collect_list(F.struct("k", "c"))).alias("all"))
    return (added.select("source", "rate", "first", F.col("all.c").alias("below"))
            .unionByName(rates.filter("rate IS NULL").select("source", "rate"), allowMissingColumns=True))


def _blocks(rates: DataFrame) -> int:
    """Blocks of sources, by a hash, whose arrays have at most ``TABLE_VALUES`` numbers each (or are one source's)."""
    low, high = _reach()
    values = rates.select("source", F.coalesce(high - low + 1, F.lit(1)).alias("values"))
    sources, blocks = values.count(), 1
    while blocks < 8 * sources:
        most = (values.groupBy(_block(blocks).alias("block")).agg(F.sum("values").alias("values"))
                .agg(F.max("values")).first()[0])
        if most <= TABLE_VALUES:
            break
        blocks *= 2
    return blocks


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("source"), F.lit(blocks))


def replicate(docs: DataFrame, weights: dict | None = None, temper: float = 0.5, epochs: float = 1.0,
              seed: str = "mix-1") -> DataFrame:
    """The mixture: ``docs`` with each row as often as drawn, numbered from 1 in ``copy``, shuffled."""
    columns = [c for c in docs.columns if c != "copy"]
    docs = docs.select(*columns)
    names = iter(n for n in (f"_{i}" for i in range(len(columns) + 8)) if n not in columns)
    of, first, below, copies, dealt = (next(names) for _ in range(5))
    wanted = stored(rates(docs, weights, temper, epochs), "rates")  # a row per source
    drawn = uniform(seed, F.col("doc_id"))
    blocks, several = _blocks(wanted), None
    for b in range(blocks):
        rows, some = (x if blocks == 1 else x.filter(_block(blocks) == b) for x in (docs, wanted))
        table = cumulative(some).select(F.col("source").alias(of), F.col("first").alias(first), F.col("below").alias(below))
        counted = (rows.join(F.broadcast(table), rows["source"].eqNullSafe(table[of]))  # counted by _blocks
                   .withColumn(copies, F.when(F.col(below).isNull(), F.lit(1))
                               .otherwise(F.col(first) + F.size(F.filter(below, lambda c: c <= drawn)))))
        part = (counted.filter(F.col(copies) > 0)
                .select(*columns, F.explode(F.sequence(F.lit(1), F.col(copies))).alias("copy")))
        several = part if several is None else several.unionByName(part)
    place = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("copy"))
    return (several.withColumn(dealt, place).repartition(F.col(dealt)).sortWithinPartitions(dealt)
            .select(*columns, "copy"))
