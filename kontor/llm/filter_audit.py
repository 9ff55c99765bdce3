"""Interaction audit of five document filters, from a sparse document-term matrix.

Matrix
    A task cuts its documents into shards (at most 16 MB of text, or one text)
    and counts each document's words by numbers of the shard's own.  Only a
    shard's distinct words are shuffled: dealt by word, sorted, and numbered
    in that order, which is the global dictionary (partition, then rank), and
    sent back to their shard.  There the rows get global column numbers: a CSR
    shard.  No word has more than one row per shard, and a word's rows are
    only streamed past, never gathered.

Filters
    A: a row's sum is under ``MIN_WORDS``.  B: 100 times its nonzero columns
    are fewer than ``MIN_DISTINCT`` times its sum.  C and D are read off the
    text in the same pass as the words, and so is the SHA-256 that E goes by.

Audit
    Rows alike in id, part, digest and flags collapse before any join, so a
    hot text or a repeated row is one row per task.  Labels meet the ids in an
    equi-join (null ids have no label and pass it by).  Per digest, part and
    labels remain a count, the least id and the rows that have it; a document
    fails E where its id is above the least id of the digest.  At most 32
    combinations of failures per part go into the table of 120 orders of 5
    steps, which is a constant.

Defined cases: a null text is empty.  A null source is the part ''.  A null id
has no label, is no smaller than any id and has no smaller one: it neither
fails E nor makes others fail it.  Of several labels of one id the largest
counts.  Rows with equal id and text are equal documents of equal id, none
smaller.  An empty table has no part and gives no row.  Further columns don't
matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions
from .shards import shards, stored_small

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 200, 50, 2
CAPITALS, SIGNS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
BIT = {f: 1 << i for i, f in enumerate(FILTERS)}

DOC, WORD = 0, 1  # kinds of rows
LOCAL = ("kind int, shard long, doc_id {id}, part string, digest binary, flags int, first binary, second binary, "
         "word binary, place int")


def text_flags(text: bytes, n_chars: int) -> int:
    """C and D."""
    capitals = len(text) - len(text.translate(None, CAPITALS))
    signs = len(text.translate(None, SIGNS)) < len(text)
    return BIT["C"] * (100 * capitals > MAX_CAPITALS * n_chars) + BIT["D"] * signs


def _shard_rows(shard: int, rows: pa.Table, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    known: dict[bytes, int] = {}
    columns, times, digests, flags = [], [], [], []
    for text in rows["text"]:
        text = text.as_py() or ""
        raw = text.encode()
        places = np.array([known.setdefault(w, len(known)) for w in raw.split()], np.int32)
        column, n = np.unique(places, return_counts=True)
        columns.append(column.astype("<i4").tobytes())
        times.append(n.astype("<i4").tobytes())
        digests.append(hashlib.sha256(raw).digest())
        flags.append(text_flags(raw, len(text)))

    def batch(size: int, **given):
        given["shard"] = pa.array(np.full(size, shard, np.int64))
        return pa.RecordBatch.from_arrays(
            [given[f.name].cast(f.type) if f.name in given else pa.nulls(size, f.type) for f in schema], schema=schema)

    yield batch(len(flags), kind=pa.array(np.full(len(flags), DOC, np.int32)),
                doc_id=rows["doc_id"].combine_chunks(), part=rows["part"].combine_chunks(),
                digest=pa.array(digests, pa.binary()), flags=pa.array(flags, pa.int32()),
                first=pa.array(columns, pa.binary()), second=pa.array(times, pa.binary()))
    del columns, times
    words = list(known)
    del known
    for at in range(0, len(words), 100_000):
        some = words[at:at + 100_000]
        yield batch(len(some), kind=pa.array(np.full(len(some), WORD, np.int32)), word=pa.array(some, pa.binary()),
                    place=pa.array(np.arange(at, at + len(some), dtype=np.int32)))


def _make_shards(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in shards(batches, "text"):
            yield from _shard_rows(shard, rows, schema)

    return run


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted words of one partition numbered: equal neighbours share a number."""
    last, following = None, TaskContext.get().partitionId() << 40
    for batch in batches:
        words = batch.column("word")
        if not len(words):
            continue
        fresh = np.ones(len(words), bool)
        if len(words) > 1:
            fresh[1:] = pc.not_equal(words[1:], words[:-1]).to_numpy(zero_copy_only=False)
        fresh[0] = words[0].as_py() != last
        ids = following - 1 + np.cumsum(fresh)
        last, following = words[-1].as_py(), int(ids[-1]) + 1
        yield pa.RecordBatch.from_arrays([batch.column("shard"), batch.column("place"), pa.array(ids)],
                                         ["shard", "place", "term"])


def _matrix_rows(id_type: pa.DataType):
    def run(docs: pa.Table, words: pa.Table) -> pa.Table:
        term = np.zeros(words.num_rows, np.int64)
        term[words["place"].to_numpy()] = words["term"].to_numpy()
        columns = [term[np.frombuffer(c.as_py(), "<i4")].astype("<i8") for c in docs["first"]]
        return pa.table({"doc_id": docs["doc_id"].cast(id_type), "part": docs["part"], "digest": docs["digest"],
                         "flags": docs["flags"], "columns": pa.array([c.tobytes() for c in columns], pa.binary()),
                         "counts": docs["second"]})

    return run


def term_matrix(docs: DataFrame, part: str = "source") -> tuple[DataFrame, DataFrame]:
    """(matrix, dictionary).

    ``matrix`` has a row per document: doc_id, part, digest, the flags C and D,
    and its CSR row as little-endian ``columns`` (64-bit term numbers) and
    ``counts`` (32-bit); ``dictionary`` has (word, term) once per shard and word.
    """
    from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
    from pyspark.sql.types import StructType

    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType
    layout = LOCAL.format(id=id_type.simpleString())
    rows = docs.select("doc_id", F.coalesce(F.col(part), F.lit("")).alias("part"), "text")
    local = stored_small(rows.mapInArrow(_make_shards(to_arrow_schema(StructType.fromDDL(layout))), layout), "terms")
    words = (local.filter(F.col("kind") == WORD).select("shard", "place", "word")
             .repartition(shuffle_partitions(spark), "word").sortWithinPartitions("word"))
    numbered = words.mapInArrow(_number, "shard long, place int, term long")
    rows = local.filter(F.col("kind") == DOC).select("shard", "doc_id", "part", "digest", "flags", "first", "second")
    result = (f"doc_id {id_type.simpleString()}, part string, digest binary, flags int, columns binary, counts binary")
    matrix = (rows.groupBy("shard").cogroup(numbered.groupBy("shard"))
              .applyInArrow(_matrix_rows(to_arrow_type(id_type)), result))
    dictionary = (numbered.join(local.filter(F.col("kind") == WORD).select("shard", "place", "word"),
                                ["shard", "place"]).select("word", "term").distinct())
    return matrix, dictionary


def _row_flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A and B by the sums and nonzero counts of CSR rows, joined to the flags there are."""
    for batch in batches:
        counts = batch.column("counts")
        width = pc.divide(pc.binary_length(counts), 4).to_numpy(zero_copy_only=False).astype(np.int64)
        values = np.frombuffer(b"".join(c.as_py() for c in counts), "<i4").astype(np.int64)
        indptr = np.concatenate([[0], np.cumsum(width)])
        total = np.diff(np.concatenate([[0], np.cumsum(values)])[indptr])
        nonzero = np.diff(np.concatenate([[0], np.cumsum(values != 0)])[indptr])
        failed = (BIT["A"] * (total < MIN_WORDS)
                  + BIT["B"] * (100 * nonzero < MIN_DISTINCT * total)).astype(np.int32)
        failed |= batch.column("flags").to_numpy().astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"), batch.column("digest"), pa.array(failed, pa.int32())],
            ["doc_id", "part", "digest", "flags"])


def failures(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """(part, flags, quality, toxic, n): documents by the filters they fail (bits of ``FILTERS``) and their labels."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    matrix = term_matrix(docs, part)[0]
    rows = matrix.mapInArrow(_row_flags, f"doc_id {id_type}, part string, digest binary, flags int")
    rows = stored_small(rows.groupBy("doc_id", "part", "digest", "flags").agg(F.count(F.lit(1)).alias("n")), "flags")
    known = (labels.filter("doc_id IS NOT NULL").groupBy("doc_id")
             .agg(F.max("quality").cast("int").alias("quality"), F.max("toxic").cast("int").alias("toxic")))
    of_ids = rows.filter("doc_id IS NOT NULL").join(known, "doc_id", "left")
    cells = stored_small(
        of_ids.groupBy("digest", "flags", "part", "quality", "toxic")
        .agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "n")).alias("least")), "cells")
    least = (cells.groupBy("digest").agg(F.min("least.doc_id").alias("least_id"), F.sum("n").alias("copies"))
             .filter("copies > 1").select("digest", "least_id"))
    copied = cells.join(least, "digest", "left")
    spared = F.when(F.col("least_id").isNull(), F.col("n")).when(
        F.col("least.doc_id") == F.col("least_id"), F.col("least.n")).otherwise(0)
    sides = F.explode(F.array(F.struct(F.col("flags").alias("flags"), spared.alias("n")),
                              F.struct((F.col("flags") + BIT["E"]).alias("flags"), (F.col("n") - spared).alias("n"))))
    known_ids = copied.select("part", "quality", "toxic", sides.alias("side")).select(
        "part", "side.flags", "quality", "toxic", "side.n").filter("n > 0")
    none = F.lit(None).cast("int")
    without = rows.filter("doc_id IS NULL").select("part", "flags", none.alias("quality"), none.alias("toxic"), "n")
    return (known_ids.unionByName(without).groupBy("part", "flags", "quality", "toxic").agg(F.sum("n").alias("n")))


def _steps():
    """The constant table of orders: (filter_order, step, the step's bit, the bits before it)."""
    rows = []
    for order in permutations(FILTERS):
        before = 0
        for step, f in enumerate(order, 1):
            rows.append(F.struct(F.lit("".join(order)).alias("filter_order"), F.lit(step).alias("step"),
                                 F.lit(BIT[f]).alias("bit"), F.lit(before).alias("before")))
            before |= BIT[f]
    return F.array(*rows)


def audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """Per part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley."""
    found = failures(docs, labels, part)
    per_flags = found.groupBy("part", "flags").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("quality") == 1, F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"))
    at = per_flags.select("part", "flags", "n", "good", "toxic", F.explode(_steps()).alias("at")).select("*", "at.*")
    fails = F.col("flags").bitwiseAND(F.col("bit")) != 0
    earlier = F.col("flags").bitwiseAND(F.col("before")) != 0

    def total(column, condition):
        return F.sum(F.when(condition, F.col(column)).otherwise(0)).cast("long")

    rows = at.groupBy("part", "filter_order", "step", "bit").agg(
        total("n", ~fails & ~earlier).alias("kept"), total("n", fails & ~earlier).alias("removed"),
        total("n", fails & earlier).alias("redundant"), total("n", F.col("flags") == F.col("bit")).alias("unique_fails"),
        total("good", fails & ~earlier).alias("good_lost"), total("toxic", fails & ~earlier).alias("toxic_lost"))
    # 120 rows a part and filter
    return rows.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "bit"))).drop("bit")
