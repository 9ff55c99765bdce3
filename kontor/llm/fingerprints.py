"""SimHash document fingerprints and block-table search, in DataFrame operations only.

Fingerprint
    Terms are pairs of neighbouring words (the last word stands alone); a
    term's weight is its length in bytes, so that long, telling words
    outweigh short, common ones.  Each term's 128-bit hash votes with its
    weight on 128 signed bits; a bit is set when the votes for it exceed half
    of all votes.  Two bits share one 64-bit sum (32 bits each, enough for
    2 GiB of text), which halves the aggregation state.  A fingerprint is a
    struct of two 64-bit halves.

Block tables
    A fingerprint is cut into ``blocks`` blocks.  Two fingerprints that
    differ in at most ``radius`` bits agree in at least blocks - radius
    blocks, so for each choice of that many blocks a table is keyed by their
    bits: every pair within the radius meets in one of the tables.

Null and empty texts have no term and fingerprint zero.  Repeated rows are
rows of their own: the order of documents with equal ids is their text's
hash, then arbitrary among equal rows.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, stored, stored_by_key

BITS = 128
HALVES = ("hi", "lo")
PAIR = (1 << 32) | 1  # two bits, 32 apart
LOW = (1 << 32) - 1
WORDS = r"[\x20\x09-\x0D]+"


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _halves(number: int) -> tuple[int, int]:
    return _signed(number >> 64), _signed(number & ((1 << 64) - 1))


def from_numbers(spark, numbers) -> DataFrame:
    """Fingerprints ``fp`` from 128-bit numbers."""
    return spark.createDataFrame([(_halves(n),) for n in numbers], "fp struct<hi:long,lo:long>")


def to_number(fp) -> int:
    return (fp["hi"] & ((1 << 64) - 1)) << 64 | fp["lo"] & ((1 << 64) - 1)


def simhash(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, fp): one row per distinct keys; a text's terms are added up where its row is."""
    words = docs.select(*keys, F.split(F.coalesce(F.col(text), F.lit("")), WORDS).alias("words"))
    following = F.get("words", F.col("i") + 1)
    terms = (words.select(*keys, "words", F.posexplode("words").alias("i", "word"))
             .select(*keys, F.xxhash64("word", following).alias("hi"),
                     (F.octet_length("word") + F.coalesce(F.octet_length(following), F.lit(0))).cast("long").alias("w"))
             .withColumn("lo", F.xxhash64("hi")))
    votes = [F.sum(F.shiftrightunsigned(h, k).bitwiseAND(F.lit(PAIR)) * F.col("w")).alias(f"{h}{k}")
             for h in HALVES for k in range(32)]
    added = terms.groupBy(*keys).agg(F.sum("w").alias("all"), *votes)
    halves = []
    for h in HALVES:
        bits = F.lit(0).cast("long")
        for k in range(32):
            for at, vote in ((k, F.col(f"{h}{k}").bitwiseAND(F.lit(LOW))),
                             (k + 32, F.shiftrightunsigned(f"{h}{k}", 32))):
                bits = bits.bitwiseOR(F.when(2 * vote > F.col("all"), F.lit(_signed(1 << at))).otherwise(F.lit(0)))
        halves.append(bits.alias(h))
    return added.select(*keys, F.struct(*halves).alias("fp"))


def distance(a: Column, b: Column) -> Column:
    """Number of differing bits."""
    return sum((F.bit_count(a[h].bitwiseXOR(b[h])) for h in HALVES), F.lit(0))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - distance(a, b) / F.lit(float(BITS))


def hex_digits(fp: Column) -> Column:
    return F.lower(F.concat(*[F.lpad(F.hex(fp[h]), 16, "0") for h in HALVES]))


# ---- block tables -----------------------------------------------------------

def block_masks(radius: int, blocks: int) -> list[tuple[int, int]]:
    edge = [BITS * i // blocks for i in range(blocks + 1)]
    own = [(1 << edge[i + 1]) - (1 << edge[i]) for i in range(blocks)]
    return [_halves(sum(own[i] for i in some)) for some in itertools.combinations(range(blocks), blocks - radius)]


def within_radius(queries: DataFrame, fps: DataFrame, radius: int = 6, blocks: int = 8) -> DataFrame:
    """(query, fp, distance) for every fingerprint ``fp`` of ``fps`` within ``radius`` bits of a query's.

    Both sides hold fingerprints in ``fp``; equal ones are one.  With the
    defaults there are 28 tables, each keyed by 32 bits.
    """
    if not 0 <= radius < blocks:
        raise ValueError("more blocks than the radius are needed")
    masks = F.array(*[F.struct(*[F.lit(m).cast("long").alias(h) for h, m in zip(HALVES, pair)])
                      for pair in block_masks(radius, blocks)])

    def table(df, name):
        key = [F.col(name)[h].bitwiseAND(F.col("mask")[h]).alias(f"key_{h}") for h in HALVES]
        return (df.select(F.col("fp").alias(name)).distinct()
                .select(name, F.posexplode(masks).alias("t", "mask")).select(name, "t", *key))

    found = table(queries, "query").join(table(fps, "fp"), ["t", "key_hi", "key_lo"])
    return (found.select("query", "fp", distance(F.col("query"), F.col("fp")).alias("distance"))
            .filter(F.col("distance") <= radius).distinct())


# ---- a document, its edited text, the next document -------------------------------

def successors(rows: DataFrame) -> DataFrame:
    """(rid, next_rid) in descending order of ``doc_id``, the first following the last.

    Ids are dealt out by ranges and numbered range by range; the ranges'
    heads, one row per range, link them.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("hash"), F.col("rid")]
    ranged = stored(rows.select("rid", "doc_id", "hash").repartitionByRange(shuffle_partitions(rows.sparkSession), *order)
                    .withColumn("part", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("part").orderBy(*order)
    led = ranged.select("rid", "part", F.lead("rid").over(inside).alias("follower"),
                        F.row_number().over(inside).alias("n"))
    heads = (ranged.select("part", "rid", F.row_number().over(inside).alias("n")).filter("n = 1")
             .select("part", "rid"))
    chain = Window.orderBy("part")
    after = heads.select("part", F.coalesce(F.lead("rid").over(chain), F.first("rid").over(chain)).alias("head"))
    return (led.join(F.broadcast(after), "part")  # one row per range
            .select("rid", F.coalesce("follower", "head").alias("next_rid")))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and their likeness.

    The edited text has the last third of its code points (rounded down)
    replaced by the first as many of the next document, or by all it has.
    """
    spark = docs.sparkSession
    rows = stored_by_key(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
                         .select("doc_id", "text", F.xxhash64("text").alias("hash"),
                                 F.char_length("text").cast("long").alias("n_chars"),
                                 F.monotonically_increasing_id().alias("rid")),
                         "rid", shuffle_partitions(spark), "rows")
    follow = stored(successors(rows), "successors")
    fps = stored(simhash(rows, ["rid"]), "fps")

    # what each row sends to the one before it: the replacing characters and its fingerprint
    asked = (follow.join(rows.select("rid", "n_chars"), "rid")
             .select(F.col("rid").alias("to"), F.col("next_rid").alias("rid"),
                     F.floor(F.col("n_chars") / 3).cast("int").alias("cut")))
    sent = (rows.select("rid", "text").join(asked, "rid").join(fps, "rid")
            .select(F.col("to").alias("rid"), "cut", F.expr("substring(text, 1, cut)").alias("head"),
                    F.col("fp").alias("next_fp")))
    edited = (rows.join(sent, "rid")
              .select("rid", "doc_id", "n_chars", "next_fp",
                      F.concat(F.expr("substring(text, 1, n_chars - cut)"), F.col("head")).alias("edited"))
              .withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)))
    keys = ["rid", "doc_id", "n_chars", "next_fp", "edited_sha256"]
    both = simhash(edited, keys, "edited").withColumnRenamed("fp", "edited_fp").join(fps, "rid")
    return both.select("doc_id", "n_chars", "edited_sha256", hex_digits(F.col("fp")).alias("fingerprint"),
                       hex_digits(F.col("edited_fp")).alias("edited_fingerprint"),
                       likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
                       likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
