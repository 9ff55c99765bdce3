"""Benchmark decontamination by a broadcast set of test n-grams, in DataFrame operations only.

Words are runs of letters, digits and non-ASCII characters, lower-cased in
A-Z.  A window is ``width`` consecutive words of a benchmark item; an item
with fewer words, but not none, is one window.  Every occurrence of a window
in a document is found and its words are hit.

Scan
    Each distinct window is filed under its *anchor*, its longest word.  The
    documents' words are looked up in the broadcast anchors; where one
    matches, the words around it are compared with the whole window in the
    same join, so only verified hits leave it.  The benchmark is broadcast in
    blocks of some ``block`` windows and ``block_bytes`` bytes at most, sizes
    that do not depend on it; a larger benchmark means more blocks, each run
    against all documents.  A window is broadcast once, under a name of its
    own (its MD5), however many items have it.

Hits are stored, and those of one document merged as intervals.  Which items they stand for is
looked up afterwards, once per document and window that met; a window that
very many documents have is spread over ``SALTS`` tasks.

Null and empty texts have no words and are never contaminated.  Repeated
rows get equal results.  Items without an id hit words but are not counted
or named.  A benchmark without any window hits nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, stored

WIDTH = 13
BLOCK = 200_000          # windows broadcast at a time
BLOCK_BYTES = 64 << 20   # and their size
SALTS = 16
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"      # in lower-cased text
PIECE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"  # a word and what follows
LEADING = r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def windows_of(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(name, window, item_id): the windows of each item; equal windows have equal names."""
    words = benchmark.select("item_id", words_of(F.col("text")).alias("words")).filter(F.size("words") > 0)
    each = words.select("item_id", F.explode(F.expr(
        f"transform(sequence(1, greatest(size(words) - {width - 1}, 1)), i -> slice(words, i, {width}))"))
        .alias("window")).distinct()
    return stored(each.select(F.md5(F.array_join("window", " ").cast("binary")).alias("name"), "window", "item_id"),
                  "benchmark_windows")


def anchored(windows: DataFrame) -> DataFrame:
    """(anchor, at, name, window): distinct windows, each under its longest word."""
    length = F.transform("window", F.length)
    at = F.array_position(length, F.array_max(length)).cast("int")
    return (windows.select("name", "window").distinct()
            .select(F.element_at("window", at).alias("anchor"), at.alias("at"), "name", "window"))


def _bytes(window: Column) -> Column:
    """An upper bound of what one row of ``anchored`` takes: each word padded to eight bytes, and again as anchor."""
    padded = F.aggregate(window, F.lit(0).cast("long"), lambda n, w: n + F.octet_length(w) + 24)
    return 2 * padded + 160


def _row_key() -> list[Column]:
    return [F.col("doc_id"), F.xxhash64("text").alias("hash")]


def hits(docs: DataFrame, windows: DataFrame, block: int = BLOCK, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, hash, first, last, name): every occurrence of a window in a document, in word positions from 0."""
    known = anchored(windows)
    n, size = known.agg(F.count(F.lit(1)), F.sum(_bytes(F.col("window")))).first()
    blocks = max(-(-n // block), -(-(size or 0) // block_bytes), 1)
    found = None
    for b in range(blocks):
        some = known if blocks == 1 else known.filter(F.pmod(F.xxhash64("name"), F.lit(blocks)) == b)
        words = (docs.select(*_row_key(), words_of(F.col("text")).alias("words"))
                 .select("doc_id", "hash", "words", F.posexplode("words").alias("i", "word")))
        # the anchor is word i, so the window starts at i - at + 1
        start = F.col("i") - F.col("at") + 2
        same = (F.col("word") == F.col("anchor")) & (start >= 1) & (
            F.slice("words", F.greatest(start, F.lit(1)), F.size("window")) == F.col("window"))
        part = words.join(F.broadcast(some), same).select(
            "doc_id", "hash", (start - 1).alias("first"), (start + F.size("window") - 2).alias("last"), "name")
        found = part if found is None else found.unionByName(part)
    return found


def items_met(found: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc_id, hash, item): the distinct items of the windows that a document has."""
    salt = F.pmod(F.xxhash64("doc_id", "hash"), F.lit(SALTS)).cast("int")
    met = found.select("doc_id", "hash", "name").distinct().withColumn("salt", salt)
    items = (windows.filter("item_id is not null").select("name", F.col("item_id").alias("item"))
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    return met.join(items, ["name", "salt"]).select("doc_id", "hash", "item").distinct()


def _merged(found: DataFrame) -> DataFrame:
    """Hit words per document, overlaps counted once, as disjoint intervals' new parts."""
    before = (Window.partitionBy("doc_id", "hash").orderBy("first", "last")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (found.select("doc_id", "hash", "first", "last").distinct()
            .withColumn("seen", F.coalesce(F.max("last").over(before), F.lit(-1)))
            .select("doc_id", "hash", F.greatest(F.col("first"), F.col("seen") + 1).alias("first"), "last")
            .filter("last >= first"))


def report(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block: int = BLOCK,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated (a twentieth of the words hit)."""
    windows = windows_of(benchmark, width)
    found = stored(hits(docs, windows, block, block_bytes), "hits")  # read twice: the documents are scanned once a block
    key = ["doc_id", "hash"]
    n_hit = _merged(found).groupBy(*key).agg(F.sum(F.col("last") - F.col("first") + 1).alias("n_hit"))
    named = (items_met(found, windows)
             .groupBy(*key).agg(F.collect_list(F.col("item").cast("string")).alias("items")))
    per_doc = n_hit.join(named, (n_hit.doc_id.eqNullSafe(named.doc_id)) & (n_hit.hash == named.hash), "left").select(
        n_hit.doc_id, n_hit.hash, "n_hit", F.array_sort("items").alias("items"))
    rows = docs.select(*_row_key(), F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    both = rows.join(per_doc, rows.doc_id.eqNullSafe(per_doc.doc_id) & (rows.hash == per_doc.hash), "left")
    zero = F.lit(0).cast("long")
    return (both.select(rows.doc_id, rows.hash, "n_words", F.coalesce("n_hit", zero).alias("n_hit"),
                        F.coalesce(F.size(F.coalesce("items", F.array().cast("array<string>"))), zero).cast("long")
                        .alias("n_items"),
                        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256)
                        .alias("items_sha256"))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """``docs`` without the contaminated documents."""
    bad = (report(docs, benchmark, width, block).filter("contaminated")
           .select(F.col("doc_id").alias("bad_id"), F.col("hash").alias("bad_hash")).distinct())
    gone = docs["doc_id"].eqNullSafe(bad["bad_id"]) & (F.xxhash64(docs["text"]) == bad["bad_hash"])
    return docs.join(bad, gone, "left_anti")


def without_spans(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """``docs`` with the hit words, and the separators after them, cut out of ``text``."""
    columns = docs.columns
    names = iter(n for n in (f"_{i}" for i in range(len(columns) + 4)) if n not in columns)
    cut_id, cut_hash, cut = next(names), next(names), next(names)
    spans = (_merged(hits(docs, windows_of(benchmark, width), block)).groupBy("doc_id", "hash")
             .agg(F.array_distinct(F.flatten(F.collect_list(F.sequence("first", "last")))).alias(cut))
             .withColumnsRenamed({"doc_id": cut_id, "hash": cut_hash}))
    joined = docs.join(spans, docs["doc_id"].eqNullSafe(spans[cut_id])
                       & (F.xxhash64(docs["text"]) == spans[cut_hash]), "left")
    kept = F.filter(F.regexp_extract_all("text", F.lit(PIECE), F.lit(0)),
                    lambda piece, i: ~F.array_contains(F.col(cut), i))
    rest = F.concat(F.regexp_extract("text", LEADING, 0), F.array_join(kept, ""))
    return joined.withColumn("text", F.when(F.col(cut).isNotNull(), rest).otherwise(F.col("text"))).select(*columns)
