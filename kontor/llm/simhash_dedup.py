"""SimHash near-duplicates through a byte-position inverted index.

A text's fingerprint has bit b set when more than half of its word
shingles hash (XXH64, seed 42) to a value with bit b set.  Two
fingerprints are linked when at most ``max_bits`` of their 64 bits differ.

The index
    A fingerprint is eight bytes at eight positions.  ``max_bits`` differing
    bits spoil at most ``max_bits`` bytes, so linked fingerprints share at
    least 8 - max_bits positional bytes: the guaranteed minimum.  A posting
    list of one positional byte would hold 1/256 of everything, so lists are
    kept per *combination* of ``m`` positions: a pair with the guaranteed
    matches has m of them within any 8 - max_bits' first positions (see
    ``combinations``), hence shares at least one list.  ``m`` follows the
    number of distinct fingerprints, so a list stays short on average; every
    choice finds every link.

Count filter and check
    Each pair met in a list is tallied over all eight positions and kept
    from the guaranteed minimum on; then its bits are compared.

Long lists
    Pairs grow with the square of a list.  Lists are therefore read as
    sorted runs, never as pairs: short runs are compared by shifted arrays;
    a longer one (up to ``LONG`` members) is searched breadth first and gives
    at most one link per member, which keeps its classes whole.  Beyond
    ``LONG`` the members leave the list, and each sends itself to all values
    within max_bits / 2 bits: two members meet at such a value exactly when
    they are linked, and joining all that meet there to one of them loses no
    class.  The rows are a fixed number per member, however large the crowd.

Equal fingerprints are one node from the start.  Classes are connected
components of the links, by alternating star contractions with a
written table per round.

Null and empty texts have fingerprint zero and are linked like any other.
A class is named by its smallest doc_id (null ids count only if there is
no other).  Repeated rows give repeated result rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .components import component_roots

BYTES = 8
SHORT, LONG = 32, 4096


def fingerprint_of(text: bytes | None, words_per_shingle: int) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    words = (text or b"").lower().split()  # bytes: ASCII case and white space only
    if not words:
        return 0
    k = min(words_per_shingle, len(words))
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    stops = ends[k - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(line[a:b], 42) for a, b in zip(starts[: len(stops)].tolist(), stops)),
                    np.uint64, len(stops))
    votes = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):  # bounded memory for very long texts
        block = h[at: at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * votes > len(h)).astype(np.uint64)
    return int((bits << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64))


def with_fingerprints(docs: DataFrame, words_per_shingle: int = 4, text: str = "text",
                      into: str = "fp") -> DataFrame:
    """``docs`` with the signed 64-bit fingerprint in ``into``; no shuffle."""

    @F.pandas_udf("long")
    def fp(texts):
        values = [fingerprint_of(None if t is None else t.encode(), words_per_shingle) for t in texts]
        return pd.Series(np.array(values, np.uint64).view(np.int64))

    return docs.withColumn(into, fp(F.col(text)))


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# ---- links ------------------------------------------------------------------

def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def list_masks(max_bits: int, m: int) -> list[int]:
    """The m-position lists in which every linked pair meets: of any max_bits + m
    positions at most max_bits are spoilt, so m match."""
    return [_signed(sum(0xFF << (8 * p) for p in places))
            for places in itertools.combinations(range(max_bits + m), m)]


def list_width(distinct: int, max_bits: int) -> int:
    """Positions per list: lists stay short on average, whatever the input's size.
    Any width finds every link."""
    for m in range(min(2, BYTES - max_bits), BYTES - max_bits):
        if 4 * distinct <= 1 << (8 * m):
            return m
    return BYTES - max_bits


def flips(radius: int) -> list[int]:
    """All patterns of at most ``radius`` set bits, fewest first."""
    return [_signed(sum(1 << b for b in bits))
            for r in range(radius + 1) for bits in itertools.combinations(range(64), r)]


def _linked(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Count filter, then the bits: which pairs of fingerprints are linked."""
    x = (a ^ b).view(np.uint64)  # bits of signed numbers would be counted on their absolute value
    shared = (x.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
    ok = np.flatnonzero(shared >= BYTES - max_bits)
    return ok[np.bitwise_count(x[ok]) <= max_bits]


def _spanning(members: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that join each class within one run: one per member at most."""
    rest, out = members, []
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = _linked(np.full(len(rest), x), rest, max_bits)
            if len(near):
                out.append((np.full(len(near), x), rest[near]))
                queue.extend(rest[near].tolist())
                rest = np.delete(rest, near)
    return out


def _run_links(lists: np.ndarray, keys: np.ndarray, fps: np.ndarray, max_bits: int):
    """Links and members of overlong runs, for whole runs sorted by (list, key)."""
    new = np.concatenate([[True], (lists[1:] != lists[:-1]) | (keys[1:] != keys[:-1])])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(fps)))
    run = np.cumsum(new) - 1
    left, right, crowd = [], [], []
    at = np.flatnonzero((sizes[run] > 1) & (sizes[run] <= SHORT))
    for shift in range(1, SHORT):
        at = at[at + shift < len(fps)]
        at = at[run[at] == run[np.minimum(at + shift, len(fps) - 1)]]
        if not len(at):
            break
        ok = at[_linked(fps[at], fps[at + shift], max_bits)]
        left.append(fps[ok])
        right.append(fps[ok + shift])
    for r in np.flatnonzero(sizes > SHORT):
        members = fps[starts[r]: starts[r] + sizes[r]]
        if sizes[r] > LONG:
            crowd.append(members)
            continue
        for a, b in _spanning(members, max_bits):
            left.append(a)
            right.append(b)
    return left, right, crowd


def _table(a, b) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _search(max_bits: int):
    """Stream of sorted postings -> links (a, b); members of overlong runs as (a, null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 3  # the last, still open run
        streaming = None                    # (list, key) of an overlong run whose members pass through

        def done(cols):
            left, right, crowd = _run_links(*cols, max_bits)
            if left:
                yield _table(np.concatenate(left), np.concatenate(right))
            for c in crowd:
                yield _table(c, pa.nulls(len(c), pa.int64()))

        for batch in batches:
            cols = [np.concatenate([h, batch.column(i).to_numpy()]) for i, h in enumerate(held)]
            if not len(cols[0]):
                continue
            if streaming is not None:
                same = (cols[0] == streaming[0]) & (cols[1] == streaming[1])
                n = len(same) if same.all() else int(np.argmin(same))
                if n:
                    yield _table(cols[2][:n], pa.nulls(n, pa.int64()))
                cols = [c[n:] for c in cols]
                if not len(cols[0]):
                    held = cols
                    continue
                streaming = None
            last = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield from done([c[:cut] for c in cols])
            held = [c[cut:] for c in cols]
            if len(held[0]) > LONG:
                streaming = (held[0][0], held[1][0])
                yield _table(held[2], pa.nulls(len(held[2]), pa.int64()))
                held = [c[:0] for c in held]
        if len(held[0]):
            yield from done(held)

    return run


def links(fps: DataFrame, max_bits: int, distinct: int) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp``: every linked pair's ends
    are connected by them, and every row is a linked pair."""
    if not 0 < max_bits < BYTES:
        raise ValueError("byte positions guarantee matches for 1 to 7 bits")
    masks = list_masks(max_bits, list_width(distinct, max_bits))
    postings = (fps.select("fp", F.posexplode(F.array(*[F.lit(m) for m in masks])).alias("list", "mask"))
                .select(F.col("list").cast("long").alias("list"),
                        F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp"))
    found = stored(postings.repartition("list", "key").sortWithinPartitions("list", "key")
                   .mapInArrow(_search(max_bits), "a long, b long"), "links")
    pairs = found.filter("b is not null")
    near, far = max_bits // 2, max_bits - max_bits // 2
    close = len(flips(near))
    meet = (found.filter("b is null").select(F.col("a").alias("fp")).distinct()
            .select("fp", F.posexplode(F.array(*[F.lit(x) for x in flips(far)])).alias("i", "flip"))
            .select("fp", (F.col("i") < close).alias("near"), F.col("fp").bitwiseXOR(F.col("flip")).alias("at")))
    # members within the smaller radius are linked to all that meet there
    star = meet.filter("near").groupBy("at").agg(F.min("fp").alias("a"))
    joined = meet.join(star, "at").filter(F.col("fp") != F.col("a")).select("a", F.col("fp").alias("b"))
    return pairs.unionByName(joined).distinct()


# ---- classes ------------------------------------------------------------------

def near_duplicate_classes(docs: DataFrame, max_bits: int = 4, doc_id: str = "doc_id", fp: str = "fp") -> DataFrame:
    """One row per row of ``docs``: (doc_id, fp, component_id, root); ``root`` is the
    class's smallest fingerprint, which tells classes without any id apart.

    ``docs`` holds ids and fingerprints and should be a stored table: it is read twice.
    """
    ids = docs.select(F.col(doc_id).alias("doc_id"), F.col(fp).alias("fp"))
    nodes = stored(ids.groupBy("fp").agg(F.min("doc_id").alias("smallest")), "fingerprints")
    edges = links(nodes.select("fp"), max_bits, nodes.count())
    roots = component_roots(edges)
    placed = (nodes.join(roots.withColumnsRenamed({"node": "fp"}), "fp", "left")
              .select("fp", "smallest", F.coalesce("root", "fp").alias("root")))
    first = placed.groupBy("root").agg(F.min("smallest").alias("component_id"))
    named = placed.join(first, "root").select("fp", "component_id", "root")
    return ids.join(named, "fp").select("doc_id", "fp", "component_id", "root")


def near_duplicates(docs: DataFrame, words_per_shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """(doc_id, fp, component_id, root) of texts; the fingerprints are computed once."""
    fps = stored(with_fingerprints(docs.select("doc_id", "text"), words_per_shingle).select("doc_id", "fp"), "simhash")
    return near_duplicate_classes(fps, max_bits)


def keep_one_of_each(docs: DataFrame, words_per_shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one row of each class left: the one with the smallest doc_id
    (of repeated rows, one of them)."""
    columns = docs.columns
    fp = next(n for n in ("fp", *(f"fp_{i}" for i in range(len(columns) + 1))) if n not in columns)
    whole = stored(with_fingerprints(docs, words_per_shingle, into=fp), "simhash_docs")
    classes = near_duplicate_classes(whole, max_bits, fp=fp)
    kept = (classes.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .groupBy("component_id", "root").agg(F.min("fp").alias("kept_fp")))
    chosen = whole.join(kept, whole["doc_id"].eqNullSafe(kept["component_id"]) & (whole[fp] == kept["kept_fp"]),
                        "left_semi")
    return chosen.dropDuplicates(["doc_id", fp]).select(*columns)
