"""Removal of repeated byte passages by minimisers and hashes of whole windows.

A byte goes when some string of ``depth`` bytes covers it that also starts
anywhere else, in the same text or in another; texts are taken apart as
UTF-8 bytes and matches never cross them.  Ordering every suffix through
``depth`` bytes would show this -- the groups that stay equal are the
repeated windows -- but would move every position of the corpus.  No
suffix is sorted here: minimisers and window hashes stand in for the digits of
a radix sort, and what has become unique is dropped before the next is looked at:

Equal texts
    collapse first, by SHA-256: a text of at least ``depth`` bytes that
    occurs twice goes whole; one copy goes on to stand for the others.

First digit
    the window's *minimiser*: of its ``digit``-byte strings the one with the
    least hash.  Equal windows have equal minimisers, and neighbouring
    windows mostly share theirs, so a text has one row per run of windows
    (about one per 37 bytes with the defaults) and not one per byte.  Runs
    whose digit occurs once in the corpus are unique; they leave the sort.

Second digit
    the whole window, by a 128-bit hash, first for both ends of each
    surviving run.  Removal is decided by coverage: between two windows
    known to repeat and at most ``depth`` apart every byte is covered, so
    windows there need not be sorted for their own sake.

Last digit
    all windows of the runs that share their first digit with a run that has
    a window outside such gaps.  Those outside are decided, the others only
    take part, so that no partner is missed.

Within a batch equal windows are recognised at once; one row tells the rest
of the corpus.  A passage shared by very many texts thus sends one row per
batch, and no key gathers a row per text.

The hash of the first digit only selects candidates; the whole windows decide.

Null and empty texts have 0 bytes, no removed byte and no span.  Repeated
rows count as equal texts.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import release, shuffle_partitions, stored, stored_by_key

DEPTH, DIGIT = 200, 128
BLOCK = 1 << 22  # bytes of a text hashed at a time

_SEED = np.random.default_rng(20240229)
_BYTE = _SEED.integers(0, 1 << 64, 256, dtype=np.uint64)  # a random value per byte
_BASE = 0x9E3779B97F4A7C15  # odd, hence invertible modulo 2**64


# ---- the first digit: minimisers --------------------------------------------

@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _string_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each k-byte string, by differences of a running polynomial."""
    up, down = _powers(1 << max(12, int(len(data)).bit_length()))
    run = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=run[1:])
    h = (run[k:] - run[:-k]) * down[: len(data) - k + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def _sliding(values: np.ndarray, width: int, least) -> np.ndarray:
    """Least (or greatest) of each ``width`` neighbours, by doubling."""
    step, out = 1, values
    while step * 2 <= width:
        out = least(out[:-step], out[step:])
        step *= 2
    return out if step == width else least(out[: len(out) - (width - step)], out[width - step:])


def window_runs(data: np.ndarray, depth: int, digit: int):
    """Runs of neighbouring windows with equal minimisers: (hash, first, last, repeats in the run).

    Long texts go block by block; a run cut by a block border is two runs.
    """
    windows = len(data) - depth + 1
    parts = []
    for at in range(0, max(windows, 0), BLOCK):
        block = data[at: at + BLOCK + depth - 1]
        h = _string_hashes(block, digit)
        span = depth - digit + 1
        least = _sliding(h, span, np.minimum)
        edge = np.flatnonzero(least[1:] != least[:-1]) + 1
        first = np.concatenate([[0], edge])
        last = np.concatenate([edge - 1, [len(least) - 1]])
        value = least[first]
        # a digit that occurs twice within one run repeats already: mark every run with a
        # window over two neighbouring occurrences, or, where these are just ``span`` apart
        # and no window has both, with the last window over the one and the first over the other
        pad = np.zeros(span - 1, np.uint64)
        chosen = np.flatnonzero(_sliding(np.concatenate([pad, least, pad]), span, np.maximum) == h)
        pair = np.flatnonzero((h[chosen[1:]] == h[chosen[:-1]]) & (np.diff(chosen) <= span))
        marks = np.zeros(len(first) + 1, np.int64)
        low = np.maximum(chosen[pair + 1] - span + 1, 0)
        high = np.minimum(chosen[pair], len(least) - 1)
        np.add.at(marks, np.searchsorted(first, low, "right") - 1, 1)
        np.add.at(marks, np.searchsorted(first, high, "right"), -1)
        twice = np.cumsum(marks)[:-1] > 0
        parts.append((value, first + at, last + at, twice))
    if not parts:
        return np.empty(0, np.uint64), *(np.empty(0, np.int64),) * 2, np.empty(0, bool)
    return tuple(np.concatenate(x) for x in zip(*parts))


RUNS = "digit long, text_id long, first long, last long, weight int"


def _runs(depth: int, digit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, cols = batch.column(0).to_numpy(), [[], [], [], [], []]
            for i, text in enumerate(batch.column(1).cast(pa.binary())):
                v, a, b, twice = window_runs(np.frombuffer(text.as_py(), np.uint8), depth, digit)
                for c, x in zip(cols, (v.view(np.int64), np.full(len(v), ids[i]), a, b, 1 + twice)):
                    c.append(x)
            if not cols[0]:
                continue
            v, t, a, b, w = (np.concatenate(c).astype(np.int64) for c in cols)
            if not len(v):
                continue
            # digits met twice in this batch are known to repeat; one row per digit tells the others
            _, at, group, n = np.unique(v, return_index=True, return_inverse=True, return_counts=True)
            known = (n[group] > 1) | (w > 1)
            tell = at[(n > 1)]
            yield _batch(RUNS, np.concatenate([v, v[tell]]),
                         np.concatenate([t, np.full(len(tell), -1)]), np.concatenate([a, a[tell]]),
                         np.concatenate([b, b[tell]]),
                         np.concatenate([np.where(known, 0, w), np.full(len(tell), 2)]))
            single = known & (n[group] == 1)  # repeats within its own run only: tell as well
            if single.any():
                yield _batch(RUNS, v[single], np.full(single.sum(), -1), a[single], b[single],
                             np.full(single.sum(), 2))

    return run


def _batch(schema: str, *cols) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32()}
    named = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(cols, named)],
                                      names=[n for n, _ in named])


def _repeated(rows: DataFrame, keys: list[str], place: str) -> DataFrame:
    """Rows whose key has a weight of two or more in the whole corpus.

    Weight 0 marks rows already known to repeat: they pass, and are dealt out
    by their place, so that no key gathers them.  Rows without a text only tell.
    """
    known = F.col("weight") == 0
    first, *others = keys
    met = F.when(known, F.xxhash64("text_id", place)).otherwise(F.col(first))
    total = F.sum("weight").over(Window.partitionBy("known", "met", *others))
    return (rows.withColumns({"known": known, "met": met}).withColumn("total", total)
            .filter((F.col("known") | (F.col("total") >= 2)) & (F.col("text_id") >= 0)))


# ---- the second and the last digit: whole windows ----------------------------

WINDOWS = "h1 long, h2 long, text_id long, at long, weight int"


def sparse(at: np.ndarray, depth: int) -> np.ndarray:
    """Of sorted windows known to repeat, enough to cover the same bytes."""
    kept = at[:1].tolist()
    for i in range(1, len(at)):
        if i + 1 == len(at) or at[i + 1] - kept[-1] > depth:
            kept.append(at[i])
    return np.array(kept, np.int64)


def _all_of(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    size = last - first + 1
    return np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())


def _open(at: np.ndarray, known: np.ndarray, depth: int) -> np.ndarray:
    """Which windows are neither known to repeat nor between two near enough that are."""
    if not len(known):
        return np.ones(len(at), bool)
    known = np.sort(known)
    after = np.searchsorted(known, at)
    inner = (after > 0) & (after < len(known))
    out = np.ones(len(at), bool)
    out[inner] = known[after[inner]] - known[after[inner] - 1] > depth
    out[np.isin(at, known)] = False
    return out


def _ends(first, last, known, depth):
    """Both ends of each run; all are decided."""
    at = np.unique(np.concatenate([first, last]))
    return at, np.ones(len(at), bool)


def _rest(first, last, known, depth):
    """All windows; the open ones are decided."""
    at = _all_of(first, last)
    return at, _open(at, known, depth)


def _undecided(depth: int):
    """The first digits of runs that have an open window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [np.empty(0, np.int64)]
            for lists in zip(*(batch.column(i) for i in range(4))):
                digit, first, last, known = (np.array(x.as_py() or [], np.int64) for x in lists)
                open_ = _open(_all_of(first, last), known, depth)
                run_of = np.repeat(np.arange(len(first)), last - first + 1)
                out.append(digit[np.unique(run_of[open_])])
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(out)), pa.int64())], names=["digit"])

    return run


def _windows(choose, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            ids = batch.column(0).to_numpy()
            text, first, last, known = (batch.column(i) for i in range(1, 5))
            hashes, owners, places, asks = [], [], [], []
            for i in range(len(ids)):
                data = text[i].as_py().encode()
                lists = [np.array(c[i].as_py() or [], np.int64) for c in (first, last, known)]
                at, ask = choose(*lists, depth)
                asks.append(ask)
                hashes.extend(digest(data[p: p + depth]) for p in at.tolist())
                owners.append(np.full(len(at), ids[i]))
                places.append(at)
            if not hashes:
                continue
            h = np.frombuffer(b"".join(hashes), np.dtype("V16"))
            pair = h.view(np.int64).reshape(-1, 2)
            owner, place, ask = np.concatenate(owners), np.concatenate(places), np.concatenate(asks)
            # windows equal within the batch are known to repeat; one row each tells the others
            order = np.lexsort((pair[:, 1], pair[:, 0]))
            new = np.concatenate([[True], (pair[order][1:] != pair[order][:-1]).any(axis=1)])
            group = np.empty(len(order), np.int64)
            group[order] = np.cumsum(new) - 1
            n = np.bincount(group)
            alone = n[group] == 1
            yield _batch(WINDOWS, pair[alone, 0], pair[alone, 1], np.where(ask, owner, -1)[alone], place[alone],
                         np.ones(alone.sum(), np.int32))
            tell = order[new][n > 1]
            if not len(tell):
                continue
            nobody = np.full(len(tell), -1)
            yield _batch(WINDOWS, pair[tell, 0], pair[tell, 1], nobody, nobody, np.full(len(tell), 2, np.int32))
            both = np.flatnonzero(~alone & ask)
            if not len(both):
                continue
            edge = np.flatnonzero(np.diff(owner[both])) + 1
            for part in np.split(both, edge):
                at = sparse(np.sort(place[part]), depth)
                who = np.full(len(at), owner[part[0]])
                yield _batch(WINDOWS, at, at, who, at, np.zeros(len(at), np.int32))

    return run


def _lists(runs: DataFrame) -> DataFrame:
    return runs.groupBy("text_id").agg(*[F.collect_list(c).alias(c) for c in ("digit", "first", "last")])


def _positions(rows: DataFrame, into: str) -> DataFrame:
    return rows.groupBy("text_id").agg(F.collect_list("at").alias(into))


# ---- spans --------------------------------------------------------------------

def cut_out(data: bytes, at: np.ndarray, depth: int) -> tuple[int, int, bytes]:
    """(bytes removed, spans removed, bytes left) for windows starting at ``at``."""
    at = np.sort(at)
    if not len(at):
        return 0, 0, data
    start = np.concatenate([[True], np.diff(at) > depth])
    first = at[start]
    end = np.append(at[np.flatnonzero(start)[1:] - 1], at[-1]) + depth
    edges = np.stack([np.concatenate([[0], end]), np.append(first, len(data))], axis=1).tolist()
    left = b"".join(data[a:b] for a, b in edges)
    return len(data) - len(left), len(first), left


REMOVED = "text_id long, n_removed long, n_spans long, kept binary"


def _cut(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [cut_out(t.as_py().encode(), np.array((a.as_py() or []) + (b.as_py() or []), np.int64), depth)
                    for t, a, b in zip(batch.column(1), batch.column(2), batch.column(3))]
            n, spans, kept = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                names=["text_id", "n_removed", "n_spans", "kept"])

    return run


# ---- the operator ------------------------------------------------------------

def _sha(text: str):
    return F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)


def repeated_passages(docs: DataFrame, depth: int = DEPTH, digit: int = DIGIT, text: str = "text") -> DataFrame:
    """(sha, n_removed, n_spans, kept) of each distinct text that loses bytes.

    ``sha`` is the text's SHA-256 in hex, ``kept`` the bytes left, concatenated.
    """
    spark = docs.sparkSession
    buckets = shuffle_partitions(spark)
    classes = stored(docs.select(_sha(text).alias("sha"), F.col(text).alias("text"))
               .filter(F.octet_length("text") >= depth)
               .groupBy("sha").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies")), "classes", "zstd")
    # numbered where they are stored: no two texts share an id, however many there are
    texts = stored_by_key(classes.withColumn("text_id", F.monotonically_increasing_id()), "text_id", buckets, "texts")
    release(classes)

    runs = stored(_repeated(texts.select("text_id", "text").mapInArrow(_runs(depth, digit), RUNS), ["digit"], "first")
                  .select("digit", "text_id", "first", "last"), "runs")
    lists = stored_by_key(_lists(runs), "text_id", buckets, "run_lists")
    nothing = F.lit(None).cast("array<long>")
    ends = (texts.join(lists.hint("shuffle_hash"), "text_id")
            .select("text_id", "text", "first", "last", nothing.alias("known"))
            .mapInArrow(_windows(_ends, depth), WINDOWS))
    ends = stored_by_key(_positions(_repeated(ends, ["h1", "h2"], "at"), "known"), "text_id", buckets, "ends")

    undecided = (lists.join(ends.hint("shuffle_hash"), "text_id", "left").select("digit", "first", "last", "known")
                 .mapInArrow(_undecided(depth), "digit long").distinct())
    meeting = _lists(runs.join(undecided, "digit", "left_semi"))
    rest = (texts.join(meeting.hint("shuffle_hash"), "text_id").join(ends.hint("shuffle_hash"), "text_id", "left")
            .select("text_id", "text", "first", "last", "known").mapInArrow(_windows(_rest, depth), WINDOWS))
    rest = stored_by_key(_positions(_repeated(rest, ["h1", "h2"], "at"), "more"), "text_id", buckets, "rest")

    places = ends.join(rest, "text_id", "full")
    partly = (texts.filter("copies = 1").select("text_id", "text", "sha")
              .join(places.hint("shuffle_hash"), "text_id"))
    cut = partly.select("text_id", "text", "known", "more").mapInArrow(_cut(depth), REMOVED)
    cut = cut.join(texts.select("text_id", "sha"), "text_id").drop("text_id")
    whole = (texts.filter("copies > 1")
             .select("sha", F.octet_length("text").cast("long").alias("n_removed"),
                     F.lit(1).cast("long").alias("n_spans"), F.lit(b"").alias("kept")))
    return cut.select("sha", "n_removed", "n_spans", "kept").unionByName(whole)


def removal_report(docs: DataFrame, depth: int = DEPTH, digit: int = DIGIT) -> DataFrame:
    """Per document: n_bytes, n_removed, n_spans and the SHA-256 of the bytes left."""
    removed = (repeated_passages(docs.select("text"), depth, digit)
               .select("sha", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")))
    rows = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                       _sha("text").alias("sha"))
    zero = F.lit(0).cast("long")
    return (rows.join(removed, "sha", "left")
            .select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"),
                    F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256")))


def without_repeats(docs: DataFrame, depth: int = DEPTH, digit: int = DIGIT) -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text``; every row stays.

    A character cut in two loses its other bytes as well.  ``n_chars``, where
    there is one, counts the new text.
    """
    columns = docs.columns
    names = iter(n for n in (f"_{k}{i}" for i in range(len(columns) + 3) for k in ("sha", "kept")) if n not in columns)
    sha, kept = next(names), next(names)

    @F.pandas_udf("string")
    def readable(parts: pd.Series) -> pd.Series:
        return pd.Series([None if p is None else bytes(p).decode("utf-8", "ignore") for p in parts], dtype=object)

    removed = (repeated_passages(docs.select("text"), depth, digit)
               .select(F.col("sha").alias(sha), readable("kept").alias(kept)))
    out = (docs.withColumn(sha, _sha("text")).join(removed, sha, "left")
           .withColumn("text", F.coalesce(kept, "text")))
    if "n_chars" in columns:
        changed = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col(kept).isNotNull(), changed).otherwise(F.col("n_chars")))
    return out.select(*columns)
