"""Brown class-based bigram language model, trained and applied as Spark jobs.

Words to units to classes
    A word seen ``OWN`` times in the training texts is a unit of its own, so
    the units grow with the vocabulary, as long as it has at least 1/``UNITS``
    of all their tokens; words with 1/``HEAD`` of them always are.  Hence there
    are at most ``UNITS`` of them whatever the text, and what is held per unit
    is bounded.  Every other word belongs to one of ``ENDINGS`` units by a hash
    of its last two characters, known or not.  There are as many classes as the
    root of the number of units, ``CLASSES`` at least.

Exchange clustering
    The counts of neighbouring units over all training text stay in Spark.
    A chunk's counts are dealt out by a hash of the pair, so that a frequent
    word's pairs are added up in many tasks; the sums are packed into blocks
    that hold all neighbours of some units.  The
    ``HEAD`` most frequent words and the endings start from an exchange one by
    one; the other units start in the class of their ending, split evenly
    where there are more classes.  Then all units move in rounds: tasks find
    each unit's best class against the class bigrams of the round, its own
    counts taken out, and a share of the moves is made.  A round that lowers
    the likelihood is taken back and the share halved; this goes on until a
    round gains less than ``GAIN`` of it.  Broadcast are the class bigrams and
    a class per unit, 12 MB at most.

Model
    P(text) = product of P(class | class before) * P(word | class), the end
    of a text being a token and the state before its first word.  Transitions
    are class bigram counts backed off to class frequencies.  Emission is
    P(unit | class) * P(word | unit), the latter with ``EXTRA`` added to each
    of the unit's known words and to one unknown word; a unit of its own has
    one word.  Both are proper distributions over the known words and one unknown
    word per unit.

Counts
    Texts are dealt into chunks by a hash of their place in the scan, so that
    repeated rows spread like others (give it a table as it was written, whose
    scan is the same when a task runs again).  A chunk's distinct words with
    their counts are small against its text and are all that is shuffled:
    counts are added per word, looked up, and sent back per chunk as its
    dictionary, which scores the chunk's texts.  Head words need no look-up;
    no key gathers more than one row per chunk.

Tokens are runs of characters other than space and 0x09-0x0D, A-Z
lower-cased, then one end per text.  Null and empty texts are the end alone;
a text of any length is read whole.  Repeated rows and rows without an id get
a result each and count as often as they are there.  Words with equal counts
are taken in their own order, units with equal gains stay where they are.
Further columns are not read.  With no training text every token has the
unknown word's probability.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .common import _settings, id_remainder, release, shuffle_partitions

OWN = 20              # occurrences that make a word a unit of its own,
UNITS = 1 << 20       # if they are at least this part of all tokens
HEAD, ENDINGS = 1024, 512
CLASSES, ROUNDS = 48, 8  # at least; of the exchange one by one, at the start
GAIN = 1e-3           # of the likelihood's gain over independent classes: a round that adds less is the last
BLOCK = 500_000       # neighbour counts in a block, some: 8 MB at most
MERGED = 2_000_000    # neighbour counts added up in one group, some: 32 MB
FEW = {"spark.sql.execution.arrow.maxBytesPerBatch": "16m"}  # some blocks at a time reach a worker
# copies are packed well and, but for the texts and the chunks' dictionaries, deleted once used
stored = partial(common.stored, compression="zstd")
stored_by_key = partial(common.stored_by_key, compression="zstd")
EXTRA = 0.5           # added to a known word's count within its unit
BACK_OFF = 5.0        # weight of the class frequencies against a class's bigram counts
CHUNK_BYTES = 12 << 20
END = b""             # the end of a text: no word is empty


def tokens(text: str | None) -> list[bytes]:
    """Words and the end."""
    words = (text or "").encode().lower().split()
    words.append(END)
    return words


def ending(word: bytes) -> int:
    """The unit of a word without one of its own: by its last two characters."""
    return zlib.crc32(word.decode("utf-8", "replace")[-2:].encode()) % ENDINGS


def ending_of(word):
    """The same for a column."""
    return F.pmod(F.crc32(F.substring(word.cast("string"), -2, 2).cast("binary")), F.lit(ENDINGS)).cast("int")


# ---- exchange clustering --------------------------------------------------------

def _entropy(x):
    return x * np.log(np.maximum(x, 1e-300))


def exchange(u: np.ndarray, v: np.ndarray, n: np.ndarray, units: int, classes: int = CLASSES,
             rounds: int = ROUNDS) -> np.ndarray:
    """Class of each unit from counts ``n`` of unit ``u`` before unit ``v``."""
    follows = np.zeros((units, units))
    np.add.at(follows, (u, v), n)
    size = follows.sum(axis=0)
    order = np.argsort(-size, kind="stable")
    of = np.empty(units, np.int64)
    of[order] = np.minimum(np.arange(units), units) % classes
    member = np.eye(classes)[of]
    joint = member.T @ follows @ member
    before, after = joint.sum(axis=1), joint.sum(axis=0)
    ahead, behind = follows @ member, follows.T @ member  # unit to class, class to unit
    for _ in range(rounds):
        moved = 0
        for w in order:
            c, own = of[w], follows[w, w]
            a, b = ahead[w].copy(), behind[w].copy()
            if not a.sum() + b.sum():
                continue
            a[c] -= own
            b[c] -= own
            # take the unit out of its class
            joint[c] -= a
            joint[:, c] -= b
            joint[c, c] -= own
            out, into = a.sum() + own, b.sum() + own
            before[c] -= out
            after[c] -= into
            # gain of putting it into each class
            diagonal = np.diag(joint)
            rows = (_entropy(joint + a) - _entropy(joint)).sum(axis=1)
            cols = (_entropy(joint + b[:, None]) - _entropy(joint)).sum(axis=0)
            gain = (rows + cols - (_entropy(diagonal + a) + _entropy(diagonal + b) - 2 * _entropy(diagonal))
                    + _entropy(diagonal + a + b + own) - _entropy(diagonal)
                    - (_entropy(before + out) - _entropy(before)) - (_entropy(after + into) - _entropy(after)))
            best = int(np.argmax(gain))
            if gain[best] <= gain[c] + 1e-9:
                best = c
            joint[best] += a
            joint[:, best] += b
            joint[best, best] += own
            before[best] += out
            after[best] += into
            if best != c:
                moved += 1
                of[w] = best
                for table, side in ((ahead, follows[:, w]), (behind, follows[w])):
                    table[:, c] -= side
                    table[:, best] += side
        if not moved:
            break
    return of


# ---- exchange of all units, in tasks ---------------------------------------------

def _squeezed(ids: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(ids).tobytes(), "zstd", asbytes=True)


def _plain(blob: bytes, rows: int, kind) -> np.ndarray:
    return np.frombuffer(pa.decompress(blob, rows * np.dtype(kind).itemsize, "zstd", asbytes=True), kind)


def _parts(of: np.ndarray, parts: int):
    """(part, places of its rows, in their order) of the parts that have any."""
    order = np.argsort(of, kind="stable")
    edge = np.searchsorted(of[order], np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(edge)).tolist():
        yield p, order[edge[p]: edge[p + 1]]


SENT = "part int, size int, code binary, n binary"


def _sent(code: np.ndarray, n: np.ndarray, groups: int) -> pa.Table:
    """Counts of a chunk's pairs, a row per group; ``code`` ascends and goes as differences."""
    mixed = (code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    rows = [(p, len(at), _squeezed(np.diff(code[at], prepend=0)), _squeezed(n[at]))
            for p, at in _parts((mixed % np.uint64(groups)).astype(np.int64), groups)]
    part, size, codes, counts = zip(*rows) if rows else ((),) * 4
    return pa.table({"part": pa.array(part, pa.int32()), "size": pa.array(size, pa.int32()),
                     "code": pa.array(codes, pa.binary()), "n": pa.array(counts, pa.binary())})


BOTH = "block int, size int, unit binary, other binary, n binary"


def _summed(units: int, blocks: int):
    """Sums of one group's pairs, both ways round, a row per block of units."""
    def run(table: pa.Table) -> pa.Table:
        sizes = table["size"].to_pylist()
        code = np.concatenate([np.cumsum(_plain(x.as_py(), k, np.int64)) for x, k in zip(table["code"], sizes)])
        n = np.concatenate([_plain(x.as_py(), k, np.int64) for x, k in zip(table["n"], sizes)])
        order = np.argsort(code, kind="stable")
        code = code[order]
        edge = np.flatnonzero(np.diff(code, prepend=-1))
        code, n = code[edge], np.add.reduceat(n[order], edge)
        u, v = (code // units).astype(np.int32), (code % units).astype(np.int32)
        rows = []
        for unit, other in ((u, v), (v, -1 - u)):
            rows += [(p, len(at), *map(_squeezed, (unit[at], other[at], n[at]))) for p, at in _parts(unit % blocks, blocks)]
        names, kinds = ("block", "size", "unit", "other", "n"), (pa.int32(), pa.int32()) + (pa.binary(),) * 3
        return pa.table({c: pa.array(x, k) for c, x, k in zip(names, zip(*rows), kinds)})

    return run


def _pack(table: pa.Table) -> pa.Table:
    """One block, in the order of its units: these, their neighbours (followers as they are, those
    before as -1 - unit) and counts."""
    sizes = table["size"].to_pylist()
    columns = {c: np.concatenate([_plain(x.as_py(), m, k) for x, m in zip(table[c], sizes)])
               for c, k in (("unit", np.int32), ("other", np.int32), ("n", np.int64))}
    order = np.argsort(columns["unit"], kind="stable")
    return pa.table({c: pa.array([x[order].tobytes()], pa.binary()) for c, x in columns.items()})


def packed(met: DataFrame, units: int, blocks: int) -> DataFrame:
    """(unit, other, n): neighbour counts in both directions, all of a unit in one block."""
    sums = met.groupBy("part").applyInArrow(_summed(units, blocks), BOTH)
    return stored(sums.groupBy("block").applyInArrow(_pack, "unit binary, other binary, n binary"), "blocks")


def _blocks(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for unit, other, n in zip(*batch.columns):
            yield (np.frombuffer(unit.as_py(), np.int32), np.frombuffer(other.as_py(), np.int32),
                   np.frombuffer(n.as_py(), np.int64))


def _pair_sums(shared, groups: int):
    """Counts of neighbouring groups of units: (code, n).  The groups are few: a table of them is 19 MB at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shared.value
        total = np.zeros(groups * groups)
        for unit, other, n in _blocks(batches):
            ahead = other >= 0
            total += np.bincount(of[unit[ahead]].astype(np.int64) * groups + of[other[ahead]], n[ahead], len(total))
        code = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(code, pa.int64()), pa.array(total[code].astype(np.int64))],
                                         names=["code", "n"])

    return run


def group_pairs(blocks: DataFrame, of: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(before, after, n) of the groups of units, at most groups**2 rows."""
    shared = blocks.sparkSession.sparkContext.broadcast(of.astype(np.int32))
    with _settings(blocks.sparkSession, FEW):
        rows = (blocks.mapInArrow(_pair_sums(shared, groups), "code long, n long").groupBy("code")
                .agg(F.sum("n").alias("n")).toPandas().sort_values("code"))
    shared.unpersist()
    code = rows["code"].to_numpy(np.int64)
    return code // groups, code % groups, rows["n"].to_numpy(np.int64)


def best_classes(unit, other, n, of: np.ndarray, joint: np.ndarray):
    """(unit, best class) of the units that gain by moving, the others staying where they are; ``unit`` ascends."""
    classes = len(joint)
    edge = np.diff(unit, prepend=-1) != 0
    own, at = unit[edge], np.cumsum(edge) - 1
    ahead = other >= 0
    a, b = (np.bincount(at[m] * classes + of[o[m]], n[m], len(own) * classes).reshape(-1, classes)
            for m, o in ((ahead, other), (~ahead, -1 - other)))
    before, after = joint.sum(axis=1) + 1e-9, joint.sum(axis=0) + 1e-9
    expected = np.outer(before, after) / max(joint.sum(), 1)  # of independent classes, as a weak prior
    ratio = np.log((joint + expected / before[:, None]) / expected)
    gain = a @ ratio.T + b @ ratio
    # its own class is looked at without it
    c, rows = of[own], np.arange(len(own))
    out, into = a.sum(axis=1, keepdims=True), b.sum(axis=1, keepdims=True)
    total = max(joint.sum(), 1)
    rest = np.maximum(before[c][:, None] - out, 1e-9)
    gain[rows, c] = (a * np.log((np.maximum(joint[c] - a, 0) + after / total) * total / (rest * after))).sum(axis=1)
    rest = np.maximum(after[c][:, None] - into, 1e-9)
    gain[rows, c] += (b * np.log((np.maximum(joint[:, c].T - b, 0) + rest / total) * total / (before * rest))).sum(axis=1)
    best = gain.argmax(axis=1)
    moves = gain[rows, best] > gain[rows, c] + 1e-9
    return own[moves], best[moves]


def _moves(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, joint = shared.value
        for block in _blocks(batches):
            unit, best = best_classes(*block, of, joint)
            yield pa.RecordBatch.from_arrays([pa.array(unit, pa.int32()), pa.array(best, pa.int32())],
                                             names=["unit", "best"])

    return run


def _information(joint: np.ndarray) -> float:
    """The class bigrams' part of the log-likelihood, over that of independent classes."""
    return float(_entropy(joint).sum() - _entropy(joint.sum(axis=1)).sum() - _entropy(joint.sum(axis=0)).sum()
                 + _entropy(joint.sum()))


def exchange_all(blocks: DataFrame, of: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """(class of each unit, class bigrams) by rounds over all units, from the classes ``of``."""
    def bigrams(of):
        joint = np.zeros((classes, classes))
        u, v, n = group_pairs(blocks, of, classes)
        joint[u, v] = n
        return joint

    rng, share = np.random.default_rng(5), 0.5
    joint = bigrams(of)
    while joint.any() and share > 0.05:
        shared = blocks.sparkSession.sparkContext.broadcast((of.astype(np.int32), joint))
        with _settings(blocks.sparkSession, FEW):
            rows = blocks.mapInArrow(_moves(shared), "unit int, best int").toPandas().sort_values("unit")
        shared.unpersist()
        if not len(rows):
            break
        some = rng.random(len(rows)) < share
        after = of.copy()
        after[rows["unit"].to_numpy()[some]] = rows["best"].to_numpy()[some]
        there = bigrams(after)
        gained = _information(there) - _information(joint)
        if gained <= 0:
            share /= 2
            continue
        of, joint = after, there
        if gained < GAIN * _information(joint):
            break
    return of, joint


def split_classes(of: np.ndarray, free: np.ndarray, classes: int) -> np.ndarray:
    """The units ``free`` of ``CLASSES`` classes spread over more: each class split by its share of them."""
    of, extra = of.copy(), classes - CLASSES
    at = CLASSES
    for c in range(CLASSES):
        mine = free[of[free] == c]
        parts = int(extra * len(mine) / max(len(free), 1))
        part = np.arange(len(mine)) % (parts + 1)
        of[mine[part > 0]] = at + part[part > 0] - 1
        at += parts
    return of


# ---- training ------------------------------------------------------------------

@dataclass
class Model:
    head: dict           # word -> unit
    head_count: np.ndarray
    first_ending: int    # units of one word come before
    of: np.ndarray       # class of each unit
    transition: np.ndarray  # log10 P(class | class before)
    unit_part: np.ndarray   # log10 P(unit | class)
    unit_tokens: np.ndarray
    unit_words: np.ndarray
    train_tokens: int
    train_words: int

def _chunk_words(table: pa.Table) -> pa.Table:
    """Distinct words of one chunk: (chunk, word, n in training texts)."""
    trained, seen = Counter(), set()
    for text, held in zip(table["text"], table["held_out"]):
        words = tokens(text.as_py())
        if held.as_py():
            seen.update(words)
        else:
            trained.update(words)
    for w in seen:
        trained.setdefault(w, 0)
    words = list(trained)
    chunk = table["chunk"][0].as_py()
    return pa.table({"chunk": pa.array([chunk] * len(words), pa.int32()), "word": pa.array(words, pa.binary()),
                     "n": pa.array(list(trained.values()), pa.int64())})


def _unit_pairs(head: dict, first_ending: int, groups: int):
    """Counts of neighbouring units of one chunk, whose dictionary has the words with units of their own."""
    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        units = Units(head, first_ending, zip(found["word"].to_numpy(), found["unit"].to_numpy().tolist()))
        line = array("i", [units[END]])
        for text, held in zip(texts["text"], texts["held_out"]):
            if not held.as_py():
                line.extend(map(units.__getitem__, tokens(text.as_py())))
        del units
        ids = np.frombuffer(line, np.int32)
        code = ids[:-1] * np.int64(first_ending + ENDINGS)
        code += ids[1:]
        code.sort()
        edge = np.flatnonzero(np.diff(code, prepend=-1))
        return _sent(code[edge], np.diff(edge, append=len(code)).astype(np.int64), groups)

    return run


class Units(dict):
    """word -> unit of one chunk's words."""

    def __init__(self, head: dict, first_ending: int, found):
        super().__init__(head)
        self.update(found)
        self.first_ending = first_ending

    def __missing__(self, word: bytes) -> int:
        u = self[word] = self.first_ending + ending(word)
        return u


def chunked(docs: DataFrame, held_out, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The texts, dealt into chunks by a hash and stored by chunk."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), held_out.alias("held_out"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-size // chunk_bytes))
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(chunks)).cast("int"))
    return stored_by_key(dealt, "chunk", min(chunks, shuffle_partitions(spark)), "chunks")


def chunks_of(texts: DataFrame) -> int:
    return (texts.agg(F.max("chunk")).first()[0] or 0) + 1


def fit(texts: DataFrame) -> tuple[Model, DataFrame]:
    """(model, dictionaries): the model's tables, and each chunk's training words but the head's, with unit and count."""
    spark = texts.sparkSession
    words = stored(texts.groupBy("chunk").applyInArrow(
        _chunk_words, "chunk int, word binary, n long"), "chunk_words")
    counts = stored(words.filter("n > 0").groupBy("word").agg(F.sum("n").alias("n"))
                    .withColumn("ending", ending_of(F.col("word"))), "word_counts")
    total, distinct = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    total = total or 0
    buckets = shuffle_partitions(spark)
    # the most frequent words; the end is always one of them
    own = ((F.col("n") >= OWN) & (F.col("n") * UNITS >= total)) | (F.col("n") * HEAD >= total) | (F.col("word") == F.lit(END))
    first = counts.filter(own).orderBy((F.col("word") == F.lit(END)).desc(), F.col("n").desc(), "word").limit(HEAD)
    common = sorted(((bytes(r["word"]), r["n"]) for r in first.select("word", "n").collect()),
                    key=lambda r: (-r[1], r[0])) or [(END, 0)]
    head = {w: i for i, (w, _) in enumerate(common)}
    known = spark.createDataFrame([(w,) for w in head], "word binary")
    others = counts.join(F.broadcast(known), "word", "left_anti")
    # the other words with a unit of their own are numbered part by part
    parts = stored(others.filter(own).repartition(buckets, "word").withColumn("part", F.spark_partition_id()), "units")
    sizes = dict(sorted(map(tuple, parts.groupBy("part").count().collect())))
    starts = dict(zip(sizes, (len(head) + np.concatenate([[0], np.cumsum(list(sizes.values()))])).tolist()))
    first_ending = len(head) + sum(sizes.values())
    units = first_ending + ENDINGS
    start = spark.createDataFrame(list(starts.items()), "part int, start long")
    numbered = stored(parts.join(F.broadcast(start), "part")
                      .select("word", "n", "ending", (F.col("start") - 1 + F.row_number().over(
                          Window.partitionBy("part").orderBy("word"))).cast("int").alias("unit")), "numbered")
    rest = others.filter(~own).select("word", "n", "ending", (F.lit(first_ending) + F.col("ending")).cast("int").alias("unit"))
    needed = stored_by_key(words.join(F.broadcast(known), "word", "left_anti").select("chunk", "word")
                           .join(numbered.unionByName(rest).select("word", "n", "unit"), "word"),
                           "chunk", min(buckets, chunks_of(texts)), "dictionaries")

    unit_tokens = np.zeros(units)
    unit_words = np.zeros(units)
    unit_tokens[: len(head)] = [n for _, n in common]
    unit_words[:first_ending] = 1
    start_of = np.arange(units)  # units of the exchange one by one: head words, then endings
    start_of[first_ending:] = len(head) + np.arange(ENDINGS)
    middle = numbered.select("unit", "n", "ending").toPandas()  # 16 bytes for each of at most UNITS units
    unit_tokens[middle["unit"]] = middle["n"]
    start_of[middle["unit"]] = len(head) + middle["ending"]
    for r in rest.groupBy("ending").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect():
        unit_tokens[first_ending + r["ending"]], unit_words[first_ending + r["ending"]] = r["n"], r["words"]
    release(words, counts, parts, numbered)  # what they hold is in the dictionaries now

    groups, parts = -(-(total + 1) // MERGED), -(-2 * (total + 1) // BLOCK)
    met = (texts.groupBy("chunk").cogroup(needed.filter(F.col("unit") < first_ending).groupBy("chunk"))
           .applyInArrow(_unit_pairs(head, first_ending, groups), SENT))
    blocks = packed(met, units, parts)
    classes = max(CLASSES, math.isqrt(units))
    small = len(head) + ENDINGS
    of = exchange(*group_pairs(blocks, start_of, small), small)[start_of]
    of = split_classes(of, np.arange(len(head), first_ending), classes)
    of, joint = exchange_all(blocks, of, classes)
    release(blocks)
    # smoothed throughout: every class and unit keeps a share, also of text never seen
    mass = np.bincount(of, unit_tokens + EXTRA, classes) + 1e-9
    frequency = mass / mass.sum()
    transition = (joint + BACK_OFF * frequency) / (joint.sum(axis=1, keepdims=True) + BACK_OFF)
    unit_part = (unit_tokens + EXTRA) / mass[of]
    model = Model(head, unit_tokens[: len(head)], first_ending, of, np.log10(transition), np.log10(unit_part),
                  unit_tokens, unit_words, int(total), int(distinct))
    return model, needed


# ---- scoring ------------------------------------------------------------------

RESULT = ("doc_id {id}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
          "score double")


def _score_chunk(shared, id_type: pa.DataType):
    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        m: Model = shared.value
        # the chunk's dictionary: head words, the others found; unknown words by their ending
        place = dict(m.head)
        place.update(zip(found["word"].to_numpy(), range(len(m.head), len(m.head) + len(found))))
        unit = np.concatenate([np.arange(len(m.head)), found["unit"].to_numpy(), m.first_ending + np.arange(ENDINGS)])
        count = np.concatenate([m.head_count, found["n"].to_numpy(), np.zeros(ENDINGS)])
        unknown = len(unit) - ENDINGS

        class Places(dict):
            def __missing__(self, word):
                i = self[word] = unknown + ending(word)
                return i

        place = Places(place)
        emit = m.unit_part[unit] + np.where(
            unit < m.first_ending, 0.0,
            np.log10((count + EXTRA) / (m.unit_tokens[unit] + EXTRA * (m.unit_words[unit] + 1))))
        base = np.log10((count + 1) / (m.train_tokens + m.train_words + 1))
        of = m.of[unit]
        start = m.of[m.head[END]]
        # all texts as one line; a text's tokens end with the next one's first place
        line, ends = array("i"), []
        for text in texts["text"]:
            line.extend(map(place.__getitem__, tokens(text.as_py())))
            ends.append(len(line))
        at, ends = np.frombuffer(line, np.int32), np.array(ends, np.int64)
        first = np.concatenate([[0], ends[:-1]]).astype(np.int64)[: len(ends)]
        c = of[at]
        before = np.concatenate([[start], c[:-1]])[: len(c)]
        before[first] = start
        score = m.transition[before, c]
        del before, c
        score += emit[at]
        known = (count > 0).astype(np.int64)
        sums = [np.add.reduceat(x, first) if len(first) else x for x in (known[at], base[at], score)]
        return pa.table({"doc_id": texts["doc_id"].cast(id_type), "held_out": texts["held_out"],
                         "n_tokens": pa.array(ends - first, pa.int64()), "n_known": pa.array(sums[0], pa.int64()),
                         "train_tokens": pa.array([m.train_tokens] * len(ends), pa.int64()),
                         "base_score": pa.array(sums[1], pa.float64()), "score": pa.array(sums[2], pa.float64())})

    return run


def score_documents(docs: DataFrame, modulus: int = 7, held_out: int = 2, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per document: held_out, n_tokens, n_known, train_tokens, base_score (add-one unigrams) and score (log10)."""
    from pyspark.sql.pandas.types import to_arrow_type

    texts = chunked(docs, id_remainder(F.col("doc_id"), modulus) == held_out, chunk_bytes)
    model, needed = fit(texts)
    id_type = docs.schema["doc_id"].dataType
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return (texts.groupBy("chunk").cogroup(needed.groupBy("chunk"))
            .applyInArrow(_score_chunk(shared, to_arrow_type(id_type)), RESULT.format(id=id_type.simpleString())))
