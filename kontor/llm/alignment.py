"""Alignment of two tokenizers over a corpus, and how often their ids meet.

A is a byte-level model of the tokenizers library on space + text, B a
sentencepiece model on text (it adds that space itself).  Both token lists
cover the same bytes.

Alignment
    The cumulative ends of each list go into a dictionary from end to index.
    The ends that both have, sorted, slice the two id lists into groups; a
    group's links are its pairs of tokens with overlapping byte ranges.

Spans
    Both tokenizers always have a token end before a space or line break that
    follows something other than white space: A's pre-tokens never cross it,
    and none of B's pieces holds a mark or line break behind another
    character, which is checked when a worker loads the models.  Texts are cut
    there, and each distinct span of a task is encoded and aligned once (a
    table of at most ``TABLE`` bytes, begun anew when full).  Models without
    these properties get whole texts.

Corpus-wide counts
    A shard of documents (at most 16 MB of text, or one text) is written once:
    per document the spans it has, per span the shard's id pairs it links.
    Only the shard's distinct pairs with their counts are shuffled: summed per
    pair, compared with the largest count of their B id (one row per B id,
    bounded by the vocabulary: broadcast), and sent back to the shard, where
    spans and then documents add them up.  No key has more than one row per
    shard.

Null and empty texts, and texts whose joined bytes differ from space + text
(B reads U+2581 as a space), have no tokens: zeros and no groups.  Repeated
rows count as documents of their own.  Ties for the largest count all count
as best.  An empty table gives an empty result.  Further columns don't matter.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shards import shards, stored_small

MARK, BREAK = "▁", "\n"
TABLE = 128 << 20   # bytes that a task's table of spans may take
ENTRY = 220         # of them for a span besides its text and links


# ---- the two tokenizers ---------------------------------------------------------

def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 stands for itself, the rest follows at U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both encoders, the bytes of their tokens, and where texts may be cut for both."""

    def __init__(self, a_path: str, b_path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        alphabet = byte_alphabet()
        size = 1 + max(self.a.get_vocab().values())
        self.a_bytes = [b""] * size
        for token, i in self.a.get_vocab().items():
            known = all(c in alphabet for c in token)
            self.a_bytes[i] = bytes(alphabet[c] for c in token) if known else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        ids = range(self.b.get_piece_size())
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, ids))]
        plain = [self.b.id_to_piece(i) for i in ids if not (
            self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_byte(i) or self.b.is_unused(i))]
        with open(a_path, encoding="utf-8") as f:
            model = json.load(f)
        steps = model.get("pre_tokenizer") or {}
        self.cuts = (model.get("normalizer") is None and steps.get("type") == "ByteLevel"
                     and bool(steps.get("use_regex")) and not steps.get("add_prefix_space")
                     and not any(MARK in p.lstrip(MARK) or BREAK in p for p in plain)
                     and len(self.b.encode(BREAK)) == 2)
        self.cut = re.compile(r"\s+\S*(?:[^\S \n]\s*\S*)*")

    def spans(self, text: str) -> list[str]:
        """Space + text in spans that both tokenizers encode independently."""
        return self.cut.findall(" " + text) if self.cuts else [" " + text]

    def encode(self, spans: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        a = [e.ids for e in self.a.encode_batch_fast(spans, add_special_tokens=False)]
        if self.cuts:  # behind a break B adds no mark of its own
            b = [ids[2:] for ids in self.b.encode([BREAK + s for s in spans], num_threads=1)]
        else:
            b = self.b.encode([s[1:] for s in spans], num_threads=1)
        return zip(a, b)


@functools.lru_cache(maxsize=2)
def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    return Tokenizers(a_path, b_path)


# ---- alignment of two token lists -------------------------------------------------

def ends(lengths: list[int]) -> dict[int, int]:
    """Cumulative end -> number of tokens up to it."""
    return dict(zip(accumulate(lengths), count(1)))


def groups(a_ends: dict[int, int], b_ends: dict[int, int]) -> list[tuple[int, int, int, int]]:
    """Slices (of A from, to; of B from, to) between the ends that both have."""
    common = sorted(a_ends.keys() & b_ends.keys())
    to_a, to_b = [a_ends[e] for e in common], [b_ends[e] for e in common]
    return list(zip([0, *to_a], to_a, [0, *to_b], to_b))


def group_links(a_len: list[int], b_len: list[int]) -> Iterator[tuple[int, int]]:
    """Positions of the overlapping tokens of one group."""
    i = j = 0
    a_end, b_end = a_len[0], b_len[0]
    while True:
        yield i, j
        if a_end == b_end:  # the group's end: nothing inside it ends for both
            return
        if a_end < b_end:
            i += 1
            a_end += a_len[i]
        else:
            j += 1
            b_end += b_len[j]


class Aligned:
    """A task's table of spans: what the two tokenizers make of each, found once."""

    def __init__(self, both: Tokenizers):
        self.both = both
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.text: list[str] = []                       # groups, as a1,a2|b1;a3|b2
        self.counts = array("q")                        # n_a, n_b, n_groups, links before
        self.codes = array("q")                         # id pairs of all links, a << 32 | b
        self.wrong: set[int] = set()                    # spans whose bytes differ
        self.size = 0

    def add(self, spans: list[str]) -> None:
        a_of, b_of, codes = self.both.a_bytes.__getitem__, self.both.b_bytes.__getitem__, self.codes
        for span, (a, b) in zip(spans, self.both.encode(spans)):
            at = self.place[span] = len(self.text)
            a_parts, b_parts = [*map(a_of, a)], [*map(b_of, b)]
            whole = span.encode()
            written, before = [], len(codes)
            if b"".join(a_parts) != whole or b"".join(b_parts) != whole:
                self.wrong.add(at)
                a = b = []
            else:
                a_len, b_len = [*map(len, a_parts)], [*map(len, b_parts)]
                for i, k, j, m in groups(ends(a_len), ends(b_len)):
                    if k - i == m - j == 1:
                        written.append(f"{a[i]}|{b[j]}")
                        codes.append(a[i] << 32 | b[j])
                    else:
                        written.append(f"{','.join(map(str, a[i:k]))}|{','.join(map(str, b[j:m]))}")
                        codes.extend(a[i + x] << 32 | b[j + y] for x, y in group_links(a_len[i:k], b_len[j:m]))
            text = ";".join(written)
            self.text.append(text)
            self.counts.extend((len(a), len(b), len(written), before))
            self.size += ENTRY + 2 * len(span) + len(text) + 8 * (len(codes) - before)

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """(per span n_a, n_b, n_groups, n_links, first link; codes), copies."""
        counts = np.array(self.counts, np.int64).reshape(-1, 4)
        codes = np.array(self.codes, np.int64)
        links = np.diff(counts[:, 3], append=len(codes))
        return np.column_stack([counts[:, :3], links, counts[:, 3]]), codes


# ---- shards -----------------------------------------------------------------------

DOC, SPANS, PAIR = 0, 1, 2  # kinds of rows
SHARDS = ("kind int, shard long, doc_id {id}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "groups string, first binary, second binary, code long, n long")
STEP = 4 << 20  # characters encoded at a time


def _range_index(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, … for each range, one behind the other."""
    before = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)


def _shard_rows(known: Aligned, shard: int, rows: pa.Table, keep_groups: bool, schema: pa.Schema):
    """Batches of a shard: its documents, its spans' links as places in its pairs, its pairs."""
    used, report = [], []
    if known.size > TABLE:
        known.clear()
    texts = rows["text"]
    at = 0
    while at < rows.num_rows:
        lists, size = [], 0
        while at + len(lists) < rows.num_rows and size <= STEP:
            text = texts[at + len(lists)].as_py() or ""
            lists.append(known.both.spans(text) if text else [])
            size += len(text)
        at += len(lists)
        known.add(list(dict.fromkeys(s for spans in lists for s in spans if s not in known.place)))
        for spans in lists:
            places = [*map(known.place.__getitem__, spans)]
            if known.wrong and not known.wrong.isdisjoint(places):
                places = []
            joined = ";".join(map(known.text.__getitem__, places))
            used.append(np.unique(np.array(places, np.int64), return_counts=True))
            report.append((hashlib.sha256(joined.encode()).hexdigest() if places else "",
                           joined if keep_groups else None))
    counts, codes = known.table()
    local, inverse = np.unique(np.concatenate([p for p, _ in used]), return_inverse=True)
    edges = np.concatenate([[0], np.cumsum([len(p) for p, _ in used])])
    times = np.concatenate([n for _, n in used])
    # sums per document; the extra zero lets reduceat close the last one
    sums = np.zeros((len(used), 4), np.int64)
    filled = np.flatnonzero(np.diff(edges))
    if len(filled):
        sums[filled] = np.add.reduceat(counts[local][inverse, :4] * times[:, None], edges[filled], axis=0)
    links = counts[local, 3]
    of_spans = codes[_range_index(counts[local, 4], links)]
    pairs, place = np.unique(of_spans, return_inverse=True)
    weight = np.bincount(inverse, times, len(local)).astype(np.int64) if len(times) else np.zeros(0, np.int64)
    pair_n = np.bincount(place, np.repeat(weight, links), len(pairs)).astype(np.int64)

    def batch(size: int, **columns):
        fixed = {"shard": pa.array(np.full(size, shard, np.int64))} | columns
        return pa.RecordBatch.from_arrays(
            [fixed[f.name].cast(f.type) if f.name in fixed else pa.nulls(size, f.type) for f in schema], schema=schema)

    def kind(k: int, n: int):
        return pa.array(np.full(n, k, np.int32))

    inverse, times = inverse.astype("<i4"), times.astype("<i4")
    cut = [slice(a, b) for a, b in zip(edges[:-1], edges[1:])]
    yield batch(len(used), kind=kind(DOC, len(used)), doc_id=rows["doc_id"].combine_chunks(),
                **{c: pa.array(sums[:, i]) for i, c in enumerate(("n_a", "n_b", "n_groups", "n_links"))},
                groups_sha256=pa.array([s for s, _ in report], pa.string()),
                groups=pa.array([g for _, g in report], pa.string()),
                first=pa.array([inverse[c].tobytes() for c in cut], pa.binary()),
                second=pa.array([times[c].tobytes() for c in cut], pa.binary()))
    yield batch(1, kind=kind(SPANS, 1), first=pa.array([links.astype("<i4").tobytes()], pa.binary()),
                second=pa.array([place.astype("<i4").tobytes()], pa.binary()))
    for i in range(0, len(pairs), 200_000):
        part = slice(i, i + 200_000)
        yield batch(len(pairs[part]), kind=kind(PAIR, len(pairs[part])), code=pa.array(pairs[part]),
                    n=pa.array(pair_n[part]))


def _make_shards(a_path: str, b_path: str, keep_groups: bool, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Aligned(tokenizers(a_path, b_path))
        for shard, rows in shards(batches, "text"):
            yield from _shard_rows(known, shard, rows, keep_groups, schema)

    return run


def aligned_shards(docs: DataFrame, a_path: str, b_path: str, keep_groups: bool = False) -> DataFrame:
    """The stored shards: rows of documents, spans and id pairs."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    layout = SHARDS.format(id=docs.schema["doc_id"].dataType.simpleString())
    schema = to_arrow_schema(StructType.fromDDL(layout))
    made = docs.select("doc_id", "text").mapInArrow(_make_shards(a_path, b_path, keep_groups, schema), layout)
    return stored_small(made, "alignment")


def link_counts(parts: DataFrame) -> DataFrame:
    """(code, n, best): how many links of the corpus hold the id pair a << 32 | b, and whether none of b's has more."""
    pairs = stored_small(parts.filter(F.col("kind") == PAIR).groupBy("code").agg(F.sum("n").alias("n")), "pairs")
    b_id = F.col("code").bitwiseAND(F.lit((1 << 32) - 1))
    most = pairs.groupBy(b_id.alias("b_id")).agg(F.max("n").alias("most"))  # a row per B id: the vocabulary bounds it
    return (pairs.withColumn("b_id", b_id).join(F.broadcast(most), "b_id")
            .select("code", "n", (F.col("n") == F.col("most")).alias("best")))


def _sums(id_type: pa.DataType):
    def run(parts: pa.Table, found: pa.Table) -> pa.Table:
        order = np.argsort(found["code"].to_numpy(), kind="stable")  # the shard's places are in the order of the codes
        total, best = found["n"].to_numpy()[order], found["best"].to_numpy(zero_copy_only=False)[order]
        kinds = parts["kind"].to_numpy()
        row = parts.slice(int(np.flatnonzero(kinds == SPANS)[0]), 1)
        links = np.frombuffer(row["first"][0].as_py(), "<i4").astype(np.int64)
        place = np.frombuffer(row["second"][0].as_py(), "<i4")
        upto = np.concatenate([[0], np.cumsum(links)])
        # sums per span as differences of running sums; a document's as a weighted sum of its spans'
        of_total = np.diff(np.concatenate([[0], np.cumsum(total[place])])[upto])
        of_best = np.diff(np.concatenate([[0], np.cumsum(best[place], dtype=np.int64)])[upto])
        docs = parts.filter(pa.array(kinds == DOC))
        n_best, count_sum = [], []
        for spans, times in zip(docs["first"], docs["second"]):
            at, n = np.frombuffer(spans.as_py(), "<i4"), np.frombuffer(times.as_py(), "<i4").astype(np.int64)
            n_best.append(int(of_best[at] @ n))
            count_sum.append(int(of_total[at] @ n))
        kept = ("n_a", "n_b", "n_groups", "n_links")
        return pa.table({"doc_id": docs["doc_id"].cast(id_type), **{c: docs[c] for c in kept},
                         "n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64()),
                         "groups_sha256": docs["groups_sha256"], "groups": docs["groups"]})

    return run


def alignment(docs: DataFrame, a_path: str, b_path: str, keep_groups: bool = True) -> DataFrame:
    """Per document: tokens of both, groups, links, the links that are their B id's most frequent, the links' counts
    summed, the groups as ``a1,a2|b1;a3|b2`` (where ``keep_groups``) and their SHA-256."""
    from pyspark.sql.pandas.types import to_arrow_type

    parts = aligned_shards(docs, a_path, b_path, keep_groups)
    found = (parts.filter(F.col("kind") == PAIR).select("shard", "code")
             .join(link_counts(parts), "code").select(F.col("shard").alias("of_shard"), "code", "n", "best"))
    id_type = docs.schema["doc_id"].dataType
    rows = (parts.filter(F.col("kind") != PAIR)
            .select("kind", "shard", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups",
                    "first", "second"))
    result = (f"doc_id {id_type.simpleString()}, n_a long, n_b long, n_groups long, n_links long, n_best long, "
              "count_sum long, groups_sha256 string, groups string")
    return (rows.groupBy("shard").cogroup(found.groupBy("of_shard"))
            .applyInArrow(_sums(to_arrow_type(id_type)), result))
