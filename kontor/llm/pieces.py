"""SentencePiece encoding and decoding by a distinct-chunk table.

No piece of the model holds the word mark after another character, which is
checked when a worker loads the model.  A text therefore falls apart, exactly,
at every mark that follows something else, and around a line break where no
longer piece has one.  The chunks between are marked words: each distinct one
is segmented once per task, all new ones of a batch in one call, and a text's
ids are its chunks' ids joined in the order of their positions.  Decoding is
joined alike; only the first chunk is decoded with the begin id, since the
library drops the mark it puts there itself.  A model with a piece that does
cross a mark gets whole texts.

The table belongs to a task, not to the corpus: a corpus-wide one would have
to move every occurrence of a word twice.  It is bounded in bytes (``TABLE``);
a full one starts anew.  There is no shuffle.

Null and empty texts are the begin and the end id and decode to the empty
text.  Very long texts, repeated rows and ties need no rule of their own; an
empty table gives an empty one.  Columns of the input are kept; one already
called ``ids`` or ``decoded`` is replaced.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
BREAK = "\n"
TABLE = 64 << 20   # bytes of chunks, ids and decoded chunks that a task remembers
ENTRY = 300        # bytes an entry costs besides


class Pieces:
    """The library's encoder with its marked words segmented once each."""

    def __init__(self, model_path: str):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=model_path)
        plain = [lib.id_to_piece(i) for i in range(lib.get_piece_size())
                 if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))]
        self.crossing = (any(MARK in p.lstrip(MARK) for p in plain) or any(BREAK in p for p in plain)
                         or len(lib.encode(BREAK)) != 2)
        self.break_ids = lib.encode(BREAK)[1:]
        self.cut = re.compile(f"{MARK}*[^{MARK}{BREAK}]+|{MARK}+|{BREAK}")
        self.begin, self.end = (np.array([i], "<u4").tobytes() for i in (lib.bos_id(), lib.eos_id()))
        self.ids: dict[str, bytes] = {}
        self.decoded: dict[str, str] = {}
        self.size = 0

    def chunks(self, text: str) -> list[str]:
        """The marked words of a non-empty text."""
        return self.cut.findall(MARK + text.replace(" ", MARK))

    def segment(self, chunks: set[str]) -> None:
        """Adds the chunks that the table doesn't know."""
        if self.size > TABLE:
            self.ids, self.decoded, self.size = {}, {}, 0
        new = [c for c in chunks if c not in self.ids]
        # behind a break the library adds no mark of its own to the chunk and drops none in decoding
        found = [ids[2:] for ids in self.library.encode([BREAK + c for c in new], num_threads=1)]
        texts = self.library.decode([self.break_ids + ids for ids in found], num_threads=1) if found else []
        for chunk, ids, text in zip(new, found, texts):
            self.ids[chunk] = np.array(ids, "<u4").tobytes()
            self.decoded[chunk] = text[1:]
            self.size += ENTRY + 4 * len(ids) + 6 * len(chunk)

    def encode_all(self, texts: list[str]) -> tuple[list[bytes], list[str]]:
        """(little-endian 32-bit ids with begin and end, decoded text) of each text."""
        if self.crossing:
            ids = self.library.encode(texts, add_bos=True, add_eos=True, num_threads=1)
            return [np.array(i, "<u4").tobytes() for i in ids], [self.library.decode(i) for i in ids]
        lists = [self.chunks(t) if t else [] for t in texts]
        self.segment({c for chunks in lists for c in chunks})
        ids_of, text_of = self.ids.__getitem__, self.decoded.__getitem__
        ids, decoded = [], []
        for chunks in lists:
            ids.append(b"".join([self.begin, *map(ids_of, chunks), self.end]))
            if chunks:
                first = self.begin + ids_of(chunks[0])
                decoded.append(self.library.decode(np.frombuffer(first, "<u4").tolist())
                               + "".join(map(text_of, chunks[1:])))
            else:
                decoded.append("")
        return ids, decoded


@functools.lru_cache(maxsize=2)
def pieces(model_path: str) -> Pieces:
    return Pieces(model_path)


PART = 4 << 20  # characters of text encoded at a time


def _parts(texts: list[str]) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size > PART:
            yield part
            part, size = [], 0
    yield part


def encoded(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (binary: little-endian unsigned 32-bit, begin and end included) and ``decoded``."""
    @F.arrow_udf("struct<ids: binary, decoded: string>")
    def encode(column: pa.Array) -> pa.Array:
        known = pieces(model_path)
        ids, decoded = [], []
        for part in _parts([t or "" for t in column.to_pylist()]):
            more, texts = known.encode_all(part)
            ids += more
            decoded += texts
        return pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                                          ["ids", "decoded"])

    kept = [c for c in docs.columns if c not in ("ids", "decoded")]
    both = next(n for n in (f"_encoded{i}" for i in range(len(kept) + 1)) if n not in kept)
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], encode(F.col(text)).alias(both))
    return rows.select(*[F.col(f"`{c}`") for c in kept], f"{both}.ids", f"{both}.decoded")


def encoding_report(docs: DataFrame, model_path: str) -> DataFrame:
    """Per document: number of ids, SHA-256 of the ids and of the decoded text."""
    return encoded(docs.select("doc_id", "text"), model_path).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
