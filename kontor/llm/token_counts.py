"""Token counts by a whole-token shortcut.

The vocabulary is a byte-pair merge table with byte fallback.  Two facts
about it make most merging unnecessary; both are proved from the model
file when a worker starts, not assumed:

* No piece holds the word mark after another character, and a character
  that occurs in no longer piece merges with nothing.  A text therefore
  falls apart, exactly, at every word mark that follows something else and
  around every such character; the parts are encoded independently.
* For each vocabulary string the encoder is run on the string alone.  The
  strings that come back as their own single token form the shortcut
  table: a part found there counts one and is never merged.

Only the remaining parts are merged, once per distinct part and worker
(a table of bounded size remembers them).

Null and empty texts have 0 bytes and 0 tokens.  Columns of the input are
kept; a column already called ``n_bytes``, ``n_tokens`` or ``over_limit``
is replaced.
"""

from __future__ import annotations

import functools
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
BREAK = "\n"  # in no vocabulary string: separates a part from the mark the encoder puts first
REMEMBERED = 400_000  # merged parts kept per worker


class PartCounts(dict):
    """part of a text -> number of tokens; unknown parts are merged on first use."""

    def __init__(self, encoder, proved: dict[str, int]):
        super().__init__(proved)
        self.encoder, self.proved = encoder, proved

    def __missing__(self, part: str) -> int:
        if len(self) > len(self.proved) + REMEMBERED:
            self.clear()
            self.update(self.proved)
        n = self[part] = merged_count(self.encoder, part)
        return n


def merged_count(encoder, part: str) -> int:
    """Tokens of one part, by the library."""
    if part == MARK:  # the encoder adds this mark itself, to non-empty texts only
        return len(encoder.encode(BREAK)) - 1
    if part[0] == MARK:
        return len(encoder.encode(part[1:]))
    return len(encoder.encode(BREAK + part)) - 2


@functools.lru_cache(maxsize=4)
def tables(model_path: str):
    """(pattern that cuts a text into parts, part counts with the proved single tokens)."""
    import sentencepiece

    encoder = sentencepiece.SentencePieceProcessor(model_file=model_path)
    special = [i for i in range(encoder.get_piece_size())
               if encoder.is_control(i) or encoder.is_unknown(i) or encoder.is_byte(i) or encoder.is_unused(i)]
    pieces = [encoder.id_to_piece(i) for i in sorted(set(range(encoder.get_piece_size())) - set(special))]
    if any(MARK in p.lstrip(MARK) for p in pieces):
        raise ValueError("a piece crosses a word boundary: the texts can't be cut there")
    joined = {c for p in pieces if len(p) > 1 for c in p} - {MARK}
    if BREAK in joined or BREAK in pieces:
        raise ValueError("the separator occurs in the vocabulary")
    inside = "".join(map(re.escape, sorted(joined)))
    cut = re.compile(f"{MARK}+[{inside}]*|[{inside}]+|[^{inside}{MARK}]", re.DOTALL)
    whole = [p for p in pieces if cut.fullmatch(p)]
    return cut, PartCounts(encoder, {p: 1 for p in whole if merged_count(encoder, p) == 1})


def count_text(text: str | None, model_path: str) -> int:
    if not text:
        return 0
    cut, counts = tables(model_path)
    return sum(map(counts.__getitem__, cut.findall(MARK + text.replace(" ", MARK))))


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096, text: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit``; no shuffle."""

    @F.pandas_udf("long")
    def n_tokens(texts: pd.Series) -> pd.Series:
        return pd.Series([count_text(t, model_path) for t in texts], dtype="int64")

    return (docs.withColumn("n_bytes", F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long"))
            .withColumn("n_tokens", n_tokens(F.col(text)))
            .withColumn("over_limit", F.col("n_tokens") > F.lit(limit)))
