"""Text helpers: message chunking, key-list normalisation, capitalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for the same results:
# a log row holds at most 4000 characters of a message; message type 1 is NOTICE.
LOG_CHUNK_CHARS = 4000
LOG_NOTICE = 1


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def chunk_starts(text, size: int = LOG_CHUNK_CHARS) -> Column:
    """0-based chunk numbers of a text; empty or NULL text gives none."""
    t = _c(text)
    n = F.length(t)
    return F.when(n > 0, F.sequence(F.lit(0), F.floor((n - 1) / F.lit(size)).cast("int"))).otherwise(
        F.array().cast("array<int>")
    )


def chunk_piece(text, piece, size: int = LOG_CHUNK_CHARS) -> Column:
    """Piece ``piece`` (0-based) of a text split in runs of ``size`` characters."""
    return F.substring(_c(text), _c(piece) * F.lit(size) + F.lit(1), F.lit(size))


def normalise_key_list(keys: str | list[str]) -> list[str]:
    """User key list -> column names: upper-case, blanks removed, split on commas.

    Applies to a handful of column *names* on the driver, never to data.
    """
    if isinstance(keys, str):
        keys = keys.split(",")
    out = []
    for k in keys:
        k = "".join(str(k).split()).upper()
        if k:
            out.append(k)
    return out


def normalise_key_text(s) -> Column:
    """Column form of the same rule (for key lists stored as data)."""
    return F.split(F.upper(F.regexp_replace(_c(s), r"\s", "")), ",")


def strip_quotes(s) -> Column:
    return F.replace(_c(s), F.lit("'"), F.lit(""))


def capitalise(s) -> Column:
    """initcap: first letter of each blank-separated word upper, the rest lower."""
    return F.initcap(_c(s))
