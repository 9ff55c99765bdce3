"""Keyed upsert and merge without a transactional table format.

``upsert(target, batch, pk)``: rows of ``batch`` replace the target rows
with the same key, new keys are inserted.  When the batch has fewer
columns than the target, matched rows keep their other columns and new
rows get NULL there (``INSERT ... ON CONFLICT DO UPDATE SET (batch
columns)``).

Two physical plans, chosen by the batch's measured (uncompressed) bytes:

* ``broadcast`` (daily batches against a large table): the batch is
  broadcast and the target is only *streamed* -- an anti-join keeps the
  untouched rows, a left join updates matched rows in place; the target
  is never shuffled;
* ``shuffle`` (a batch too large to broadcast): one full outer join on
  the key, both sides hashed once.

Key rules (one rule for both load paths):

* a key repeated inside one batch is an error (``DuplicateKeyError``);
* a NULL key component: ``null_keys="reject"`` (a primary key) raises
  ``NullKeyError``; ``null_keys="insert"`` (merge semantics) inserts the
  row, since NULL never equals anything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shuffles_dropped
from .sizing import DEFAULT_BROADCAST_LIMIT, by_merge, measured_bytes, size_metrics, size_of


class DuplicateKeyError(ValueError):
    pass


class NullKeyError(ValueError):
    pass


def _any_null(keys: Sequence[str]) -> Column:
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return cond


def check_batch_keys(batch: DataFrame, pk: Sequence[str], null_keys: str = "reject") -> int:
    """Raise on a repeated key (or on a NULL key when they are rejected).

    One grouped pass over the batch (partial aggregation map-side); at most
    one offending key reaches the driver.  Returns the batch's uncompressed
    bytes, counted on the same pass.
    """
    pk = list(pk)
    has_null = _any_null(pk)
    rows, text = size_metrics(batch)
    per_key = batch.groupBy(*pk).agg(rows.alias("_n"), text.alias("_t"))
    wrong = (has_null & F.lit(null_keys == "reject")) | (~has_null & (F.col("_n") > 1))
    with shuffles_dropped(batch.sparkSession):
        found = per_key.select("_n", "_t", F.when(wrong, F.struct(*pk, "_n")).alias("_row")).agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.coalesce(F.sum("_t"), F.lit(0)).alias("text"),
            F.first("_row", ignorenulls=True).alias("wrong")).first()
    if found["wrong"] is not None:
        row = found["wrong"].asDict()
        if any(row[k] is None for k in pk):
            raise NullKeyError(f"NULL in key {pk}: {row}")
        raise DuplicateKeyError(f"key {pk} repeated in batch: {row}")
    return size_of(found.asDict(), len(batch.columns))


def resolve_keys(keys: str | Sequence[str], df: DataFrame) -> list[str]:
    """User key list ('data_actual_date, ACCOUNT_RK') -> the table's column names.

    Names are normalised (blanks removed, case folded) and matched without
    regard to case; every key must be a column, else ``ValueError`` names
    the missing ones.
    """
    from ..functions.text import normalise_key_list

    wanted = normalise_key_list(keys)
    by_upper = {c.upper(): c for c in df.columns}
    missing = [k for k in wanted if k not in by_upper]
    if missing or not wanted:
        raise ValueError(f"key column(s) {missing or wanted} not in {df.columns}")
    return [by_upper[k] for k in wanted]


def check_columns(target: DataFrame, batch: DataFrame, pk: Sequence[str]) -> None:
    missing = [k for k in pk if k not in target.columns or k not in batch.columns]
    if missing:
        raise ValueError(f"key column(s) {missing} not in both tables")
    extra = [c for c in batch.columns if c not in target.columns]
    if extra:
        raise ValueError(f"batch column(s) {extra} not in target")


def choose_strategy(batch: DataFrame, strategy: str = "auto", limit: int = DEFAULT_BROADCAST_LIMIT,
                    size: int | None = None) -> str:
    """By the batch's measured bytes: ``size`` where a job has counted them, else counted here."""
    if strategy != "auto":
        return strategy
    return "broadcast" if (measured_bytes(batch) if size is None else size) <= limit else "shuffle"


def upsert(target: DataFrame, batch: DataFrame, pk: Sequence[str], *, check: bool = True,
           null_keys: str = "reject", strategy: str = "auto",
           broadcast_limit: int = DEFAULT_BROADCAST_LIMIT, size: int | None = None) -> DataFrame:
    pk = list(pk)
    check_columns(target, batch, pk)
    if check:
        size = check_batch_keys(batch, pk, null_keys)
    cols = target.columns
    partial = set(batch.columns) != set(cols)
    how = choose_strategy(batch, strategy, broadcast_limit, size)

    if not partial:
        keys = batch.select(*pk)
        keys = F.broadcast(keys) if how == "broadcast" else by_merge(keys)
        return target.join(keys, pk, "left_anti").select(*cols).unionByName(batch.select(*cols))

    updated_cols = [c for c in batch.columns if c not in pk]
    b = batch.select(*pk, *[F.col(c).alias(f"_b_{c}") for c in updated_cols], F.lit(True).alias("_in_b"))

    def merged(in_b: Column) -> list[Column]:
        out = []
        for c in cols:
            if c in pk:
                out.append(F.col(c))
            elif c in updated_cols:
                out.append(F.when(in_b, F.col(f"_b_{c}")).otherwise(F.col(c)).alias(c))
            else:
                out.append(F.col(c))
        return out

    if how == "broadcast":
        # stream the target once: matched rows take the batch's columns
        updated = target.join(F.broadcast(b), pk, "left").select(*merged(F.coalesce("_in_b", F.lit(False))))
        # new keys: batch keys absent from the target (key-only scan, semi-join)
        matched = target.select(*pk).join(F.broadcast(batch.select(*pk)), pk, "left_semi")
        new = batch.join(matched, pk, "left_anti")
        new = new.select(*[F.col(c) if c in batch.columns else F.lit(None).cast(target.schema[c].dataType).alias(c)
                           for c in cols])
        return updated.select(*cols).unionByName(new)

    # one full outer join on the key; the USING form coalesces the key columns
    return target.join(b, pk, "full").select(*merged(F.coalesce("_in_b", F.lit(False))))


def merge(mirror: DataFrame, batch: DataFrame, pk: Sequence[str], **kw) -> DataFrame:
    """MERGE: matched -> update all, not matched -> insert all; NULL keys insert."""
    kw.setdefault("null_keys", "insert")
    return upsert(mirror, batch, pk, **kw)
