"""Keeping a mirror up to date from an ordered series of delta batches.

A chain of full-row merges, applied in delta order, leaves for every key
the row of the newest delta that carries it.  So instead of one merge --
one shuffle of the mirror -- per delta:

1. keep the deltas newer than the last one loaded (``after``);
2. fold them: per key, the row with the highest ``delta_id``.  This is a
   hash aggregate with ``max_by``; partial aggregation runs map-side, so
   a key that appears in every delta is reduced before the shuffle;
3. merge the folded batch into the mirror once (``operators.upsert``:
   broadcast when the folded batch is small, so the mirror is streamed).

Rows with a NULL key component never match, so each is inserted as is.
The fold requires each key at most once per delta; ``validate`` checks
that (one aggregation over the deltas, not the mirror).

``apply_deltas_chain`` is the literal loop (one merge per delta id),
kept as the reference form the fold is tested against.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sizing import DEFAULT_BROADCAST_LIMIT, measured_bytes
from .upsert import check_batch_keys, merge

DELTA_ID = "delta_id"


def _any_null(keys: Sequence[str]) -> Column:
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return cond


def newer_than(deltas: DataFrame, after: int | None, order_col: str = DELTA_ID) -> DataFrame:
    return deltas if after is None else deltas.filter(F.col(order_col) > F.lit(after))


def fold_deltas(deltas: DataFrame, pk: Sequence[str], order_col: str = DELTA_ID) -> DataFrame:
    """Last row per key by ``order_col`` (keeps ``order_col``)."""
    pk = list(pk)
    rest = [c for c in deltas.columns if c not in pk]
    keyed = deltas.filter(~_any_null(pk))
    last = keyed.groupBy(*pk).agg(F.max_by(F.struct(*rest), order_col).alias("_last"))
    folded = last.select(*pk, *[F.col(f"_last.{c}").alias(c) for c in rest]).select(*deltas.columns)
    return folded.unionByName(deltas.filter(_any_null(pk)))


def apply_deltas(mirror: DataFrame, deltas: DataFrame, pk: Sequence[str], after: int | None = None,
                 order_col: str = DELTA_ID, validate: bool = True, strategy: str = "auto") -> DataFrame:
    """Mirror after merging every delta newer than ``after``, in order, in one pass."""
    pk = list(pk)
    todo = newer_than(deltas, after, order_col)
    if validate:
        check_batch_keys(todo, pk + [order_col], null_keys="insert")
    folded = fold_deltas(todo, pk, order_col).drop(order_col)
    return merge(mirror, folded.select(*mirror.columns), pk, check=False, strategy=strategy)


def delta_ids(deltas: DataFrame, after: int | None = None, order_col: str = DELTA_ID) -> list[int]:
    """Distinct batch numbers, ascending (numeric order).  One small row per batch."""
    rows = newer_than(deltas, after, order_col).select(order_col).distinct().orderBy(order_col).collect()
    return [r[0] for r in rows]


def apply_deltas_chain(mirror: DataFrame, deltas: DataFrame, pk: Sequence[str], after: int | None = None,
                       order_col: str = DELTA_ID, checkpoint_every: int = 16,
                       strategy: str = "auto") -> DataFrame:
    """One merge per delta id, in numeric order; lineage cut every few merges."""
    from ..session import checkpoint_root

    checkpoint_root(mirror.sparkSession)
    pk = list(pk)
    # every batch's keys checked in one aggregation, not one job per delta
    check_batch_keys(newer_than(deltas, after, order_col), pk + [order_col], null_keys="insert")
    cur = mirror
    for i, did in enumerate(delta_ids(deltas, after, order_col), 1):
        batch = deltas.filter(F.col(order_col) == F.lit(did)).drop(order_col).select(*mirror.columns)
        cur = merge(cur, batch, pk, check=False, strategy=strategy)
        if i % checkpoint_every == 0:
            cur = cur.checkpoint(eager=True)
    return cur


def last_loaded(log: DataFrame, table_name: str, order_col: str = DELTA_ID) -> int:
    """Highest delta id whose load finished (status 'end'); 0 when none.

    Only finished loads count, so a delta that failed mid-way is retried.
    """
    row = (log.filter((F.col("table_name") == table_name) & (F.col("status") == "end"))
              .agg(F.coalesce(F.max(order_col), F.lit(0)).alias("m")).first())
    return int(row["m"])


def merge_newer(mirror: DataFrame, batch: DataFrame, pk: Sequence[str], order_col: str = DELTA_ID,
                broadcast_batch: bool | None = None) -> DataFrame:
    """Merge keeping, per key, the row with the highest ``order_col``.

    Both sides carry ``order_col``.  The result does not depend on the order
    in which batches arrive, so a stream that delivers delta 1005 before
    1003 still converges to the fold of all deltas.  A (size-checked) small
    batch is broadcast and the mirror is streamed, plus one key-only scan.
    """
    pk = list(pk)
    b = fold_deltas(batch, pk, order_col)
    if broadcast_batch is None:  # measured; beyond the limit both joins shuffle on the key
        broadcast_batch = measured_bytes(batch) <= DEFAULT_BROADCAST_LIMIT
    bk = b.select(*pk, F.col(order_col).alias("_bid"))
    bk = F.broadcast(bk) if broadcast_batch else bk
    kept = (mirror.join(bk, pk, "left")
                  .filter(F.col("_bid").isNull() | (F.col(order_col) >= F.col("_bid")))
                  .select(*mirror.columns))
    present = mirror.select(*pk, F.col(order_col).alias("_tid")).join(
        F.broadcast(b.select(*pk)) if broadcast_batch else b.select(*pk), pk, "left_semi")
    fresh = (b.join(present, pk, "left")
              .filter(F.col("_tid").isNull() | (F.col(order_col) > F.col("_tid")))
              .select(*mirror.columns))
    return kept.unionByName(fresh)
