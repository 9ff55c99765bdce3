"""Run logs: the append-only audit table and the chunked message log.

* ``RunLog`` gathers the status rows of one run (a handful per table or
  delta: metadata, not data) and appends them in one write, so a run
  leaves one small file instead of one per status.
* ``chunk_messages`` splits every message into pieces of at most 4000
  characters (an empty message stores nothing) and numbers the pieces
  like a database sequence: consecutive ids, either in the order of the
  scan (no row is shuffled) or in the order of the keys (``sequential_ids``:
  no single-task window).
"""

from __future__ import annotations

import datetime as _dt
import zlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import LOG_CHUNK_CHARS, LOG_NOTICE, chunk_piece, chunk_starts
from ..operators.sequence import Sequence as IdSequence
from ..operators.sequence import scan_order_ids, sequential_ids
from ..operators.upsert import check_batch_keys
from ..specs import spec


def chunk_messages(messages: DataFrame, key_cols: Sequence[str], text_col: str = "message",
                   start_id: int | F.Column = 1, message_type: int | str = LOG_NOTICE,
                   size: int = LOG_CHUNK_CHARS, order: str = "key") -> DataFrame:
    """(keys..., piece, record_id, message, message_type) per piece of each message.

    ``message_type`` is a constant or the name of a column of ``messages``.
    The keys must be unique and not NULL, else an error names the key.  With
    ``order="scan"`` the pieces are numbered where they are read: ``messages``
    is a scan or local rows then (see ``scan_order_ids``), and ``start_id`` may
    be a function from the number of pieces to the first id.
    """
    mtype = F.col(message_type) if isinstance(message_type, str) else F.lit(message_type)
    keys = list(key_cols)
    check_batch_keys(messages.select(*keys), keys)  # a NULL or repeated key can not be numbered
    if order == "scan":
        texts = messages.select(*keys, F.col(text_col).alias("_text"), mtype.cast("int").alias("message_type"),
                                F.explode(chunk_starts(text_col, size)).alias("piece"))
        return scan_order_ids(texts, start_id).select(
            *keys, "piece", "record_id", chunk_piece("_text", "piece", size).alias("message"), "message_type")
    weights = messages.select(*keys, F.size(chunk_starts(text_col, size)).alias("n_pieces"))
    ids = sequential_ids(weights, keys, start_id, name="first_id", weight="n_pieces")
    ids = ids.filter(F.col("n_pieces") > 0).select(*keys, "first_id")
    pieces = messages.join(ids, keys).select(
        *keys, "first_id", F.col(text_col).alias("_text"), mtype.cast("int").alias("_type"),
        F.explode(chunk_starts(text_col, size)).alias("piece"))
    return pieces.select(
        *keys,
        "piece",
        (F.col("first_id") + F.col("piece")).cast("long").alias("record_id"),
        chunk_piece("_text", "piece", size).alias("message"),
        F.col("_type").alias("message_type"),
    )


def next_record_id(log: DataFrame | None) -> F.Column:
    """Sequence continuation: max existing id + 1 (1 for an empty log).

    Returned as a scalar subquery-like literal computed on the cluster.
    """
    if log is None:
        return F.lit(1)
    row = log.agg(F.coalesce(F.max("record_id"), F.lit(0)).alias("m")).first()
    return F.lit(int(row["m"]) + 1)


def session_identity(spark: SparkSession) -> dict:
    """Who wrote a log row: the session's user, database and application."""
    sc = spark.sparkContext
    ident = spark.range(1).select(F.current_user().alias("u"), F.current_database().alias("d")).first()
    return {
        "pid": zlib.crc32(sc.applicationId.encode()) & 0x7FFFFFFF,  # one number per application
        "usename": ident["u"],
        "datname": ident["d"],
        "client_addr": None,
        "application_name": sc.appName,
        "backend_start": _dt.datetime.fromtimestamp(sc.startTime / 1000, _dt.timezone.utc).isoformat(),
    }


def log_messages(spark: SparkSession, messages: DataFrame, key_cols: Sequence[str],
                 existing: DataFrame | None = None, message_type: int | str = LOG_NOTICE,
                 sequence: IdSequence | None = None) -> DataFrame:
    """Full ``lg_messages`` rows for a frame of messages.

    The ids come out of ``sequence``, one range for all pieces, so writers at
    work at once never share an id; its first range starts above ``existing``.
    Without a sequence they follow ``existing``'s highest.
    """
    if sequence is None:
        pieces = chunk_messages(messages, key_cols, "message", next_record_id(existing), message_type)
    else:
        def highest() -> int:
            return 0 if existing is None else existing.agg(F.coalesce(F.max("record_id"), F.lit(0))).first()[0]

        pieces = chunk_messages(messages, key_cols, "message", lambda n: sequence.reserve(n, highest), message_type,
                                order="scan")
    who = session_identity(spark)
    cols = [F.col("record_id"), F.current_timestamp().alias("date_time"), F.lit(who["pid"]).cast("long").alias("pid"),
            F.col("message"), F.col("message_type")]
    for c in ("usename", "datname", "client_addr", "application_name", "backend_start"):
        cols.append(F.lit(who[c]).cast("string").alias(c))
    return pieces.select(*cols)


class RunLog:
    """Append-only audit rows (sources, action_date, status, description, error)."""

    def __init__(self, spark: SparkSession, path: str, table: str = "load_logs"):
        self.spark = spark
        self.path = path
        self.spec = spec(table)
        self.rows: list[tuple] = []

    def add(self, *values) -> None:
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        names = self.spec.columns
        row = list(values)
        ts_at = names.index("action_date")
        row.insert(ts_at, now)
        row += [None] * (len(names) - len(row))
        self.rows.append(tuple(row))

    def flush(self) -> int:
        if not self.rows:
            return 0
        n = len(self.rows)
        self.spark.createDataFrame(self.rows, self.spec.schema).coalesce(1).write.mode("append").parquet(self.path)
        self.rows = []
        return n

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.spec.schema).parquet(self.path)
