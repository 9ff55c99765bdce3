"""Registered queries: one callable (spark, sf_dir) -> DataFrame per key.

Each runs over the whole derived tables of ``kontor.sources.testbed``.
Call dates below are parameters of the monthly/daily procedures (the
feature), not row caps: the scans still read whole tables and prune by
date at the Parquet reader.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from .functions import dates as D
from .functions import text as X
from .operators import aggregates as AG
from .operators.scd import join_valid_at, valid_at_by_sort
from .operators.sizing import measured_broadcast
from .plans import dimension_counts as DC
from .plans import f101 as F101
from .plans import posting_stats as PS
from .plans import runlog as RL
from .plans import turnover as TO
from .sources import testbed as TB

# The call date of the monthly jobs in the registered queries.
CALL_DATE = "1998-03-03"
# What form 101 is made of; the deltas are no part of it.
FORM_101_VIEWS = [name for name in TB.VIEWS if name != "deltas"]

Query = Callable[[SparkSession, str], DataFrame]


def _ledger(spark, d):
    return {name: TB.view(spark, d, name) for name in
            ("ft_posting_f", "md_account_d", "md_exchange_rate_d")}


def q_posting_collapse(spark, d):
    return TB.view(spark, d, "ft_posting_f")


def q_turnover_day(spark, d):
    v = _ledger(spark, d)
    return TO.turnover_day(v["ft_posting_f"], v["md_account_d"], v["md_exchange_rate_d"], CALL_DATE)


def q_turnover_month(spark, d):
    v = _ledger(spark, d)
    return TO.turnover_month(v["ft_posting_f"], v["md_account_d"], v["md_exchange_rate_d"], CALL_DATE)


def q_turnover_all(spark, d):
    v = _ledger(spark, d)
    return TO.account_turnover(v["ft_posting_f"], v["md_account_d"], v["md_exchange_rate_d"])


def _f101(spark, d, fan_out):
    v = {name: TB.view(spark, d, name) for name in FORM_101_VIEWS}
    turn = TO.turnover_month(v["ft_posting_f"], v["md_account_d"], v["md_exchange_rate_d"], CALL_DATE)
    return F101.f101_report(v["md_ledger_account_s"], v["md_account_d"], v["md_currency_d"],
                            v["ft_balance_f"], v["md_exchange_rate_d"], turn, CALL_DATE, fan_out=fan_out)


def q_f101_report(spark, d):
    return _f101(spark, d, True)


def q_f101_preagg(spark, d):
    return _f101(spark, d, False)


def q_f101_all(spark, d):
    """Every month of the data in one job, each as called on its last day."""
    v = {name: TB.view(spark, d, name) for name in FORM_101_VIEWS}
    p, a, r = v["ft_posting_f"], v["md_account_d"], v["md_exchange_rate_d"]
    span = p.agg(F.min("oper_date").alias("lo"), F.max("oper_date").alias("hi")).first()
    turn = TO.account_turnover(p, a, r)
    return F101.f101_range(v["md_ledger_account_s"], a, v["md_currency_d"], v["ft_balance_f"], r, turn,
                           span["lo"], span["hi"])


def q_valid_at(spark, d):
    """Every account version with the rate valid on the version's first day."""
    acc = TB.view(spark, d, "md_account_d").select("account_rk", "data_actual_date", "currency_rk")
    fx = TB.view(spark, d, "md_exchange_rate_d")
    out = join_valid_at(acc.withColumnRenamed("data_actual_date", "version_date"), fx,
                        ["currency_rk"], "version_date", how="left", dimension=True)
    return out.select("account_rk", "version_date", "currency_rk", "reduced_cource")


def q_opening_balance(spark, d):
    """Every account version with the balance of the eve of its month (left join)."""
    acc = TB.view(spark, d, "md_account_d").select("account_rk", "data_actual_date")
    bal = TB.view(spark, d, "ft_balance_f").select("account_rk", "on_date", "balance_out")
    j = acc.join(bal, (acc.account_rk == bal.account_rk)
                 & (bal.on_date == D.prev_month_end(acc.data_actual_date)), "left")
    return j.select(acc.account_rk, acc.data_actual_date, bal.balance_out)


def q_ledger_prefix_join(spark, d):
    """Account versions matched to their ledger account by number prefix."""
    acc = TB.view(spark, d, "md_account_d")
    led = TB.view(spark, d, "md_ledger_account_s").select("ledger_account", "chapter")
    j = acc.join(measured_broadcast(led),
                 F.substring("account_number", 1, 5) == F.col("ledger_account").cast("string"))
    return j.select("account_rk", "data_actual_date", "ledger_account", "chapter")


def q_posting_minmax(spark, d):
    return PS.posting_minmax(TB.view(spark, d, "ft_posting_f"))


def q_posting_minmax_guarded(spark, d):
    """Every calendar day of the postings' range requested; days without postings give no row."""
    p = TB.view(spark, d, "ft_posting_f")
    return PS.posting_minmax_guarded(p, PS.day_spine(p))


def q_posting_minmax_tvf(spark, d):
    """The SQL table function called laterally for every calendar day of the range."""
    p = TB.view(spark, d, "ft_posting_f")
    return PS.call_posting_function_over(spark, p, PS.day_spine(p))


def q_rate_dedup(spark, d):
    fx = TB.view(spark, d, "md_exchange_rate_d")
    return AG.drop_exact_duplicates(fx.unionByName(fx))


def q_distinct_values(spark, d):
    TB.table(spark, d, "customer").createOrReplaceTempView("customer_v")
    return spark.sql("SELECT DISTINCT c_mktsegment FROM customer_v")


def q_group_count(spark, d):
    return AG.count_by(TB.table(spark, d, "events"), "event_type")


def q_last_delta_id(spark, d):
    return AG.max_or_default(TB.view(spark, d, "deltas"), "delta_id", 0, "last_delta_id")


def q_discipline_join(spark, d):
    counts = DC.counts_per(TB.table(spark, d, "events"), "event_type")
    return DC.join_counts(DC.literal_dimension(spark), counts, "event_type")


def q_literal_dim(spark, d):
    """The literal dimension, each type flagged when events carry it."""
    seen = TB.table(spark, d, "events").select("event_type").distinct().withColumn("seen", F.lit(True))
    dim = DC.literal_dimension(spark)
    return dim.join(seen, "event_type", "left").select("row_id", "event_type", "category",
                                                        F.coalesce("seen", F.lit(False)).alias("seen"))


def q_date_bounds(spark, d):
    o = TB.table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    return o.select("d", D.month_start("d").alias("month_start"), D.month_end("d").alias("month_end"),
                    D.prev_month_end("d").alias("prev_month_end"), D.iso("d").alias("d_text"))


def q_month_spine(spark, d):
    """Every day of every month that has postings."""
    m = TB.view(spark, d, "ft_posting_f").select(D.month_start("oper_date").alias("month_start")).distinct()
    return m.select("month_start", F.explode(D.days_between("month_start", D.month_end("month_start"))).alias("day"))


def q_date_parse(spark, d):
    o = TB.table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "dd.MM.yyyy").alias("d_text"))
    return o.select("o_orderkey", "d_text", D.parse_dotted("d_text").alias("d"))


def q_date_validate(spark, d):
    """yyyy-MM-dd texts, some with an impossible month; invalid ones parse to NULL."""
    o = TB.table(spark, d, "orders")
    month = F.when(F.col("o_orderkey") % 10 == 7, F.lit("13")).otherwise(F.date_format("o_orderdate", "MM"))
    day = F.date_format("o_orderdate", "d")  # one digit where one is enough
    txt = F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("-"), month, F.lit("-"), day)
    t = o.select("o_orderkey", txt.alias("d_text"))
    return t.select("o_orderkey", "d_text", D.parse_iso("d_text").alias("d"),
                    D.parse_iso("d_text").isNotNull().alias("is_valid"))


def q_date_rejects(spark, d):
    """The reject set of those texts."""
    return D.rejected(q_date_validate(spark, d).select("o_orderkey", "d_text"), "d_text")


def q_valid_at_buckets(spark, d):
    """The same look-up on the path for a large version table: joined by month, not broadcast."""
    acc = TB.view(spark, d, "md_account_d").select("account_rk", F.col("data_actual_date").alias("version_date"),
                                                   "currency_rk")
    out = join_valid_at(acc, TB.view(spark, d, "md_exchange_rate_d"), ["currency_rk"], "version_date", how="left",
                        broadcast_limit=-1)
    return out.select("account_rk", "version_date", "currency_rk", "reduced_cource")


def q_valid_at_sorted(spark, d):
    """The same look-up by one sort of versions and facts together."""
    acc = TB.view(spark, d, "md_account_d").select("account_rk", F.col("data_actual_date").alias("version_date"),
                                                   "currency_rk")
    fx = TB.view(spark, d, "md_exchange_rate_d").select("currency_rk", "data_actual_date", "data_actual_end_date",
                                                        "reduced_cource")
    return valid_at_by_sort(acc, fx, ["currency_rk"], "version_date")


def q_text_normalise(spark, d):
    c = TB.table(spark, d, "customer")
    raw = F.concat_ws(", ", F.lower("c_name"), F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit("' ")))
    parts = X.normalise_key_text(raw)
    return c.select("c_custkey", X.strip_quotes(F.upper(F.regexp_replace(raw, r"\s", ""))).alias("key_text"),
                    F.size(parts).alias("n_parts"), F.element_at(parts, 1).alias("first_part"))


def q_log_chunk(spark, d):
    docs = TB.table(spark, d, "documents").select("doc_id", F.col("text").alias("message"))
    # numbered where they are read: no text is shuffled
    out = RL.chunk_messages(docs, ["doc_id"], "message", start_id=1, order="scan")
    return out.select("doc_id", "piece", "record_id", "message", "message_type",
                      F.length("message").alias("chunk_chars"))


def q_log_identity(spark, d):
    """Every piece of the message log with the session it was written by, as flags."""
    docs = TB.table(spark, d, "documents").select("doc_id", F.col("text").alias("message"))
    sc = spark.sparkContext
    rows = RL.log_messages(spark, docs, ["doc_id"])
    number = F.crc32(F.lit(sc.applicationId).cast("binary")).bitwiseAND(F.lit(0x7FFFFFFF))
    return rows.select(
        "record_id", (F.col("pid") == number).alias("own_pid"), (F.col("usename") == F.current_user()).alias("own_user"),
        (F.col("datname") == F.current_database()).alias("own_database"),
        (F.col("application_name") == F.lit(sc.appName)).alias("own_application"),
        F.col("client_addr").isNull().alias("no_address"),
        (F.col("date_time") <= F.current_timestamp()).alias("stamped"))


def q_head_rows(spark, d):
    return TB.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate").orderBy("o_orderkey").limit(10)


NONEMPTY_TABLES = ("nation", "customer", "supplier", "orders", "lineitem", "events", "documents")


def q_nonempty_guard(spark, d):
    from .sources.tables import nonempty_flags
    return nonempty_flags(spark, {t: f"{d.rstrip('/')}/{t}.parquet" for t in NONEMPTY_TABLES + ("no_such_table",)})


QUERIES: dict[str, Query] = {
    "posting_collapse": q_posting_collapse,
    "turnover_day": q_turnover_day,
    "turnover_month": q_turnover_month,
    "turnover_all": q_turnover_all,
    "f101_report": q_f101_report,
    "f101_preagg": q_f101_preagg,
    "f101_all": q_f101_all,
    "valid_at": q_valid_at,
    "valid_at_buckets": q_valid_at_buckets,
    "valid_at_sorted": q_valid_at_sorted,
    "opening_balance": q_opening_balance,
    "ledger_prefix_join": q_ledger_prefix_join,
    "posting_minmax": q_posting_minmax,
    "posting_minmax_guarded": q_posting_minmax_guarded,
    "posting_minmax_tvf": q_posting_minmax_tvf,
    "rate_dedup": q_rate_dedup,
    "distinct_values": q_distinct_values,
    "group_count": q_group_count,
    "last_delta_id": q_last_delta_id,
    "discipline_join": q_discipline_join,
    "literal_dim": q_literal_dim,
    "date_bounds": q_date_bounds,
    "month_spine": q_month_spine,
    "date_parse": q_date_parse,
    "date_validate": q_date_validate,
    "date_rejects": q_date_rejects,
    "text_normalise": q_text_normalise,
    "log_chunk": q_log_chunk,
    "log_identity": q_log_identity,
    "head_rows": q_head_rows,
    "nonempty_guard": q_nonempty_guard,
}


def _io_queries():
    from .queries_io import QUERIES_IO
    return QUERIES_IO


QUERIES.update(_io_queries())
