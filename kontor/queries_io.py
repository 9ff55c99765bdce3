"""Registered queries that write and read back: upsert, merge, delta
folders, slice replacement, CSV round trips, detail load, run log.

Every staging folder is a fresh one under the shared checkpoint folder
(``session.scratch_path``), never a machine-local temp folder.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .operators import deltas as DL
from .operators.bucket_mirror import BucketMirror
from .operators.sizing import STORED
from .operators.upsert import merge, upsert
from .plans import detail_load as DLOAD
from .plans import dimension_counts as DC
from .plans import marts as MT
from .plans import procedures as PR
from .plans import refresh as RF
from .plans import turnover as TO
from .plans.runlog import RunLog
from .session import scratch_path, shuffles_dropped
from .sinks import files as SK
from .sources import csv as CS
from .sources import testbed as TB
from .specs import spec
from .streaming.mirror import run_mirror_stream

MIRROR_PK = ["account_rk"]
HISTORY_PK = ["data_actual_date", "account_rk"]
MIRROR_SCHEMA = T.StructType([
    T.StructField("account_rk", T.LongType()),
    T.StructField("data_actual_date", T.DateType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("amount", T.DecimalType(18, 2)),
])
DELTA_DATE_FORMAT = "dd.MM.yyyy"
FIRST_RUN_UNTIL = "2024-01-15"  # the first mirror run sees the deltas up to this day
CALL_DATE = "1998-03-03"
REMOVED_DAY = _dt.date(1998, 3, 3)


# ---- upsert -------------------------------------------------------------

def _master(spark, d):
    c = TB.table(spark, d, "customer")
    return c.select(F.col("c_custkey").alias("account_rk"), F.col("c_name").alias("name"),
                    F.col("c_nationkey").cast("bigint").alias("nation"),
                    F.col("c_acctbal").cast("decimal(18,2)").alias("balance"),
                    F.col("c_mktsegment").alias("segment"))


def _master_batch(spark, d):
    target = _master(spark, d)
    spent = TB.table(spark, d, "orders").groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("spent"))
    active = target.join(spent, target.account_rk == spent.o_custkey).select(
        "account_rk", "name", "nation", (F.col("balance") - F.col("spent")).cast("decimal(18,2)").alias("balance"),
        F.lit("ACTIVE").alias("segment"))
    s = TB.table(spark, d, "supplier").select(
        (F.lit(TB.SUPPLIER_ACCOUNT_OFFSET) + F.col("s_suppkey")).alias("account_rk"), F.col("s_name").alias("name"),
        F.col("s_nationkey").cast("bigint").alias("nation"), F.col("s_acctbal").cast("decimal(18,2)").alias("balance"),
        F.lit("SUPPLIER").alias("segment"))
    return active.unionByName(s)


def q_upsert_by_key(spark, d):
    return upsert(_master(spark, d), _master_batch(spark, d), ["account_rk"])


def q_upsert_partial(spark, d):
    return upsert(_master(spark, d), _master_batch(spark, d).select("account_rk", "balance"), ["account_rk"])


# ---- deltas ---------------------------------------------------------------

def _empty_mirror(spark):
    return spark.createDataFrame([], MIRROR_SCHEMA)


def q_delta_fold(spark, d):
    return DL.apply_deltas(_empty_mirror(spark), TB.view(spark, d, "deltas"), MIRROR_PK)


def q_delta_fold_history(spark, d):
    return DL.apply_deltas(_empty_mirror(spark), TB.view(spark, d, "deltas"), HISTORY_PK)


def q_delta_merge(spark, d):
    """One MERGE of the newer deltas, folded, into the mirror that the older ones left."""
    deltas = TB.view(spark, d, "deltas")
    until = F.lit(_dt.date.fromisoformat(FIRST_RUN_UNTIL))
    mirror = DL.fold_deltas(deltas.filter(F.col("data_actual_date") <= until), MIRROR_PK).drop(DL.DELTA_ID)
    batch = DL.fold_deltas(deltas.filter(F.col("data_actual_date") > until), MIRROR_PK).drop(DL.DELTA_ID)
    return merge(mirror, batch, MIRROR_PK)


def q_delta_merge_buckets(spark, d):
    """The same MERGE into a mirror stored by buckets: only those that the newer deltas touch are rewritten."""
    deltas = TB.view(spark, d, "deltas")
    until = F.lit(_dt.date.fromisoformat(FIRST_RUN_UNTIL))
    mirror = BucketMirror(spark, scratch_path(spark, "mirror"), MIRROR_SCHEMA, MIRROR_PK, buckets=16)
    for part in (deltas.filter(F.col("data_actual_date") <= until), deltas.filter(F.col("data_actual_date") > until)):
        mirror.merge(DL.fold_deltas(part, MIRROR_PK).drop(DL.DELTA_ID).select(*MIRROR_SCHEMA.fieldNames()))
    return mirror.read()


def q_delta_incremental(spark, d):
    """Two runs, each stamping the rows it writes: the first loads the deltas up to a
    day and logs them; the second resumes after the last *finished* delta in the log."""
    deltas = TB.view(spark, d, "deltas")
    log_path, mirror_root = scratch_path(spark, "etl-log"), scratch_path(spark, "mirror")
    stamped = T.StructType(list(MIRROR_SCHEMA.fields) + [T.StructField("run", T.IntegerType())])
    first = deltas.filter(F.col("data_actual_date") <= F.lit(_dt.date.fromisoformat(FIRST_RUN_UNTIL)))
    v1 = SK.next_version(spark, mirror_root)
    DL.apply_deltas(spark.createDataFrame([], stamped), first.withColumn("run", F.lit(1)), MIRROR_PK).write.parquet(v1)
    SK.finish_version(spark, v1)
    log = RunLog(spark, log_path, "etl_log")
    for did in DL.delta_ids(first):
        log.add("start", did, "mirror")
        log.add("end", did, "mirror")
    log.add("start", 99999999, "mirror")  # a load that never finished: must not count
    log.flush()
    last = DL.last_loaded(log.read(), "mirror")
    mirror = spark.read.schema(stamped).parquet(SK.latest_version(spark, mirror_root))
    return DL.apply_deltas(mirror, deltas.withColumn("run", F.lit(2)), MIRROR_PK, after=last)


def _write_delta_folders(spark, d):
    """The deltas as numbered folders root/<delta_id>/part-*.csv."""
    root = scratch_path(spark, "deltas")
    TB.write_numbered_folders(TB.view(spark, d, "deltas"), root, "delta_id", date_format=DELTA_DATE_FORMAT)
    return root


def q_delta_scan(spark, d):
    root = _write_delta_folders(spark, d)
    return CS.scan_delta_folders(spark, root, MIRROR_SCHEMA, date_format=DELTA_DATE_FORMAT)


def q_delta_stream(spark, d):
    root = _write_delta_folders(spark, d)
    mirror_root, ckpt = scratch_path(spark, "stream-mirror"), scratch_path(spark, "stream-ckpt")
    latest = run_mirror_stream(spark, root, mirror_root, ckpt, MIRROR_SCHEMA, MIRROR_PK,
                               date_format=DELTA_DATE_FORMAT, max_files_per_trigger=7)
    return spark.read.parquet(latest).select(*MIRROR_SCHEMA.fieldNames())


# ---- slices and round trips ---------------------------------------------------

def _month_views(spark, d):
    return TB.view(spark, d, "ft_posting_f"), TB.view(spark, d, "md_account_d"), TB.view(spark, d, "md_exchange_rate_d")


def q_replace_slice(spark, d):
    """Write March, then replace two days whose postings changed (one emptied)."""
    from .functions.dates import month_days

    p, a, r = _month_views(spark, d)
    mart = RF.mart_table(spark, scratch_path(spark, "marts"), "dm_account_turnover_f")
    mart.replace(TO.turnover_month(p, a, r, CALL_DATE), month_days(CALL_DATE))
    changed = [REMOVED_DAY, REMOVED_DAY + _dt.timedelta(days=1)]
    p2 = p.filter(F.col("oper_date") != F.lit(REMOVED_DAY))
    mart.replace(TO.account_turnover(p2, a, r, changed[0], changed[-1]), changed)
    return mart.read()


def _procedure_tables(spark, d):
    """Catalog tables for both marts, and the ledger as the views that SQL users have."""
    for name in TB.VIEWS:
        if name != "deltas":
            TB.view(spark, d, name).createOrReplaceTempView(f"ds_{name}")
    names = []
    for mart in ("dm_account_turnover_f", "dm_f101_round_f"):
        path = scratch_path(spark, mart)
        names.append(f"{mart}_{path[-12:]}")
        PR.create_mart(spark, names[-1], mart, path)
    return names


def q_turnover_procedure(spark, d):
    """The monthly turnover by its SQL procedure, called twice: the second call replaces the first."""
    turnover, _ = _procedure_tables(spark, d)
    for _ in range(2):
        PR.fill_turnover(spark, turnover, CALL_DATE)
    return spark.table(turnover)


def q_f101_procedure(spark, d):
    """Form 101 by its SQL procedure, from the turnover that the other one filled."""
    turnover, form = _procedure_tables(spark, d)
    PR.fill_turnover(spark, turnover, CALL_DATE)
    PR.fill_form_101(spark, form, turnover, CALL_DATE)
    return spark.table(form)


_REFRESHED: dict[tuple[str, str], str] = {}  # one refresh brings both marts up to date


def _refreshed(spark, d):
    key = (spark.sparkContext.applicationId, d)
    if key not in _REFRESHED:
        _REFRESHED[key] = _refresh_run(spark, d)
    return _REFRESHED[key]


def _refresh_run(spark, d):
    """Marts built from a ledger with some stale days, accounts and rates, and refreshed after a load has put them right."""
    from .jobs import read_detail
    from .functions.dates import month_start
    from .operators.sizing import stage

    detail, marts = scratch_path(spark, "detail"), scratch_path(spark, "marts")
    v = {n: TB.view(spark, d, n) for n in TB.VIEWS if n != "deltas"}

    def version(name, df):
        s = spec(name)
        have = [F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in s.schema.fields]
        out = SK.next_version(spark, f"{detail}/{name}")
        with shuffles_dropped(spark):
            df.select(*have).write.option("compression", STORED).parquet(out)
        SK.finish_version(spark, out)

    def load(name, df):
        batch = stage(df.select(*spec(name).columns), f"batch-{name}")
        DLOAD.upsert_days(spark, f"{detail}/{name}", batch, name)
        SK.delete_path(spark, batch.path)

    def refresh():
        return RF.refresh_marts(spark, detail, marts, lambda n: read_detail(spark, detail, n))

    late_day = F.dayofyear("oper_date") % 60 == 7
    p = v["ft_posting_f"]
    stale = p.withColumn("credit_amount", (F.col("credit_amount") + F.lit(1)).cast("decimal(18,2)"))
    load("ft_posting_f", p.filter(~late_day).unionByName(stale.filter(late_day)))
    b = v["ft_balance_f"]
    late_eve = F.month("on_date") == 5
    load("ft_balance_f", b.withColumn("balance_out", F.when(late_eve, F.col("balance_out") + 1).otherwise(
        F.col("balance_out")).cast("decimal(18,2)")))
    late_account = (F.col("account_rk") % 40 == 3) & (month_start("data_actual_date") == F.lit(_dt.date(1997, 7, 1)))
    version("md_account_d", v["md_account_d"].filter(~late_account))
    late_rate = (F.col("currency_rk") % 5 == 2) & (F.col("data_actual_date") == F.lit(_dt.date(1996, 2, 1)))
    version("md_exchange_rate_d", v["md_exchange_rate_d"].filter(~late_rate))
    for n in ("md_currency_d", "md_ledger_account_s"):
        version(n, v[n])
    refresh()
    load("ft_posting_f", p.filter(late_day))
    load("ft_balance_f", b.filter(late_eve))
    version("md_account_d", v["md_account_d"])
    version("md_exchange_rate_d", v["md_exchange_rate_d"])
    refresh()
    return marts


def q_turnover_refresh(spark, d):
    """The turnover mart after a refresh by changed days: equal to one built anew."""
    return RF.mart_table(spark, _refreshed(spark, d), "dm_account_turnover_f").read()


def q_f101_refresh(spark, d):
    """Form 101 of every month after a refresh by changed days: equal to one built anew."""
    return RF.mart_table(spark, _refreshed(spark, d), "dm_f101_round_f").read()


def q_csv_extract(spark, d):
    s = spec("ft_balance_f")
    path = TB.write_extract(TB.view(spark, d, "ft_balance_f"), scratch_path(spark, "extract"), date_format="dd.MM.yyyy")
    return CS.read_extract(spark, path, s.schema, date_format="dd.MM.yyyy")


def _damaged_balances(spark, d):
    """The balance extract with some amounts and dates that are none."""
    b = TB.view(spark, d, "ft_balance_f").select(
        F.date_format("on_date", "dd.MM.yyyy").alias("on_date"), "account_rk", "currency_rk",
        F.col("balance_out").cast("string").alias("balance_out"))
    bad_date = (F.col("account_rk") % 50 == 7) & F.col("on_date").endswith("1996")
    b = b.withColumn("balance_out", F.when(F.col("account_rk") % 90 == 11, F.concat(F.lit("~"), F.col("balance_out")))
                     .otherwise(F.col("balance_out")))
    b = b.withColumn("on_date", F.when(bad_date, F.concat(F.lit("32"), F.substring("on_date", 3, 8))).otherwise(F.col("on_date")))
    path = TB.write_extract(b, scratch_path(spark, "x-damaged"))
    return CS.read_sorted_out(spark, path, spec("ft_balance_f").schema, date_format=DELTA_DATE_FORMAT,
                              encoding=CS.EXTRACT_ENCODING, index_col=True, keep_blank_text=True)


def q_csv_good_rows(spark, d):
    """The good rows of an extract with damage in it."""
    return _damaged_balances(spark, d).good


def q_csv_refused(spark, d):
    """Its refused lines: what is wrong, and the cells behind the index column."""
    refused = _damaged_balances(spark, d).refused
    return refused.select("reason", F.regexp_replace("line", "^[^;]*;", "").alias("line"))


def q_csv_infer(spark, d):
    s = spec("ft_posting_f")
    path = SK.write_csv(TB.view(spark, d, "ft_posting_f"), scratch_path(spark, "postings-csv"))
    inferred = CS.read_inferred(spark, path)
    types = ",".join(inferred.schema[c].dataType.simpleString() for c in s.columns)
    return inferred.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in s.schema.fields],
                           F.lit(types).alias("inferred_types"))


def q_csv_tab_roundtrip(spark, d):
    counts = DC.join_counts(DC.literal_dimension(spark),
                            DC.counts_per(TB.table(spark, d, "events"), "event_type"), "event_type")
    path = SK.write_csv(counts, scratch_path(spark, "tab"), sep="\t", single_file=True)
    schema = T.StructType([T.StructField("event_type", T.StringType()), T.StructField("row_id", T.LongType()),
                           T.StructField("category", T.StringType()), T.StructField("count", T.LongType())])
    return CS.read_tab(spark, path, schema)


def q_mart_roundtrip(spark, d):
    """The whole turnover mart exported to CSV and re-imported into a clone."""
    p, a, r = _month_views(spark, d)
    s = spec("dm_account_turnover_f")
    csv = MT.export_mart(TO.account_turnover(p, a, r), scratch_path(spark, "mart-csv"))
    return MT.import_mart(spark, csv, s.schema, scratch_path(spark, "mart-clone"))


# ---- detail load and its log ---------------------------------------------------

def _detail_run(spark, d):
    root = scratch_path(spark, "detail")
    bal_spec = spec("ft_balance_f")
    stale = TB.view(spark, d, "ft_balance_f").filter(F.col("on_date") < F.lit(_dt.date(1998, 1, 1))).withColumn(
        "balance_out", (F.col("balance_out") + F.lit(1)).cast("decimal(18,2)"))
    # the detail table as an earlier load left it (partitioned by day)
    with shuffles_dropped(spark):
        stale.select(*bal_spec.columns).hint("rebalance", "on_date").write.option("compression", STORED).partitionBy(
            "on_date").parquet(f"{root}/ft_balance_f")
    extracts = {
        "ft_balance_f": TB.write_extract(TB.view(spark, d, "ft_balance_f"), scratch_path(spark, "x-bal"), "dd.MM.yyyy"),
        "md_account_d": TB.write_extract(TB.view(spark, d, "md_account_d"), scratch_path(spark, "x-acc")),
        "md_currency_d": "",
    }
    log_path = scratch_path(spark, "load-log")
    out = DLOAD.load_tables(spark, extracts, root, log_path)
    return out, log_path


def _load_one(spark, d, name, extract_df, date_format=None):
    root = scratch_path(spark, "detail")
    x = TB.write_extract(extract_df, scratch_path(spark, f"x-{name}"), date_format)
    DLOAD.load_tables(spark, {name: x}, root, scratch_path(spark, "load-log"))
    from .jobs import read_detail
    return read_detail(spark, root, name)


def q_detail_load_postings(spark, d):
    """Posting extract with repeated keys (one row per line item): summed per key at load."""
    return _load_one(spark, d, "ft_posting_f", TB.view(spark, d, "raw_postings"))


def q_detail_load_rates(spark, d):
    """Rate extract with every row twice: exact duplicates dropped at load."""
    fx = TB.view(spark, d, "md_exchange_rate_d")
    return _load_one(spark, d, "md_exchange_rate_d", fx.unionByName(fx))


def q_detail_load_currency(spark, d):
    return _load_one(spark, d, "md_currency_d", TB.view(spark, d, "md_currency_d"))


def q_detail_load_accounts(spark, d):
    return _load_one(spark, d, "md_account_d", TB.view(spark, d, "md_account_d"))


def q_detail_load_ledger(spark, d):
    """The chart of accounts: columns the test ledger does not have are blank in the extract."""
    have = TB.view(spark, d, "md_ledger_account_s")
    full = have.select(*[F.col(f.name) if f.name in have.columns else F.lit(None).cast(f.dataType).alias(f.name)
                         for f in spec("md_ledger_account_s").schema.fields])
    loaded = _load_one(spark, d, "md_ledger_account_s", full)
    return loaded.select(*have.columns, F.col("pair_account"))


def q_load_after_failure(spark, d):
    """Accounts loaded in two halves, with a load between them that fails while writing: nothing is lost."""
    from .jobs import read_detail

    root, log = scratch_path(spark, "detail"), scratch_path(spark, "load-log")
    acc = TB.view(spark, d, "md_account_d")
    half = F.col("account_rk") % 2 == 0

    def extract(df):
        return TB.write_extract(df, scratch_path(spark, "x-acc"))

    DLOAD.load_tables(spark, {"md_account_d": extract(acc.filter(half))}, root, log)
    # what a write that broke off leaves: a version folder without the marker of its end
    broken = SK.next_version(spark, f"{root}/md_account_d")
    acc.limit(0).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(broken)
    damaged = acc.filter(half).withColumn("data_actual_end_date", F.lit("31/31/31"))
    DLOAD.load_tables(spark, {"md_account_d": extract(damaged)}, root, log)
    DLOAD.load_tables(spark, {"md_account_d": extract(acc.filter(~half))}, root, log)
    return read_detail(spark, root, "md_account_d")


def root_of(table_path: str) -> str:
    return table_path.rstrip("/").rsplit("/", 1)[0]


def q_detail_load(spark, d):
    out, _ = _detail_run(spark, d)
    from .jobs import read_detail
    return read_detail(spark, root_of(out["ft_balance_f"]), "ft_balance_f")


def q_run_log(spark, d):
    """The log of a load; per source its rows are stamped, in order and inside the run."""
    before = spark.range(1).select(F.current_timestamp().alias("t")).first()["t"]
    _, log_path = _detail_run(spark, d)
    by = Window.partitionBy("sources").orderBy("action_date", F.col("status").desc())
    return RunLog(spark, log_path, "load_logs").read().select(
        "sources", "status", "description", F.row_number().over(by).alias("step"),
        F.coalesce(F.col("action_date").between(F.lit(before), F.current_timestamp()), F.lit(False)).alias("stamped"))


QUERIES_IO = {
    "upsert_by_key": q_upsert_by_key,
    "upsert_partial": q_upsert_partial,
    "delta_fold": q_delta_fold,
    "delta_fold_history": q_delta_fold_history,
    "delta_merge": q_delta_merge,
    "delta_merge_buckets": q_delta_merge_buckets,
    "delta_incremental": q_delta_incremental,
    "delta_scan": q_delta_scan,
    "delta_stream": q_delta_stream,
    "replace_slice": q_replace_slice,
    "turnover_procedure": q_turnover_procedure,
    "f101_procedure": q_f101_procedure,
    "turnover_refresh": q_turnover_refresh,
    "f101_refresh": q_f101_refresh,
    "csv_extract": q_csv_extract,
    "csv_good_rows": q_csv_good_rows,
    "csv_refused": q_csv_refused,
    "csv_infer": q_csv_infer,
    "csv_tab_roundtrip": q_csv_tab_roundtrip,
    "mart_roundtrip": q_mart_roundtrip,
    "detail_load": q_detail_load,
    "detail_load_postings": q_detail_load_postings,
    "detail_load_rates": q_detail_load_rates,
    "detail_load_currency": q_detail_load_currency,
    "detail_load_accounts": q_detail_load_accounts,
    "detail_load_ledger": q_detail_load_ledger,
    "load_after_failure": q_load_after_failure,
    "run_log": q_run_log,
}
