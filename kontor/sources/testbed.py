"""Ledger tables derived from the driver's TPC-H-like tables.

Every view is a plain DataFrame expression over ``/root/testdata/sf*``,
so its size grows with the scale factor, and every view has a word-for-
word SQL twin in ``kontor.oracle`` that DuckDB runs as a CTE.  Nothing is
sampled or capped.

* ``ft_posting_f``  lineitem x orders: one posting per (order date,
  supplier account, customer account), both amounts the sum of the
  extended prices (collapsed by key, as the loader does);
* ``md_account_d``  customers and suppliers that have postings, one
  version per month from their first to their last active month;
* ``md_currency_d`` nations, open-ended;
* ``md_exchange_rate_d`` monthly rates of the foreign currencies over the
  months their accounts exist, some months deliberately missing;
* ``ft_balance_f``  each account's balance on the eve of each version,
  some accounts deliberately without balances;
* ``md_ledger_account_s`` the chart of ledger accounts the account
  numbers point at;
* ``deltas``        events: the last event of each user on each day,
  numbered ``yyyyMMdd`` like the numbered delta folders.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import collapse_by_key
from ..operators.sizing import STORED, by_merge
from ..session import scratch_path, shuffles_dropped
from ..sinks.files import _fs
from ..specs import DOMESTIC_CURRENCY_CODES as DOMESTIC_CODES
from .csv import enable_legacy_charsets

# Fixed values of the derived test ledger (shared with kontor.oracle):
SUPPLIER_ACCOUNT_OFFSET = 1_000_000_000_000
LEDGER_BASE = 30100
LEDGER_SPREAD = 7
OPEN_START = "1900-01-01"
OPEN_END = "2999-12-31"
EXTRACT_FILE_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def currency_code(rk: Column) -> Column:
    return (F.when(rk % 10 == 0, F.lit(DOMESTIC_CODES[0]))
            .when(rk % 10 == 5, F.lit(DOMESTIC_CODES[1]))
            .otherwise(F.lpad(rk.cast("string"), 3, "0")))


def raw_postings(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(by_merge(o), li.l_orderkey == o.o_orderkey)
    amount = F.col("l_extendedprice").cast("decimal(18,2)")
    return j.select(
        F.col("o_orderdate").cast("date").alias("oper_date"),
        (F.lit(SUPPLIER_ACCOUNT_OFFSET) + F.col("l_suppkey")).alias("credit_account_rk"),
        F.col("o_custkey").alias("debet_account_rk"),
        amount.alias("credit_amount"),
        amount.alias("debet_amount"),
    )


POSTING_KEYS = ["oper_date", "credit_account_rk", "debet_account_rk"]


def postings(spark, sf_dir, raw: DataFrame | None = None) -> DataFrame:
    if raw is not None:
        return collapse_by_key(raw, POSTING_KEYS, ["credit_amount", "debet_amount"], cast_to="decimal(18,2)")
    return _both_amounts(_one_amount(spark, sf_dir))


def _one_amount(spark, sf_dir) -> DataFrame:
    """Postings with one amount: both amounts of a line item are one column, so one sum is shuffled and stored."""
    return collapse_by_key(raw_postings(spark, sf_dir), POSTING_KEYS, ["credit_amount"], cast_to="decimal(18,2)")


def _both_amounts(one: DataFrame) -> DataFrame:
    return one.select("*", F.col("credit_amount").alias("debet_amount"))


def _account_base(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("account_rk"),
        F.col("c_nationkey").cast("bigint").alias("currency_rk"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "A").otherwise("P").alias("char_type"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("acctbal"),
    )
    s = table(spark, sf_dir, "supplier").select(
        (F.lit(SUPPLIER_ACCOUNT_OFFSET) + F.col("s_suppkey")).alias("account_rk"),
        F.col("s_nationkey").cast("bigint").alias("currency_rk"),
        F.when(F.col("s_suppkey") % 2 == 0, "A").otherwise("P").alias("char_type"),
        F.col("s_acctbal").cast("decimal(18,2)").alias("acctbal"),
    )
    return c.unionByName(s)


def account_spans(spark, sf_dir, p: DataFrame | None = None) -> DataFrame:
    """First and last posting day of each account."""
    p = postings(spark, sf_dir) if p is None else p
    legs = p.select(F.col("credit_account_rk").alias("account_rk"), "oper_date").unionByName(
        p.select(F.col("debet_account_rk").alias("account_rk"), "oper_date"))
    return legs.groupBy("account_rk").agg(F.min("oper_date").alias("lo"), F.max("oper_date").alias("hi"))


def _account_versions(spark, sf_dir, p: DataFrame | None = None, span: DataFrame | None = None) -> DataFrame:
    span = account_spans(spark, sf_dir, p) if span is None else span
    months = F.sequence(F.trunc("lo", "MM"), F.trunc("hi", "MM"), F.expr("INTERVAL 1 MONTH"))
    return _account_base(spark, sf_dir).join(span, "account_rk").select(
        "account_rk", "currency_rk", "char_type", "acctbal", F.explode(months).alias("data_actual_date"))


def accounts(spark, sf_dir, p: DataFrame | None = None, span: DataFrame | None = None) -> DataFrame:
    v = _account_versions(spark, sf_dir, p, span)
    number = F.concat((F.lit(LEDGER_BASE) + F.col("currency_rk") % LEDGER_SPREAD).cast("string"),
                      F.lpad(F.col("account_rk").cast("string"), 15, "0"))
    return v.select(
        "data_actual_date",
        F.last_day("data_actual_date").alias("data_actual_end_date"),
        "account_rk",
        number.alias("account_number"),
        "char_type",
        "currency_rk",
        currency_code(F.col("currency_rk")).alias("currency_code"),
    )


def balances(spark, sf_dir, p: DataFrame | None = None, span: DataFrame | None = None) -> DataFrame:
    v = _account_versions(spark, sf_dir, p, span)
    return v.filter(F.col("account_rk") % 17 != 3).select(
        F.date_sub("data_actual_date", 1).alias("on_date"),
        "account_rk",
        "currency_rk",
        F.col("acctbal").alias("balance_out"),
    )


def currencies(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    rk = F.col("n_nationkey").cast("bigint")
    code = currency_code(rk)
    return n.select(
        rk.alias("currency_rk"),
        F.to_date(F.lit(OPEN_START)).alias("data_actual_date"),
        F.to_date(F.lit(OPEN_END)).alias("data_actual_end_date"),
        code.alias("currency_code"),
        F.when(code.isin(*DOMESTIC_CODES), F.lit("RUB"))
         .otherwise(F.concat(F.lit("C"), F.lpad(rk.cast("string"), 2, "0"))).alias("code_iso_char"),
    )


def rates(spark, sf_dir, acc: DataFrame | None = None) -> DataFrame:
    acc = accounts(spark, sf_dir) if acc is None else acc
    span = acc.groupBy("currency_rk").agg(F.min("data_actual_date").alias("lo"),
                                          F.max("data_actual_date").alias("hi"))
    foreign = currencies(spark, sf_dir).filter(~F.col("currency_code").isin(*DOMESTIC_CODES))
    m = foreign.join(span, "currency_rk").select(
        "currency_rk", "currency_code",
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("data_actual_date"))
    m = m.filter((F.month("data_actual_date") + F.col("currency_rk")) % 11 != 0)
    month_no = F.year("data_actual_date") * 12 + F.month("data_actual_date")
    units = (F.col("currency_rk") + 1) * 100000000 + (month_no * 7919 + F.col("currency_rk") * 104729) % 100000000
    rate = (units.cast("decimal(18,0)") * F.lit(Decimal("0.00000001")).cast("decimal(9,8)")).cast("decimal(18,8)")
    return m.select(
        "data_actual_date",
        F.last_day("data_actual_date").alias("data_actual_end_date"),
        "currency_rk",
        rate.alias("reduced_cource"),
        F.col("currency_code").alias("code_iso_num"),
    )


def ledger(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    la = (F.lit(LEDGER_BASE) + F.col("n_nationkey") % LEDGER_SPREAD).cast("int")
    base = n.select(la.alias("ledger_account")).distinct()
    chapter = F.when(F.col("ledger_account") % 2 == 0, "A").otherwise("B")
    return base.select(
        chapter.alias("chapter"),
        F.concat(F.lit("Chapter "), chapter).alias("chapter_name"),
        (F.col("ledger_account") % 10 + 1).cast("int").alias("section_number"),
        F.col("ledger_account"),
        F.concat(F.lit("Ledger "), F.col("ledger_account").cast("string")).alias("ledger_account_name"),
        F.when(F.col("ledger_account") % 2 == 0, "A").otherwise("P").alias("characteristic"),
        F.to_date(F.lit(OPEN_START)).alias("start_date"),
        F.to_date(F.lit(OPEN_END)).alias("end_date"),
    )


def deltas(spark, sf_dir) -> DataFrame:
    """Last event per (user, day); delta_id = yyyyMMdd of the day."""
    e = table(spark, sf_dir, "events").select("user_id", "ts", "event_type", "value")
    day = F.col("ts").cast("date")
    last = e.groupBy(F.col("user_id"), day.alias("day")).agg(
        F.max_by(F.struct("event_type", "value"), "ts").alias("last"))
    return last.select(
        F.date_format("day", "yyyyMMdd").cast("int").alias("delta_id"),
        F.col("user_id").alias("account_rk"),
        F.col("day").alias("data_actual_date"),
        F.col("last.event_type").alias("event_type"),
        F.col("last.value").cast("decimal(18,2)").alias("amount"),
    )


VIEWS = {
    "ft_posting_f": postings,
    "md_account_d": accounts,
    "md_currency_d": currencies,
    "md_exchange_rate_d": rates,
    "ft_balance_f": balances,
    "md_ledger_account_s": ledger,
    "deltas": deltas,
}


_STORED: dict[tuple, str] = {}  # (application, table folder, view) -> stored copy


def view(spark, sf_dir, name) -> DataFrame:
    """A derived table, computed once per session and folder and read from the shared
    scratch folder afterwards; each is derived from the stored ones it depends on."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    if key not in _STORED:
        if name == "raw_postings":
            df = raw_postings(spark, sf_dir)
        elif name == "ft_posting_f":
            # summed up where the line items meet their orders: a task holds as many of them as adaptive
            # execution gives it, and the line items are not stored between
            df = _one_amount(spark, sf_dir)
        elif name == "account_spans":  # a row per account: postings are shuffled by account once for what is derived from it
            df = account_spans(spark, sf_dir, view(spark, sf_dir, "ft_posting_f"))
        elif name in ("md_account_d", "ft_balance_f"):
            df = VIEWS[name](spark, sf_dir, span=view(spark, sf_dir, "account_spans"))
        elif name == "md_exchange_rate_d":
            df = rates(spark, sf_dir, view(spark, sf_dir, "md_account_d"))
        else:
            df = VIEWS[name](spark, sf_dir)
        path = scratch_path(spark, f"ledger-{name}")
        with shuffles_dropped(spark):
            df.write.option("compression", STORED).parquet(path)
        _STORED[key] = path
    stored = spark.read.parquet(_STORED[key])
    return _both_amounts(stored) if name == "ft_posting_f" else stored


def materialize(spark, sf_dir, root: str, partitions: int | None = None) -> dict[str, str]:
    """Store every view as Parquet under ``root``, each derived from the
    stored ones it depends on (postings once, accounts once).

    Large tables are range-partitioned and sorted on their date column, so
    a date filter skips files and row groups (min/max statistics), and a
    scan is split over ``partitions`` files instead of one."""
    out = {n: f"{root.rstrip('/')}/{n}" for n in VIEWS}

    def store(df, name, date_col=None):
        if date_col:
            if partitions:
                df = df.repartitionByRange(partitions, date_col)
            df = df.sortWithinPartitions(date_col)
        df.write.mode("overwrite").parquet(out[name])
        return spark.read.parquet(out[name])

    stored_p = store(postings(spark, sf_dir), "ft_posting_f", "oper_date")
    stored_a = store(accounts(spark, sf_dir, stored_p), "md_account_d", "data_actual_date")
    store(balances(spark, sf_dir, stored_p), "ft_balance_f", "on_date")
    store(rates(spark, sf_dir, stored_a), "md_exchange_rate_d")
    store(deltas(spark, sf_dir), "deltas", "delta_id")
    for n in ("md_currency_d", "md_ledger_account_s"):
        store(VIEWS[n](spark, sf_dir), n)
    return out


# ---- input files in the source system's layouts ---------------------------------

def write_extract(df: DataFrame, path: str, date_format: str | None = None, encoding: str = "cp866",
                  sep: str = ";") -> str:
    """An extract in the source-system layout: index column first, upper-case headers.  Its files are
    gzipped, as text takes some ten times the bytes, and bounded in rows, as a gzipped file is read by one task."""
    enable_legacy_charsets(df.sparkSession)
    cols = [F.monotonically_increasing_id().alias("_c0")]
    for f in df.schema.fields:
        c = F.col(f.name)
        if date_format and f.dataType.typeName() == "date":
            c = F.date_format(c, date_format)
        cols.append(c.alias(f.name.upper()))
    with shuffles_dropped(df.sparkSession):
        df.select(*cols).write.mode("overwrite").options(header=True, sep=sep, encoding=encoding, compression="gzip",
                                                         maxRecordsPerFile=EXTRACT_FILE_ROWS).csv(path)
    return path


def write_numbered_folders(df: DataFrame, root: str, id_col: str = "delta_id", sep: str = ";",
                           date_format: str | None = None) -> list[str]:
    """Batches as ``root/<id>/part-*.csv``, the layout of numbered delta folders.

    One distributed, partitioned write, then each ``<id_col>=<id>`` folder is
    renamed to the bare number (one rename per batch: metadata on HDFS, a copy
    on object stores).
    """
    spark = df.sparkSession
    w = df.repartition(id_col).write.mode("overwrite").partitionBy(id_col).options(header=True, sep=sep)
    if date_format:
        w = w.option("dateFormat", date_format)
    w.csv(root)
    p, fs = _fs(spark, root)
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(f"{id_col}="):
            target = st.getPath().getParent().suffix(f"/{name.split('=', 1)[1]}")
            fs.rename(st.getPath(), target)
            out.append(target.toString())
    return sorted(out)
