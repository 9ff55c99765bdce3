"""What the load and the refresh keep on disk: shuffles that go, runs of days and months, packed extracts."""

import datetime as dt
import glob
import os
import time

import pytest
from pyspark.sql import functions as F
from test_slices import ledger, marts, rebuilt, rows

from kontor import jobs as J
from kontor.operators.sizing import parts_of, stage
from kontor.operators.upsert import DuplicateKeyError, NullKeyError
from kontor.plans import detail_load as DL
from kontor.plans import f101 as F101
from kontor.plans import refresh as RF
from kontor.session import DROP_SHUFFLES, shuffles_dropped
from kontor.sinks import files as SK
from kontor.sinks import slices as SL
from kontor.sources import csv as CS
from kontor.sources import testbed as TB
from kontor.specs import spec

d = dt.date


def shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for x in dirs for f in glob.glob(f"{x}/*/shuffle_*")}


def watched(monkeypatch):
    """The values of every write of a slice table, from now on."""
    seen, write = [], SL.SliceTable._write

    def run(self, df, w, values, *a):
        seen.append(values)
        return write(self, df, w, values, *a)

    monkeypatch.setattr(SL.SliceTable, "_write", run)
    return seen


# ---- F1 to F4: shuffles go with their job ---------------------------------------------

def test_no_shuffle_outlives_its_write(spark, tmp):
    before, setting = shuffle_files(spark), spark.conf.get(DROP_SHUFFLES)
    days = spark.range(3000).selectExpr("date_add(DATE'2018-01-01', int(id % 5)) AS on_date", "id AS k", "id AS v")
    staged = stage(days.groupBy("on_date", "k").agg(F.sum("v").alias("v")), "summed")
    t = SL.SliceTable(spark, f"{tmp}/t", "on_date", staged.df.schema)
    t.replace(staged.df, [d(2018, 1, 1 + i) for i in range(5)])
    with pytest.raises(Exception, match="outside the requested slices"):
        t.replace(staged.df, [d(2018, 1, 1)])
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert t.read().count() == 3000 and spark.conf.get(DROP_SHUFFLES) == setting


def test_the_setting_is_put_back_by_the_last_one_out(spark):
    setting = spark.conf.get(DROP_SHUFFLES)
    one, two = shuffles_dropped(spark), shuffles_dropped(spark)
    one.__enter__()
    two.__enter__()
    one.__exit__(None, None, None)
    assert spark.conf.get(DROP_SHUFFLES) == "true"
    two.__exit__(None, None, None)
    assert spark.conf.get(DROP_SHUFFLES) == setting


def test_runs_hold_every_key_once():
    assert parts_of({3: 2, 1: 5, 2: 2, 4: 9, 5: 0}, 4) == [[1], [2, 3], [4], [5]]
    assert parts_of({}, 4) == [] and parts_of({1: 0, 2: 0}, 4) == [[1, 2]]


# ---- F3: the load ----------------------------------------------------------------------

def balances(spark, *values):
    return stage(spark.createDataFrame(list(values), spec("ft_balance_f").schema), "b")


def test_a_large_batch_is_upserted_run_of_days_by_run_of_days(spark, tmp, monkeypatch):
    from decimal import Decimal as N

    path = f"{tmp}/ft_balance_f"
    old = [(d(2018, 1, day), k, 1, N(day)) for day in (1, 2, 3, 9) for k in (1, 2)]
    DL.upsert_days(spark, path, balances(spark, *old), "ft_balance_f")
    seen = watched(monkeypatch)
    new = [(d(2018, 1, day), k, 2, N(100 + day)) for day in (1, 2, 3, 4, 5) for k in (2, 3)]
    assert DL.upsert_days(spark, path, balances(spark, *new), "ft_balance_f", part_rows=4) == 13
    assert seen == [["2018-01-01", "2018-01-02"], ["2018-01-03", "2018-01-04"], ["2018-01-05"]]
    table = DL.fact_table(spark, tmp, "ft_balance_f")
    expected = {r[:2]: r for r in old} | {r[:2]: r for r in new}
    assert rows(table.read()) == sorted(expected.values()) and table.commit().number == 2

    twice = [*new, (d(2018, 1, 5), 3, 7, N(1))]  # in the last run
    with pytest.raises(DuplicateKeyError):
        DL.upsert_days(spark, path, balances(spark, *twice), "ft_balance_f", part_rows=4)
    with pytest.raises(NullKeyError):
        DL.upsert_days(spark, path, balances(spark, *new, (None, 3, 7, N(1))), "ft_balance_f", part_rows=4)
    assert rows(table.read()) == sorted(expected.values()) and table.commit().number == 2


# ---- F4: the extracts that it reads ------------------------------------------------------

def test_extracts_are_packed_and_their_files_bounded(spark, tmp, monkeypatch):
    monkeypatch.setattr(TB, "EXTRACT_FILE_ROWS", 40)
    s = spec("md_account_d")
    df = spark.range(0, 100, 1, 2).select(*[
        {"data_actual_date": F.to_date(F.lit("2018-01-01")), "data_actual_end_date": F.to_date(F.lit("2018-01-31")),
         "account_rk": F.col("id"), "account_number": F.lit("30110"), "char_type": F.lit("А")}.get(
             f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in s.schema.fields])
    path = TB.write_extract(df, f"{tmp}/x")
    files = glob.glob(f"{path}/part-*")
    assert len(files) == 4 and all(f.endswith(".csv.gz") for f in files)
    got = CS.read_extract(spark, path, s.schema).select("account_rk", "data_actual_date", "char_type").collect()
    assert sorted(map(tuple, got)) == [(i, d(2018, 1, 1), "А") for i in range(100)]


def test_postings_are_stored_with_one_amount_and_read_with_both(spark, tmp):
    spark.createDataFrame([(1, 7, 1.25), (1, 8, 2.0), (2, 7, 3.5), (2, None, 9.0)], "l_orderkey long, l_suppkey long, l_extendedprice double").write.parquet(f"{tmp}/lineitem.parquet")
    spark.createDataFrame([(1, 5, dt.datetime(1998, 1, 5)), (2, 5, dt.datetime(1998, 1, 5))], "o_orderkey long, o_custkey long, o_orderdate timestamp").write.parquet(f"{tmp}/orders.parquet")
    view = TB.view(spark, tmp, "ft_posting_f")
    assert rows(view) == rows(TB.postings(spark, tmp, TB.raw_postings(spark, tmp))) and view.count() == 2
    assert "debet_amount" not in spark.read.parquet(*view.inputFiles()).columns
    span = rows(TB.view(spark, tmp, "account_spans"))
    assert [(r[0] % 1000, r[1:]) for r in span] == [(k, (d(1998, 1, 5),) * 2) for k in (5, 7, 8)]


# ---- F2: turnover -------------------------------------------------------------------------

def test_the_turnover_is_refreshed_run_of_days_by_run_of_days(spark, tmp, monkeypatch):
    ledger(spark, tmp)
    seen = watched(monkeypatch)
    days = RF.refresh_turnover(spark, f"{tmp}/detail", f"{tmp}/marts", lambda n: J.read_detail(spark, f"{tmp}/detail", n),
                               part_rows=2 * RF.EXCHANGES)
    assert [len(v) for v in seen] == [2, 2, 1, 1] and sum(seen, []) == [x.isoformat() for x in days]
    monkeypatch.undo()
    assert RF.mart_table(spark, f"{tmp}/marts", "dm_account_turnover_f").commit().number == 1
    RF.refresh_marts(spark, f"{tmp}/detail", f"{tmp}/marts", lambda n: J.read_detail(spark, f"{tmp}/detail", n))
    assert marts(spark, tmp) == rebuilt(spark, tmp)


def test_changed_intervals_are_those_of_the_rows_in_one_version_only(spark, tmp):
    s = spec("md_exchange_rate_d")

    def version(*values):
        out = SK.next_version(spark, f"{tmp}/md_exchange_rate_d")
        full = [dict(zip(("data_actual_date", "data_actual_end_date", "currency_rk", "code_iso_num"), v, strict=True)) for v in values]
        spark.createDataFrame([tuple(v.get(f.name) for f in s.schema.fields) for v in full], s.schema).write.parquet(out)
        return SK.finish_version(spark, out)

    a, b, c, e, g = (d(2018, m, 1) for m in (1, 2, 3, 4, 5))
    end = d(2018, 12, 31)
    same = [(a, end, 1, "x"), (a, end, 1, "x"), (None, end, 4, None)]
    old = version(*same, (b, end, 1, "x"), (b, end, 2, "y"), (c, end, 1, None), (e, end, 5, "x"), (g, end, 1, "x"))
    version(*same, (b, end, 1, "y"), (b, end, 2, "x"), (c, end, 1, ""), (e, end, 5, "x"), (e, end, 5, "x"), (g, None, 1, "x"))
    spans = RF._changed_spans(spark, tmp, "md_exchange_rate_d", old)
    assert sorted(map(str, spans.collect())) == sorted(map(str, spark.createDataFrame(
        [(b, end), (c, end), (e, end), (g, end), (g, None)], "lo date, hi date").collect()))
    assert spans._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1
    assert RF._changed_spans(spark, tmp, "md_exchange_rate_d", None) is RF.EVERYTHING
    assert RF._changed_spans(spark, tmp, "md_exchange_rate_d", SK.latest_version(spark, f"{tmp}/md_exchange_rate_d")).isEmpty()


# ---- F1: form 101 ---------------------------------------------------------------------------

def test_months_that_are_no_neighbours_are_reported_at_once(spark, tmp, monkeypatch):
    from decimal import Decimal as N

    accounts, rates, load, _ = ledger(spark, tmp)
    load("ft_posting_f", (d(2018, 3, 3), 1, 2, N(8), N(8)))

    def read(n):
        return J.read_detail(spark, f"{tmp}/detail", n)

    # versions of three months up to their last days, in the chart of accounts
    feb = read("md_account_d").filter("data_actual_date = DATE'2018-02-01'").withColumn(
        "account_number", F.expr("concat('301', account_rk, '0')"))
    out = SK.next_version(spark, f"{tmp}/detail/md_account_d")
    feb.withColumn("data_actual_date", F.explode(F.array(*[F.lit(d(2018, m, 1)) for m in (1, 2, 3)]))).withColumn(
        "data_actual_end_date", F.last_day("data_actual_date")).write.parquet(out)
    SK.finish_version(spark, out)
    RF.refresh_marts(spark, f"{tmp}/detail", f"{tmp}/marts", read)
    load("ft_balance_f", (d(2017, 12, 31), 1, 1, N(5)), (d(2018, 2, 28), 1, 1, N(6)))  # opening balances of January and March
    calls, report = [], F101.f101_range

    def run(*a, **k):
        calls.append(k["months"])
        return report(*a, **k)

    monkeypatch.setattr(F101, "f101_range", run)
    assert [m.month for m in RF.refresh_f101(spark, f"{tmp}/detail", f"{tmp}/marts", read)] == [1, 3]
    assert calls == [[d(2018, 1, 1), d(2018, 3, 1)]]
    monkeypatch.undo()

    seen = watched(monkeypatch)
    RF.refresh_turnover(spark, f"{tmp}/detail", f"{tmp}/again", read)
    del seen[:]
    RF.refresh_f101(spark, f"{tmp}/detail", f"{tmp}/again", read, part_rows=1)
    assert seen == [["2018-01-01"], ["2018-02-01"], ["2018-03-01"]]
    again = RF.mart_table(spark, f"{tmp}/again", "dm_f101_round_f")
    assert again.commit().number == 1 and again.read().filter("to_date = DATE'2018-03-31'").count()
    assert sorted(map(str, again.read().collect())) == marts(spark, tmp)[1]
    whole = report(*(read(n) for n in ("md_ledger_account_s", "md_account_d", "md_currency_d", "ft_balance_f", "md_exchange_rate_d")),
                   J.read_mart(spark, f"{tmp}/marts", "dm_account_turnover_f"), d(2018, 1, 1), d(2018, 3, 31))
    assert sorted(map(str, whole.select(*spec("dm_f101_round_f").columns).collect())) == marts(spark, tmp)[1]


def test_what_is_kept_is_packed(spark, tmp):
    ledger(spark, tmp)
    files = glob.glob(f"{tmp}/detail/ft_posting_f/data/**/*.parquet", recursive=True)
    assert files and all(os.path.basename(f).endswith(".zstd.parquet") for f in files)
