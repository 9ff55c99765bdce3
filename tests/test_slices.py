"""Slice tables: whole commits, writers at once, what changed; marts refreshed by it; mirrors by buckets."""

import datetime as dt
import glob
import os
import threading

import pytest
from pyspark.sql import functions as F

from kontor import jobs as J
from kontor.operators.bucket_mirror import BUCKET, BucketMirror
from kontor.operators.sequence import Sequence
from kontor.operators.sizing import stage
from kontor.operators.upsert import choose_strategy, merge
from kontor.plans import detail_load as DL
from kontor.plans import refresh as RF
from kontor.plans import runlog as RL
from kontor.plans import turnover as TO
from kontor.sinks import files as SK
from kontor.sinks import slices as SL
from kontor.sinks.publish import publish, published
from kontor.specs import spec

d = dt.date
S = "on_date date, k bigint, v bigint"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), S)


def table(spark, path):
    return SL.SliceTable(spark, path, "on_date", frame(spark).schema)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


D1, D2, D3 = d(2018, 1, 1), d(2018, 1, 2), d(2018, 1, 3)


def test_slices_are_replaced_and_emptied(spark, tmp):
    t = table(spark, f"{tmp}/t")
    assert rows(t.read()) == [] and t.values() == []
    t.replace(frame(spark, (D1, 1, 1), (D2, 1, 2), (D3, 1, 3)), [D1, D2, D3])
    out = t.replace(frame(spark, (D2, 1, 20)), [D2, D3])
    assert (out.rows, out.written, out.deleted) == (1, {D2}, [D3])
    assert rows(t.read()) == [(D1, 1, 1), (D2, 1, 20)]
    assert rows(t.read([D2, D3])) == [(D2, 1, 20)]
    with pytest.raises(Exception, match="outside the requested slices"):
        t.replace(frame(spark, (D1, 1, 9), (D3, 1, 9)), [D1])
    with pytest.raises(Exception, match="outside the requested slices"):
        t.replace(frame(spark, (None, 1, 9)), [D1])
    assert rows(t.read()) == [(D1, 1, 1), (D2, 1, 20)]


@pytest.mark.parametrize("broken", ["_write", "_publish"])
def test_a_driver_lost_during_the_write_or_before_the_commit_leaves_every_slice_whole(spark, tmp, monkeypatch, broken):
    t = table(spark, f"{tmp}/t")
    t.replace(frame(spark, (D1, 1, 1), (D2, 1, 2)), [D1, D2])
    step = getattr(SL.SliceTable, broken)

    def lost(self, *a, **k):
        if broken == "_write":
            step(self, *a, **k)
        raise KeyboardInterrupt

    monkeypatch.setattr(SL.SliceTable, broken, lost)
    monkeypatch.setattr(SL, "delete_path", lambda *a: None)  # the driver is gone: nothing is tidied up either
    with pytest.raises(KeyboardInterrupt):
        t.replace(frame(spark, (D1, 1, 100)), [D1, D2])
    monkeypatch.undo()
    assert rows(table(spark, f"{tmp}/t").read()) == [(D1, 1, 1), (D2, 1, 2)]
    assert len(os.listdir(f"{tmp}/t/data")) == 2
    t.replace(frame(spark, (D2, 1, 3)), [D2])
    assert rows(t.read()) == [(D1, 1, 1), (D2, 1, 3)]
    assert len(t.drop_broken()) == 1 and rows(t.read()) == [(D1, 1, 1), (D2, 1, 3)]


def test_writers_at_once(spark, tmp, monkeypatch):
    t = table(spark, f"{tmp}/t")
    t.replace(frame(spark, (D1, 1, 1), (D2, 1, 2)), [D1, D2])
    write, done = SL.SliceTable._write, []

    def meanwhile(day):
        def run(self, *a, **k):
            out = write(self, *a, **k)
            if not done:
                done.append(1)
                table(spark, f"{tmp}/t").replace(frame(spark, (day, 7, 7)), [day])
            return out
        return run

    monkeypatch.setattr(SL.SliceTable, "_write", meanwhile(D3))  # another slice: both stand
    t.replace(frame(spark, (D1, 1, 10)), [D1])
    assert rows(t.read()) == [(D1, 1, 10), (D2, 1, 2), (D3, 7, 7)]
    done.clear()
    monkeypatch.setattr(SL.SliceTable, "_write", meanwhile(D1))  # the same slice: the later one is told
    with pytest.raises(SL.ConflictError):
        t.replace(frame(spark, (D1, 1, 11)), [D1])
    assert rows(t.read()) == [(D1, 7, 7), (D2, 1, 2), (D3, 7, 7)]


def test_changes_since_a_commit_and_old_writes(spark, tmp):
    t = table(spark, f"{tmp}/t")
    for i in range(5):
        t.replace(frame(spark, (D1, i, i), *([(D2, 0, 0)] if i == 0 else [])), [D1, D2] if i == 0 else [D1])
    assert t.commit().number == 5 and t.changed_since(1) == ["2018-01-01"] and t.changed_since(5) == []
    assert t.changed_since(0) == ["2018-01-01", "2018-01-02"]
    assert len(os.listdir(f"{tmp}/t/data")) == 3  # the first write (for its second day) and those of the newest two commits
    assert rows(t.read(at=t.commit(4))) == [(D1, 3, 3), (D2, 0, 0)]


def test_a_table_stored_plainly_is_taken_over_slice_by_slice(spark, tmp):
    frame(spark, (D1, 1, 1), (D2, 1, 2)).write.partitionBy("on_date").parquet(f"{tmp}/t")
    t = table(spark, f"{tmp}/t")
    assert rows(t.read()) == [(D1, 1, 1), (D2, 1, 2)]
    t.replace(frame(spark, (D2, 1, 5)), [D2])
    assert rows(t.read()) == [(D1, 1, 1), (D2, 1, 5)]


def test_a_name_is_published_once(spark, tmp):
    got = []

    def one(i):
        got.append((publish(spark, f"{tmp}/p/1.json", {"by": i}), i))

    threads = [threading.Thread(target=one, args=(i,)) for i in range(8)]
    [x.start() for x in threads]
    [x.join() for x in threads]
    assert sum(ok for ok, _ in got) == 1 and list(published(spark, f"{tmp}/p")) == [1]
    assert [f for f in os.listdir(f"{tmp}/p") if not f.endswith(".crc")] == ["1.json"]


# ---- marts ------------------------------------------------------------------------

def ledger(spark, tmp):
    """Three accounts over two months, loaded as a first batch."""
    def dim(name, *values):
        s = spec(name)
        df = spark.createDataFrame([tuple(v.get(f.name) for f in s.schema.fields) for v in values], s.schema)
        out = SK.next_version(spark, f"{tmp}/detail/{name}")
        df.write.parquet(out)
        SK.finish_version(spark, out)

    from decimal import Decimal as N

    def accounts(currency=1):
        dim("md_account_d", *[dict(data_actual_date=d(2018, m, 1), data_actual_end_date=d(2018, m, 28), account_rk=a,
                                   account_number=f"3010{a}0", char_type="A", currency_rk=currency if a == 3 else 1,
                                   currency_code="840") for a in (1, 2, 3) for m in (1, 2)])

    def rates(second=N("2")):
        dim("md_exchange_rate_d", *[dict(data_actual_date=d(2018, m, 1), data_actual_end_date=d(2018, m, 28), currency_rk=c,
                                         reduced_cource=r, code_iso_num="840")
                                    for c in (1, 2) for m, r in ((1, N("3")), (2, second))])

    def load(name, *values):
        s = spec(name)
        staged = stage(spark.createDataFrame(list(values), s.schema), "b")
        DL.upsert_days(spark, f"{tmp}/detail/{name}", staged, name)

    accounts()
    rates()
    dim("md_currency_d", *[dict(currency_rk=c, data_actual_date=d(1900, 1, 1), data_actual_end_date=d(2999, 1, 1),
                                currency_code="840", code_iso_char="USD") for c in (1, 2)])
    dim("md_ledger_account_s", *[dict(chapter="A", ledger_account=30100 + a, start_date=d(1900, 1, 1),
                                      end_date=d(2999, 1, 1)) for a in (10, 20, 30)])
    load("ft_posting_f", *[(d(2018, m, day), 1, 2, N(day), N(day)) for m in (1, 2) for day in (3, 5, 9)],
         (d(2018, 2, 9), 3, 2, N(4), N(4)))
    load("ft_balance_f", *[(e, a, 1, N(100 * a)) for e in (d(2017, 12, 31), d(2018, 1, 31)) for a in (1, 2, 3)])
    return accounts, rates, load, N


def rebuilt(spark, tmp):
    v = {n: J.read_detail(spark, f"{tmp}/detail", n) for n in J.DETAIL_TABLES}
    turn = TO.account_turnover(v["ft_posting_f"], v["md_account_d"], v["md_exchange_rate_d"])
    report = RF.F101.f101_range(v["md_ledger_account_s"], v["md_account_d"], v["md_currency_d"], v["ft_balance_f"],
                                v["md_exchange_rate_d"], turn, d(2018, 1, 1), d(2018, 2, 28))
    return rows(turn), sorted(map(str, report.select(*spec("dm_f101_round_f").columns).collect()))


def marts(spark, tmp):
    turn, f101 = (J.read_mart(spark, f"{tmp}/marts", n) for n in ("dm_account_turnover_f", "dm_f101_round_f"))
    return rows(turn), sorted(map(str, f101.collect()))


def test_a_refresh_recomputes_what_changed_and_no_more(spark, tmp):
    accounts, rates, load, N = ledger(spark, tmp)

    def refresh():
        out = J.job_refresh(spark, f"{tmp}/detail", f"{tmp}/marts")
        got = marts(spark, tmp)
        assert got[0] and got == rebuilt(spark, tmp)
        return [x.day + 100 * x.month for x in out.days], [x.month for x in out.months]

    assert refresh() == ([103, 105, 109, 203, 205, 209], [1, 2])
    assert refresh() == ([], [])
    load("ft_posting_f", (d(2018, 2, 5), 1, 2, N(50), N(50)))          # one day of an old batch again
    assert refresh() == ([205], [2])
    load("ft_posting_f", (d(2018, 1, 20), 1, 3, N(7), N(7)))           # a new day
    assert refresh() == ([120], [1])
    load("ft_balance_f", (d(2018, 1, 31), 1, 1, N(999)))               # an opening balance
    assert refresh() == ([], [2])
    rates(N("2.5"))                                                     # February's rate
    assert refresh() == ([203, 205, 209], [2])
    accounts(currency=2)                                                # an account's currency, both months
    assert refresh() == ([103, 105, 109, 120, 203, 205, 209], [1, 2])


def test_a_refresh_reads_the_changed_days_only(spark, tmp):
    accounts, rates, load, N = ledger(spark, tmp)
    J.job_refresh(spark, f"{tmp}/detail", f"{tmp}/marts")
    load("ft_posting_f", (d(2018, 2, 5), 1, 2, N(50), N(50)))
    postings = DL.fact_table(spark, f"{tmp}/detail", "ft_posting_f")
    days = RF.turnover_days(spark, f"{tmp}/detail", RF.mart_table(spark, f"{tmp}/marts", "dm_account_turnover_f").commit().notes)
    assert days == [d(2018, 2, 5)]
    assert {f.split("oper_date=")[1][:10] for f in postings.read(days).inputFiles()} == {"2018-02-05"}
    before = set(glob.glob(f"{tmp}/marts/dm_account_turnover_f/data/*/*"))
    J.job_refresh(spark, f"{tmp}/detail", f"{tmp}/marts")
    new = set(glob.glob(f"{tmp}/marts/dm_account_turnover_f/data/*/*")) - before
    assert {p.split("on_date=")[1] for p in new if "on_date=" in p} == {"2018-02-05"}


def test_a_mart_built_otherwise_is_built_anew_by_the_first_refresh(spark, tmp):
    ledger(spark, tmp)
    J.job_turnover(spark, f"{tmp}/detail", f"{tmp}/marts", "2018-01-15")
    out = J.job_refresh(spark, f"{tmp}/detail", f"{tmp}/marts")
    assert len(out.days) == 6 and marts(spark, tmp) == rebuilt(spark, tmp)


def test_a_refresh_of_nothing(spark, tmp):
    assert J.job_refresh(spark, f"{tmp}/detail", f"{tmp}/marts") == RF.Refresh([], [])


# ---- a mirror by buckets --------------------------------------------------------------

M = "k bigint, v string"


def test_a_merge_rewrites_the_touched_buckets_only(spark, tmp):
    old = spark.range(400).selectExpr("id AS k", "concat('a', id) AS v")
    mirror = BucketMirror(spark, f"{tmp}/m", old.schema, ["k"], buckets=32)
    mirror.merge(old)
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{tmp}/m/data/*/*/*.parquet")}
    batch = spark.createDataFrame([(7, "b"), (1000, "c"), (None, "n"), (None, "n")], M)
    touched = {r[0] for r in batch.select(F.pmod(F.xxhash64("k"), F.lit(32))).collect()}
    mirror.merge(batch)
    expected = merge(old, batch, ["k"])
    assert sorted(map(str, mirror.read().collect())) == sorted(map(str, expected.collect()))
    after = {f: os.path.getmtime(f) for f in glob.glob(f"{tmp}/m/data/*/*/*.parquet")}
    assert {f: after[f] for f in before} == before
    assert {int(f.split(f"{BUCKET}=")[1].split("/")[0]) for f in set(after) - set(before)} == touched
    with pytest.raises(ValueError):
        BucketMirror(spark, f"{tmp}/m", old.schema, ["k"], buckets=16)


def test_no_merge_of_buckets_shuffles_the_mirror(spark, tmp):
    old = spark.range(5000).selectExpr("id AS k", "concat('a', id) AS v")
    mirror = BucketMirror(spark, f"{tmp}/m", old.schema, ["k"], buckets=8)
    mirror.merge(old)
    batch = spark.range(0, 6000, 2).selectExpr("id AS k", "'b' AS v")
    small = 40_000  # a fraction of the batch: several groups of buckets, one broadcast each
    seen = []
    merged = BucketMirror._merged

    def watch(self, *a):
        df = merged(self, *a)
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    BucketMirror._merged = watch
    try:
        mirror.merge(batch, broadcast_limit=small)
    finally:
        BucketMirror._merged = merged
    assert len(seen) > 2
    for plan in seen:
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert sorted(map(tuple, mirror.read().collect())) == sorted(map(tuple, merge(old, batch, ["k"]).collect()))


def test_the_mirror_job_with_buckets(spark, tmp):
    from test_failures import delta

    s = spec("md_account_d").schema
    for number, keys in ((1000, range(20)), (1001, [*range(9), 20, 21]), (1002, [0, 1, 22])):
        delta(f"{tmp}/deltas", number, keys, client=number)
        args = (f"{tmp}/deltas", f"{tmp}/mirror", f"{tmp}/log", "md_account_d", "account_rk")
        assert J.job_mirror(spark, *args, buckets=8) == f"{tmp}/mirror"
        plain = J.job_mirror(spark, f"{tmp}/deltas", f"{tmp}/plain", f"{tmp}/log2", "md_account_d", "account_rk")
    expected = spark.read.parquet(plain)
    got = J.read_bucket_mirror(spark, f"{tmp}/mirror", expected.schema, ["account_rk"], 8)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect())) and got.count() == 23
    assert s  # the declared columns are part of the delta's


def test_a_failed_delta_leaves_an_error_row(spark, tmp, monkeypatch):
    from test_failures import delta

    delta(f"{tmp}/deltas", 1000, range(3))
    monkeypatch.setattr(J.DL, "apply_deltas", lambda *a, **k: 1 // 0)
    with pytest.raises(ZeroDivisionError):
        J.job_mirror(spark, f"{tmp}/deltas", f"{tmp}/mirror", f"{tmp}/log", "md_account_d", "account_rk")
    log = spark.read.parquet(f"{tmp}/log")
    assert sorted(r["status"] for r in log.collect()) == ["error", "start"]


# ---- sizes, sequences, versions --------------------------------------------------------

def test_the_strategy_goes_by_measured_bytes(spark):
    wide = spark.range(0, 3_000_000, 1, 4).selectExpr("id AS k", "repeat('x', 100) AS v")
    staged = stage(wide, "compressible")
    assert staged.size > 400_000_000
    on_disk = sum(os.path.getsize(f) for f in glob.glob(f"{staged.path.removeprefix('file:')}/*.parquet"))
    assert on_disk < 64 << 20
    assert choose_strategy(staged.df, size=staged.size) == "shuffle" == choose_strategy(staged.df)
    from kontor.operators.upsert import upsert

    target = spark.range(10).selectExpr("id AS k", "'a' AS v")
    plan = upsert(target, staged.df, ["k"], check=False, size=staged.size)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan


def test_two_writers_get_disjoint_ids(spark, tmp):
    got = []

    def draw(n):
        s = Sequence(spark, f"{tmp}/ids")
        for _ in range(6):
            first = s.reserve(n, above=lambda: 100)
            got.append(range(first, first + n))

    threads = [threading.Thread(target=draw, args=(n,)) for n in (1, 5, 3)]
    [x.start() for x in threads]
    [x.join() for x in threads]
    ids = [i for r in got for i in r]
    assert sorted(ids) == list(range(101, 101 + 6 * 9)) and Sequence(spark, f"{tmp}/ids").last() == max(ids)


def test_message_logs_at_once_share_no_id(spark, tmp):
    logs = [J.MessageLog(spark, f"{tmp}/messages") for _ in range(3)]
    for i, log in enumerate(logs):
        log.write("x" * 9000 * (i + 1))
        log.write("")
        log.write("y")
    for log in logs:
        log.flush()
    ids = [r[0] for r in spark.read.parquet(f"{tmp}/messages").select("record_id").collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1)) and len(ids) == (3 + 5 + 7) + 3


def test_pieces_numbered_in_scan_order_without_moving_text(spark, tmp):
    docs = [(i, "z" * (i * 1500)) for i in range(40)] + [(100, ""), (101, None)]
    spark.createDataFrame(docs, "k bigint, message string").repartition(7).write.parquet(f"{tmp}/docs")
    scan = spark.read.schema("k bigint, message string").parquet(f"{tmp}/docs")
    out = RL.chunk_messages(scan, ["k"], start_id=11, order="scan")
    assert "Exchange hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
    got = out.collect()
    assert sorted(r["record_id"] for r in got) == list(range(11, 11 + len(got)))
    for k, text in docs:
        mine = sorted((r["piece"], r["record_id"], r["message"]) for r in got if r["k"] == k)
        assert "".join(m for _, _, m in mine) == (text or "")
        assert [i - mine[0][1] for _, i, _ in mine] == list(range(len(mine)))  # a message's pieces follow each other


def test_versions_count_without_the_marker_of_the_cluster(spark, tmp):
    spark.conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        out = SK.next_version(spark, f"{tmp}/t")
        frame(spark, (D1, 1, 1)).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(out)
        assert SK.latest_version(spark, f"{tmp}/t") is None
        SK.finish_version(spark, out)
    finally:
        spark.conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert SK.latest_version(spark, f"{tmp}/t") == out and rows(spark.read.parquet(out)) == [(D1, 1, 1)]


# ---- procedures ----------------------------------------------------------------------

def test_procedures_from_sql_replace_their_month(spark, tmp):
    from kontor.plans import procedures as PR

    accounts, rates, load, N = ledger(spark, tmp)
    J.register_views(spark, f"{tmp}/detail")
    PR.create_mart(spark, "t_turn", "dm_account_turnover_f", f"{tmp}/sql/turn")
    PR.create_mart(spark, "t_form", "dm_f101_round_f", f"{tmp}/sql/form")
    try:
        for day in ("2018-01-31", "2018-02-28", "2018-02-28"):
            PR.fill_turnover(spark, "t_turn", day)
            answer = PR.fill_form_101(spark, "t_form", "t_turn", day).collect()
        assert [tuple(r) for r in answer] == [(d(2018, 2, 1), d(2018, 2, 28), spark.table("t_form").filter(
            "from_date = DATE'2018-02-01'").count())]
        columns = spec("dm_account_turnover_f").columns, spec("dm_f101_round_f").columns
        got = rows(spark.table("t_turn").select(*columns[0])), sorted(map(str, spark.table("t_form").select(*columns[1]).collect()))
        assert got == rebuilt(spark, tmp)
        # a day whose postings are gone is gone from the mart, too
        postings = DL.fact_table(spark, f"{tmp}/detail", "ft_posting_f")
        postings.replace(postings.read([d(2018, 2, 9)]).limit(0), [d(2018, 2, 9)])
        J.register_views(spark, f"{tmp}/detail")
        PR.fill_turnover(spark, "t_turn", "2018-02-28")
        assert rows(spark.table("t_turn").select(*columns[0])) == rebuilt(spark, tmp)[0]
    finally:
        spark.sql("DROP TABLE IF EXISTS t_turn")
        spark.sql("DROP TABLE IF EXISTS t_form")
