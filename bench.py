"""Benchmark the headline jobs at one scale factor.

Prints ONE JSON line:
{"metric": "jobs_total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

``value`` sums the jobs; ``prepare`` (deriving the test ledger) is listed but not counted.

The ledger tables are first derived from the driver's tables and stored
as Parquet (as a detail layer would be); each job then runs against the
stored tables and is executed completely with a ``noop`` write (no
driver collect).  ``prepare`` is the time to derive and store the tables.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (8),
BENCH_SHUFFLE_PARTITIONS (default 2 x BENCH_CPUS; AQE coalesces),
BENCH_EVENT_LOG (a folder: write Spark's event log there; summarise it with
``python tools/eventlog.py <folder>`` -- stages, tasks, shuffle bytes per job).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark import SparkContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from kontor.operators import deltas as DL  # noqa: E402
from kontor.operators.upsert import merge, upsert  # noqa: E402
from kontor.plans import f101 as F101  # noqa: E402
from kontor.plans import runlog as RL  # noqa: E402
from kontor.plans import turnover as TO  # noqa: E402
from kontor.queries_io import FIRST_RUN_UNTIL, MIRROR_PK, MIRROR_SCHEMA, _master, _master_batch  # noqa: E402
from kontor.session import build_session, scratch_path  # noqa: E402
from kontor.sources import testbed as TB  # noqa: E402

CALL_DATE = "1998-03-03"


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, name: str | None = None) -> float:
    if name:  # job group: the event log attributes stages to the query
        SparkContext.getOrCreate().setJobGroup(name, name)
    t0 = time.time()
    fn()
    return round(time.time() - t0, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(2 * cpus)))
    extra = {"spark.driver.memory": "16g", "spark.sql.files.maxPartitionBytes": str(32 * 1024 * 1024)}
    event_dir = os.environ.get("BENCH_EVENT_LOG")  # a scratch folder: stage times without the UI
    if event_dir:
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir})
    spark = build_session(f"local[{cpus}]", app_name="kontor-bench", shuffle_partitions=parts, extra=extra)
    q: dict[str, float] = {}
    stored = scratch_path(spark, "bench-ledger")

    def prepare():
        TB.materialize(spark, sf_dir, stored, partitions=cpus)

    q["prepare"] = timed(prepare, "prepare")
    names = ("ft_posting_f", "md_account_d", "md_currency_d", "md_exchange_rate_d", "ft_balance_f",
             "md_ledger_account_s", "deltas")
    v = {n: spark.read.parquet(f"{stored}/{n}") for n in names}
    P, A, R = v["ft_posting_f"], v["md_account_d"], v["md_exchange_rate_d"]

    q["turnover_all"] = timed(lambda: run(TO.account_turnover(P, A, R)), "turnover_all")
    q["turnover_month"] = timed(lambda: run(TO.turnover_month(P, A, R, CALL_DATE)), "turnover_month")

    SparkContext.getOrCreate().setJobGroup("setup", "untimed setup")
    mart = f"{stored}/dm_account_turnover_f"
    TO.account_turnover(P, A, R).repartitionByRange(cpus, "on_date").sortWithinPartitions("on_date") \
        .write.mode("overwrite").parquet(mart)
    T = spark.read.parquet(mart)
    args = (v["md_ledger_account_s"], A, v["md_currency_d"], v["ft_balance_f"], R, T, CALL_DATE)
    q["f101_report"] = timed(lambda: run(F101.f101_report(*args, fan_out=True)), "f101_report")
    q["f101_preagg"] = timed(lambda: run(F101.f101_report(*args, fan_out=False)), "f101_preagg")
    SparkContext.getOrCreate().setJobGroup("setup", "untimed setup")
    span = P.agg(F.min("oper_date").alias("lo"), F.max("oper_date").alias("hi")).first()
    q["f101_all"] = timed(lambda: run(F101.f101_range(*args[:-1], span["lo"], span["hi"])), "f101_all")

    empty = spark.createDataFrame([], MIRROR_SCHEMA)
    q["delta_fold"] = timed(lambda: run(DL.apply_deltas(empty, v["deltas"], MIRROR_PK)), "delta_fold")
    # one MERGE of the newer half of the deltas, folded, into the mirror that the older half left (stored, not timed)
    SparkContext.getOrCreate().setJobGroup("setup", "untimed setup")
    older = F.col("data_actual_date") <= F.lit(FIRST_RUN_UNTIL).cast("date")
    DL.fold_deltas(v["deltas"].filter(older), MIRROR_PK).drop(DL.DELTA_ID).write.parquet(f"{stored}/mirror")
    mirror = spark.read.parquet(f"{stored}/mirror")
    newer = DL.fold_deltas(v["deltas"].filter(~older), MIRROR_PK).drop(DL.DELTA_ID)
    q["delta_merge"] = timed(lambda: run(merge(mirror, newer, MIRROR_PK)), "delta_merge")
    q["upsert_by_key"] = timed(lambda: run(upsert(_master(spark, sf_dir), _master_batch(spark, sf_dir),
                                                  ["account_rk"])), "upsert_by_key")
    docs = TB.table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("message"))
    q["log_chunk"] = timed(lambda: run(RL.chunk_messages(docs, ["doc_id"], "message", order="scan")), "log_chunk")

    # the headline value is the jobs' time; deriving the test ledger is reported, not counted
    total = round(sum(t for k, t in q.items() if k != "prepare"), 3)
    print(json.dumps({"metric": "jobs_total_sec", "value": total, "unit": "sec", "queries": q, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
