import datetime as dt
import os
from decimal import Decimal as D

from pyspark.sql import types as T

from kontor.streaming.mirror import run_mirror_stream

SCHEMA = T.StructType([T.StructField("account_rk", T.LongType()), T.StructField("data_actual_date", T.DateType()),
                       T.StructField("event_type", T.StringType()), T.StructField("amount", T.DecimalType(18, 2))])
HEADER = "account_rk;data_actual_date;event_type;amount"


def _delta(root, did, rows):
    os.makedirs(f"{root}/{did}", exist_ok=True)
    with open(f"{root}/{did}/d.csv", "w", newline="") as f:
        f.write("\r".join([HEADER] + rows))


def test_stream_resumes_and_ignores_arrival_order(spark, tmp):
    src, mirror, ckpt = f"{tmp}/deltas", f"{tmp}/mirror", f"{tmp}/ckpt"
    _delta(src, 1002, ["1;03.01.2018;c;3.00", "3;03.01.2018;x;9.00"])
    _delta(src, 1000, ["1;01.01.2018;a;1.00", "2;01.01.2018;b;2.00"])
    run_mirror_stream(spark, src, mirror, ckpt, SCHEMA, ["account_rk"], date_format="dd.MM.yyyy")
    # an older delta arrives late: it must not overwrite newer rows
    _delta(src, 1001, ["1;02.01.2018;late;5.00", "2;02.01.2018;b2;2.50"])
    latest = run_mirror_stream(spark, src, mirror, ckpt, SCHEMA, ["account_rk"], date_format="dd.MM.yyyy")
    got = {tuple(r) for r in spark.read.parquet(latest).select("account_rk", "event_type", "amount").collect()}
    assert got == {(1, "c", D("3.00")), (2, "b2", D("2.50")), (3, "x", D("9.00"))}
    # nothing new: the checkpoint makes a rerun a no-op
    assert run_mirror_stream(spark, src, mirror, ckpt, SCHEMA, ["account_rk"], date_format="dd.MM.yyyy") == latest
