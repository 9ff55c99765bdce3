import datetime as dt
import os
from decimal import Decimal as D

from pyspark.sql import types as T

from kontor.sinks import files as SK
from kontor.sources import testbed as TB
from kontor.sources import csv as CS
from kontor.specs import spec

SCHEMA = T.StructType([T.StructField("account_rk", T.LongType()), T.StructField("data_actual_date", T.DateType()),
                       T.StructField("event_type", T.StringType()), T.StructField("amount", T.DecimalType(18, 2))])


def _write(path, text, newline):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(newline.join(text))


def test_delta_folders_any_line_end(spark, tmp):
    header = "account_rk;data_actual_date;event_type;amount"
    _write(f"{tmp}/1000/a.csv", [header, "1;01.01.2018;x;1.50", "2;01.01.2018;y;2.00"], "\r")
    _write(f"{tmp}/1001/b.csv", [header, "1;02.01.2018;z;3.25", ""], "\r")
    _write(f"{tmp}/1002/c.csv", [header, "3;03.01.2018;w;4.00", ""], "\r\n")
    _write(f"{tmp}/999/d.csv", [header, "4;31.12.2017;v;0.10"], "\n")
    df = CS.scan_delta_folders(spark, tmp, SCHEMA, date_format="dd.MM.yyyy")
    got = sorted(tuple(r) for r in df.collect())
    assert got == [(999, 4, dt.date(2017, 12, 31), "v", D("0.10")),
                   (1000, 1, dt.date(2018, 1, 1), "x", D("1.50")),
                   (1000, 2, dt.date(2018, 1, 1), "y", D("2.00")),
                   (1001, 1, dt.date(2018, 1, 2), "z", D("3.25")),
                   (1002, 3, dt.date(2018, 1, 3), "w", D("4.00"))]


def test_extract_cp866_index_column_and_blank_text(spark, tmp):
    path = f"{tmp}/md_account_d.csv"
    lines = [";DATA_ACTUAL_DATE;DATA_ACTUAL_END_DATE;ACCOUNT_RK;ACCOUNT_NUMBER;CHAR_TYPE;CURRENCY_RK;CURRENCY_CODE",
             "0;2018-01-01;2018-01-31;13560;30110810000000000001;А;44;643",
             "1;2018-01-01;2018-01-31;13561;00110810000000000002;;45;",
             ""]
    with open(path, "w", encoding="cp866", newline="") as f:
        f.write("\n".join(lines))
    df = CS.read_extract(spark, path, spec("md_account_d").schema)
    rows = sorted(tuple(r) for r in df.collect())
    assert rows[0] == (dt.date(2018, 1, 1), dt.date(2018, 1, 31), 13560, "30110810000000000001", "А", 44, "643")
    assert rows[1][3] == "00110810000000000002"  # leading zeros kept: no inference
    assert rows[1][4] == "" and rows[1][6] == ""  # blanks kept as '' in text columns


def test_extract_round_trip(spark, tmp):
    s = spec("ft_balance_f")
    df = spark.createDataFrame([(dt.date(2017, 12, 31), 1, 643, D("5.10")), (dt.date(2017, 12, 31), 2, 840, D("-1.00"))],
                               s.schema)
    path = TB.write_extract(df, f"{tmp}/bal", date_format="dd.MM.yyyy")
    back = CS.read_extract(spark, path, s.schema, date_format="dd.MM.yyyy")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_tab_single_file(spark, tmp):
    df = spark.createDataFrame([(1, "football", "summer"), (2, "curling", "winter")],
                               "row_id BIGINT, discipline STRING, season STRING")
    SK.write_csv(df, f"{tmp}/disc.csv", sep="\t", single_file=True)
    parts = [p for p in os.listdir(f"{tmp}/disc.csv") if p.startswith("part-")]
    assert len(parts) == 1
    back = CS.read_tab(spark, f"{tmp}/disc.csv", df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_inferred_header_only_file_has_no_rows(spark, tmp):
    _write(f"{tmp}/empty/x.csv", ["a;b"], "\n")
    assert CS.read_inferred(spark, f"{tmp}/empty").count() == 0


def test_incremental_scan_reads_only_newer_folders(spark, tmp):
    header = "account_rk;data_actual_date;event_type;amount"
    for did, day in ((1000, "01"), (1001, "02"), (1002, "03")):
        _write(f"{tmp}/{did}/x.csv", [header, f"1;{day}.01.2018;e;1.00"], "\r")
    newer = CS.scan_delta_folders(spark, tmp, SCHEMA, date_format="dd.MM.yyyy", after=1000)
    assert sorted(r[0] for r in newer.select("delta_id").collect()) == [1001, 1002]
    assert len(newer.inputFiles()) == 2  # the 1000 folder is not even listed for reading
    assert CS.scan_delta_folders(spark, tmp, SCHEMA, after=1002).count() == 0
    assert [n for n, _ in CS.delta_folders(spark, tmp)] == [1000, 1001, 1002]
