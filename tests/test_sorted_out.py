"""Good rows and refused lines in one pass; look-ups by one sort."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kontor.operators.scd import OverlappingVersions, join_valid_at, valid_at_by_sort
from kontor.sources import csv as CS

d = dt.date
SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("on_date", T.DateType()),
                       T.StructField("v", T.StringType())])


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def test_good_rows_and_refused_lines(spark, tmp):
    x = put(f"{tmp}/x/a.csv", "ON_DATE;K;V\n01.02.2018;1;a\n2018-02-01;2;b\n03.02.2018;x;c\n04.02.2018; ;\n05.02.2018;5\n"
                              "06.02.2018;6;f;g\n;7;h\n31.02.2018;8;i\n")
    out = CS.read_sorted_out(spark, x, SCHEMA, date_format="dd.MM.yyyy")
    assert sorted(map(tuple, out.good.collect()), key=str) == sorted(
        [(1, d(2018, 2, 1), "a"), (None, d(2018, 2, 4), None), (7, None, "h")], key=str)
    assert sorted(map(tuple, out.refused.collect())) == sorted([
        ("on_date", "a.csv", "2018-02-01;2;b"), ("k", "a.csv", "03.02.2018;x;c"), ("line", "a.csv", "05.02.2018;5"),
        ("line", "a.csv", "06.02.2018;6;f;g"), ("on_date", "a.csv", "31.02.2018;8;i")])
    assert (out.n_good, out.n_refused) == (3, 5)
    assert CS.read_sorted_out(spark, x, SCHEMA, "dd.MM.yyyy", at_most=5).n_refused == 5
    with pytest.raises(CS.TooManyRefused, match="5 of 8"):
        CS.read_sorted_out(spark, x, SCHEMA, "dd.MM.yyyy", at_most=4)


def test_headers_of_sorted_out_files(spark, tmp):
    put(f"{tmp}/x/a.csv", "k;on_date;v\n1;2018-01-01;a\n")
    with pytest.raises(ValueError, match="no column"):
        CS.read_sorted_out(spark, f"{tmp}/x", T.StructType([*SCHEMA.fields, T.StructField("w", T.LongType())]))
    put(f"{tmp}/x/b.csv", "v;on_date;k\na;2018-01-01;1\n")
    with pytest.raises(Exception):
        CS.read_sorted_out(spark, f"{tmp}/x", SCHEMA)
    put(f"{tmp}/e/a.csv", "k;on_date;v\n")
    out = CS.read_sorted_out(spark, f"{tmp}/e", SCHEMA)
    assert (out.n_good, out.n_refused, out.good.count(), out.refused.count()) == (0, 0, 0, 0)


def test_tab_files_go_by_header_name_and_refuse_bad_values(spark, tmp):
    schema = T.StructType([T.StructField("event_type", T.StringType()), T.StructField("row_id", T.LongType())])
    x = put(f"{tmp}/t.csv", "row_id\tevent_type\n1\tclick\n")
    assert [tuple(r) for r in CS.read_tab(spark, x, schema).collect()] == [("click", 1)]
    y = put(f"{tmp}/u.csv", "row_id\tevent_type\nx\tclick\n")
    with pytest.raises(Exception):
        CS.read_tab(spark, y, schema).collect()


V = "k bigint, data_actual_date date, data_actual_end_date date, rate int"


def plain(facts, versions):
    out = []
    for k, at, tag in facts:
        hit = [r for vk, lo, hi, r in versions if None not in (k, vk, at, lo, hi) and vk == k and lo <= at <= hi]
        out.append((k, at, tag, hit[0] if hit else None))
    return sorted(out, key=str)


def test_by_sort_equals_the_interval_join(spark):
    base = d(2018, 1, 1)
    # a thousand versions of a hot key, with gaps; a key with one long version; a damaged one; one never met
    versions = [(1, base + dt.timedelta(days=3 * i), base + dt.timedelta(days=3 * i + i % 3), i) for i in range(1000)]
    versions += [(2, d(2017, 6, 15), d(2999, 12, 31), -2), (3, d(2018, 5, 1), d(2018, 4, 1), -3), (3, None, d(2020, 1, 1), -4),
                 (4, base, d(2018, 1, 9), -5), (5, base, base, -6), (None, base, base, -7)]
    facts = [(1, base + dt.timedelta(days=i), i) for i in range(-5, 3010)]
    facts += [(2, base + dt.timedelta(days=200 * i), 5000 + i) for i in range(-3, 30)]
    facts += [(3, d(2018, 4, 15), 6000), (4, d(2018, 1, 9), 6001), (4, d(2018, 1, 10), 6002), (6, base, 6003),
              (None, base, 6004), (1, None, 6005), (4, d(2018, 1, 9), 6001)]
    f = spark.createDataFrame(facts, "k bigint, at date, tag int").repartition(5)
    v = spark.createDataFrame(versions, V).repartition(3)
    out = valid_at_by_sort(f, v, ["k"], "at")
    assert out.columns == ["k", "at", "tag", "rate"]
    assert sorted(map(tuple, out.collect()), key=str) == plain(facts, versions)
    joined = join_valid_at(f, v, ["k"], "at", broadcast_limit=-1)
    assert sorted(map(tuple, joined.collect()), key=str) == plain(facts, versions)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan


def test_by_sort_refuses_overlaps_and_takes_empty_sides(spark):
    over = spark.createDataFrame([(1, d(2018, 1, 1), d(2018, 1, 9), 1), (1, d(2018, 1, 9), d(2018, 1, 20), 2)], V)
    f = spark.createDataFrame([(1, d(2018, 1, 5), 1)], "k bigint, at date, tag int")
    with pytest.raises(OverlappingVersions):
        valid_at_by_sort(f, over, ["k"], "at")
    assert valid_at_by_sort(f.limit(0), over.limit(1), ["k"], "at").collect() == []
    assert [tuple(r) for r in valid_at_by_sort(f, over.limit(0), ["k"], "at").collect()] == [(1, d(2018, 1, 5), 1, None)]
