import datetime as dt
import os

import pytest

from kontor.sinks import files as SK
from kontor.sources import testbed as TB

S = "on_date date, k bigint, v bigint"
d = dt.date


def test_replace_slices_overwrites_and_deletes_empty(spark, tmp):
    path = f"{tmp}/mart"
    first = spark.createDataFrame([(d(2018, 1, 1), 1, 1), (d(2018, 1, 2), 1, 2), (d(2018, 1, 3), 1, 3)], S)
    SK.replace_slices(first, path, "on_date", [d(2018, 1, 1), d(2018, 1, 2), d(2018, 1, 3)])
    second = spark.createDataFrame([(d(2018, 1, 2), 1, 20)], S)
    res = SK.replace_slices(second, path, "on_date", [d(2018, 1, 2), d(2018, 1, 3)])
    assert res.rows == 1 and res.written == {d(2018, 1, 2)} and res.deleted == [d(2018, 1, 3)]
    back = {tuple(r) for r in spark.read.schema(S).parquet(path).select("on_date", "k", "v").collect()}
    assert back == {(d(2018, 1, 1), 1, 1), (d(2018, 1, 2), 1, 20)}
    # rerun: same result
    SK.replace_slices(second, path, "on_date", [d(2018, 1, 2), d(2018, 1, 3)])
    assert {tuple(r) for r in spark.read.schema(S).parquet(path).select("on_date", "k", "v").collect()} == back


def test_rows_outside_slices_are_refused_before_anything_is_replaced(spark, tmp):
    path = f"{tmp}/m2"
    first = spark.createDataFrame([(d(2018, 1, 1), 1, 1), (d(2018, 1, 5), 1, 5)], S)
    SK.replace_slices(first, path, "on_date", [d(2018, 1, 1), d(2018, 1, 5)])
    wrong = spark.createDataFrame([(d(2018, 1, 1), 1, 100), (d(2018, 1, 5), 1, 500)], S)
    with pytest.raises(Exception, match="outside the requested slices"):
        SK.replace_slices(wrong, path, "on_date", [d(2018, 1, 1)])
    null = spark.createDataFrame([(None, 1, 100)], S)
    with pytest.raises(Exception, match="outside the requested slices"):
        SK.replace_slices(null, path, "on_date", [d(2018, 1, 1)])
    back = {tuple(r) for r in spark.read.schema(S).parquet(path).select("on_date", "k", "v").collect()}
    assert back == {(d(2018, 1, 1), 1, 1), (d(2018, 1, 5), 1, 5)}


def test_a_large_slice_has_many_writers(spark, tmp):
    path = f"{tmp}/wide"
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        big = spark.range(0, 40000, 1, 12).selectExpr("DATE'2018-01-01' AS on_date", "id AS k", "hash(id) AS v")
        SK.replace_slices(big, path, "on_date", [d(2018, 1, 1)])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len([f for f in os.listdir(f"{path}/on_date=2018-01-01") if f.endswith(".parquet")]) > 4


def test_an_unfinished_version_does_not_count(spark, tmp):
    root = f"{tmp}/t"
    df = spark.createDataFrame([(d(2018, 1, 1), 1, 1)], S)
    df.write.parquet(SK.next_version(spark, root))
    os.makedirs(f"{root}/v=2")  # what a failed write leaves
    assert SK.latest_version(spark, root).endswith("v=1")
    assert SK.next_version(spark, root).endswith("v=3")
    for _ in range(3):
        df.write.parquet(SK.next_version(spark, root))
    dropped = SK.drop_old_versions(spark, root, keep=2)
    assert [p.rsplit("/", 1)[1] for p in dropped] == ["v=1", "v=2", "v=3"]
    assert sorted(os.listdir(root)) == ["v=4", "v=5"]


def test_versions_and_empty_clone(spark, tmp):
    root = f"{tmp}/t"
    assert SK.latest_version(spark, root) is None
    v1 = SK.next_version(spark, root)
    df = spark.createDataFrame([(d(2018, 1, 1), 1, 1)], S)
    df.write.parquet(v1)
    assert SK.latest_version(spark, root).endswith("v=1")
    assert SK.next_version(spark, root).endswith("v=2")
    empty = SK.clone_empty(df)
    assert empty.count() == 0 and empty.schema == df.schema
    assert os.path.isdir(v1.replace("file:", ""))


def test_numbered_folders_round_trip(spark, tmp):
    from pyspark.sql import types as T

    from kontor.sources.csv import scan_delta_folders
    df = spark.createDataFrame([(1000, 1, "a"), (1000, 2, "b"), (1001, 1, "c")], "delta_id int, k bigint, v string")
    folders = TB.write_numbered_folders(df, f"{tmp}/d")
    assert [f.rsplit("/", 1)[1] for f in folders] == ["1000", "1001"]
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    back = scan_delta_folders(spark, f"{tmp}/d", schema)
    assert sorted(map(tuple, back.collect())) == [(1000, 1, "a"), (1000, 2, "b"), (1001, 1, "c")]
