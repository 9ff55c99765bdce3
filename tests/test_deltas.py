import datetime as dt

import pytest

from kontor.operators import deltas as DL
from kontor.operators.upsert import DuplicateKeyError

S = "delta_id int, k bigint, day date, v string"
M = "k bigint, day date, v string"
d = dt.date

ROWS = [
    (1000, 1, d(2018, 1, 1), "a"), (1000, 2, d(2018, 1, 1), "b"),
    (1001, 1, d(2018, 1, 2), "a2"), (1001, 3, d(2018, 1, 2), "c"),
    (1002, 2, d(2018, 1, 3), "b3"), (1002, None, d(2018, 1, 3), "n1"),
    (1003, None, d(2018, 1, 4), "n2"), (1003, 1, d(2018, 1, 4), "a4"),
]


def as_set(df):
    return {tuple(r) for r in df.collect()}


@pytest.mark.parametrize("pk", [["k"], ["day", "k"]])
def test_fold_equals_chain(spark, pk):
    deltas = spark.createDataFrame(ROWS, S)
    mirror = spark.createDataFrame([(2, d(2017, 12, 31), "old"), (9, d(2017, 12, 31), "keep")], M)
    fold = as_set(DL.apply_deltas(mirror, deltas, pk))
    chain = as_set(DL.apply_deltas_chain(mirror, deltas, pk, checkpoint_every=2))
    assert fold == chain


def test_latest_state_and_history_counts(spark):
    deltas = spark.createDataFrame(ROWS, S)
    empty = spark.createDataFrame([], M)
    latest = as_set(DL.apply_deltas(empty, deltas, ["k"]))
    assert {r for r in latest if r[0] is not None} == {(1, d(2018, 1, 4), "a4"), (2, d(2018, 1, 3), "b3"),
                                                        (3, d(2018, 1, 2), "c")}
    assert len(latest) == 5  # two NULL-key rows never match, both inserted
    assert DL.apply_deltas(empty, deltas, ["day", "k"]).count() == len(ROWS)


def test_incremental_resumes_after_last_finished(spark):
    deltas = spark.createDataFrame(ROWS, S)
    empty = spark.createDataFrame([], M)
    first = DL.apply_deltas(empty, deltas.filter("delta_id <= 1001"), ["k"])
    log = spark.createDataFrame([("end", 1000, "m"), ("end", 1001, "m"), ("start", 1002, "m"), ("end", 1005, "x")],
                                "status string, delta_id int, table_name string")
    last = DL.last_loaded(log, "m")
    assert last == 1001
    assert DL.last_loaded(log.filter("false"), "m") == 0
    assert as_set(DL.apply_deltas(first, deltas, ["k"], after=last)) == as_set(DL.apply_deltas(empty, deltas, ["k"]))


def test_numeric_not_text_order(spark):
    rows = [(999, 1, d(2018, 1, 1), "old"), (1000, 1, d(2018, 1, 2), "new")]
    out = as_set(DL.apply_deltas(spark.createDataFrame([], M), spark.createDataFrame(rows, S), ["k"]))
    assert out == {(1, d(2018, 1, 2), "new")}


def test_repeated_key_within_a_delta_raises(spark):
    rows = [(1000, 1, d(2018, 1, 1), "a"), (1000, 1, d(2018, 1, 1), "b")]
    with pytest.raises(DuplicateKeyError):
        DL.apply_deltas(spark.createDataFrame([], M), spark.createDataFrame(rows, S), ["k"])


def test_merge_newer_is_order_independent(spark):
    deltas = spark.createDataFrame([r for r in ROWS if r[1] is not None], S)
    ms = "delta_id int, k bigint, day date, v string"
    empty = spark.createDataFrame([], ms)
    forward = empty
    for did in (1000, 1001, 1002, 1003):
        forward = DL.merge_newer(forward, deltas.filter(f"delta_id = {did}"), ["k"])
    backward = empty
    for did in (1003, 1001, 1002, 1000):
        backward = DL.merge_newer(backward, deltas.filter(f"delta_id = {did}"), ["k"])
    again = DL.merge_newer(backward, deltas, ["k"])
    assert as_set(forward) == as_set(backward) == as_set(again)
