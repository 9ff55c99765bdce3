from kontor.operators.sequence import sequential_ids
from kontor.plans import runlog as RL


def test_chunks_empty_exact_and_long_messages(spark):
    msgs = spark.createDataFrame([(1, ""), (2, "a" * 4000), (3, "b" * 4001), (4, None), (5, "é" * 8001)],
                                 "id bigint, message string")
    out = sorted((r["id"], r["piece"], r["record_id"], len(r["message"]))
                 for r in RL.chunk_messages(msgs, ["id"], start_id=10).collect())
    assert out == [(2, 0, 10, 4000), (3, 0, 11, 4000), (3, 1, 12, 1),
                   (5, 0, 13, 4000), (5, 1, 14, 4000), (5, 2, 15, 1)]


def test_sequential_ids_consecutive_across_partitions(spark):
    df = spark.range(0, 5000, numPartitions=7).selectExpr("(id * 7919) % 5000 AS k")
    ids = sequential_ids(df, ["k"], start=1, partitions=5)
    got = sorted((r["k"], r["record_id"]) for r in ids.collect())
    assert [i for _, i in got] == list(range(1, 5001))
    assert all(k + 1 == i for k, i in got)


def test_run_log_appends(spark, tmp):
    log = RL.RunLog(spark, f"{tmp}/log", "load_logs")
    log.add("t1", "start_upload", "go")
    log.add("t1", "end_upload", "done")
    assert log.flush() == 2
    log.add("t2", "error_upload", "bad", "boom")
    log.flush()
    rows = sorted((r["sources"], r["status"], r["error"]) for r in log.read().collect())
    assert rows == [("t1", "end_upload", None), ("t1", "start_upload", None), ("t2", "error_upload", "boom")]


def test_log_messages_continue_sequence(spark):
    existing = spark.createDataFrame([(5,)], "record_id bigint")
    msgs = spark.createDataFrame([(1, "x" * 4500)], "id bigint, message string")
    rows = RL.log_messages(spark, msgs, ["id"], existing).collect()
    assert sorted(r["record_id"] for r in rows) == [6, 7]
    assert {r["message_type"] for r in rows} == {1}


def test_message_type_per_message(spark):
    msgs = spark.createDataFrame([(1, "a", 1), (2, "b" * 4001, 3)], "id bigint, message string, kind int")
    rows = sorted((r["id"], r["piece"], r["message_type"]) for r in RL.chunk_messages(msgs, ["id"], message_type="kind").collect())
    assert rows == [(1, 0, 1), (2, 0, 3), (2, 1, 3)]
