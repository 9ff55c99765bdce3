import hashlib
import math
import time
from collections import Counter

from pyspark.sql import functions as F

from kontor.llm import mixing


def brute(rows, rate):
    out = Counter()
    for r in rows:
        m = rate[r["source"]]
        u = int(hashlib.md5(f"mix-1:{'' if r['doc_id'] is None else r['doc_id']}".encode()).hexdigest()[:12], 16) / 2 ** 48
        k, p = 0, math.exp(-m)
        below = p
        while u >= below and k < 10_000:
            k += 1
            p *= m / k
            below += p
        out[(r["doc_id"], r["text"])] += k
    return out


def test_copies_equal_a_plain_inversion(corpus):
    size = Counter()
    for r in corpus.collect():
        size[r["source"]] += len((r["text"] or "").encode())
    share = {s: math.sqrt(n) for s, n in size.items()}
    rate = {s: share[s] / sum(share.values()) * sum(size.values()) / size[s] for s in size}
    got = Counter()
    out = mixing.replicate(corpus, epochs=1.0)
    for r in out.collect():
        got[(r["doc_id"], r["text"])] += 1
    assert got == +brute(corpus.collect(), rate)
    assert out.columns == [*corpus.columns, "copy"]


def test_named_weights_and_a_high_rate(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("abcd").alias("text"),
                                    F.when(F.col("id") < 3900, "big").otherwise("small").alias("source"))
    out = mixing.replicate(docs, {"big": 1, "small": 3}, epochs=2.0)
    n = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    assert abs(n["big"] - 2000) < 200 and abs(n["small"] - 6000) < 400  # a rate of 60
    assert mixing.replicate(docs, {"big": 1}).filter("source = 'small'").count() == 0


def test_very_large_rates_do_not_underflow(spark):
    rates = spark.createDataFrame([("a", 2000.0), ("b", 1e6), ("c", 3e7), (None, 0.0), ("e", None)], "source string, rate double")
    start = time.time()
    got = {r["source"]: r for r in mixing.cumulative(rates).collect()}
    assert time.time() - start < 15
    for s, rate in (("a", 2000), ("b", 10 ** 6), ("c", 3 * 10 ** 7)):
        cdf, first = got[s]["below"], got[s]["first"]
        assert abs(cdf[-1] - 1) < 1e-8 and cdf[0] < 1e-14 and abs(cdf[rate - first] - 0.5) < 0.02
        assert len(cdf) < 26 * math.sqrt(rate) + 62
    assert got[None]["below"] == [1.0] and got["e"]["below"] is None


def test_probabilities_equal_their_definition(spark):
    rates = [0.001, 0.7, 3.0, 19.5, 20.0, 60.0, 700.0]
    rows = mixing.cumulative(spark.createDataFrame([(str(m), m) for m in rates], "source string, rate double")).collect()
    for r in rows:
        below, k = 0.0, 0
        for k, c in enumerate(r["below"], r["first"]):
            below += math.exp(-r["rate"] + k * math.log(r["rate"]) - math.lgamma(k + 1))
            assert abs(c - below) < 1e-11
    assert len(rows) == len(rates)


def test_blocks_of_sources_give_the_same_rows(corpus, monkeypatch):
    whole = sorted(map(str, mixing.replicate(corpus).collect()))
    monkeypatch.setattr(mixing, "TABLE_VALUES", 60)
    out = mixing.replicate(corpus)
    assert sorted(map(str, out.collect())) == whole
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") > 1 and "SortMergeJoin" not in plan


def test_the_same_rows_whatever_the_partitioning(corpus):
    rows = [sorted(map(str, mixing.replicate(corpus.repartition(n)).collect())) for n in (1, 7)]
    assert rows[0] == rows[1]


def test_empty_tables_and_texts_and_further_columns(spark, empty, extra):
    assert mixing.replicate(empty).count() == 0
    assert mixing.replicate(extra).columns == [*extra.columns, "copy"]
    silent = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (3, "x", "b")], "doc_id long, text string, source string")
    assert {r["doc_id"] for r in mixing.replicate(silent).collect()} >= {1, 2}


def test_native_plan(corpus):
    plan = mixing.replicate(corpus)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
