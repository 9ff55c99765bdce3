import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kontor.llm import quality as Q
from kontor.llm import toxicity as X

SF = "/root/testdata/sf0.01"


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    ones = label == 1
    return (rank[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


@pytest.mark.parametrize("score,label,least", [(X.score_documents, "toxic", 0.7), (Q.score_documents, "quality", 0.95)])
def test_held_out_ranking(spark, score, label, least):
    docs, labels = read(spark, "documents"), read(spark, "labels")
    out = score(docs, labels)
    assert out.count() == docs.count() and out.filter("score is null or score < 0 or score > 1").count() == 0
    held = out.filter("held_out").join(labels, "doc_id").select("score", F.col(label).alias("y")).toPandas()
    assert auc(held["score"].to_numpy(), held["y"].to_numpy()) > least


def test_held_out_labels_and_other_columns_are_not_looked_at(spark):
    docs, labels = read(spark, "documents"), read(spark, "labels")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    flipped = labels.withColumns({c: F.when(held, 1 - F.col(c)).otherwise(F.col(c)) for c in ("quality", "toxic")})
    for score in (X.score_documents, Q.score_documents):
        a = sorted(map(tuple, score(docs, labels).collect()))
        b = sorted(map(tuple, score(docs.withColumns({"lang": F.lit("x"), "source": F.lit(None).cast("string")}),
                                    flipped).collect()))
        assert a == b


@pytest.mark.parametrize("score", [X.score_documents, Q.score_documents])
def test_awkward_rows(spark, corpus, extra, empty, score):
    labels = spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(30)] + [(None, 1, 1), (31, None, None), (3, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    out = score(extra, labels)
    assert out.count() == corpus.count() and out.filter("score is null or predicted is null or held_out is null").count() == 0
    assert score(empty, labels).count() == 0
    assert score(corpus, labels.limit(0)).count() == corpus.count()
    ones = labels.filter("quality = 1").withColumn("toxic", F.lit(1))
    assert score(corpus, ones).count() == corpus.count()


def test_rejected_documents_go(spark, corpus, extra):
    labels = spark.createDataFrame([(i, 1) for i in range(30)] + [(600, 0)], "doc_id long, quality int")
    left = Q.without_rejected(extra, labels)
    assert left.columns == extra.columns and left.count() <= corpus.count()


def plain_segments(s):
    """All maximal scoring segments by their definition: a best segment, then both sides of it."""
    best = max(((sum(s[i:j]), -(j - i), i, j) for i in range(len(s)) for j in range(i + 1, len(s) + 1)), default=(0,))
    if best[0] <= 0:
        return []
    total, _, i, j = best
    return plain_segments(s[:i]) + [(i, j - 1, total)] + [(a + j, b + j, t) for a, b, t in plain_segments(s[j:])]


def test_segments_of_long_texts_in_linear_time():
    import time

    start = time.time()
    assert len(X.segments(np.tile([1.0, -2.0], 500_000))) == 500_000
    assert len(X.segments(np.tile([2.0, -1.0], 500_000))) == 1
    assert time.time() - start < 10


def walked_segments(s):
    """The same by looking at every segment before, one by one; sums of whole numbers, so ties are exact."""
    run, found = np.concatenate([[0], np.cumsum(s)]).tolist(), []
    for i in range(len(s)):
        if s[i] > 0:
            new = (i, i, run[i], run[i + 1])
            while True:
                lower = [k for k, x in enumerate(found) if x[2] < new[2]]
                if not lower or found[lower[-1]][3] >= new[3]:
                    break
                new = (found[lower[-1]][0], i, found[lower[-1]][2], new[3])
                del found[lower[-1]:]
            found.append(new)
    return [(a, b, r - x) for a, b, x, r in found]


def test_segments_with_ties():
    rng = random.Random(8)
    for _ in range(400):
        s = [rng.choice([-2, -1, 0, 1, 2]) for _ in range(rng.randint(0, 60))]
        assert X.segments(np.array(s, float)) == walked_segments(s)


def test_segments_equal_their_definition():
    rng = random.Random(3)
    for _ in range(300):
        s = [rng.choice([-7, -3, -1, 2, 5, 11]) + rng.random() / 100 for _ in range(rng.randint(0, 14))]
        got, want = X.segments(np.array(s)), plain_segments(s)
        assert [x[:2] for x in got] == [x[:2] for x in want]
        assert np.allclose([x[2] for x in got], [x[2] for x in want])


def test_passages_are_where_the_words_are(spark):
    model = X.Model({"scum": 6.0}, ({}, {}), 1.0, 0.01, (-4.0, 1.0))
    docs = spark.createDataFrame([(1, "you are Scum scum, friend"), (2, "all is well"), (3, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["toxicity"] for r in X.with_toxicity(docs, model).collect()}
    (p,) = got[1]["passages"]
    assert "you are Scum scum, friend"[p["first"]:p["last"]] == "Scum scum"
    assert got[1]["score"] > 0.5 > got[2]["score"] == got[3]["score"] and not got[2]["passages"]


def test_word_tables_stay_bounded(monkeypatch):
    monkeypatch.setattr(Q, "REMEMBERED", 40)
    weights = np.random.default_rng(0).random(Q.BUCKETS).astype(np.float32)
    known, fresh = Q.Words(weights), None
    for i in range(20):
        text = " ".join(f"w{i}x{j}" for j in range(15)) + " w0x0 w0x0"
        fresh = Q.text_log_odds(text, Q.Words(weights), 0.1)
        assert abs(Q.text_log_odds(text, known, 0.1) - fresh) < 1e-9
    assert len(known) <= 60
