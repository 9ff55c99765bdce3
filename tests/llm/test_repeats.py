import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from kontor.llm import repeats as R


def plain(texts, depth):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[p:p + depth] for b in data for p in range(len(b) - depth + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - depth + 1):
            if seen[b[p:p + depth]] > 1:
                gone[p:p + depth] = b"\1" * depth
        left = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return out


@pytest.mark.parametrize("depth,digit", [(200, 128), (50, 20), (50, 50)])
def test_report_equals_brute_force(corpus, depth, digit):
    docs = corpus.filter("doc_id is null or doc_id <> 400").select("doc_id", "text")
    rows = docs.collect()
    want = sorted((str(r["doc_id"]), *x) for r, x in zip(rows, plain([r["text"] for r in rows], depth)))
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
                 for r in R.removal_report(docs, depth, digit).collect())
    assert got == want and sum(x[2] for x in want) > 0


def test_patched_texts_equal_brute_force(spark):
    """Texts put together from shared pieces, with copies inside one text, in several batches."""
    rng = random.Random(9)
    piece = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(5, 90))) for _ in range(12)]
    texts = ["".join(rng.choice(piece) if rng.random() < 0.7 else
                     "".join(rng.choice("xyz") for _ in range(rng.randint(1, 60))) for _ in range(rng.randint(1, 12)))
             for _ in range(120)] + ["ab" * 200, "a" * 500, "a" * 40 + "b" + "a" * 40]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in R.removal_report(docs, 30, 18).collect()}
    assert [got[i] for i in range(len(texts))] == plain(texts, 30)


def test_blocks_of_a_long_text_change_nothing(monkeypatch):
    data = np.random.default_rng(1).integers(97, 100, 5000, dtype=np.uint8)

    def minimisers():
        v, a, b, _ = R.window_runs(data, 60, 30)
        return np.repeat(v, b - a + 1)

    whole = minimisers()
    monkeypatch.setattr(R, "BLOCK", 300)
    assert len(whole) == 5000 - 60 + 1 and (minimisers() == whole).all()


def test_a_digit_twice_in_one_run_is_noticed():
    v, a, b, twice = R.window_runs(np.frombuffer(b"a" * 80, np.uint8), 60, 30)
    assert twice.all()


@pytest.mark.parametrize("depth,digit", [(200, 128), (50, 20), (50, 50)])
def test_periods_about_the_span_equal_brute_force(spark, depth, digit):
    """One text of each period, with strings that no other text has."""
    rng = random.Random(7)
    span = depth - digit + 1

    def line(n):
        return "".join(chr(rng.randrange(33, 127)) for _ in range(n))

    texts = [line(70) + line(period) * (2 * depth // period + 3) + line(90)
             for period in (max(span - 1, 1), span, span + 1, 2 * span)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in R.removal_report(docs, depth, digit).collect()}
    want = plain(texts, depth)
    assert [got[i] for i in range(len(texts))] == want and all(x[1] > 0 for x in want)


def test_the_texts_left(corpus, extra, empty):
    out = R.without_repeats(extra)
    assert out.columns == extra.columns and out.count() == extra.count()
    report = {(r["doc_id"], r["n_bytes"]): r for r in R.removal_report(corpus).collect()}
    for r in out.collect():
        before = corpus_text(corpus, r["doc_id"])
        x = report[(r["doc_id"], len((before or "").encode()))]
        if not x["n_removed"]:
            assert r["text"] == before
        else:
            assert len(r["text"].encode()) <= x["n_bytes"] - x["n_removed"] and r["n_chars"] == len(r["text"])
    assert R.without_repeats(empty).count() == 0 and R.removal_report(empty).count() == 0


_TEXT = {}


def corpus_text(corpus, doc_id):
    if not _TEXT:
        _TEXT.update({r["doc_id"]: r["text"] for r in corpus.collect()})
    return _TEXT[doc_id]
