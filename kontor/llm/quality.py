"""Quality classifier: learned subword embeddings, averaged, softmax output.

Features of a text are its words, as written, and the character 3- and
4-grams inside each (with word borders), hashed into ``BUCKETS`` rows of an
embedding table.  Word n-grams enter by their shape alone: a word equal to the
one one, two or three places before it adds a feature word of its own, the
same for all words, so that stuttering text is seen whatever it repeats.  A
text is the mean of its features' vectors; a softmax over
two classes reads it.  Table and output weights are learned together by
stochastic gradient descent in numpy, one document at a time.

Training runs in one task over at most ``LABELLED`` labelled rows (a
documented bound; their whole texts count).  For scoring, the output weights
are multiplied into the table once: a feature is then one number, a word the
sum of its features', a text's log-odds their mean, so the scan adds up
numbers per word and keeps the words it has seen (a bounded table).

Null and empty texts have no feature and score what the output bias says.
Without labelled rows every text scores 0.5.
"""

from __future__ import annotations

import io
import math
import operator
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_remainder, labelled_sample

BUCKETS, SIZE = 1 << 18, 8
GRAMS = (3, 4)
LABELLED = 6_000
EPOCHS, RATE = 5, 0.5
AGAIN = (b"\0again one", b"\0again two", b"\0again three")  # holds a space: no word of a text
REMEMBERED = 400_000


def word_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of ``words``, word after word, and how many each word has."""
    data = np.frombuffer(b"".join(b"<" + w + b">" for w in words), np.uint8).astype(np.uint64)
    size = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), size)
    keys, owners = [np.fromiter((zlib.crc32(w) for w in words), np.uint64, len(words))], [np.arange(len(words))]
    for n in GRAMS:
        if len(data) < n:
            continue
        h = np.zeros(len(data) - n + 1, np.uint64)
        for j in range(n):
            h = h * np.uint64(257) + data[j: len(data) - n + 1 + j]
        inside = owner[: len(h)] == owner[n - 1:]
        keys.append(h[inside] + np.uint64(n << 40))
        owners.append(owner[: len(h)][inside])
    key, own = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(own, kind="stable")
    h = key[order] * np.uint64(0x9E3779B97F4A7C15)
    bucket = ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - 18)
    return bucket.astype(np.int64), np.bincount(own, minlength=len(words))


def repeated(words: list[bytes]) -> list[int]:
    """How many words equal the one that many places before."""
    return [sum(map(operator.eq, words, words[d:])) for d in range(1, len(AGAIN) + 1)]


def _document(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of one text and their shares."""
    line = text.encode().split()
    if not line:
        return np.empty(0, np.int64), np.empty(0, np.float32)
    words = Counter(line)
    words.update({a: n for a, n in zip(AGAIN, repeated(line)) if n})
    bucket, n = word_features(list(words))
    times = np.repeat(np.fromiter(words.values(), np.int64, len(words)), n)
    at, inverse = np.unique(bucket, return_inverse=True)
    share = np.bincount(inverse, times)
    return at, (share / share.sum()).astype(np.float32)


def train(texts: list[str], labels: np.ndarray, seed: int = 7) -> tuple[np.ndarray, float]:
    """Per-bucket log-odds and bias, from a learned table and softmax weights."""
    rng = np.random.default_rng(seed)
    docs = [_document(t) for t in texts]
    table = ((rng.random((BUCKETS, SIZE), np.float32) - 0.5) / SIZE).astype(np.float32)
    out = np.zeros((2, SIZE), np.float32)
    bias = np.zeros(2, np.float32)
    steps, step = EPOCHS * len(docs), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(docs)):
            rate = RATE * (1 - step / steps)
            step += 1
            at, share = docs[i]
            rows = table[at]
            mean = share @ rows
            logits = out @ mean + bias
            p = np.exp(logits - logits.max())
            error = -p / p.sum()
            error[int(labels[i])] += 1
            back = error @ out
            out += rate * error[:, None] * mean
            bias += rate * 0.1 * error
            # a step along the mean's gradient, shared out by each feature's part of the text
            table[at] = rows + rate * len(at) ** 0.5 * share[:, None] * back
    return table @ (out[1] - out[0]), float(bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", labelled: int = LABELLED):
    """(per-bucket log-odds, bias); the table comes back as one array of fixed size."""
    sample = labelled_sample(docs, labels, label, labelled)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((i.as_py(), t.as_py(), y.as_py()) for b in batches
                      for i, t, y in zip(b.column(0), b.column(1), b.column(2)))
        if not rows:
            return
        weights, bias = train([r[1] for r in rows], np.array([r[2] for r in rows]))
        file = io.BytesIO()
        np.save(file, weights.astype(np.float32))
        yield pa.RecordBatch.from_arrays([pa.array([file.getvalue()], pa.binary()), pa.array([bias], pa.float64())],
                                         names=["weights", "bias"])

    learned = (sample.select("doc_id", "text", "label").repartition(1)
               .mapInArrow(task, "weights binary, bias double").collect())
    if not learned:
        return np.zeros(BUCKETS, np.float32), 0.0
    return np.load(io.BytesIO(bytes(learned[0]["weights"]))), learned[0]["bias"]


class Words(dict):
    """word -> (sum of its features' log-odds) + 1j * (number of its features)."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        self.learn(list(AGAIN))

    def learn(self, words: list[bytes]) -> None:
        if len(self) + len(words) > REMEMBERED:
            self.clear()
            words = [*words, *AGAIN]
        bucket, n = word_features(words)
        total = np.add.reduceat(self.weights[bucket].astype(float), np.concatenate([[0], np.cumsum(n)[:-1]]))
        self.update(zip(words, (total + 1j * n).tolist()))


def text_log_odds(text: str | None, known: Words, bias: float) -> float:
    words = (text or "").encode().split()
    if not words:
        return bias
    new = {w for w in words if w not in known}
    if new:
        if len(known) + len(new) > REMEMBERED:
            new = set(words)
        known.learn(list(new))
    both = sum(map(known.__getitem__, words), 0j)
    both += sum(n * known[a] for a, n in zip(AGAIN, repeated(words)))
    return both.real / both.imag + bias


def with_quality(docs: DataFrame, model, into: str = "quality_score") -> DataFrame:
    """``docs`` with the probability of label 1; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights, bias = shared.value
        known = Words(weights)
        for texts in parts:
            yield pd.Series([1 / (1 + math.exp(-max(min(text_log_odds(t, known, bias), 500), -500)))
                             for t in texts], dtype=float)

    return docs.withColumn(into, score("text"))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted)."""
    judged = with_quality(docs.select("doc_id", "text"), fit(docs, labels), "score")
    return judged.select("doc_id", (id_remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_rejected(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``docs`` without those scored below ``threshold``."""
    columns = docs.columns
    into = next(n for n in ("score", *(f"score_{i}" for i in range(len(columns) + 1))) if n not in columns)
    return with_quality(docs, fit(docs, labels), into).filter(F.col(into) >= threshold).select(*columns)
