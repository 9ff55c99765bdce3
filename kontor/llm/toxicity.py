"""Toxic passages as maximum-scoring segments of token log-odds.

Learning
    For each word, and for its first five and first four characters (words
    are inflected), the labelled documents that have it are counted, toxic
    and not.  The share of toxic ones is smoothed by a Dirichlet prior worth
    ``PRIOR`` documents that is centred one step up: the word's on its five
    characters', theirs on the four characters', theirs on the overall
    share.  A token's score is the log-odds of that share against the
    overall one, less ``DRIFT``, so that ordinary text scores below zero.
    Only tokens that ``SUPPORT`` toxic sampled documents have, or whose
    beginning they have, and that score above zero keep their own score (with
    the words sharing such a beginning); all others score -``DRIFT``.
    Three folds of labelled rows give the odds, a fourth the calibration.

Scan
    A linear scan (Ruzzo and Tompa) gives all maximal scoring segments of a
    text's token scores.  Under ordinary text the best of n tokens follows an
    extreme-value law: P(S >= x) = 1 - exp(-K n exp(-L x)), L solving
    sum p(s) exp(L s) = 1 over the scores of non-toxic documents.  Segments
    whose expected number in ordinary text of that length is at most
    ``EXPECTED`` are passages.

Document score
    The passages' evidence L S - ln(K n) is added up; a logistic curve of it,
    fitted on the calibration fold, is the probability given out.  K is
    fitted there too, to the share of non-toxic documents with a segment.

Null and empty texts have no token and score what a text without any passage
scores.  Without labelled rows, or with one label only, every text scores the
overall share (0 without any label).  Ties: a
segment is joined with an earlier one only where it starts above that one's
start and ends above its end, so equal levels keep segments apart.  Repeated
rows score alike; a labelled id that is repeated counts once per row.  Texts
of any length are scanned whole, in linear time and in memory that follows the
longest text.  ``with_toxicity`` keeps further columns, ``score_documents``
ignores them.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_remainder, labelled_sample, stored

WORD = re.compile(r"\w+")
LADDER = (4, 5)       # leading characters
PRIOR = 10.0          # documents
DRIFT = 0.5           # taken off each token's log-odds
LABELLED = 50_000     # labelled rows used, at most
SUPPORT = 3           # toxic documents that must have a token for it to score above zero
EXPECTED = 0.05
REMEMBERED = 400_000


@dataclass
class Model:
    """Scores of the words and word beginnings that can matter; all others score -DRIFT."""
    words: dict = field(default_factory=dict)
    starts: tuple = ({}, {})
    lam: float = 1.0
    k: float = 1.0
    curve: tuple = (-30.0, 0.0)

    def token(self, word: str) -> float:
        if word in self.words:
            return self.words[word]
        for n, known in zip(LADDER[::-1], self.starts[::-1]):
            if word[:n] in known:
                return known[word[:n]]
        return -DRIFT


class Scores(dict):
    def __init__(self, model: Model):
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) > REMEMBERED:
            self.clear()
        s = self[word] = self.model.token(word)
        return s


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score), in linear time.

    Each segment remembers the nearest one before it with a smaller sum at its
    start.  A search for such a segment goes from one to the next along these,
    and what one search has passed no later one passes again.
    """
    run = np.concatenate([[0.0], np.cumsum(scores)]).tolist()
    found: list[tuple[int, int, float, float, int]] = []  # first, last, sum before, sum through, nearest lower
    for i in np.flatnonzero(scores > 0).tolist():
        first, left, right, j = i, run[i], run[i + 1], len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= left:
                j = found[j][4]
            if j < 0 or found[j][3] >= right:
                break
            first, _, left, _, lower = found[j]
            del found[j:]
            j = lower
        found.append((first, i, left, right, j))
    return [(a, b, float(r - x)) for a, b, x, r, _ in found]


def passages(text: str | None, scores: Scores) -> tuple[int, list[tuple[int, int, float]]]:
    """(number of tokens, segments as character ranges with their scores)."""
    spans = [(m.start(), m.end()) for m in WORD.finditer((text or "").lower())] if text else []
    values = np.fromiter((scores[w] for w in WORD.findall(text.lower())), float) if spans else np.empty(0)
    return len(values), [(spans[a][0], spans[b][1], s) for a, b, s in segments(values)]


def evidence(n: int, found: list, lam: float, k: float) -> float:
    """Added evidence of the passages among the segments."""
    least = math.log(1 / EXPECTED)
    out = 0.0
    for *_, s in found:
        e = lam * s - math.log(max(k * n, 1e-300))
        out += e if e >= least else 0.0
    return out


# ---- learning ----------------------------------------------------------------

def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(level, token, toxic, other): documents of each kind that have the token."""
    for batch in batches:
        kinds = (Counter(), Counter())
        for text, label in zip(batch.column(0), batch.column(1)):
            words = set(WORD.findall(text.as_py().lower()))
            have = kinds[1 - (label.as_py() == 1)]
            have.update((0, w) for w in words)
            for level, n in enumerate(LADDER, 1):
                have.update((level, s) for s in {w[:n] for w in words})
        keys = list(kinds[0].keys() | kinds[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.string()),
             *(pa.array([c[k] for k in keys], pa.int64()) for c in kinds)],
            names=["level", "token", "toxic", "other"])


def _odds(sample: DataFrame):
    """Scores per level, and the overall share: (words, starts of 5, starts of 4, share, tokens)."""
    counts = stored(sample.select("text", "label").mapInArrow(
        _document_counts, "level int, token string, toxic long, other long")
        .groupBy("level", "token").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")), "token_counts")
    toxic, other = counts.filter("level = 0").agg(F.sum("toxic"), F.sum("other")).first()
    if not toxic or not other:
        return None
    base = toxic / (toxic + other)

    def level(i, token):
        return counts.filter(F.col("level") == i).select(F.col("token").alias(token), F.col("toxic").alias(f"t{i}"),
                                                         F.col("other").alias(f"n{i}"))

    def share(i, parent):
        return (F.col(f"t{i}") + PRIOR * parent) / (F.col(f"t{i}") + F.col(f"n{i}") + PRIOR)

    def score(q):
        return F.log(q / (1 - q)) - F.lit(math.log(base / (1 - base)) + DRIFT)

    four = level(1, "four").withColumn("q4", share(1, F.lit(base))).withColumn("s4", score(F.col("q4")))
    five = (level(2, "five").withColumn("four", F.substring("five", 1, LADDER[0])).join(four, "four")
            .withColumn("q5", share(2, F.col("q4"))).withColumn("s5", score(F.col("q5"))))
    words = (level(0, "word").withColumn("five", F.substring("word", 1, LADDER[1])).join(five, "five")
             .withColumn("s0", score(share(0, F.col("q5")))))
    up4, up5, up0 = ((F.col(f"s{j}") > 0) & (F.col(f"t{i}") >= SUPPORT) for j, i in ((4, 1), (5, 2), (0, 0)))
    # bounded: each row kept has, or shares its beginning with, a token of SUPPORT of the sampled documents
    w = words.filter(up4 | up5 | up0).select("word", "s0", "n0").toPandas()
    s5 = five.filter(up4 | up5).select("five", "s5").distinct().toPandas()
    s4 = four.filter(up4).select("four", "s4").toPandas()
    return w, s5, s4, base, other


def _decay(scores: np.ndarray, share: np.ndarray) -> float:
    """The positive root of sum p exp(L s) = 1, the rest of the tokens scoring -DRIFT."""
    rest = max(1.0 - share.sum(), 1e-9)

    def value(x):
        return rest * math.exp(-DRIFT * x) + float((share * np.exp(np.minimum(scores * x, 600))).sum()) - 1

    low, high = 1e-6, 1.0
    while value(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 0 else (low, mid)
    return high


def _logistic(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Intercept and slope by Newton steps, with a weak pull to zero."""
    x = np.stack([np.ones_like(z), z], axis=1)
    b = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - 1e-3 * b
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, gradient)
        b += step
        if np.abs(step).max() < 1e-9:
            break
    return float(b[0]), float(b[1])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", labelled: int = LABELLED) -> Model:
    sample = stored(labelled_sample(docs, labels, label, labelled), "labelled")
    found = _odds(sample.filter("fold <> 4"))
    if found is None:
        n, ones = sample.agg(F.count(F.lit(1)), F.sum("label")).first()
        share = min(max((ones or 0) / n, 1e-9), 1 - 1e-9) if n else 1e-9
        return Model(curve=(math.log(share / (1 - share)), 0.0))
    w, s5, s4, base, tokens = found
    model = Model(dict(zip(w["word"], w["s0"])), (dict(zip(s4["four"], s4["s4"])), dict(zip(s5["five"], s5["s5"]))))
    model.lam = _decay(w["s0"].to_numpy(float), w["n0"].to_numpy(float) / tokens)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def calibration(value):
        """(label, tokens, ``value`` of the tokens and segments) of each text in the calibration fold."""
        def run(batches):
            scores = Scores(shared.value)
            for batch in batches:
                rows = [passages(t.as_py(), scores) for t in batch.column(0)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).cast(pa.int32()), pa.array([n for n, _ in rows], pa.int64()),
                     pa.array([value(n, f) for n, f in rows], pa.float64())], names=["label", "n", "value"])

        return (sample.filter("fold = 4").select("text", "label")
                .mapInArrow(run, "label int, n long, value double").toPandas())

    rows = calibration(lambda n, found: max((s for *_, s in found), default=0.0))
    plain = rows[rows["label"] == 0]
    # K: with it, the expected number of segments is right where ordinary text has any
    heights = plain["value"].to_numpy(float)
    lengths = plain["n"].to_numpy(float)
    hit = heights > 0
    law = (lengths * np.exp(-model.lam * np.where(hit, heights, np.inf))).sum()
    model.k = float(min(1.0, max(hit.sum(), 1) / max(law, 1.0))) if hit.any() else float(1 / max(lengths.mean(), 1.0))
    lam, k = model.lam, model.k
    rows = calibration(lambda n, found: evidence(n, found, lam, k))
    z = rows["value"].to_numpy(float)
    model.curve = _logistic(np.minimum(z, 60.0), rows["label"].to_numpy(float), np.ones(len(z))) if len(z) else (
        math.log(base / (1 - base)), 1.0)
    return model


# ---- scoring ------------------------------------------------------------------

RESULT = "struct<score:double,passages:array<struct<first:int,last:int,score:double>>>"


def with_toxicity(docs: DataFrame, model: Model, into: str = "toxicity") -> DataFrame:
    """``docs`` with the score and the passages (character ranges of the lower-cased text); no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def judged(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        scores, least = Scores(m), math.log(1 / EXPECTED)
        for texts in parts:
            out, where = [], []
            for t in texts:
                n, found = passages(t, scores)
                z = min(evidence(n, found, m.lam, m.k), 60.0)
                out.append(1 / (1 + math.exp(-max(min(m.curve[0] + m.curve[1] * z, 500), -500))))
                where.append([{"first": a, "last": b, "score": s} for a, b, s in found
                              if m.lam * s - math.log(max(m.k * n, 1e-300)) >= least])
            yield pd.DataFrame({"score": out, "passages": where})

    return docs.withColumn(into, judged("text"))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_passages)."""
    judged = with_toxicity(docs.select("doc_id", "text"), fit(docs, labels))
    return judged.select("doc_id", (id_remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
                         F.col("toxicity.score").alias("score"),
                         (F.col("toxicity.score") >= threshold).cast("int").alias("predicted"),
                         F.size("toxicity.passages").alias("n_passages"))
