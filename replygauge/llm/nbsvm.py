"""Quality by naive Bayes support vectors.

n-gram indicators of words, of word shapes and of repeated words are scaled by
the log-count ratio of the classes; a linear model with hinge loss is fitted to
them by dual coordinate descent, and its margin is mapped to a probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replygauge.llm.arrays import SPACE, mix, ngrams, slices, span_hashes, text_bytes
from replygauge.llm.common import bounded_sample, remainder, remainder_of

BUCKETS = 1 << 18

# Kinds of bytes: 0 white space, 1 part of a word, 2 a sign.
_KIND = np.full(256, 2, np.uint8)
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[SPACE] = 0
# For shapes, letters and digits become one stand-in each; signs stay.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[65:91] = 65
_SHAPE[97:123] = 97
_SHAPE[128:] = 97
_SHAPE[48:58] = 48


def features(texts: pa.Array) -> Iterator[np.ndarray]:
    """The distinct n-gram buckets of each text, in ascending order."""
    data, bounds = text_bytes(texts)
    kind = _KIND[data]
    new = np.ones(len(data), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[bounds[:-1][bounds[:-1] < len(data)]] = True
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(data))
    real = kind[starts] != 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[real], ends[real]
    word = span_hashes(data, starts, ends)
    # a shape is the first three bytes' shape and how long the token is, in doublings
    cut = np.minimum(ends, starts + 3)
    shape = span_hashes(_SHAPE[data], starts, cut) + np.log2(np.maximum(ends - starts, 1)).astype(np.uint64)
    again = np.zeros(len(word), bool)
    again[1:] = word[1:] == word[:-1]
    again[2:] |= word[2:] == word[:-2]
    shape = mix(shape + again.astype(np.uint64) * np.uint64(977))
    bound = np.searchsorted(starts, bounds)
    one = (word >> np.uint64(46)).astype(np.int64)
    two = (ngrams(word, 2) >> np.uint64(46)).astype(np.int64)
    three = (ngrams(shape, 3) >> np.uint64(46)).astype(np.int64)
    seen = np.zeros(BUCKETS, bool)
    for a, b in zip(bound[:-1].tolist(), bound[1:].tolist(), strict=True):
        seen[one[a:b]] = True
        seen[two[a : max(a, b - 1)]] = True
        seen[three[a : max(a, b - 2)]] = True
        found = np.flatnonzero(seen)
        seen[found] = False
        yield found


@dataclass
class Model:
    ratio: np.ndarray
    weight: np.ndarray
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, found: np.ndarray) -> float:
        r = self.ratio[found]
        return float(r @ self.weight[found]) / (math.sqrt(float(r @ r)) or 1.0) + self.bias

    def probability(self, margin: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * margin + self.shift))))


def hinge_fit(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: float = 1.0, rounds: int = 12) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the linear L1-loss support vector machine, with a constant feature."""
    weight, bias = np.zeros(len(ratio)), 0.0
    values = []
    for found in rows:
        r = ratio[found]
        values.append(r / (np.sqrt(r @ r) or 1.0))
    alpha = np.zeros(len(rows))
    square = np.array([v @ v + 1.0 for v in values])
    order = np.random.default_rng(5)
    for _ in range(rounds):
        for i in order.permutation(len(rows)):
            gradient = y[i] * (values[i] @ weight[rows[i]] + bias) - 1
            to = min(max(alpha[i] - gradient / square[i], 0.0), cost)
            if to != alpha[i]:
                change = (to - alpha[i]) * y[i]
                weight[rows[i]] += change * values[i]
                bias += change
                alpha[i] = to
    return weight, bias


def platt(margins: np.ndarray, y: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through (margin, label)."""
    b = np.array([2.0, 0.0])
    x = np.column_stack([margins, np.ones(len(margins))])
    for _ in range(25 if len(y) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        grad = x.T @ (weights * (y - p)) - 0.01 * (b - [2.0, 0.0])
        curve = (x * (weights * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2)
        b = b + np.clip(np.linalg.solve(curve, grad), -1, 1)
    return float(b[0]), float(b[1])


def fit(rows: list[np.ndarray], y: np.ndarray, class_rows: tuple[int, int]) -> Model:
    """y: 0 or 1. A fifth of the rows only serves the map to a probability; class_rows: labelled rows of class 0 and 1."""
    held = np.arange(len(rows)) % 5 == 4
    counts = np.ones((2, BUCKETS))
    for found, label, out in zip(rows, y, held, strict=True):
        if not out:
            counts[label, found] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    model = Model(ratio, np.zeros(BUCKETS))
    if len(set(y[~held])) == 2:
        train = [r for r, out in zip(rows, held, strict=True) if not out]
        model.weight, model.bias = hinge_fit(train, 2.0 * y[~held] - 1, ratio)
    margins = np.array([model.margin(r) for r, out in zip(rows, held, strict=True) if out])
    labels = y[held]
    share = np.array([class_rows[k] / max(1, (y == k).sum()) for k in (0, 1)])
    weights = share[labels] / (share[labels].mean() or 1.0) if len(labels) else np.ones(0)
    model.slope, model.shift = platt(margins, labels, weights)
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = 2500) -> Model:
    """Fit on at most about ``per_class`` labelled texts of each class.

    Only rows whose crc32(doc_id) leaves a remainder other than 2 by 4 are used;
    of a doc_id labelled twice the larger label counts.
    """
    known = (
        labels.select("doc_id", F.col(label).cast("int").alias("y")).where(F.col("y").isin(0, 1))
        .groupBy("doc_id").agg(F.max("y").alias("y")).where(remainder("doc_id", 4) != 2)
    )
    # its size is bounded by per_class, so the texts need not be shuffled to meet it
    picked = F.broadcast(bounded_sample(known, "doc_id", "y", per_class))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [x.astype(np.int32).tobytes() for x in features(part["text"])]
                yield pa.RecordBatch.from_arrays([part["doc_id"].cast(pa.int64()), part["y"].cast(pa.int32()), pa.array(found, pa.binary())], ["doc_id", "y", "found"])

    sample = docs.select("doc_id", "text").join(picked, "doc_id").mapInArrow(run, "doc_id long, y int, found binary")
    rows = sorted(sample.collect(), key=lambda r: r.doc_id)
    share = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    return fit([np.frombuffer(r.found, np.int32) for r in rows], np.array([r.y for r in rows], np.int64), (share.get(0, 0), share.get(1, 0)))


def score_quality(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``docs``.

    Null and empty texts have no n-gram and get the score of the constant alone; a
    null id is never held out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                score = np.array([m.probability(m.margin(x)) for x in features(part["text"])])
                yield pa.RecordBatch.from_arrays([
                    part["doc_id"], pa.array([i is not None and remainder_of(i, 4) == 2 for i in part["doc_id"].to_pylist()]),
                    pa.array(score), pa.array((score >= threshold).astype(np.int32)),
                ], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
