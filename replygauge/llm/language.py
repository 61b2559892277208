"""Language by sparse multinomial logistic regression on TF-IDF character n-grams.

Trained by follow-the-regularised-leader with an elastic-net penalty, which
leaves most weights at zero; a temperature fitted on texts kept aside turns the
scores into calibrated probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replygauge.llm.arrays import slices
from replygauge.llm.common import bounded_sample, remainder, remainder_of

BUCKETS = 1 << 16
SIZES = (1, 2, 3)
#: Term frequencies are shares of the text's n-grams, times this.
SCALE = 50.0
UNKNOWN = "und"

_LETTER = np.zeros(0x110000, bool)
for _at in range(0, 0x33000, 0x1000):
    _LETTER[_at : _at + 0x1000] = [chr(c).isalpha() for c in range(_at, _at + 0x1000)]


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams in order of their text, the bounds of each text's, and its number of letters.

    Letters count in lower case, anything else is one kind of gap. n-grams with a
    gap inside, or of gaps alone, are left out.
    """
    listed = [f" {(x or '').lower()} " for x in texts.to_pylist()]
    codes = np.frombuffer("".join(listed).encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in listed])])
    letter = _LETTER[codes]
    c = np.where(letter, codes, 0).astype(np.uint64)
    letters = np.add.reduceat(letter, bounds[:-1], dtype=np.int64) if len(listed) else np.zeros(0, np.int64)
    found, at = [], []
    for n in SIZES:
        h = np.full(len(c) - n + 1, n, np.uint64)
        keep = np.zeros(len(h), bool)
        for i in range(n):
            h = (h ^ c[i : len(h) + i]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            keep |= letter[i : len(h) + i]
        if n == 3:
            keep &= letter[1:-1]
        where = np.flatnonzero(keep)
        found.append((h[where] >> np.uint64(48)).astype(np.int64))
        at.append(where)
    order_bounds = [np.searchsorted(w, bounds) for w in at]
    pieces = [f[b[i] : b[i + 1]] for i in range(len(listed)) for f, b in zip(found, order_bounds, strict=True)]
    sizes = sum((np.diff(b) for b in order_bounds), np.zeros(len(listed), np.int64))
    return np.concatenate(pieces) if pieces else np.zeros(0, np.int64), np.concatenate([[0], np.cumsum(sizes)]), letters


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    #: One row per language.
    weight: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Scores of each text and language, and the number of letters of each text."""
        found, bounds, letters = grams(texts)
        sizes = np.diff(bounds)
        out = np.tile(self.bias, (len(sizes), 1))
        filled = np.flatnonzero(sizes)
        for k in range(len(self.languages)):
            if len(filled):
                sums = np.add.reduceat((self.idf * self.weight[k])[found], bounds[:-1][filled])
                out[filled, k] += SCALE * sums / sizes[filled]
        return out, letters


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def follow_the_leader(
    rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int,
    rate: float = 0.3, smooth: float = 1.0, l1: float = 0.02, l2: float = 0.01, rounds: int = 4,
) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal, one text at a time. rows: (buckets, values). Returns weights and constants."""
    z, n = np.zeros((classes, BUCKETS + 1)), np.zeros((classes, BUCKETS + 1))

    def weights(at: np.ndarray | slice) -> np.ndarray:
        zs, ns = z[:, at], n[:, at]
        return -np.sign(zs) * np.maximum(np.abs(zs) - l1, 0) / ((smooth + np.sqrt(ns)) / rate + l2)

    order = np.random.default_rng(3)
    for _ in range(rounds):
        for i in order.permutation(len(rows)):
            at = np.append(rows[i][0], BUCKETS)
            x = np.append(rows[i][1], 1.0)
            w = weights(at)
            p = softmax(w @ x)
            p[y[i]] -= 1
            g = p[:, None] * x
            z[:, at] += g - (np.sqrt(n[:, at] + g * g) - np.sqrt(n[:, at])) / rate * w
            n[:, at] += g * g
    w = weights(slice(None))
    return w[:, :-1], w[:, -1]


def temperature_of(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the scores that makes the labels likeliest."""
    if not len(y):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    loss = [-np.log(softmax(logits / t)[np.arange(len(y)), y] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, over all texts, and how many texts there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count, seen = np.zeros(BUCKETS, np.int64), 0, np.zeros(BUCKETS, bool)
        for batch in batches:
            for part in slices(batch, "text"):
                found, bounds, _ = grams(part["text"])
                count += part.num_rows
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    seen[found[a:b]] = True
                    total += seen
                    seen[:] = False
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], count))], ["bucket", "n"])

    frequencies, count = np.zeros(BUCKETS, np.int64), 0
    for r in texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        if r.bucket < 0:
            count = r.n
        else:
            frequencies[r.bucket] = r.n
    return frequencies, count


def train(docs: DataFrame, per_class: int = 1000) -> Model:
    """Fit on at most about ``per_class`` texts of each language; document frequencies count every training text.

    Only texts and non-null languages of rows whose crc32(doc_id) leaves a remainder
    other than 2 by 4 are used.
    """
    known = docs.where((remainder("doc_id", 4) != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    frequencies, count = document_frequencies(known.select("text"))
    idf = np.log((1 + count) / (1 + frequencies)) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found, bounds, _ = grams(part["text"])
                pairs = [np.unique(found[a:b], return_counts=True) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([
                    part["doc_id"].cast(pa.int64()), part["lang"],
                    pa.array([p[0].astype(np.int32).tobytes() for p in pairs], pa.binary()),
                    pa.array([p[1].astype(np.int32).tobytes() for p in pairs], pa.binary()),
                ], ["doc_id", "lang", "at", "n"])

    sample = bounded_sample(known.select("doc_id", "lang", "text"), "doc_id", "lang", per_class)
    rows = sorted(sample.mapInArrow(run, "doc_id long, lang string, at binary, n binary").collect(), key=lambda r: (r.doc_id, r.lang, r["at"], r["n"]))
    rows = [r for r in rows if r["at"]]
    languages = sorted({r.lang for r in rows})
    if not languages:
        return Model([], idf, np.zeros((0, BUCKETS)), np.zeros(0))
    x = []
    for r in rows:
        at, n = np.frombuffer(r["at"], np.int32), np.frombuffer(r["n"], np.int32)
        x.append((at, SCALE * n / n.sum() * idf[at]))
    y = np.array([languages.index(r.lang) for r in rows])
    aside = np.arange(len(rows)) % 5 == 4 if len(rows) >= 10 else np.zeros(len(rows), bool)
    weight, bias = follow_the_leader([v for v, a in zip(x, aside, strict=True) if not a], y[~aside], len(languages))
    logits = np.array([weight[:, at] @ v + bias for (at, v), a in zip(x, aside, strict=True) if a])
    return Model(languages, idf, weight, bias, temperature_of(logits, y[aside]))


def guess(model: Model, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """The likeliest language of each text and its calibrated probability."""
    logits, letters = model.logits(texts)
    known = (letters > 0) & bool(model.languages)
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    p = softmax(logits / model.temperature)
    names = [model.languages[k] if fine else UNKNOWN for k, fine in zip(p.argmax(1), known, strict=True)]
    return names, np.where(known, p.max(1), 0.0)


def predict_language(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row per row of ``docs``.

    ``und`` with score 0 for a null text, one without letters, or a model that
    learned from no text; a null id is never held out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                names, score = guess(shared.value, part["text"])
                held = [i is not None and remainder_of(i, 4) == 2 for i in part["doc_id"].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(held), pa.array(names, pa.string()), pa.array(score)],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a learned language with probability ``least`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield part.filter(pa.array(guess(shared.value, part["text"])[1] >= least))

    return docs.mapInArrow(run, docs.schema)
