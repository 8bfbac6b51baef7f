"""Quality grades by ordinal cumulative-link regression on hashed text.

A text becomes a vector of hashed features: its words (in lower case), the shapes of its
words (runs of lower case, capitals, digits and each kind of punctuation), pairs of
neighbouring shapes, and how often words repeat.  One weight vector w is shared by all grades; ordered thresholds
t_1 < t_2 < ... cut the scale: P(grade >= g_k) = sigmoid(w.x - t_k).  The expected grade
and the tail probability at a chosen grade follow for every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .hashing import lower_ascii, mix, pair, span_hashes, word_spans

#: Rated documents that the weights are fitted on (bounded): those with the least hashes, for each grade.
SAMPLE = 4000
#: Hashed features: of shapes, of pairs of shapes, of words; besides the few counted ones.
PARTS = (256, 256, 512)
HASHED, COUNTED = sum(PARTS), 8
#: Rounds and strength of the fit.
ROUNDS, RIDGE, RATE = 300, 1e-3, 0.05
#: A document is kept if the probability of the upper grade is at least this.
KEEP = 0.2

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[:32] = 4
_CLASS[97:123] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[128:] = 1  # letters of other scripts; their marks share the class


def vectors(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Features of each row (rows x HASHED + COUNTED); shares of its words, so length does not matter."""
    n = len(offsets) - 1
    out = np.zeros((n, HASHED + COUNTED), np.float32)
    starts, ends, first = word_spans(raw, offsets)
    words = np.diff(first)
    some = np.maximum(words, 1).astype(np.float64)
    out[:, HASHED] = words == 0
    if not len(starts):
        return out
    kind = _CLASS[raw]
    lead = np.zeros(len(raw), bool)
    lead[starts] = True
    lead[1:] |= kind[1:] != kind[:-1]
    runs = np.flatnonzero(lead)
    shape = span_hashes(kind[runs], np.searchsorted(runs, starts), np.searchsorted(runs, ends))
    row = np.repeat(np.arange(n), words)
    same = row[1:] == row[:-1]
    h = span_hashes(lower_ascii(raw), starts, ends)
    lo = 0
    for size, f, r in zip(PARTS, (shape, pair(shape[:-1], shape[1:])[same], mix(h)), (row, row[1:][same], row)):
        at = r * size + (f >> np.uint64(40)).astype(np.int64) % size
        out[:, lo : lo + size] = np.bincount(at, minlength=n * size).reshape(n, size) / some[:, None]
        lo += size
    out[:, :HASHED] = np.sqrt(out[:, :HASHED])
    h = span_hashes(raw, starts, ends)
    again = np.bincount(row[1:][same & (h[1:] == h[:-1])], minlength=n)
    order = np.lexsort((h, row))
    distinct = np.bincount(row[order][np.concatenate([[True], (h[order][1:] != h[order][:-1]) | (row[order][1:] != row[order][:-1])])], minlength=n)
    length = np.bincount(row, weights=(ends - starts), minlength=n)
    # distinct words fall behind in long texts; what counts is how far below the usual
    usual = np.minimum(1, 1.6 * some**-0.12)
    out[:, HASHED + 1] = again / some
    out[:, HASHED + 2] = np.maximum(0, usual - distinct / some)
    out[:, HASHED + 3] = np.minimum(length / some, 40) / 10
    out[:, HASHED + 4] = np.maximum(0, 5 - words) / 5
    total = np.maximum(np.diff(offsets), 1)
    cum = np.concatenate([[0], np.cumsum((kind >= 4) & (raw != 32))])
    out[:, HASHED + 5] = (cum[offsets[1:]] - cum[offsets[:-1]]) / total
    cum = np.concatenate([[0], np.cumsum(kind == 2)])
    out[:, HASHED + 6] = (cum[offsets[1:]] - cum[offsets[:-1]]) / total
    cum = np.concatenate([[0], np.cumsum(kind == 3)])
    out[:, HASHED + 7] = (cum[offsets[1:]] - cum[offsets[:-1]]) / total
    return out


@dataclass
class Model:
    grades: np.ndarray  # ascending ratings
    weights: np.ndarray
    thresholds: np.ndarray  # one less than the grades, ascending

    def tails(self, x: np.ndarray) -> np.ndarray:
        """P(rating >= grades[k + 1]) for each row and k."""
        return 1 / (1 + np.exp(-np.clip((x @ self.weights)[:, None] - self.thresholds, -50, 50)))

    def expected(self, x: np.ndarray) -> np.ndarray:
        return self.grades[0] + self.tails(x) @ np.diff(self.grades)


def fit_model(x: np.ndarray, rating: np.ndarray) -> Model:
    """Maximum likelihood of the cumulative-link model, slightly shrunk; grades weigh alike.

    Thresholds stay ordered as a first one plus positive steps.
    """
    grades, y = np.unique(rating.astype(float), return_inverse=True)
    k = len(grades) - 1
    if k < 1:
        return Model(grades if len(grades) else np.array([1.0]), np.zeros(x.shape[1]), np.zeros(0))
    weight = (len(y) / (len(grades) * np.bincount(y)))[y]
    weight = weight / weight.sum()
    scale = np.maximum(x.std(0), 1e-3)
    centre = x.mean(0)
    z = ((x - centre) / scale).astype(np.float32)
    share = np.array([(weight * (y > j)).sum() for j in range(k)])
    theta = -np.log(np.clip(share, 1e-3, 1 - 1e-3) / np.clip(1 - share, 1e-3, 1))
    steps = np.log(np.maximum(np.diff(theta), 1e-2))
    p = np.concatenate([np.zeros(z.shape[1]), theta[:1], steps])
    m, v = np.zeros(len(p)), np.zeros(len(p))
    d = z.shape[1]
    for i in range(1, ROUNDS + 1):
        theta = p[d] + np.concatenate([[0], np.cumsum(np.exp(p[d + 1 :]))])
        tail = 1 / (1 + np.exp(-np.clip((z @ p[:d].astype(np.float32))[:, None].astype(float) - theta, -30, 30)))
        full = np.concatenate([np.ones((len(z), 1)), tail, np.zeros((len(z), 1))], 1)
        rows = np.arange(len(z))
        chance = np.maximum(full[rows, y] - full[rows, y + 1], 1e-9)
        slope = tail * (1 - tail)
        upper = np.concatenate([np.zeros((len(z), 1)), slope, np.zeros((len(z), 1))], 1)
        toward = (upper[rows, y] - upper[rows, y + 1]) / chance * weight
        g_theta = np.zeros(k)
        for j in range(k):
            g_theta[j] = -(weight * ((y == j + 1) * slope[:, j] - (y == j) * slope[:, j]) / chance).sum()
        grad = np.concatenate([z.T @ toward.astype(np.float32) - RIDGE * p[:d], [g_theta.sum()], [g_theta[j + 1 :].sum() * np.exp(p[d + 1 + j]) for j in range(k - 1)]])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        p = p + RATE * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.999**i)) + 1e-8)
    theta = p[d] + np.concatenate([[0], np.cumsum(np.exp(p[d + 1 :]))])
    weights = p[:d] / scale
    return Model(grades, weights, theta + centre @ weights)


def fit(docs: DataFrame, ratings: DataFrame, rating: str = "quality") -> Model:
    """Learn from a bounded sample of rated documents; without ratings every text has the one grade.

    ``ratings`` has doc_id and a numeric rating; null ratings are left out, of several
    for one doc_id the least counts.  Over 100 different ratings are no grades: ValueError.
    Each grade's sample is SAMPLE rows, less where there are more than eight grades, so
    that what comes to the driver has one bound whatever their number.
    """
    rows = ratings.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(rating).cast("double").alias("rating")).where("doc_id is not null and rating is not null").groupBy("doc_id").agg(F.min("rating").alias("rating"))
    grades = [r["rating"] for r in rows.select("rating").distinct().orderBy("rating").limit(101).collect()]
    if not grades or len(grades) > 100:
        if grades:
            raise ValueError("ratings are not graded: over 100 different values")
        return Model(np.array([1.0]), np.zeros(HASHED + COUNTED), np.zeros(0))
    picked = None
    for g in grades:
        part = rows.where(F.col("rating") == g).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE * 8 // max(8, len(grades)))
        picked = part if picked is None else picked.unionAll(part)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, raw, offs in common.text_steps(batches):
            x = vectors(raw, offs)
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array([r.tobytes() for r in x], pa.binary())], ["rating", "x"])

    seen = text.join(F.broadcast(picked), "doc_id").select("doc_id", "rating", "text").mapInArrow(run, "rating double, x binary").toArrow()  # at most 8 * SAMPLE rows
    if not seen.num_rows:
        return Model(np.array([max(grades)]), np.zeros(HASHED + COUNTED), np.zeros(0))
    x = np.frombuffer(b"".join(seen["x"].to_pylist()), np.float32).reshape(seen.num_rows, -1)
    return fit_model(x, seen["rating"].to_numpy())


def grade(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, expected_grade, p_upper (probability of the highest grade) of every whole text; no shuffle.

    Null text counts as empty; repeated rows each give a row, an empty table none; other
    columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b, raw, offs in common.text_steps(batches):
            x = vectors(raw, offs).astype(np.float64)
            tails = m.tails(x)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(m.expected(x)), pa.array(tails[:, -1] if tails.shape[1] else np.ones(len(x)))], ["doc_id", "expected_grade", "p_upper"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "doc_id long, expected_grade double, p_upper double")


def select(docs: DataFrame, model: Model, keep: float = KEEP) -> DataFrame:
    """Rows of ``docs``, unchanged, whose p_upper is at least ``keep``.

    Null text counts as empty; repeated rows are each judged, an empty table gives none;
    columns keep their names, whatever they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(steps: Iterator) -> Iterator[np.ndarray]:
        for _, raw, offs in steps:
            tails = shared.value.tails(vectors(raw, offs).astype(np.float64))
            yield tails[:, -1] >= keep if tails.shape[1] else np.ones(len(offs) - 1, bool)

    return common.filter_by_text(docs, judge)
