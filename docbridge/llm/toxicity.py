"""Toxicity by maximum-scoring segments.

Tokens carry posterior log-odds of toxic against clean documents under a Dirichlet prior
whose pseudo-counts follow the corpus frequencies, less one deviation; other tokens cost
a little.  The least weight that counts is the one that predicts documents best whose own
label is left out, so it is not harsher where labels are few or a language is rare.  A linear scan finds
the passages that no extension or cut improves; how unlikely the best score is in a
clean text of that length follows an extreme-value (Gumbel) law, fitted to the best
scores of clean documents.  Each passage's score is measured by that law; a document's
evidence is that of its best passage and of every further one beyond what chance shows,
and a logistic link turns it into the probability of the label.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .hashing import eights, lower_ascii, mix, span_hashes, spans_of

#: Letters are A-Z, a-z and all bytes of other scripts.
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True
#: Labelled documents that the model learns from, those with the least hashes, by class.
TOXIC_SAMPLE, CLEAN_SAMPLE = 6000, 12000
#: Pseudo-documents of the prior for each labelled one, deviations taken off the log-odds, least documents, cap, cost of other tokens.
PRIOR, DEVIATIONS, LEAST_DOCS, CAP, COST = 0.2, 1.0, 3, 6.0, 0.15
#: Least weights to choose from.
LEVELS = (1.0, 1.5, 2.0, 2.5, 3.0)
#: A word also stands for its beginnings of so many bytes.
STEMS = (4, 5, 6)
#: Least probability of no chance passage for one to be listed.
SIGNIFICANT = 0.01
FOLDS = 5


def fold(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 5; fold 0 is held out.  A null doc_id is in no fold."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features (hashes) x tokens, 0 for none; starts, ends; and each row's first token (n+1 values)."""
    raw = lower_ascii(raw)
    starts, ends, first = spans_of(LETTER[raw], offsets)
    rows = [span_hashes(raw, starts, ends)]
    begin = eights(raw)[starts] if len(starts) else np.zeros(0, np.uint64)
    for k in STEMS:
        stem = mix((begin & np.uint64((1 << 8 * k) - 1)) ^ np.uint64(k << 56))
        rows.append(np.where(ends - starts >= k, stem, np.uint64(0)))
    return np.stack(rows), starts, ends, first


def weights(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Log-odds, less their deviation, of features found in so many of the documents; 0 where too few are toxic.

    A feature's pseudo-count is PRIOR times the documents that it is found in, so that
    its weight depends on its own counts and the ratio of the classes alone.
    """
    few = (toxic < LEAST_DOCS) | (n_toxic < 1) | (n_clean < 1)
    toxic = np.maximum(toxic, LEAST_DOCS)
    own, all_ = PRIOR * (toxic + clean), PRIOR * (n_toxic + n_clean)
    a, b = toxic + own, clean + own
    odds = np.log(a / np.maximum(n_toxic + all_ - a, PRIOR)) - np.log(b / np.maximum(n_clean + all_ - b, PRIOR))
    return np.where(few, 0.0, np.minimum(odds - DEVIATIONS * np.sqrt(1 / a + 1 / b), CAP))


@dataclass
class Model:
    features: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # sorted
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    rate: float = 1.0  # of the Gumbel law
    volume: float = 1.0
    slope: float = 0.0  # of the logistic link
    offset: float = -5.0

    def __post_init__(self) -> None:
        self._maybe = np.zeros(1 << 16, bool)
        self._maybe[(self.features >> np.uint64(48)).astype(np.int64)] = True

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Score of each token: its best feature's weight, or the cost of any other token."""
        out = np.full(rows.shape[1], -COST)
        if len(self.features):
            for h in rows:
                some = np.flatnonzero(self._maybe[(h >> np.uint64(48)).astype(np.int64)])
                at = np.minimum(np.searchsorted(self.features, h[some]), len(self.features) - 1)
                hit = self.features[at] == h[some]
                some, at = some[hit], at[hit]
                out[some] = np.maximum(out[some], self.weights[at])
        return out

    def surprise(self, best: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Gumbel variate: how far the best segment exceeds what a clean text of that length shows."""
        return self.rate * best - np.log(self.volume * np.maximum(length, 1))

    def chance(self, best: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Probability of such a segment in a clean text."""
        return -np.expm1(-np.exp(-np.clip(self.surprise(best, length), -30, 700)))

    def evidence(self, best: np.ndarray, row: np.ndarray, value: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Surprise of each row's best passage, and of its other passages (``row``, ``value``: all of them) where positive."""
        own = self.surprise(best, length)
        beyond = np.bincount(row, weights=np.maximum(self.surprise(value, length[row]), 0), minlength=len(best))
        return own + beyond - np.where(best > 0, np.maximum(own, 0), 0)

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * evidence + self.offset, -500, 500)))

    def judge(self, h: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Probability of each row from its tokens' features."""
        best, row, value = passages(h, self.scores(h), first)
        return self.probability(self.evidence(best, row, value, np.diff(first)))


def best_segments(s: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Greatest sum of consecutive scores in each row, 0 if none is positive."""
    n = len(first) - 1
    out = np.zeros(n)
    if not len(s):
        return out
    total = np.concatenate([[0.0], np.cumsum(s)])
    row = np.repeat(np.arange(n), np.diff(first))
    drop = row * (np.abs(total).max() * 2 + 1)  # a row's start lies below all of the row before
    low = np.minimum.accumulate(total[:-1] - drop) + drop
    np.maximum.at(out, row, total[1:] - low)
    return np.where(out > 1e-9, out, 0.0)


def segments(s: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end, score) of one row, in linear time.

    Candidates wait on a stack; each knows the sum left of its start and at its end.  A
    new one joins those back to the last that starts lower, as long as that ends lower too.
    """
    out: list[list[float]] = []  # start, end, sum before start, sum at end, place of the last lower start
    for i in np.flatnonzero(s > 0).tolist() if len(s) else []:
        before = float(s[:i].sum()) if not out else out[-1][3] + float(s[int(out[-1][1]) : i].sum())
        item = [i, i + 1, before, before + float(s[i]), -1]
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][2] >= item[2]:
                j = int(out[j][4])
            if j < 0 or out[j][3] >= item[3]:
                item[4] = j
                out.append(item)
                break
            item = [out[j][0], item[1], out[j][2], item[3], -1]
            del out[j:]
    return [(int(a), int(b), y - x) for a, b, x, y, _ in out]


def passages(h: np.ndarray, s: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's best segment; row and score of all maximal segments.

    A token that only repeats the one before it is no further evidence.
    """
    if s.size:
        again = np.flatnonzero(h[0][1:] == h[0][:-1]) + 1
        again = again[~np.isin(again, first)]
        s[again] = np.minimum(s[again], -COST)
    best = best_segments(s, first)
    row, value = [], []
    for i in np.flatnonzero(best > 0).tolist():
        found = [v for _, _, v in segments(s[first[i] : first[i + 1]])]
        row += [i] * len(found)
        value += found
    return best, np.array(row, np.int64), np.array(value, float)


def sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """Labelled documents outside fold 0 (doc_id, toxic, text), bounded by class, and the class sizes."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)").where(fold(F.col("doc_id")) != 0)
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    picked = None
    for toxic, most in ((1, TOXIC_SAMPLE), (0, CLEAN_SAMPLE)):
        part = rows.where(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        picked = part if picked is None else picked.unionAll(part)
    picked = F.broadcast(picked)  # at most TOXIC_SAMPLE + CLEAN_SAMPLE rows
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return text.join(picked, "doc_id").select("doc_id", "toxic", "text"), sizes


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn the model from the bounded sample; without toxic or clean rows it scores all texts alike.

    Labels other than 0 and 1, null doc_ids and labels of absent documents are left out;
    of several labels of one doc_id the greatest counts; a labelled document that stands
    in several rows counts with each.  Null text counts as empty.
    """
    rows, sizes = sample(docs, labels)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list[np.ndarray]] = {0: [], 1: []}
        docs_ = [0, 0]
        for b, raw, offs in common.text_steps(batches):
            h, _, _, first = tokens(raw, offs)
            for i, toxic in enumerate(b.column(1).to_pylist()):
                seen[toxic].append(np.unique(h[:, first[i] : first[i + 1]]))
                docs_[toxic] += 1
        for toxic in (0, 1):
            if docs_[toxic]:
                f, n = np.unique(np.concatenate([*seen[toxic], np.zeros(docs_[toxic], np.uint64)]), return_counts=True)
                if f[0] == 0:
                    n[0] = docs_[toxic]  # feature 0 counts the documents
                for lo in range(0, len(f), 1 << 16):
                    part = slice(lo, lo + (1 << 16))
                    zero = np.zeros(len(f[part]), np.int64)
                    both = (zero, n[part]) if toxic else (n[part], zero)
                    yield pa.RecordBatch.from_arrays([pa.array(f[part].view(np.int64)), pa.array(both[0]), pa.array(both[1])], ["feature", "clean", "toxic"])

    counts = common.checkpoint(rows.mapInArrow(count, "feature long, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where((F.col("toxic") >= LEAST_DOCS) | (F.col("feature") == 0)))
    n = counts.where("feature = 0").first()
    if n is None or not n["clean"] or not n["toxic"]:
        share = 0.9995 if n is not None and n["toxic"] else 0.0005
        return Model(offset=float(np.log(share / (1 - share))))

    def versions(toxic: np.ndarray, clean: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Weights as a document outside the sample, a clean and a toxic one of it see them: without its own label."""
        all_ = n["toxic"], n["clean"]
        return weights(toxic, clean, *all_), weights(toxic, np.maximum(clean - 1, 0), all_[0], all_[1] - 1), weights(toxic - 1, clean, all_[0] - 1, all_[1])

    def weighty(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(np.max(versions(b.column(2).to_numpy(), b.column(1).to_numpy()), axis=0) > LEVELS[0]))

    # bounded: features in LEAST_DOCS of at most TOXIC_SAMPLE documents, and weighty
    found = counts.where("feature <> 0").mapInArrow(weighty, counts.schema).toPandas()
    f = found["feature"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(f)
    seen_by = [w[order] for w in versions(found["toxic"].to_numpy(np.int64), found["clean"].to_numpy(np.int64))]
    shared = docs.sparkSession.sparkContext.broadcast([[_model(f[order], w, level) for w in seen_by] for level in LEVELS])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for b, raw, offs in common.text_steps(batches):
            h, _, _, first = tokens(raw, offs)
            toxic = np.repeat(b.column(1).to_numpy(), np.diff(first)) == 1
            for level, (_, without_clean, without_toxic) in enumerate(models):
                s = np.where(toxic, without_toxic.scores(h), without_clean.scores(h))
                mass = [float(np.exp(np.minimum(s[x:y], CAP)).sum()) for x, y in zip(first[:-1], first[1:])]
                top, row, value = passages(h, s, first)
                each = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(offs))).astype(np.int32)), pa.array(value))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(offs) - 1, level, np.int32)), b.column(1), pa.array(top), each, pa.array(np.diff(first).astype(np.float64)), pa.array(mass)], ["level", "toxic", "best", "each", "length", "mass"])

    seen = rows.mapInArrow(best, "level int, toxic int, best double, each array<double>, length double, mass double").toPandas()  # a row for each sampled document and level
    fitted = [_laws(shared.value[k][0], seen[seen["level"] == k], sizes) for k in range(len(LEVELS))]
    return min(fitted, key=lambda x: x[0])[1]


def _model(features: np.ndarray, w: np.ndarray, level: float) -> Model:
    some = w > level
    return Model(features[some], w[some])


def _laws(model: Model, seen: pd.DataFrame, sizes: dict[int, int]) -> tuple[float, Model]:
    """Fit the Gumbel law and the logistic link to the sample; its weighted log loss, and the model."""
    clean = seen[seen["toxic"] == 0]
    mass = float((clean["mass"].sum() + 1) / (clean["length"].sum() + 1))
    # the rate at which chance scores fall off: E[exp(rate * score)] = 1, with two kinds of tokens
    share = min(max((mass - np.exp(-COST)) / (np.exp(CAP) - np.exp(-COST)), 1e-9), 0.02)
    low_, high = 1e-3, 20.0
    for _ in range(60):
        mid = (low_ + high) / 2
        if share * np.exp(mid * CAP) + (1 - share) * np.exp(-mid * COST) < 1:
            low_ = mid
        else:
            high = mid
    model.rate = low_
    gumbel = model.rate * clean["best"].to_numpy() - np.log(np.maximum(clean["length"].to_numpy(), 1))
    model.volume = float(np.exp(np.clip(gumbel.mean() - np.euler_gamma, -30, 30)))
    best, length = seen["best"].to_numpy(), seen["length"].to_numpy()
    y = seen["toxic"].to_numpy(float)
    held = {t: max(1, int((y == t).sum())) for t in (0, 1)}
    weight = np.where(y == 1, sizes.get(1, 1) / held[1], sizes.get(0, 1) / held[0])
    weight = weight / weight.mean()
    row = np.repeat(np.arange(len(seen)), seen["each"].map(len).to_numpy(np.int64))
    value = np.concatenate([*seen["each"], np.zeros(0)]).astype(float)
    x = model.evidence(best, row, value, length)
    model.slope, model.offset = _logistic(x, y, weight)
    p = np.clip(model.probability(x), 1e-6, 1 - 1e-6)
    return float(-(weight * np.where(y == 1, np.log(p), np.log(1 - p))).mean()), model


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and offset of the weighted logistic fit, slightly shrunk."""
    scale = max(float(x.std()), 1e-9)
    z = np.stack([(x - x.mean()) / scale, np.ones(len(x))], 1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        grad = z.T @ (w * (y - p)) - [0.1 * beta[0], 0.001 * beta[1]]
        hess = (z * (w * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + np.diag([0.1, 0.001])
        beta = beta + np.clip(np.linalg.solve(hess, grad), -2, 2)
    slope = max(beta[0], 0.0) / scale
    return slope, beta[1] - slope * float(x.mean())


SCORED = "doc_id long, score double, passages array<struct<start:int,end:int,score:double>>"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and significant passages (byte offsets) of every whole text; no shuffle.

    Null text counts as empty: the score of no evidence.  Repeated rows each give a row,
    an empty table none; other columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded, see fit()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b, raw, offs in common.text_steps(batches):
            h, starts, ends, first = tokens(raw, offs)
            s = m.scores(h)
            (best, row, value), length = passages(h, s, first), np.diff(first)
            listed: list[list[dict]] = [[] for _ in best]
            for i in np.flatnonzero((best > 0) & (m.chance(best, length) < SIGNIFICANT)).tolist():
                a, z = int(first[i]), int(first[i + 1])
                for x, y, v in segments(s[a:z]):
                    if m.chance(np.array(v), length[i]) < SIGNIFICANT:
                        listed[i].append({"start": int(starts[a + x] - offs[i]), "end": int(ends[a + y - 1] - offs[i]), "score": v})
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(m.probability(m.evidence(best, row, value, length))), pa.array(listed, kind)], ["doc_id", "score", "passages"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, SCORED)


def select(docs: DataFrame, model: Model, most: float = 0.5) -> DataFrame:
    """Rows of ``docs``, unchanged, whose score is below ``most``.

    Null text counts as empty; repeated rows are each judged, an empty table gives none;
    columns keep their names, whatever they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(steps: Iterator) -> Iterator[np.ndarray]:
        m = shared.value
        for _, raw, offs in steps:
            h, _, _, first = tokens(raw, offs)
            yield m.judge(h, first) < most

    return common.filter_by_text(docs, judge)
