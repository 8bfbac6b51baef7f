"""Order-independent document fingerprints: a homomorphic multiset hash.

A document is the multiset of its paragraphs (lines that hold more than white space).
Each paragraph has a wide vector of lanes; a document's fingerprint is the sum of its
paragraphs' vectors lane by lane, modulo 2**16 in the identity lanes and 2**32 in the others.  Adding or removing a paragraph
adds or subtracts its vector (``combine``, ``remove``), and order does not matter.

The vector has two parts.  The identity lanes are a cryptographic hash of the
paragraph, so that equal sums mean equal multisets.  The likeness lanes place each
window of WINDOW bytes of the paragraph, numbered where the paragraph repeats it, as +1
or -1 in one lane, both picked by a hash: a paragraph's vector depends on the paragraph
alone.  Products of such vectors estimate how many numbered windows two paragraphs
share, and ``likeness`` turns the products of sums into a share from 0 to 1.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .hashing import WHITE, eights, mix, pair, span_hashes

IDENTITY_LANES, LIKENESS_LANES, WINDOW = 32, 256, 12
LANES = IDENTITY_LANES + LIKENESS_LANES


def _paragraphs(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each paragraph."""
    n = len(raw)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    line = raw == 10
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    edge[1:] |= line
    edge[:n] |= line  # the break itself is a span of its own
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[:-1], cuts[1:]
    solid = np.concatenate([[0], np.cumsum(~WHITE[raw])])
    keep = solid[ends] > solid[starts]
    starts, ends = starts[keep], ends[keep]
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def vectors(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Fingerprints (rows x LANES, uint32) of texts given as bytes and offsets."""
    rows = len(offsets) - 1
    out = np.zeros((rows, LANES), np.uint32)
    starts, ends, own = _paragraphs(raw, offsets)
    if not len(starts):
        return out
    whole = raw.tobytes()
    digests = b"".join([hashlib.blake2b(whole[a:b], digest_size=2 * IDENTITY_LANES).digest() for a, b in zip(starts.tolist(), ends.tolist())])
    wide = np.frombuffer(digests, "<u2").reshape(-1, IDENTITY_LANES)
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    out[own[first], :IDENTITY_LANES] = np.add.reduceat(wide, first, axis=0, dtype=np.uint16)
    seg, lane, sign = _windows(raw, starts, ends)
    total = np.bincount(own[seg] * LIKENESS_LANES + lane, weights=sign, minlength=rows * LIKENESS_LANES)
    out[:, IDENTITY_LANES:] = total.astype(np.int64).reshape(rows, LIKENESS_LANES).astype(np.uint32)
    return out


def _windows(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Paragraph, lane and sign of each window; a paragraph shorter than a window is one."""
    count = np.maximum(ends - starts - WINDOW + 1, 1)
    seg, place = common.within(count)
    at = starts[seg] + place
    half = eights(raw)
    h = pair(half[at], half[np.minimum(at + WINDOW - 8, len(raw) - 1)])
    short = np.flatnonzero(ends - starts < WINDOW)
    edge = np.concatenate([[0], np.cumsum(count)])
    h[edge[short]] = span_hashes(raw, starts[short], ends[short])
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        h[a:b].sort()  # order within a paragraph does not matter; equal windows meet
    fresh = np.concatenate([[True], h[1:] != h[:-1]])
    fresh[edge[:-1]] = True
    again = np.flatnonzero(~fresh)
    number = again - np.flatnonzero(fresh)[np.cumsum(fresh)[again] - 1]
    h[again] = pair(h[again], number.astype(np.uint64))
    h = mix(h)
    return seg, (h >> np.uint64(56)).astype(np.int64) % LIKENESS_LANES, ((h >> np.uint64(20)) & np.uint64(1)).astype(np.float64) * 2 - 1


def of_texts(texts: list[str]) -> np.ndarray:
    data = [t.encode() for t in texts]
    return vectors(np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64))


def _wrap(v: np.ndarray) -> np.ndarray:
    v[..., :IDENTITY_LANES] &= np.uint32(0xFFFF)
    return v


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Fingerprint of two documents put together."""
    return _wrap(a + b)


def remove(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Fingerprint of ``a`` without the paragraphs of ``b``."""
    return _wrap(a - b)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated likeness of each pair of rows, from 0 to 1; 1 for equal fingerprints.

    With A and B the counts of numbered windows of the two documents (a window counts
    twice only where its paragraph stands twice) it estimates 2 A.B / (A.A + B.B): where
    no paragraph is repeated, the share of common windows.  With 256 lanes the estimate
    strays by about 0.06.
    """
    x, y = (v[:, IDENTITY_LANES:].view(np.int32).astype(np.float64) for v in (np.ascontiguousarray(a), np.ascontiguousarray(b)))
    size = (x * x).sum(1) + (y * y).sum(1)
    share = np.clip(2 * (x * y).sum(1) / np.maximum(size, 1e-9), 0.0, 1.0)
    return np.where((a == b).all(1), 1.0, np.where(size > 0, share, 0.0))


def to_text(v: np.ndarray) -> list[str]:
    return [base64.b64encode(row[:IDENTITY_LANES].astype("<u2").tobytes() + row[IDENTITY_LANES:].astype("<u4").tobytes()).decode() for row in v]


def from_text(s: str) -> np.ndarray:
    data = base64.b64decode(s)
    return np.concatenate([np.frombuffer(data, "<u2", IDENTITY_LANES), np.frombuffer(data, "<u4", offset=2 * IDENTITY_LANES)]).astype(np.uint32)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint of every whole text, however long; no shuffle.

    Null text counts as empty; equal texts have equal fingerprints.  Repeated rows each
    give a row, an empty table none; other columns are not looked at, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, offs in common.text_steps(batches):
            yield pa.RecordBatch.from_arrays([rows.column(0).cast(pa.int64()), common.strings(to_text(vectors(raw, offs)))], ["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fingerprint string")


_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


class _Ranges:
    """Ranges of (doc_id, hash), each named by what it starts with."""

    def __init__(self, starts: list[tuple[int, int]]):
        self.k, self.h = (np.array(x, np.int64) for x in zip(*starts))
        self.several = np.unique(self.k[1:][self.k[1:] == self.k[:-1]])

    def of(self, k: np.ndarray, h: np.ndarray) -> np.ndarray:
        """The range of each row: the last that starts at or before it."""
        part = np.searchsorted(self.k, k, "right") - 1
        first = np.searchsorted(self.k, k, "left")
        one = np.flatnonzero((part == first) & (self.k[part] == k) & (self.h[part] > h))
        part[one] -= 1
        for x in np.intersect1d(self.several, k):
            rows = np.flatnonzero(k == x)
            lo = first[rows[0]]
            part[rows] = lo + np.searchsorted(self.h[lo : part[rows[0]] + 1], h[rows], "right") - 1
        return part


EDITED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def against_edits(docs: DataFrame, bytes_per_part: int = 8 << 20) -> DataFrame:
    """Each text, and its edit with the start of the next document, fingerprinted and compared.

    Next means next in the order of doc_id, null first, and of the text's hash among
    equal doc_ids; after the last comes the first.  Documents are dealt once to ranges
    of that order, of about ``bytes_per_part`` (more on inputs beyond 64 GB, as its
    square root); a doc_id with more text than that has several.  A range is named by
    what it starts with, which also goes to the range before as the one look-ahead that
    it needs.  Null text counts as empty; texts are whole, however long; repeated rows
    each give a row; a single document is its own next; an empty table gives no rows;
    other columns are not looked at, whatever their names.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST))
    t = F.coalesce("text", F.lit(""))
    keys = docs.select(key.alias("k"), F.xxhash64(t).alias("h"), F.octet_length(t).cast("long").alias("b"))
    size = keys.agg(F.sum("b").alias("b"), F.min("k").alias("lo")).first()
    if size["lo"] is None:
        return spark.createDataFrame([], EDITED)
    own = int(bytes_per_part * max(1.0, (size["b"] / (1 << 36)) ** 0.5))
    parts = size["b"] // own + 1
    # a few numbers for each range: where it is to start, then what it is found to start with
    cuts = keys.select(F.col("k").cast("double").alias("k")).approxQuantile("k", [i / parts for i in range(1, parts)], 0.2 / parts) if parts > 1 else []
    wanted = {(size["lo"], _LEAST), *((int(c), _LEAST) for c in cuts if c > size["lo"])}
    for r in keys.groupBy("k").agg(F.sum("b").alias("b")).where(F.col("b") > own).toLocalIterator():  # fewer than ``parts`` rows
        n = r["b"] // own + 1
        wanted |= {(r["k"], _LEAST + i * (1 << 64) // n) for i in range(n)}
    rough = _Ranges(sorted(wanted))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[int, tuple[int, int]] = {}
        for b in batches:
            k, h = (b.column(i).to_numpy() for i in (0, 1))
            order = np.lexsort((h, k))
            part, at = np.unique(rough.of(k[order], h[order]), return_index=True)
            for p, i in zip(part.tolist(), order[at].tolist()):
                least[p] = min(least.get(p, (_MOST, _MOST)), (int(k[i]), int(h[i])))
        yield pa.RecordBatch.from_arrays([pa.array(list(least), pa.int32()), pa.array([x for x, _ in least.values()], pa.int64()), pa.array([x for _, x in least.values()], pa.int64())], ["part", "k", "h"])

    found = keys.select("k", "h").mapInArrow(first, "part int, k long, h long").groupBy("part").agg(F.min(F.struct("k", "h")).alias("s")).select("s.k", "s.h").collect()
    ranges = _Ranges(sorted((r["k"], r["h"]) for r in found))
    n = len(ranges.k)

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k, h = (b.column(i).to_numpy() for i in (0, 1))
            part = ranges.of(k, h)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(part.astype(np.int32)), pa.array(np.zeros(len(k), bool))], names)
            leads = np.flatnonzero((ranges.k[part] == k) & (ranges.h[part] == h))
            if len(leads):
                leads = leads[np.unique(part[leads], return_index=True)[1]]  # one row that starts a range is enough
                more = b.take(pa.array(leads))
                yield pa.RecordBatch.from_arrays([*more.columns, pa.array(((part[leads] - 1) % n).astype(np.int32)), pa.array(np.ones(len(leads), bool))], names)

    names = ["k", "h", "doc_id", "text", "part", "ahead"]

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # (part, doc_id, text, ahead)
        weight = 0

        def out(rows: list[tuple], after: list[str]) -> pa.RecordBatch:
            texts = [r[2] for r in rows]
            edited = [x[: len(x) - len(x) // 2] + y[: len(x) // 2] for x, y in zip(texts, after)]
            v, e, w = of_texts(texts), of_texts(edited), of_texts(after[-1:])
            following = np.concatenate([v[1:], w])
            skips = [i for i in range(len(rows) - 1) if after[i] is not texts[i + 1]]
            if skips:
                following[skips] = of_texts([after[i] for i in skips])
            return pa.RecordBatch.from_arrays(
                [pa.array([r[1] for r in rows], pa.int64()), pa.array([len(x) for x in texts], pa.int64()), common.strings([hashlib.sha256(x.encode()).hexdigest() for x in edited]), common.strings(to_text(v)), common.strings(to_text(e)), pa.array(likeness(v, e)), pa.array(likeness(v, following))],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

        def flush(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, weight
            rows, after = [], []
            keep: list[tuple] = []
            for i, r in enumerate(held):
                if r[3]:
                    continue
                nxt = held[i + 1] if i + 1 < len(held) else None
                if nxt is None and not final:
                    keep = [r]
                    break
                rows.append(r)
                after.append(nxt[2] if nxt is not None and nxt[0] == r[0] else r[2])
            # of look-ahead rows only those that follow a kept row matter
            held, weight = keep, sum(len(r[2]) for r in keep)
            if rows:
                yield out(rows, after)

        for b in batches:
            for part, doc, text, ahead in zip(*(b.column(i).to_pylist() for i in (4, 2, 3, 5))):
                if ahead and held and held[-1][3] and held[-1][0] == part:
                    continue  # only the first look-ahead of a range counts
                held.append((part, doc, text, ahead))
                weight += len(text)
                if weight > common.STEP_BYTES // 2:
                    yield from flush(False)
        yield from flush(True)

    tagged = docs.select(key.alias("k"), F.xxhash64(t).alias("h"), F.col("doc_id").cast("long").alias("doc_id"), t.alias("text")).mapInArrow(tag, "k long, h long, doc_id long, text string, part int, ahead boolean")
    return tagged.repartitionById(n, F.col("part")).sortWithinPartitions("part", "ahead", "k", "h", "text").mapInArrow(edit, EDITED)
