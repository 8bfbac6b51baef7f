"""Best-fit packing by minimum bin slack.

Documents become pieces of at most ``capacity`` tokens.  What is packed is the
histogram of piece lengths (at most ``capacity`` numbers, whatever the corpus), so the
plan is made on the driver from bounded data.  For each bin the largest length left is
set, and a bitset subset-sum over the lengths still available finds the fullest
feasible combination for the rest; the combination is taken as often as the counts
allow (each single bin would find the same one again).  Pieces are then dealt to the
places of the plan by their rank within a length, counted in two steps so that no
length, however common, meets in one task.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .hashing import spans_of

#: Spans whose ids a worker remembers.
MEMORY = 400_000
#: Buckets in which the pieces of a length are ranked, for each million pieces and at least.
BUCKETS_PER_MILLION, LEAST_BUCKETS = 64, 64
#: Bytes up to which a span is remembered, and bytes of text taken at a time.
LONGEST_KEPT, STEP_BYTES = 64, 2 << 20
#: Words that the splitting pattern takes as one match, as lower-casing keeps them: letters of Latin-1 alone.
_PLAIN = re.compile(r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
#: ASCII letters; what is parted from a letter before it at the end of a span.
_LETTER, _STOP = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_STOP[[44, 46]] = True

_tokenizers: dict = {}


class SpanTokenizer:
    """Ids of whole texts by the library, each distinct span between blanks and line breaks encoded once.

    That is exact for tokenizers that lower case, drop white space and never merge
    across it; any other file is told by its settings and gets its texts whole.  A closing
    stop or comma after an ASCII letter is a match of its own.  Plain words are encoded
    many at a time, as each ends in the one token with the word-end suffix; all other
    spans by themselves.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.cuts = self._by_words(json.load(f))
        # plain words in lower case are what normalising and splitting leave as they are
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}

    @staticmethod
    def _by_words(settings: dict) -> bool:
        """Whether white space only parts words, whatever stands around it."""
        before, after = settings.get("normalizer") or {}, settings.get("pre_tokenizer") or {}
        kinds = [x.get("type") for x in before.get("normalizers", [])]
        split, *rest = after.get("pretokenizers") or [{}]
        return (
            kinds == ["NFC", "Replace", "Lowercase"]
            and before["normalizers"][1].get("pattern") == {"Regex": r"\s+"}
            and before["normalizers"][1].get("content") == " "
            and (split.get("type"), split.get("behavior"), split.get("invert")) == ("Split", "Removed", True)
            and split.get("pattern") == {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
            and [x.get("type") for x in rest] == ["ByteLevel"]
            and not rest[0].get("add_prefix_space")
            and (settings.get("model") or {}).get("end_of_word_suffix") == "</w>"
            and not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"] for t in settings.get("added_tokens", []))
        )

    def _each(self, spans: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(spans, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """Each of ``words`` is one match of letters in lower case."""
        ids = np.array(self.plain.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = (np.flatnonzero(self.closes[ids]) + 1) * 4
        if len(ends) != len(words) or (len(ends) and ends[-1] != 4 * len(ids)):
            return self._each(words)
        raw = ids.tobytes()
        ends = ends.tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def _new(self, spans: list[bytes]) -> dict[bytes, bytes]:
        known = self.known
        lower = {s: s.lower() for s in spans if s.isalpha()}  # of bytes: ASCII letters
        odd = []
        for s in spans:
            if s not in lower:
                if _PLAIN.fullmatch(t := s.decode()):
                    lower[s] = t.lower().encode()
                else:
                    odd.append(s)
        words = {w: known.get(w) for w in set(lower.values())}
        fresh = [w for w, ids in words.items() if ids is None]
        for lo in range(0, len(fresh), 1000):
            part = fresh[lo : lo + 1000]
            words.update(zip(part, self._words([w.decode() for w in part])))
        out = {s: words[w] for s, w in lower.items()}
        for lo in range(0, len(odd), 20_000):
            part = odd[lo : lo + 20_000]
            out.update(zip(part, self._each([s.decode() for s in part])))
        return out

    def _spans(self, spans: list[bytes]) -> list[bytes]:
        known = self.known
        out = list(map(known.get, spans))
        new = self._new([s for s, ids in zip(spans, out) if ids is None])
        if new:
            out = [new[s] if ids is None else ids for s, ids in zip(spans, out)]
            known.update(islice(((s, ids) for s, ids in new.items() if len(s) <= LONGEST_KEPT), max(0, MEMORY - len(known))))
        return out

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Little-endian 32-bit ids of all rows, and where each row's begin (n+1 values)."""
        if not self.cuts:
            whole = raw.tobytes()
            each = self._each([whole[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())])
            return b"".join(each), np.concatenate([[0], np.cumsum([len(x) // 4 for x in each])]).astype(np.int64)
        solid = (raw != 32) & (raw != 10)
        starts, ends, _ = spans_of(solid, offsets)
        if not len(starts):
            return b"", np.zeros(len(offsets), np.int64)
        stop = ends[_STOP[raw[ends - 1]] & (ends - starts > 1) & _LETTER[raw[ends - 2]]] - 1
        lead = np.zeros(len(raw) + 1, bool)
        lead[starts] = lead[stop] = True
        edges = np.append(np.flatnonzero(lead[:-1][solid]), int(solid.sum()))
        codes, spans = common.span_codes(raw[solid], edges)
        ids = self._spans(spans)
        total = np.concatenate([[0], np.cumsum(np.array([len(x) // 4 for x in ids], np.int64)[codes])])
        return b"".join(map(ids.__getitem__, codes.tolist())), total[np.searchsorted(np.flatnonzero(lead), offsets)]


def tokenizer(path: str | None = None) -> SpanTokenizer:
    """The tokenizer of a file, kept by the worker; by default the public 49k vocabulary."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _tokenizers:
        import public_tokenizers

        _tokenizers[path] = SpanTokenizer(path or public_tokenizers.path("word_bpe_49k.json"))
    return _tokenizers[path]


PIECES = "doc_id long, t1 long, row int, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, capacity: int = 2048, end_id: int = 0, path: str | None = None) -> DataFrame:
    """Pieces of the tokenised documents: doc_id, piece, start, length, ids_crc32.

    Null text counts as empty and has the closing id alone; only documents longer than
    ``capacity`` are cut, however long they are.  Repeated rows each give their pieces,
    an empty table none; other columns are not looked at, whatever their names.  ``t1``
    (a hash of the text) and ``row`` (place in its batch) only spread and order the pieces.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        for part, raw, offs in common.text_steps(batches, most=STEP_BYTES):
            ids, first = tok.encode(raw, offs)
            size = np.diff(first) + 1
            row, piece = common.within(-(-size // capacity))
            start = piece * capacity
            length = np.minimum(size[row] - start, capacity)
            last = start + length == size[row]
            at = (first[row] + start) * 4
            view, crc = memoryview(ids), []
            for a, n, closed in zip(at.tolist(), (length - last).tolist(), last.tolist()):
                c = zlib.crc32(view[a : a + 4 * n])
                crc.append(zlib.crc32(end, c) if closed else c)
            own = pa.array(row)
            yield pa.RecordBatch.from_arrays([part.column(0).take(own), part.column(2).take(own), pa.array(row.astype(np.int32)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())], ["doc_id", "t1", "row", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), common.text_id(F.col("text"))[0]).mapInArrow(run, PIECES)


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """The lengths, within their counts, whose sum comes closest to ``room`` from below.

    Bitset subset-sum: bit s of ``reach`` says that a sum of s is feasible.  Lengths go
    from long to short and a common length in doubling portions; the search ends once
    ``room`` itself is reached.
    """
    mask = (1 << room + 1) - 1
    reach, trail = 1, []
    for length in sorted((x for x in counts if x <= room and counts[x]), reverse=True):
        left, portion = min(counts[length], room // length), 1
        while left and not reach >> room & 1:
            take = min(portion, left)
            grown = (reach | reach << take * length) & mask
            if grown != reach:
                trail.append((reach, length, take))
                reach = grown
            left -= take
            portion *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    out: list[int] = []
    for was, length, take in reversed(trail):
        if not was >> total & 1:
            out += [length] * take
            total -= length * take
    return out


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Combinations of lengths and how many sequences use each; every piece is in one."""
    counts = {k: v for k, v in histogram.items() if v > 0}
    out = []
    while counts:
        first = max(counts)
        counts[first] -= 1
        combination = [first, *fullest(counts, capacity - first)]
        counts[first] += 1
        need = Counter(combination)
        times = min(counts[x] // n for x, n in need.items())
        out.append((combination, times))
        for x, n in need.items():
            counts[x] -= n * times
            if not counts[x]:
                del counts[x]
    return out


def places(plan_: list[tuple[list[int], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length, runs of ranks: first rank, first sequence, offset."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    used: Counter = Counter()
    sequence = 0
    for combination, times in plan_:
        offset = 0
        for x in combination:
            runs.setdefault(x, []).append((used[x], sequence, offset))
            used[x] += times
            offset += x
        sequence += times
    return {x: tuple(np.array(c, np.int64) for c in zip(*r)) for x, r in runs.items()}


def pack(docs: DataFrame, capacity: int = 2048, end_id: int = 0, path: str | None = None) -> DataFrame:
    """Pieces of ``docs`` with sequence_id and offset; no sequence exceeds ``capacity``.

    An empty table gives no rows; repeated rows and ties of doc_id are pieces of their
    own (equal pieces are interchangeable); other columns of ``docs`` are not used.
    """
    cut = common.checkpoint(pieces(docs, capacity, end_id, path))
    by_length = cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most ``capacity`` rows
    histogram = {r["length"]: r["n"] for r in by_length}
    total = sum(histogram.values())
    buckets = max(LEAST_BUCKETS, BUCKETS_PER_MILLION * total // 1_000_000)
    spread = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "t1", "piece"), F.lit(buckets)))
    ranked = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = spread.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")).select("length", "bucket", F.coalesce(F.sum("n").over(ranked), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "t1", "row", "piece")
    ranks = spread.withColumn("inside", F.row_number().over(inside) - 1).join(base, ["length", "bucket"]).withColumn("rank", F.col("base") + F.col("inside"))
    runs = docs.sparkSession.sparkContext.broadcast(places(plan(histogram, capacity)))  # bounded: the plan has at most a few runs for each length

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = (b.column(i).to_numpy() for i in (3, 5))
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for x in np.unique(length):
                at = np.flatnonzero(length == x)
                first, seq, off = runs.value[int(x)]
                k = np.searchsorted(first, rank[at], "right") - 1
                sequence[at] = seq[k] + rank[at] - first[k]
                offset[at] = off[k]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranks.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
