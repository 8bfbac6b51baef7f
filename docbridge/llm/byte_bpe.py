"""Byte-level BPE with a hierarchical-bitmap rank queue.

The pairs of a pre-token wait in one bucket per merge rank; a bucket holds places in
the linked list of tokens.  A two-level bitmap over the ranks answers "lowest rank
that waits" by find-first-set.  A place whose pair has changed since is stale and is
skipped.  A pre-token of n bytes takes O(n log n) steps however long it is.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Spans of text whose ids are remembered by a worker, and their longest bytes.
MEMORY, LONGEST_KEPT = 600_000, 64
#: Bytes of text taken at a time.
STEP_BYTES = 2 << 20
#: Visible ASCII, and first bytes of the characters among which other white space is.
_VISIBLE, _MAY_LEAD_SPACE = np.zeros(256, bool), np.zeros(256, bool)
_VISIBLE[33:127] = True
_MAY_LEAD_SPACE[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class RankQueue:
    """Merge the tokens of one pre-token, lowest rank first, leftmost first among equals."""

    __slots__ = ("ranks", "tokens", "single")

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {v: k for k, v in ranks.items()}
        self.single = [ranks.get(bytes([b]), -1) for b in range(256)]

    def merge(self, piece: bytes) -> list[int]:
        n = len(piece)
        get = self.ranks.get
        part = [piece[i : i + 1] for i in range(n)]
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        waiting = [-1] * n  # rank of the pair that starts at a place, -1 where there is none
        buckets: dict[int, list[int]] = {}
        words: dict[int, int] = {}
        top = 0
        for i in range(n - 1):
            r = get(piece[i : i + 2], -1)
            if r >= 0:
                waiting[i] = r
                if r in buckets:
                    buckets[r].append(i)  # places ascend, which is a heap already
                else:
                    buckets[r] = [i]
                    w = r >> 6
                    words[w] = words.get(w, 0) | 1 << (r & 63)
                    top |= 1 << w
        while top:
            w = (top & -top).bit_length() - 1
            bits = words[w]
            low = (bits & -bits).bit_length() - 1
            r = w << 6 | low
            bucket = buckets[r]
            i = heapq.heappop(bucket)
            if not bucket:
                del buckets[r]
                bits &= bits - 1
                words[w] = bits
                if not bits:
                    top &= top - 1
            if waiting[i] != r:
                continue
            j = after[i]
            whole = part[i] + part[j]
            part[i] = whole
            waiting[j] = -1
            k = after[j]
            after[i] = k
            waiting[i] = -1
            places = []
            if k < n:
                before[k] = i
                s = get(whole + part[k], -1)
                if s >= 0:
                    places.append((i, s))
            h = before[i]
            if h >= 0:
                s = get(part[h] + whole, -1)
                waiting[h] = -1
                if s >= 0:
                    places.append((h, s))
            for place, s in places:
                waiting[place] = s
                if s in buckets:
                    heapq.heappush(buckets[s], place)
                else:
                    buckets[s] = [place]
                    w = s >> 6
                    words[w] = words.get(w, 0) | 1 << (s & 63)
                    top |= 1 << w
        out, i = [], 0
        while i < n:
            out.append(self.ranks[part[i]])
            i = after[i]
        return out


class ByteBPE:
    """Encoder and decoder for a rank file and a splitting pattern; no special tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cuts: bool):
        self.queue = RankQueue(ranks)
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.cuts = cuts
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.known: dict[bytes, tuple[int, ...]] = {b"": ()}
        self.decimal = {v: b"%d" % v for v in self.queue.tokens}

    def _piece(self, piece: str) -> tuple[int, ...]:
        ids = self.pieces.get(piece)
        if ids is None:
            raw = piece.encode()
            r = self.ranks.get(raw, -1)
            ids = (r,) if r >= 0 else tuple(self.queue.merge(raw))
            if len(self.pieces) < MEMORY and len(raw) <= LONGEST_KEPT:
                self.pieces[piece] = ids
        return ids

    def _span(self, span: bytes) -> tuple[int, ...]:
        out: list[int] = []
        for piece in self.split(span.decode()):
            out += self._piece(piece)
        ids = tuple(out)
        if len(self.known) < MEMORY and len(span) <= LONGEST_KEPT:
            self.known[span] = ids
        return ids

    def spans(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes], list[tuple[int, ...]]]:
        """Codes of the spans of all rows, each row's first one (n+1 values), and the distinct spans and their ids by code.

        A match of the default pattern takes a blank only as its first character or as
        part of white space alone, so a single blank between two visible characters
        always starts a match, and texts may be cut there.  Another pattern gets its
        texts whole.
        """
        n = len(raw)
        lead = np.zeros(n + 1, bool)
        lead[offsets] = True
        if n > 2 and self.cuts:
            visible = _VISIBLE[raw]
            after = visible | (raw >= 128) & ~_MAY_LEAD_SPACE[raw]
            # of other scripts: not the last byte of something that may be white space
            before = visible | (raw >= 128)
            before[1:] &= ~((raw[:-1] == 0xC2) & (raw[1:] >= 128))
            before[2:] &= ~((raw[:-2] >= 0xE1) & (raw[:-2] <= 0xE3))
            lead[1 : n - 1] |= (raw[1:-1] == 32) & before[:-2] & after[2:]
        starts = np.flatnonzero(lead[:-1])
        codes, spans = common.span_codes(raw, np.append(starts, n)) if n else (np.zeros(0, np.int64), [])
        known = self.known.get
        return codes, np.searchsorted(starts, offsets), spans, [ids if (ids := known(s)) is not None else self._span(s) for s in spans]

    def encode(self, text: str) -> list[int]:
        """Ids of a text."""
        raw = np.frombuffer(text.encode(), np.uint8)
        codes, _, _, ids = self.spans(raw, np.array([0, len(raw)]))
        return [i for c in codes.tolist() for i in ids[c]]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.queue.tokens.__getitem__, ids))


_coders: dict[tuple[str | None, str | None], ByteBPE] = {}


def coder(path: str | None = None, pattern: str | None = None) -> ByteBPE:
    """The coder of a rank file, kept by the worker; by default the public 50k vocabulary."""
    if (path, pattern) not in _coders:
        import public_tokenizers

        own = pattern or public_tokenizers.PATTERN
        _coders[path, pattern] = ByteBPE(load_ranks(path or public_tokenizers.path("byte_bpe_50k.tiktoken")), own, own == public_tokenizers.PATTERN)
    return _coders[path, pattern]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, ids (array<int>) of every whole text, however long.  Row by row, no shuffle.

    Null text counts as empty and has no ids; repeated rows each give a row, an empty
    table none; other columns are not looked at, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path, pattern)
        for rows, raw, offs in common.text_steps(batches, most=STEP_BYTES):
            codes, first, _, ids = c.spans(raw, offs)
            out = [[i for k in codes[a:b].tolist() for i in ids[k]] for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(out, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return _texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, bytes (binary) of a frame of doc_id, ids.

    Null ids count as none; repeated rows each give a row, an empty table none; other
    columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path, pattern)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array([c.decode(x or []) for x in b.column(1).to_pylist()], pa.binary())], ["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def digest(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Encode, decode and keep digests only, in one pass: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Null text counts as empty: no tokens, digests of nothing.  Repeated rows each give a
    row, an empty table none; texts are whole, however long; other columns are not looked
    at, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path, pattern)
        for rows, raw, offs in common.text_steps(batches, most=STEP_BYTES):
            codes, first, _, ids = c.spans(raw, offs)
            total = np.concatenate([[0], np.cumsum(np.array(list(map(len, ids)), np.int64)[codes])])
            written = [b" ".join(map(c.decimal.__getitem__, x)) for x in ids]
            decoded = list(map(c.decode, ids))
            codes, edge = codes.tolist(), first.tolist()
            a, d = [], []
            for x, y in zip(edge[:-1], edge[1:]):
                own = codes[x:y]
                a.append(hashlib.sha256(b" ".join(map(written.__getitem__, own))).hexdigest())
                d.append(hashlib.sha256(b"".join(map(decoded.__getitem__, own))).hexdigest())
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(total[first])), pa.array(a, pa.string()), pa.array(d, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
