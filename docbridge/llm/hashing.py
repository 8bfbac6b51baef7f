"""Vectorised hashes of bytes, words and runs of them.

None is a polynomial: each step mixes before it adds the next part, so that texts built
to cancel out (Thue-Morse words, long runs) collide no more often than others.
"""

from __future__ import annotations

import hashlib

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of a span that are hashed eight at a time; longer spans have a cryptographic hash.
LONG = 64

#: ASCII space and the controls \t \n \v \f \r.
WHITE = np.zeros(256, bool)
WHITE[[0x20, 9, 10, 11, 12, 13]] = True
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise: every bit of the result depends on every bit of ``x``."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two hashes in this order."""
    a = a * _ODD
    a ^= a >> np.uint64(32)
    a += b
    return mix(a)


def eights(raw: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one number; zeros follow the end."""
    out = np.zeros(len(raw) + 8, np.uint8)
    out[: len(raw)] = raw
    for k, kind in ((1, np.uint16), (2, np.uint32), (4, np.uint64)):
        out = out[:-k].astype(kind) | out[k:].astype(kind) << kind(8 * k)
    return out[: len(raw)]


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of spans of bytes that may overlap."""
    size = ends - starts
    h = mix(size.astype(np.uint64) * _ODD + np.uint64(1))
    padded = np.zeros(len(raw) + 8, np.uint8)
    padded[: len(raw)] = raw
    rows = np.lib.stride_tricks.sliding_window_view(padded, 8)
    far = np.flatnonzero(size > LONG)
    live = np.flatnonzero((size > 0) & (size <= LONG))
    at, left = starts[live], size[live]
    while len(live):
        part = np.ascontiguousarray(rows[at]).view("<u8").ravel() & _KEEP[np.minimum(left, 8)]
        h[live] = mix(h[live] ^ part)
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    if len(far):
        whole = memoryview(np.ascontiguousarray(raw))
        h[far] = np.frombuffer(b"".join([hashlib.blake2b(whole[a:b], digest_size=8).digest() for a, b in zip(starts[far].tolist(), ends[far].tolist())]), "<u8")
    return h


class Runs:
    """Hashes of runs of at most ``widest`` symbols; each is made of two runs of a power of two."""

    def __init__(self, symbols: np.ndarray, widest: int):
        self.levels = [symbols]
        while 2 << len(self.levels) - 1 <= widest:
            last, k = self.levels[-1], 1 << len(self.levels) - 1
            self.levels.append(pair(last[:-k], last[k:]) if len(last) > k else last[:0])

    def at(self, start: np.ndarray, width: int) -> np.ndarray:
        """Of ``width`` symbols from each start on."""
        k = width.bit_length() - 1
        row = self.levels[k]
        return row[start] if width == 1 << k else pair(row[start], row[start + (width - (1 << k))] + np.uint64(width))

    def all(self, width: int) -> np.ndarray:
        """Of all runs of ``width`` symbols, by their start."""
        k = width.bit_length() - 1
        row, n = self.levels[k], len(self.levels[0]) - width + 1
        if n <= 0:
            return row[:0]
        return row[:n] if width == 1 << k else pair(row[:n], row[width - (1 << k) :][:n] + np.uint64(width))


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and each row's first word (n+1 values)."""
    return spans_of(~WHITE[raw], offsets)


def spans_of(solid: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``solid`` within rows, and each row's first one (n+1 values)."""
    n = len(solid)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | cut[1:n]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | cut[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hashes(raw, starts, ends)


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    """A-Z to a-z, other bytes unchanged."""
    return np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)


def sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive keys, in time that does not depend on the width."""
    n = len(keys)
    if n < width:
        return keys[:0]
    padded = np.full(-(-n // width) * width, np.iinfo(keys.dtype).max, keys.dtype)
    padded[:n] = keys
    block = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])
