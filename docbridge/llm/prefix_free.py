"""Suffix order of texts by prefix-free parsing.

A gram of GRAM bytes whose hash falls on a trigger starts a phrase, which reaches up to
and over the next trigger.  No suffix of a phrase that holds its closing trigger is the
start of another one, so the order of two suffixes of the texts is that of

1. what is left of their phrases: the suffix array of the dictionary (the distinct
   phrases, each sorted once however often it stands in the texts), and, where that is
   the same, of
2. the phrases that follow: the suffix array of the parse (the texts as sequences of
   ranks of phrases).

Both arrays are made by prefix doubling.  A text's end comes before every byte.
"""

from __future__ import annotations

import numpy as np

from . import common
from .hashing import eights, mix

#: Bytes of a trigger, and one gram of so many is one.
GRAM, EVERY = 8, 16


def dense(key: np.ndarray) -> np.ndarray:
    """Ranks from 1 on of rows by their key; equal keys share a rank."""
    order = np.argsort(key)
    sorted_ = key[order]
    new = np.ones(len(order), np.int64)
    new[1:] = sorted_[1:] != sorted_[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def doubled(rank: np.ndarray, span: int, left: np.ndarray) -> np.ndarray:
    """Ranks of whole suffixes of sequences laid end to end, from ranks of their first ``span`` symbols.

    ``left``: symbols from each place to the end of its sequence.  Nothing ranks 0.
    """
    longest = int(left.max()) if len(left) else 0
    while span < longest:
        size = np.bincount(rank)
        tied = np.flatnonzero(size[rank] > 1)
        if not len(tied):
            break
        after = np.zeros(len(tied), np.int64)
        more = left[tied] > span
        after[more] = rank[tied[more] + span]
        # ranks leave room for the rows of a tie, so only ties are sorted again
        sub = dense(rank[tied] << 32 | after)
        first = np.full(len(size), np.iinfo(np.int64).max)
        np.minimum.at(first, rank[tied], sub)
        grown = np.concatenate([[0], np.cumsum(size)])[rank] + 1
        grown[tied] += sub - first[rank[tied]]
        rank, span = grown, span * 2
    return rank


class Parse:
    """Phrases of texts, the dictionary of distinct ones, and the parse."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, every: int = EVERY):
        n = len(raw)
        own = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        trigger = (mix(eights(raw)) % np.uint64(every)) == 0
        trigger &= np.arange(n) + GRAM <= offsets[own + 1]
        trigger[offsets[:-1][np.diff(offsets) > 0]] = True
        self.starts = np.flatnonzero(trigger)
        self.row = own[self.starts]
        following = np.append(self.starts[1:], n)
        self.last = np.append(self.row[1:] != self.row[:-1], True) if len(self.row) else np.zeros(0, bool)
        self.stops = following  # where the next phrase, or the text, begins to count
        ends = np.where(self.last, following, following + GRAM)
        whole = raw.tobytes()
        ids: dict[tuple[bytes, bool], int] = {}
        self.phrase = np.array([ids.setdefault((whole[a:b], c), len(ids)) for a, b, c in zip(self.starts.tolist(), ends.tolist(), self.last.tolist())], np.int64)
        self.dictionary = [p for p, _ in ids]
        self.edge = np.concatenate([[0], np.cumsum([len(p) for p in self.dictionary])]).astype(np.int64)

    def dictionary_ranks(self) -> np.ndarray:
        """Suffix array of the dictionary: the rank of every suffix of every phrase, phrases laid end to end."""
        raw = np.frombuffer(b"".join(self.dictionary), np.uint8)
        left = np.repeat(self.edge[1:], np.diff(self.edge)) - np.arange(len(raw))
        head = eights(raw).byteswap()  # the first byte counts most
        some = np.minimum(left, 8)
        head &= ~((np.uint64(1) << (np.uint64(8) * (np.uint64(8) - some.astype(np.uint64))) % np.uint64(64)) - np.uint64(1)) | np.where(some == 8, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))
        rank = dense(head)
        if len(raw) and not raw.min():  # a byte 0 is more than the text's end
            rank = dense(rank << 4 | some)
        return doubled(rank, 8, left)

    def parse_ranks(self, phrase_rank: np.ndarray) -> np.ndarray:
        """Suffix array of the parse: the rank of the phrases from each one on to its text's end."""
        last = np.flatnonzero(self.last)
        left = last[np.searchsorted(last, np.arange(len(self.phrase)))] - np.arange(len(self.phrase)) + 1
        return doubled(dense(phrase_rank[self.phrase]), 1, left)


def corpus_order(raw: np.ndarray, offsets: np.ndarray, every: int = EVERY) -> np.ndarray:
    """Places of all bytes in the order of the suffixes that start there; equal suffixes by place."""
    if not len(raw):
        return np.zeros(0, np.int64)
    p = Parse(raw, offsets, every)
    of_suffix = p.dictionary_ranks()
    of_parse = np.append(p.parse_ranks(of_suffix[p.edge[:-1]]), 0)
    k, place = common.within(p.stops - p.starts)
    key = of_suffix[p.edge[p.phrase[k]] + place] << 32 | np.where(p.last[k], 0, of_parse[k + 1])
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    tied = np.flatnonzero(np.append(same, False) | np.append(False, same))
    order[tied] = order[tied][np.lexsort((order[tied], key[order[tied]]))]
    return order


def repeated_starts(raw: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """Which places start a ``width``-byte string (inside one text) that also starts elsewhere: read off neighbours in corpus order."""
    out = np.zeros(len(raw), bool)
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(raw))
    order = corpus_order(raw, offsets)
    order = order[left[order] >= width]  # what lies between two equal starts shares them
    a, b = order[:-1], order[1:]
    whole = eights(raw)
    for o in [*range(0, width - 7, 8), width - 8] if width >= 8 else [0]:
        same = whole[a + o] == whole[b + o] if width >= 8 else (whole[a] ^ whole[b]) & np.uint64((1 << 8 * width) - 1) == 0
        a, b = a[same], b[same]
    out[a] = out[b] = True
    return out
