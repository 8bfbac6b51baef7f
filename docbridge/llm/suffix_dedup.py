"""Suffix-array dedup by prefix-free parsing.

The corpus is parsed into overlapping phrases, suffixes are sorted for the dictionary of
distinct phrases alone, and strings that start twice are read off neighbours in the
resulting order (``prefix_free``).

1. Rolling-hash triggers: of every ``reach`` consecutive grams the one with the least
   hash is an anchor.  Each ``width``-byte string has one among its first grams, equal
   strings have it at the same place.  A phrase is an anchor with all bytes of the
   strings that start by it, so each string lies in exactly one phrase.  What follows the
   anchor in each of its strings is the phrase's core: equal strings lie in phrases with
   equal cores, and phrases whose core occurs once are dropped, first by a count-min
   sketch that loses none, then exactly.
2. The dictionary holds each distinct phrase with its count.  All strings of a phrase
   that occurs twice do so too.
3. Distinct phrases that share their core meet, and their suffixes are put in corpus
   order; neighbours with ``width`` bytes in common start equal strings.

A core with more than MOST distinct phrases (the start of a passage that very many texts
hold) would meet in one task; its strings are counted by two hashes instead, which deals
them by content.  Copies of whole texts are folded before all that.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, sketch
from .hashing import _KEEP, eights, mix, pair, sliding_min
from .prefix_free import repeated_starts
from .repeats import counted, covered, lists

#: Distinct phrases of one core that are sorted together, and bytes of phrases sorted at a time.
MOST, SORTED_BYTES = 4096, 1 << 19
TEXTS = ["t", "n_rows", "n_bytes", "packed"]


@dataclass(frozen=True)
class Strings:
    """``gram + reach <= width + 1`` must hold."""

    width: int
    reach: int
    gram: int


def strings(width: int = 200) -> Strings:
    gram = 8 if width >= 64 else max(1, width // 8)
    return Strings(width, max(1, width * 2 // 5 if width >= 64 else width - gram - width // 2 + 1), gram)


def fixed(whole: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Hash of ``length`` bytes from each place on; ``whole``: the 8 bytes from each place on."""
    if length < 8:
        return mix(whole[at] & _KEEP[length])
    h = np.full(len(at), length, np.uint64)
    for o in range(0, length - 7, 8):
        h = pair(h, whole[at + o])
    return pair(h, whole[at + (length - 8)]) if length % 8 else h


def phrases(whole: np.ndarray, first: np.ndarray, s: Strings) -> tuple[np.ndarray, ...]:
    """Row, first and last string start, anchor and core of each phrase of a step's texts."""
    rows = np.flatnonzero(np.diff(first) >= s.width)
    if not len(rows):
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    grams = mix(whole if s.gram == 8 else whole & _KEEP[s.gram])[: len(whole) - s.gram + 1]
    grams &= np.uint64(0xFFFFFFFF00000000)
    grams |= np.arange(len(grams), dtype=np.uint64)
    n = len(whole) - s.width + 1
    at = sliding_min(grams, s.reach)[:n].astype(np.uint32)  # the low half: the place
    edge = np.zeros(n + 1, np.int8)
    edge[first[rows]] = 1
    edge[first[rows + 1] - s.width + 1] = -1  # between two texts there are always places that start no string
    starts = np.cumsum(edge[:-1], dtype=np.int8).view(bool)
    turn = np.ones(n + 1, bool)
    turn[1:-1] = at[1:] != at[:-1]
    turn |= edge != 0
    lo, hi = np.flatnonzero(starts & turn[:-1]), np.flatnonzero(starts & turn[1:])
    at = at[lo].astype(np.int64)
    return np.searchsorted(first, lo, "right") - 1, lo, hi, at, mix(fixed(whole, at, s.width - s.reach + 1))


def contents(whole: np.ndarray, lo: np.ndarray, hi: np.ndarray, at: np.ndarray, s: Strings) -> np.ndarray:
    """Hash of all bytes of phrases: the first and the last string cover all between them, as they overlap or touch."""
    place = ((hi - lo) << 32 | (at - lo)).astype(np.uint64)
    return pair(pair(fixed(whole, lo, s.width), fixed(whole, hi, s.width)), place)


def _prefilter(docs: DataFrame, s: Strings, text_id: Column) -> Broadcast:
    """Sketch of all cores.  Copies of a text within a task are counted once."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        seen: set[int] = set()
        for rows, raw, offs in common.text_steps(batches):
            ids = rows.column(1).to_pylist()
            keep = np.zeros(len(ids), bool)
            for i, t in enumerate(ids):
                if t not in seen:
                    seen.add(t)
                    keep[i] = True
            row, _, _, _, core = phrases(eights(raw), offs, s)
            yield core[keep[row]]

    total = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    return sketch.build(docs.select(F.coalesce("text", F.lit("")).alias("text"), text_id.alias("t")), keys, 2 * total / (s.reach + 1))


def _repeated(docs: DataFrame, s: Strings, text_id: Column) -> DataFrame:
    """Distinct texts (TEXTS) with ``runs`` (lo, hi, settled: all strings of the settled ones repeat) and ``single`` starts."""
    filter_ = _prefilter(docs, s, text_id)
    texts = common.distinct_texts(docs, text_id).select(*TEXTS)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = filter_.value
        for rows, raw, offs in common.packed_steps(batches):
            whole = eights(raw)
            row, lo, hi, at, core = phrases(whole, offs, s)
            keep = np.flatnonzero(cells.repeated(core))
            row, lo, hi, at, core = (x[keep] for x in (row, lo, hi, at, core))
            base = offs[row]
            yield pa.RecordBatch.from_arrays([pa.array(core.view(np.int64)), pa.array(contents(whole, lo, hi, at, s).view(np.int64)), rows.column(0).take(pa.array(row)), pa.array((lo - base).astype(np.int32)), pa.array((hi - base).astype(np.int32))], ["core", "content", "t", "lo", "hi"])

    # said to be not null, else joins ask for it in one reader's way each and no exchange is shared
    found = texts.mapInArrow(parse, "core long not null, content long not null, t long not null, lo int not null, hi int not null")
    place = F.xxhash64("t", "lo")  # any one place stands for a distinct phrase
    dictionary = found.groupBy("core", "content").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("least"))
    # ``any`` is asked for so that both readers of the dictionary want the same columns and share its exchange
    cores = counted(dictionary, "core", F.count(F.lit(1)).alias("several"), F.max("n").alias("often"), F.min("least").alias("any")).where("(several > 1 or often > 1) and any is not null").select("core", "several")
    judged = dictionary.join(cores.hint("merge"), "core").select("core", "content", "n", "least", "several").where("n > 1 or several > 1")
    marked = found.join(judged.hint("merge"), ["core", "content"])
    settled, asked = F.col("n") > 1, (F.col("several") > 1) & (F.col("least") == place)
    runs = marked.where(settled | asked).groupBy("t").agg(F.collect_list(F.struct("lo", "hi", settled.alias("settled"), asked.alias("asked"), (F.col("several") > MOST).alias("many"), "core")).alias("runs"))
    some = texts.join(runs.hint("merge"), "t").select(*TEXTS, "runs").where(F.exists("runs", lambda r: r["asked"]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bytes of the phrases to sort."""
        for rows, raw, offs in common.packed_steps(batches):
            own, (lo, hi, settled, asked, many, core) = lists(rows.column(4))
            pick = np.flatnonzero(asked & ~many)
            a, b = offs[own[pick]] + lo[pick], offs[own[pick]] + hi[pick] + s.width
            whole = raw.tobytes()
            for x in range(0, len(pick), 4096):
                k = pick[x : x + 4096]
                yield pa.RecordBatch.from_arrays([pa.array(core[k]), rows.column(0).take(pa.array(own[k])), pa.array(lo[k]), pa.array(settled[k]), pa.array([whole[i:j] for i, j in zip(a[x : x + 4096].tolist(), b[x : x + 4096].tolist())], pa.binary())], ["core", "t", "lo", "settled", "bytes"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Starts of strings that neighbours in corpus order share; whole groups of a core at a time."""
        held: list[tuple] = []
        size, now = 0, None

        def out() -> pa.RecordBatch:
            data = [h[3] for h in held]
            offs = np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)
            twice = np.flatnonzero(repeated_starts(np.frombuffer(b"".join(data), np.uint8), offs, s.width))
            row = np.searchsorted(offs, twice, "right") - 1
            fresh = ~np.array([h[2] for h in held], bool)[row]
            row, at = row[fresh], (twice - offs[row])[fresh]
            return pa.RecordBatch.from_arrays([pa.array([h[0] for h in held], pa.int64()).take(pa.array(row)), pa.array((np.array([h[1] for h in held], np.int64)[row] + at).astype(np.int32))], ["t", "lo"])

        for b in batches:
            for core, t, lo, settled, data in zip(*(b.column(i).to_pylist() for i in range(5))):
                if core != now and size > SORTED_BYTES:
                    yield out()
                    held, size = [], 0
                now = core
                held.append((t, lo, settled, data))
                size += len(data)
        if held:
            yield out()

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The strings of phrases with a very common core, each by two hashes; weight 2 for what occurs twice by itself."""
        for rows, raw, offs in common.packed_steps(batches):
            whole = eights(raw)
            own, (lo, hi, settled, asked, many, _) = lists(rows.column(4))
            pick = asked & many
            own, lo, hi, twice = (x[pick] for x in (own, lo, hi, settled))
            for x in range(0, len(lo), 512):
                seg, place = common.within((hi - lo + 1)[x : x + 512])
                seg = seg + x
                at = lo[seg] + place
                start = offs[own[seg]] + at
                head = fixed(whole, start, s.width // 2) >> np.uint64(32)
                yield pa.RecordBatch.from_arrays([pa.array(mix(fixed(whole, start, s.width)).view(np.int64)), pa.array(head.astype(np.uint32).view(np.int32)), rows.column(0).take(pa.array(own[seg])), pa.array(at.astype(np.int32)), pa.array(np.where(twice[seg], 2, 1).astype(np.int32))], ["string", "head", "t", "lo", "weight"])

    cuts = some.mapInArrow(cut, "core long not null, t long not null, lo int not null, settled boolean not null, bytes binary not null")
    read_off = cuts.repartition("core").sortWithinPartitions("core").mapInArrow(sort, "t long, lo int")
    hashed = some.mapInArrow(look, "string long not null, head int not null, t long not null, lo int not null, weight int not null")
    hits = counted(hashed, "string", F.sum("weight").alias("n"), more=("head",)).where("n > 1").select("string", "head")
    also = hashed.where("weight = 1").join(hits.hint("merge"), ["string", "head"]).select("t", "lo")
    single = read_off.unionAll(also).groupBy("t").agg(F.collect_list("lo").alias("single"))
    return texts.join(runs.hint("merge"), "t", "left").join(single.hint("merge"), "t", "left").select(*TEXTS, "runs", "single")


def remove(docs: DataFrame, width: int = 200, texts: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the bytes left, if ``texts``).

    Each byte in a ``width``-byte string that also starts anywhere else, in the same
    document or another row, is removed; strings are judged on the input.  Null text
    counts as empty; texts are whole, however long; a repeated row is a document of its
    own, so its text starts elsewhere too; an empty table gives no rows; other columns
    are ignored.
    """
    s = strings(width)
    own = common.exact_text_id(docs)
    spans = _repeated(docs, s, own)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, offs in common.packed_steps(batches):
            gone = covered(rows, 4, offs, width)
            copies = rows.column(1).to_numpy() > 1
            out: list[list] = [[], [], [], [], []]
            for i in range(rows.num_rows):
                a, b = int(offs[i]), int(offs[i + 1])
                g = gone[a:b]
                if copies[i] and b - a >= width:
                    g = np.ones(b - a, bool)
                kept = raw[a:b][~g].tobytes()
                for x, v in zip(out, (b - a, int(g.sum()), int(np.count_nonzero(np.diff(np.concatenate([[0], g.view(np.int8)])) == 1)), hashlib.sha256(kept).hexdigest(), kept)):
                    x.append(v)
            cols = [rows.column(0), *(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.string())]
            yield pa.RecordBatch.from_arrays(cols + ([pa.array(out[4], pa.binary())] if texts else []), names)

    names = ["t", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * texts
    done = spans.mapInArrow(cut, "t long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * texts)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), own.alias("t")).join(done.hint("merge"), "t").drop("t")
