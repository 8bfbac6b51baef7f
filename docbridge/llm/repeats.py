"""Exact repeated windows of words in a corpus, by content-defined anchors.

A window is ``width`` consecutive words of one text.  Hashes of short grams trigger
anchors: of every ``reach`` consecutive grams the least is one.  Each window thus has an
anchor near its start that depends on its content alone, equal windows have it at the
same place, and each anchor stands for one run of window starts.

* ``core``: hash of the words from the anchor on that all its windows share.  Windows
  that repeat have a repeated core, so anchors whose core does not repeat are dropped -
  first by a count-min sketch (bounded size, loses none), then exactly.
* ``whole``: hash of all words that the anchor's windows cover.  If it repeats, all its
  windows do, and no window need be looked at.  This settles the inside of long copies.
* What is left are the anchors at the ends of copies: core repeated, whole not.  Only
  for these are the windows themselves hashed and counted.

What decides is keyed by two hashes (core and whole, window and its first words), none of
which a built text can make collide (see ``hashing``).  Copies of whole texts are folded
before all that.  Every exchange is keyed by content hashes and counted with partial
aggregation, and joins are laid out so that Spark can split hot keys.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, sketch
from .hashing import Runs, mix, pair, sliding_min, word_hashes, word_spans


@dataclass(frozen=True)
class Windows:
    """``gram + reach <= width + 1`` must hold."""

    width: int
    reach: int
    gram: int

    def units(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[Runs, np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of the words and their runs, each row's first word (n+1 values), and the words' spans."""
        starts, ends, first = word_spans(raw, offsets)
        return Runs(word_hashes(raw, starts, ends), self.width), first, starts, ends


def anchors(runs: Runs, first: np.ndarray, w: Windows) -> tuple[np.ndarray, ...]:
    """Row, first and last window start (counted from the step's first word), core and whole of each anchor."""
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    sizes = np.diff(first) - w.width + 1
    rows = np.flatnonzero(sizes > 0)
    if not len(rows):
        return none
    grams = mix(runs.all(w.gram))
    high = np.uint64(0xFFFFFFFF00000000)
    least = sliding_min((grams & high) | np.arange(len(grams), dtype=np.uint64), w.reach)
    if len(rows) == 1:
        start = np.arange(first[rows[0]], first[rows[0]] + sizes[rows[0]])
    else:
        seg, place = common.within(sizes[rows])
        start = first[rows][seg] + place
    at = (least[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    lo, hi, at = start[new], start[np.append(new[1:], len(at)) - 1], at[new]
    row = np.searchsorted(first, lo, "right") - 1
    core = mix(runs.at(at, w.width - w.reach + 1))
    # the first and the last window cover all between them, as they overlap or touch
    place = ((hi - lo) << 32 | (at - lo)).astype(np.uint64)
    whole = pair(pair(runs.at(lo, w.width), runs.at(hi, w.width)), place)
    return row, lo, hi, core, whole


def prefilter(docs: DataFrame, w: Windows, text_id: Column) -> Broadcast:
    """Sketch of all anchors' cores.  Copies of a text within a task are counted once."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        seen: set[int] = set()
        for rows, raw, offs in common.text_steps(batches):
            ids = rows.column(1).to_numpy()
            fresh = []
            for i, t in enumerate(ids.tolist()):
                if t not in seen:
                    seen.add(t)
                    fresh.append(i)
            runs, first, _, _ = w.units(raw, offs)
            row, _, _, core, _ = anchors(runs, first, w)
            if len(fresh) < len(ids):
                keep = np.zeros(len(ids), bool)
                keep[fresh] = True
                core = core[keep[row]]
            yield core

    units = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    return sketch.build(docs.select(F.coalesce("text", F.lit("")).alias("text"), text_id.alias("t")), keys, units / 6 / ((w.reach + 1) / 2))


TEXTS = ["t", "first_id", "n_rows", "n_bytes", "packed"]


def counted(rows: DataFrame, key: str, *aggregates: Column, more: tuple[str, ...] = ()) -> DataFrame:
    """Aggregates by ``key`` (long) and ``more``, laid out so that a join on them deals both sides anew.

    The rows are grouped by the key's complement.  A later join on the key then has an
    exchange on either side, which lets Spark split the rows of a hot key at run time;
    reusing the aggregate's own layout would forbid that.
    """
    return rows.withColumn("__not", F.bitwise_not(key)).groupBy("__not", *more).agg(*aggregates).withColumn(key, F.bitwise_not("__not")).drop("__not")


def repeated_spans(docs: DataFrame, w: Windows, text_id: Column) -> DataFrame:
    """Distinct texts with the runs of the starts of windows that also start earlier.

    Earlier: smaller doc_id - null first -, then the text's hash, then place in the
    text.  Copies of whole texts are left to the caller: a distinct text counts as one
    text here.  Columns as ``common.distinct_texts``, then ``runs`` (array of lo, hi,
    settled: the settled ones count) and ``single`` (array of further starts), in words
    of the text; either may be null.

    One plan without materialised steps: the exchange of the texts is written once and
    reused by its readers.
    """
    filter_ = prefilter(docs, w, text_id)
    texts = common.distinct_texts(docs, text_id).select(*TEXTS)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = filter_.value
        for rows, raw, offs in common.packed_steps(batches):
            hashes, first, _, _ = w.units(raw, offs)
            row, lo, hi, core, whole = anchors(hashes, first, w)
            keep = np.flatnonzero(cells.repeated(core))
            if not len(keep):
                continue
            row = row[keep]
            base = first[row]
            own = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(core[keep].view(np.int64)), pa.array(whole[keep].view(np.int64)), rows.column(0).take(own), rows.column(1).take(own), pa.array((lo[keep] - base).astype(np.int32)), pa.array((hi[keep] - base).astype(np.int32))],
                ["core", "whole", "t", "first_id", "lo", "hi"],
            )

    # said to be not null, else joins ask for it in one reader's way each and no exchange is shared
    found = texts.mapInArrow(find, "core long not null, whole long not null, t long not null, first_id long, lo int not null, hi int not null")
    # what leads a class: its earliest place
    order = F.struct(F.coalesce("first_id", F.lit(-(1 << 63))).alias("o"), "t", "lo")
    classes = found.groupBy("core", "whole").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("least"))
    # ``any`` is asked for so that both readers of the classes want the same columns and share their exchange
    kinds = counted(classes, "core", F.sum("n").alias("m"), F.min("least").alias("any")).where("m > 1 and any is not null").select("core", "m")
    # mixed: the core also stands in another class
    judged = classes.join(kinds.hint("merge"), "core").select("core", "whole", "n", "least", (F.col("m") > F.col("n")).alias("mixed")).where("n > 1 or mixed")
    marked = found.join(judged.hint("merge"), ["core", "whole"]).withColumn("leads", F.col("least") == order)
    # settled: all windows of the run repeat.  asked: its windows must be looked up.
    settled = (F.col("n") > 1) & ~F.col("leads")
    asked = F.col("mixed") & ((F.col("n") == 1) | F.col("leads"))
    runs = marked.where(settled | asked).groupBy("t").agg(F.collect_list(F.struct("lo", "hi", settled.alias("settled"), asked.alias("asked"))).alias("runs"))

    # windows of the runs to look up, each with a second hash, of its first words
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, offs in common.packed_steps(batches):
            hashes, first, _, _ = w.units(raw, offs)
            own, (lo, hi, _, wanted) = lists(rows.column(5))
            own, lo, hi = (x[wanted] for x in (own, lo, hi))
            size = (hi - lo + 1).astype(np.int64)
            end = np.cumsum(size)
            a = 0
            while a < len(size):  # about 64 thousand windows at a time
                b = max(a + 1, int(np.searchsorted(end, (end[a - 1] if a else 0) + (1 << 16), "right")))
                seg, place = common.within(size[a:b])
                seg = seg + a
                at = lo[seg] + place
                start = first[own[seg]] + at
                h = mix(hashes.at(start, w.width))
                head = hashes.at(start, (w.width + 1) // 2) >> np.uint64(32)
                mine = pa.array(own[seg])
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(head.astype(np.uint32).view(np.int32)), rows.column(0).take(mine), rows.column(1).take(mine), pa.array(at.astype(np.int32))], ["window", "head", "t", "first_id", "lo"])
                a = b

    some = texts.join(runs.hint("merge"), "t").select(*TEXTS, "runs").where(F.exists("runs", lambda r: r["asked"]))
    windows = some.mapInArrow(look, "window long not null, head int not null, t long not null, first_id long, lo int not null")
    hits = counted(windows, "window", F.count(F.lit(1)).alias("n"), F.min(order).alias("least"), more=("head",)).where("n > 1").select("window", "head", "least")
    seen = windows.join(hits.hint("merge"), ["window", "head"]).where(F.col("least") != order)
    single = seen.groupBy("t").agg(F.collect_list("lo").alias("single"))
    return texts.join(runs.hint("merge"), "t", "left").join(single.hint("merge"), "t", "left").select(*TEXTS, "runs", "single")


def lists(col: pa.ListArray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Row and fields of each element of a column of lists of structs."""
    flat = col.flatten()
    own = np.repeat(np.arange(len(col)), pa.compute.list_value_length(col).fill_null(0).to_numpy(zero_copy_only=False))
    return own, [flat.field(i).to_numpy(zero_copy_only=False) for i in range(flat.type.num_fields)]


def covered(rows: pa.RecordBatch, column: int, first: np.ndarray, width: int) -> np.ndarray:
    """Which units of the step are in a repeated window; ``runs`` and ``single`` are the columns from ``column`` on."""
    change = np.zeros(int(first[-1]) + 1, np.int32)
    own, (lo, hi, settled, *_) = lists(rows.column(column))
    settled = settled.astype(bool)
    own, lo, hi = own[settled], lo[settled], hi[settled]
    np.add.at(change, first[own] + lo, 1)
    np.add.at(change, first[own] + hi + width, -1)
    col = rows.column(column + 1)
    own = np.repeat(np.arange(len(col)), pa.compute.list_value_length(col).fill_null(0).to_numpy(zero_copy_only=False))
    at = first[own] + col.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + width, -1)
    return np.cumsum(change[:-1]) > 0
