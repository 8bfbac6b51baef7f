"""Substring dedup: a count-min prefilter, then exact groups.

Partition sketches of all windows' cores are merged; they overestimate counts, so a
second pass groups exactly only what is estimated to repeat and loses nothing (see
``sketch`` and ``repeats``).  Texts may be of any length: a window never needs more than
its own text, and a text is one step however long it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, repeats
from .hashing import word_spans

EMPTY = hashlib.sha256(b"").hexdigest()


def windows(width: int = 20) -> repeats.Windows:
    gram = min(3, max(1, width // 5))
    return repeats.Windows(width, max(1, width * 13 // 20 if width >= 8 else width - gram), gram)


def remove(docs: DataFrame, width: int = 20, texts: bool = False) -> DataFrame:
    """doc_id, t (hash of the text), n_words, n_removed, kept_sha256 (and kept, the words left, if ``texts``).

    Words are runs without ASCII white space.  Each word in a window of ``width`` words
    that also starts earlier - in a document with a smaller doc_id, or in the same at an
    earlier place - is removed; windows are judged on the input; the words left are
    joined by one space.  Null text has no words; null doc_id comes first; documents
    that share a doc_id but not their text come in the order of the text's hash;
    repeated rows (same doc_id and text) are one document and have the same result; an
    empty table gives no rows; other columns are ignored.
    """
    w = windows(width)
    text_id = common.exact_text_id(docs)
    spans = repeats.repeated_spans(docs, w, text_id)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, offs in common.packed_steps(batches):
            _, _, first = word_spans(raw, offs)
            gone = repeats.covered(rows, 5, first, width)
            whole = raw.tobytes()
            n, r, sha, left = [], [], [], []
            for i in range(rows.num_rows):
                a, b = int(first[i]), int(first[i + 1])
                words = whole[offs[i] : offs[i + 1]].split()
                g = gone[a:b]
                removed = int(g.sum())
                if removed:
                    words = [words[j] for j in np.flatnonzero(~g)]
                kept = b" ".join(words)
                n.append(b - a)
                r.append(removed)
                sha.append(hashlib.sha256(kept).hexdigest())
                left.append(kept)
            cols = [*rows.columns[:2], pa.array(n, pa.int64()), pa.array(r, pa.int64()), pa.array(sha, pa.string())]
            yield pa.RecordBatch.from_arrays(cols + ([pa.array(left, pa.binary()).cast(pa.string())] if texts else []), names)

    names = ["t", "first_id", "n_words", "n_removed", "kept_sha256"] + ["kept"] * texts
    done = spans.mapInArrow(cut, "t long, first_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * texts)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_id.alias("t"))
    later = ~F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("n_words") >= width)  # a copy: all its windows start earlier
    out = own.join(done.hint("merge"), "t").withColumn("n_removed", F.when(later, F.col("n_words")).otherwise(F.col("n_removed")))
    out = out.withColumn("kept_sha256", F.when(later, F.lit(EMPTY)).otherwise(F.col("kept_sha256")))
    return out.withColumn("kept", F.when(later, F.lit("")).otherwise(F.col("kept"))).drop("first_id") if texts else out.drop("first_id")


def clean(docs: DataFrame, width: int = 20) -> DataFrame:
    """Rows of ``docs`` with repeated words taken out of ``text`` (and n_chars, if there, counted anew).

    A text that loses nothing is unchanged, null stays null; all rows and other columns
    stay, whatever their names.
    """
    t, kept, gone, first = "__t", "__kept", "__gone", "__first"
    w = windows(width)
    text_id = common.exact_text_id(docs)
    spans = repeats.repeated_spans(docs, w, text_id)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts that lose words, or that copies must lose."""
        for rows, raw, offs in common.packed_steps(batches):
            _, _, begin = word_spans(raw, offs)
            lost = repeats.covered(rows, 5, begin, width)
            whole = raw.tobytes()
            copies = rows.column(2).to_numpy()
            take, left, removed = [], [], []
            for i in range(rows.num_rows):
                g = lost[begin[i] : begin[i + 1]]
                if g.any() or (copies[i] > 1 and len(g) >= width):
                    take.append(i)
                    removed.append(bool(g.any()))
                    own = whole[offs[i] : offs[i + 1]].split()
                    left.append(b" ".join([own[j] for j in np.flatnonzero(~g)]) if g.any() else b"")
            at = pa.array(take, pa.int64())
            yield pa.RecordBatch.from_arrays([rows.column(0).take(at), rows.column(1).take(at), pa.array(removed, pa.bool_()), pa.array(left, pa.binary()).cast(pa.string())], [t, first, gone, kept])

    changed = spans.mapInArrow(cut, f"{t} long, {first} long, {gone} boolean, {kept} string")
    out = docs.withColumn(t, text_id).join(changed.hint("merge"), t, "left")
    copy = ~F.col("doc_id").cast("long").eqNullSafe(F.col(first))
    text = F.when(F.col(gone).isNull(), F.col("text")).when(copy, F.lit("")).when(F.col(gone), F.col(kept)).otherwise(F.col("text"))
    columns = [text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    out = out.select(*columns)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
