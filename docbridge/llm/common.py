"""Helpers shared by the operators: checkpoints, Arrow batches, text identity."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Most bytes of text that one vectorised step takes (a longer document is a step of its own).
STEP_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint(df: DataFrame, *superseded: DataFrame) -> DataFrame:
    """Cut lineage: write ``df`` to the shared folder and read it back.

    The folder is the one that the cluster names in ``spark.checkpoint.dir``; only where
    that setting is absent and all runs in one process (tests, local runs) a temporary
    one is used.  A written table
    is whole whatever executors are lost later, its size is known to the planner, and
    plans stay small in loops.  Tables go when the application ends; those in
    ``superseded``, earlier results of this function that nothing needs any more, at once.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.partition("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="docbridge-")
        sc.setCheckpointDir(folder)
    path = f"{folder.rstrip('/')}/docbridge-{uuid.uuid4().hex}"
    with shuffles_end(spark):
        df.write.parquet(path)
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(target)
    discard(*superseded)
    out = spark.read.schema(df.schema).parquet(path)
    out._docbridge_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``checkpoint`` wrote; other frames are left alone."""
    for old in tables:
        if getattr(old, "_docbridge_path", None):
            sc = old.sparkSession.sparkContext
            path = sc._jvm.org.apache.hadoop.fs.Path(old._docbridge_path)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Queries run within leave no shuffle files; else those stay until the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def text_id(text: Column) -> list[Column]:
    """Two independent 64-bit hashes that identify a text (null counts as empty)."""
    t = F.coalesce(text, F.lit(""))
    return [F.xxhash64(t).alias("t1"), F.xxhash64(F.lit(7), t).alias("t2")]


def exact_text_id(docs: DataFrame) -> Column:
    """A 64-bit hash of the text (null counts as empty) that differs for all texts of ``docs``.

    Another hash checks it; should two texts collide, the next seed is taken.
    """
    text = F.coalesce("text", F.lit(""))
    for seed in range(100):
        own = F.xxhash64(F.lit(seed), text)
        both = docs.select(own.alias("t"), F.xxhash64(F.lit(seed - 1000), text, F.lit(seed)).alias("u"))
        if both.groupBy("t").agg(F.min("u").alias("a"), F.max("u").alias("b")).where("a <> b").isEmpty():
            return own
    raise RuntimeError("no collision-free hash")


def distinct_texts(docs: DataFrame, text_id_: Column) -> DataFrame:
    """One row for each distinct text: t, first_id (smallest doc_id), n_rows, n_bytes, packed (the text, zstd).

    Copies meet in a partial aggregation before the shuffle, so a group of copies,
    however large, sends one row per task.  Texts travel compressed one by one.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=6)
        for rows, raw, offs in text_steps(batches, "text"):
            whole = raw.tobytes()
            packed = [codec.compress(whole[a:b], asbytes=True) if b > a else b"" for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(np.diff(offs)), pa.array(packed, pa.binary())], ["t", "doc_id", "n_bytes", "packed"])

    rows = docs.select(text_id_.alias("t"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # said here, else inner joins add it below the aggregate and outer joins don't: two exchanges
    rows = rows.mapInArrow(pack, "t long, doc_id long, n_bytes long, packed binary").where("t is not null")
    return rows.groupBy("t").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n_rows"), F.any_value("n_bytes").alias("n_bytes"), F.any_value("packed").alias("packed"))


def packed_steps(batches: Iterator[pa.RecordBatch], most: int = STEP_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Like ``text_steps`` for rows of ``distinct_texts``."""
    codec = pa.Codec("zstd")
    for batch in batches:
        if not batch.num_rows:
            continue
        size = batch.column(batch.schema.get_field_index("n_bytes")).to_numpy()
        packed = batch.column(batch.schema.get_field_index("packed"))
        offs = np.concatenate([[0], np.cumsum(size)])
        for lo, hi in steps(offs, most):
            raw = b"".join([codec.decompress(packed[i].as_py(), int(size[i]), asbytes=True) if size[i] else b"" for i in range(lo, hi)])
            yield batch.slice(lo, hi - lo), np.frombuffer(raw, np.uint8), offs[lo : hi + 1] - offs[lo]
        del batch, packed, raw
        release()


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n+1 offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]] if len(offsets) else raw[:0], offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)


def steps(offsets: np.ndarray, most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose bytes add up to at most ``most`` (or a single longer row)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def release() -> None:
    """Give freed memory back: workers live on between tasks, and allocators keep what they once had."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def text_steps(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = STEP_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut Arrow batches into steps of bounded size: (rows, bytes, offsets)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        raw, offs = text_buffer(batch.column(batch.schema.get_field_index(column)))
        for lo, hi in steps(offs, most):
            yield batch.slice(lo, hi - lo), raw[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        del batch, raw, offs
        release()


def span_codes(raw: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Cut bytes at ``edges`` (from 0 to their number): a code for each span, and the distinct spans by code."""
    spans = pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(raw))])
    coded = spans.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_pylist()


def within(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For segment sizes: the segment of each element and its place in the segment."""
    counts = np.asarray(counts, np.int64)
    seg = np.repeat(np.arange(len(counts)), counts)
    starts = np.cumsum(counts) - counts
    return seg, np.arange(len(seg)) - np.repeat(starts, counts)


def map_rows(docs: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], *more: StructField) -> DataFrame:
    """``run`` over batches of all columns, to which it adds ``more``, whatever the columns' names."""
    names = [c if c in ("doc_id", "text") else f"__{i}" for i, c in enumerate(docs.columns)]
    fields = [StructField(n, f.dataType) for n, f in zip(names, docs.schema.fields)]
    return docs.toDF(*names).mapInArrow(run, StructType([*fields, *more])).toDF(*docs.columns, *(f.name for f in more))


def filter_by_text(docs: DataFrame, judge: Callable[[Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]], Iterator[np.ndarray]]) -> DataFrame:
    """Rows that ``judge`` keeps, with all their columns, whatever their names; no shuffle.

    ``judge`` gets steps of (rows, bytes, offsets) of the column ``text`` and gives a
    mask for each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks = list(judge(text_steps(iter([batch]))))
            if masks:
                yield batch.filter(pa.array(np.concatenate(masks)))

    return map_rows(docs, run)


def strings(values: list) -> pa.Array:
    return pa.array(values, pa.string())
