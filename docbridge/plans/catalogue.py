"""Registered queries: each demonstrates operators through the engine's own modules."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, ShortType, StringType, StructField, StructType

from ..config import ReadConfig, WriteConfig
from ..functions import decode as dec
from ..functions import encode as enc
from ..operators import outcome
from ..operators.ship import Send, chunks, partition_writer, ship_chunk, stats_of, summary_schema
from ..operators.sink import bulk_write
from ..sources import store as st
from ..sources.dsl import IGNORE_ABOVE, compile_query, keyword
from ..sources.scan import page_through, read_index, slices, typed
from ..sources.transport import ScriptedTransport
from ..streaming.sink import latest_per_key, make_foreach_batch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
HOST = {"hosts": ("store:unused",), "api_key": "none"}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def folder(spark: SparkSession) -> str:
    """A new folder for a store: in the cluster's shared one, else, where all runs in one process, a temporary one."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not shared and spark.sparkContext.master.partition("[")[0] != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{shared.rstrip('/')}/store-{uuid.uuid4().hex}" if shared else tempfile.mkdtemp(prefix="docbridge-")


def lines(df: DataFrame, name: str = "line", **cfg) -> DataFrame:  # noqa: ANN003
    return enc.action_lines(df, WriteConfig(**HOST, **cfg), name)


def source(df: DataFrame, alias: str, *keep: str) -> DataFrame:
    """The named columns, and the document of the others."""
    df = enc.stringify_hostile(df)
    return df.select(*keep, enc.source_json(df, [c for c in df.columns if c not in keep]).alias(alias))


# -- action lines and documents ----------------------------------------------


@query
def action_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(table(spark, sf_dir, "customer"), index="customer", id_field="c_custkey")


@query
def action_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(table(spark, sf_dir, "orders"), index="orders", id_field="o_orderkey", op_type="create")


@query
def action_delete_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("_is_delete", F.col("o_orderstatus") == "F")
    return lines(orders, index="orders", id_field="o_orderkey", has_deletes=True, delete_flag_column="_is_delete")


@query
def action_autoid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(table(spark, sf_dir, "nation"), index="nation")


@query
def drop_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer")
    return df.select(enc.source_json(df, enc.payload_columns(df.columns, ("c_nationkey", "c_acctbal"))).alias("src"))


@query
def ntz_epoch_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events")
    return df.select("event_id", enc.json_value(F.col("ts"), df.schema["ts"].dataType).alias("ms"))


@query
def date_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_shipdate").cast("date").alias("d"))
    return df.select("l_orderkey", enc.json_value(F.col("d"), df.schema["d"].dataType).alias("ms"))


@query
def nested_temporal(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    df = table(spark, sf_dir, "events").select("event_id", F.struct(ts.alias("t")).alias("s"), F.array(ts, F.timestamp_add("DAY", F.lit(1), ts)).alias("a"), F.create_map(F.lit("k"), ts).alias("m"))
    return source(df, "j", "event_id")


@query
def nonfinite_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.when(F.col("event_id") % 7 == 0, float("nan")).when(F.col("event_id") % 11 == 0, float("inf")).otherwise(F.col("value"))
    df = table(spark, sf_dir, "events").select("event_id", v.alias("v"))
    return df.select("event_id", enc.json_value(F.col("v"), df.schema["v"].dataType).alias("v"))


@query
def null_fields_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "orders").select("o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("F")).alias("st"))
    return source(df, "j")


@query
def binary_base64(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer").select("c_custkey", F.repeat("c_name", 6).cast("binary").alias("b"))
    return source(df, "j", "c_custkey").select("c_custkey", F.get_json_object("j", "$.b").alias("b"))


@query
def float_short_repr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every component as its document spells it: the shortest digits, with an exponent below a thousandth."""
    df = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "f"))
    return source(df, "j", "vec_id", "i").select("vec_id", "i", F.regexp_extract("j", r"^\{\"f\":(.*)\}$", 1).alias("f"))


@query
def variant_to_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events").select("event_id", F.parse_json("props").alias("p"))
    return enc.stringify_hostile(df)


@query
def interval_to_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events").select("event_id", F.make_dt_interval((F.col("event_id") % 5 + 1).cast("int"), F.lit(2), F.lit(3), F.lit(4)).alias("i"))
    return enc.stringify_hostile(df)


@query
def array_of_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = F.struct("turn", "role", "text")
    df = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return df.select("conv_id", enc.source_json(df, df.columns).alias("j"))


# -- accounting ----------------------------------------------------------------


#: Keys to a part: queries that hold a part in one task hold no more than that.
PART = 4_000
SCRIPTED = {**HOST, "index": "docs", "require_existing_index": False}


def _parts(df: DataFrame, key: str, line: Column, **more: Column) -> Any:
    """Action lines with their key, grouped by ranges of ``PART`` whole-number keys."""
    part = F.floor(F.col(key) / PART).cast("long")
    return df.select(part.alias("part"), F.col(key).alias("key"), line.alias("line"), *(c.alias(n) for n, c in more.items())).groupBy("part")


def _line(op: str | Column, key: str, body: Column) -> Column:
    head = F.to_json(F.struct(F.struct(F.lit("docs").alias("_index"), F.col(key).cast("string").alias("_id")).alias("x")))
    name = F.lit(op) if isinstance(op, str) else op
    return F.concat(F.replace(head, F.lit('"x"'), F.concat(F.lit('"'), name, F.lit('"'))), F.when(name != "delete", F.concat(F.lit("\n"), body)).otherwise(""))


def _no_pause(seconds: float) -> None:
    """The clock of a scripted transport whose pauses take no time."""


@query
def chunking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of 500 documents, in the order of keys, of each part of the orders."""
    cfg = WriteConfig(**SCRIPTED, id_field="o_orderkey")
    orders = enc.stringify_hostile(table(spark, sf_dir, "orders"))
    return _parts(orders, "o_orderkey", _line("index", "o_orderkey", enc.source_json(orders, orders.columns))).applyInArrow(_chunked(cfg), "part long, chunk long, docs long, lo long, hi long")


def _chunked(cfg: WriteConfig) -> Callable[[pa.Table], pa.Table]:
    def cut(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("key")
        keys, at, out = rows["key"].to_pylist(), 0, []
        for n, held in enumerate(chunks(iter(rows["line"].to_pylist()), cfg.chunk_size, cfg.chunk_bytes)):
            out.append((rows["part"][0].as_py(), n, len(held), keys[at], keys[at + len(held) - 1]))
            at += len(held)
        return pa.Table.from_pylist([dict(zip(("part", "chunk", "docs", "lo", "hi"), r)) for r in out])

    return cut


def _line_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as upserts whose order is that of ship date, then the other columns."""
    df = table(spark, sf_dir, "lineitem").withColumn("id", F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")))
    order = F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    cfg = WriteConfig(**HOST, index="lines", id_field="id", drop_fields=("_order",))
    docs = df.withColumn("_order", order)
    names = enc.payload_columns(docs.columns, cfg.drop_fields)
    return docs.select(F.lit("index").alias("_op"), enc.document_id(docs, "id").alias("_id"), enc.source_json(docs, names).alias("_source"), F.col("_order").alias("_seq"))


@query
def upsert_last_write_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = st.upsert(spark.createDataFrame([], st.STATE), _line_actions(spark, sf_dir))
    schema = StructType([StructField("id", StringType()), StructField("l_partkey", LongType()), StructField("l_suppkey", LongType()), StructField("l_quantity", DoubleType())])
    return typed(state, schema, ReadConfig(**HOST, index="lines"))


def _order_state(spark: SparkSession, sf_dir: str, every: int = 1) -> DataFrame:
    df = table(spark, sf_dir, "orders").where(F.col("o_orderkey") % every == 0) if every > 1 else table(spark, sf_dir, "orders")
    return enc.documents(df, WriteConfig(**HOST, index="orders", id_field="o_orderkey")).select("_id", "_source")


def _counted(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query
def create_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appending all orders to an index that holds every third."""
    new = enc.documents(table(spark, sf_dir, "orders"), WriteConfig(**HOST, index="orders", id_field="o_orderkey", op_type="create"))
    _, outcomes = st.create(_order_state(spark, sf_dir, 3), new.withColumn("_seq", F.monotonically_increasing_id()))
    return _counted(outcomes)


@query
def delete_404_noop(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = table(spark, sf_dir, "orders").select((F.col("o_orderkey") + F.when(F.col("o_orderkey") % 4 == 0, 100000000).otherwise(0)).alias("id"), F.lit(True).alias("gone"))
    docs = enc.documents(gone, WriteConfig(**HOST, index="orders", id_field="id", has_deletes=True, delete_flag_column="gone"))
    _, outcomes = st.apply_actions(_order_state(spark, sf_dir), docs.withColumn("_seq", F.monotonically_increasing_id()))
    return _counted(outcomes)


def _responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Response items as events stand for them."""
    e = F.col("event_id")
    ops, statuses = F.array(*map(F.lit, ("index", "create", "delete"))), F.array(*map(F.lit, (200, 201, 404, 409, 429, 400, 503)))
    df = table(spark, sf_dir, "events").select("event_id", "user_id", F.get(ops, (e % 3).cast("int")).alias("op"), F.get(statuses, (e % 7).cast("int")).alias("st"))
    return df.withColumn("outcome", outcome.classify_column(F.col("op"), F.col("st")))


@query
def classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _responses(spark, sf_dir).groupBy("op", "st", "outcome").agg(F.count(F.lit(1)).alias("n"))


@query
def reject_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = _responses(spark, sf_dir).where(~F.col("st").between(200, 299) & (F.col("outcome") != outcome.IGNORED))
    return bad.groupBy(outcome.bucket_column(F.col("st")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def _refuse_by_count(n: int, actions: list[tuple]) -> list[int | None]:
    """Request n (from 0) meets backpressure on documents that say they are refused more often."""
    return [429 if doc["k"] > n else None for _, _, doc in actions]


def _stubborn() -> ScriptedTransport:
    return ScriptedTransport(_refuse_by_count, clock=_no_pause)


def _budgeted(cfg: WriteConfig) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Ship the lines of each k apart, so that retries can be told by what became of them."""

    def ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: dict[str, list[int]] = {}
            for k in pc.unique(b.column(0)).to_pylist():
                lines = b.filter(pc.equal(b.column(0), k)).column(1).to_pylist()
                for held in chunks(iter(lines), cfg.chunk_size, cfg.chunk_bytes):
                    account = ship_chunk(_stubborn(), cfg, held)
                    for name, kind in (("written", outcome.WRITTEN), ("errors", outcome.ERROR)):
                        if account.counts[name]:
                            sums = found.setdefault(kind, [0, 0])
                            sums[0] += account.counts[name]
                            sums[1] += account.diagnostics["docs_retried"]
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), *(pa.array([v[i] for v in found.values()], pa.int64()) for i in (0, 1))], ["outcome", "n", "docs_retried"])

    return ship


@query
def retry_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that are refused k times before they are taken, shipped under the default budget."""
    cfg = WriteConfig(**SCRIPTED, id_field="event_id", bypass_fast_path=True)
    k = F.col("event_id") % 6
    lines = table(spark, sf_dir, "events").select(k.alias("k"), _line("index", "event_id", F.to_json(F.struct(k.alias("k")))).alias("line"))
    shipped = lines.mapInArrow(_budgeted(cfg), "outcome string, n long, docs_retried long")
    return shipped.groupBy("outcome").agg(F.sum("n").alias("n"), F.sum("docs_retried").alias("docs_retried"))


@query
def merge_signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.col("user_id") % 8
    tally = lambda kind: F.sum(F.when(F.col("outcome") == kind, 1).otherwise(0))
    parts = _responses(spark, sf_dir).groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("total_input"), *(tally(k).alias(n) for k, n in ((outcome.WRITTEN, "written"), (outcome.DELETED, "deleted"), (outcome.IGNORED, "ignored"), (outcome.ERROR, "errors"))))
    extra = lambda p: F.when(F.col("part") == p, 5).otherwise(0)
    return outcome.totals(parts.withColumns({"total_input": F.col("total_input") + extra(1), "errors": F.col("errors") + extra(2)}))


def _answer(n: int, actions: list[tuple]) -> dict:
    """A response that gives each document the status that its id stands for."""
    items = []
    for op, key, _ in actions:
        status = (200, 201, 404, 409, 429, 400, 503)[int(key) % 7]
        items.append({op: {"_id": key, "status": status} | ({"error": {"type": "scripted", "reason": f"status {status}"}} if status >= 300 else {})})
    return {"took": 1, "errors": True, "items": items}


def _answering() -> ScriptedTransport:
    return ScriptedTransport(_answer, clock=_no_pause)


def _sampled(cfg: WriteConfig) -> Callable[[pa.Table], pa.Table]:
    """Ship a part and list the samples of its summary."""
    write = partition_writer(cfg, _answering)

    def ship(rows: pa.Table) -> pa.Table:
        (summary,) = write(iter(rows.sort_by("key").select(["line"]).to_batches()))
        kept = outcome.merge(summary.to_pylist())["error_samples"]
        return pa.table({"part": pa.array([rows["part"][0].as_py()] * len(kept), pa.int64()), "event_id": pa.array([int(s["_id"]) for s in kept], pa.int64()), "op": pa.array([s["op_type"] for s in kept], pa.string()), "st": pa.array([s["status"] for s in kept], pa.int32())})

    return ship


@query
def error_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the writer keeps of the failures of each part."""
    cfg = WriteConfig(**SCRIPTED, id_field="event_id", bypass_fast_path=True, max_retries_per_doc=0)
    op = F.get(F.array(*map(F.lit, ("index", "create", "delete"))), (F.col("event_id") % 3).cast("int"))
    return _parts(table(spark, sf_dir, "events"), "event_id", _line(op, "event_id", F.lit("{}"))).applyInArrow(_sampled(cfg), "part long, event_id long, op string, st int")


def _summed(rows: pa.Table) -> pa.Table:
    stats = stats_of([Send(docs=1, size=n, rtt_ms=v, cpu_ms=0.0) for n, v in zip(rows["size"].to_pylist(), rows["value"].to_pylist())])
    return pa.Table.from_pylist([{"part": rows["part"][0].as_py(), "n": stats["n_sends"], "bytes": stats["bytes_sent"], "busy": round(stats["send_busy_ms"], 2)} | {s: round(stats[f"rtt_ms_{s}"], 6) for s in ("p50", "p95", "max")}])


@query
def send_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The writer's statistics of requests for which events stand, of each part."""
    sends = _parts(table(spark, sf_dir, "events").where("value is not null"), "event_id", F.lit(""), value=F.col("value"), size=F.col("user_id").cast("long"))
    return sends.applyInArrow(_summed, "part long, n long, bytes long, busy double, p50 double, p95 double, max double")


# -- scans -----------------------------------------------------------------------


def _paged(cfg: ReadConfig) -> Callable[[pa.Table], pa.Table]:
    """Write a part to a stand-in index and read it back, slice by slice and page by page."""

    def read(rows: pa.Table) -> pa.Table:
        index = ScriptedTransport(deal=lambda _, key: int(key))
        index.bulk(rows["line"].to_pylist())
        out = []
        for spec in slices(cfg.num_slices):
            for n, hits in enumerate(page_through(index, index.open_pit(cfg.index, cfg.pit_keep_alive), {"match_all": {}}, cfg.batch_size, cfg.pit_keep_alive, spec)):
                keys = [h["_source"]["event_id"] for h in hits]
                out.append({"part": rows["part"][0].as_py(), "sl": spec["id"], "pg": n, "n": len(keys), "s": sum(keys), "last": max(keys)})
        return pa.Table.from_pylist(out)

    return read


def _pages(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    cfg = ReadConfig(**HOST, index="docs", num_slices=n)
    padded = table(spark, sf_dir, "events").withColumn("_key", F.lpad(F.col("event_id").cast("string"), 19, "0"))  # an index orders ids as text
    return _parts(padded, "event_id", _line("index", "_key", F.to_json(F.struct("event_id")))).applyInArrow(_paged(cfg), "part long, sl long, pg long, n long, s long, last long")


@query
def slice_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five slices of an index of events hold, read page by page."""
    return _pages(spark, sf_dir, 5).groupBy(F.col("sl").alias("slice")).agg(F.sum("n").alias("n"), F.sum("s").alias("s"))


@query
def paging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of three slices of each part, in the order of ids."""
    return _pages(spark, sf_dir, 3).select("part", "sl", "pg", "n", F.col("last").alias("search_after"))


@query
def dsl_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = {"bool": {"must": [{"term": {"event_type": "error"}}], "filter": [{"range": {"value": {"gte": 5, "lt": 50}}}], "must_not": [{"terms": {"user_id": [1, 2, 3]}}]}}
    return table(spark, sf_dir, "events").where(compile_query(q, F.col)).select("event_id", "event_type", "value")


@query
def typed_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders to documents and back under their own schema; instants lose what is below a millisecond."""
    df = table(spark, sf_dir, "orders")
    docs = enc.documents(df, WriteConfig(**HOST, index="orders", id_field="o_orderkey"))
    back = typed(docs.select("_id", "_source"), df.schema, ReadConfig(**HOST, index="orders", id_field="o_orderkey"))
    return back


@query
def bool_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = (F.col("event_id") % 6).cast("int")
    sv = F.get(F.array(*map(F.lit, (" TRUE ", "y", "No", "0", "maybe", ""))), e)
    s = F.lower(F.trim(sv))
    known = s.isin(*dec.TRUE_STRINGS, *dec.FALSE_STRINGS)
    doc = F.parse_json(F.to_json(F.struct(sv.alias("v"))))
    value = dec.decode(F.variant_get(doc, "$.v", "variant"), BooleanType())
    return table(spark, sf_dir, "events").select("event_id", F.when(known, value.cast("string")).otherwise("mismatch").alias("r"))


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a smallint column makes of the value of each document."""
    for b in batches:
        out = []
        for doc in b.column(2).to_pylist():
            try:
                out.append("ok" if dec.read_coerce(json.loads(doc)["v"], ShortType(), "v") is not None else "null")
            except dec.ReadSchemaMismatch as e:
                out.append("not_integer" if "fraction" in str(e) else "out_of_range")
        yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(out, pa.string())], ["l_orderkey", "l_linenumber", "r"])


@query
def int_width_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.when(F.col("l_linenumber") % 2 == 0, F.col("l_extendedprice")).otherwise(F.col("l_quantity") * F.col("l_partkey"))
    lines = table(spark, sf_dir, "lineitem")
    keys = ", ".join(f"{c} {lines.schema[c].dataType.simpleString()}" for c in ("l_orderkey", "l_linenumber"))
    return lines.select("l_orderkey", "l_linenumber", F.to_json(F.struct(v.alias("v"))).alias("doc")).mapInArrow(_held, f"{keys}, r string")


@query
def scalar_as_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    j = F.when(e % 2 == 0, F.to_json(F.struct(e.alias("a")))).otherwise(F.to_json(F.struct(F.array(e, e).alias("a"))))
    back = dec.decode(F.variant_get(F.parse_json(j), "$.a", "variant"), ArrayType(LongType()))
    return table(spark, sf_dir, "events").select("event_id", F.size(back).alias("n"))


# -- streams and the two planes ---------------------------------------------------


@query
def cdc_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = latest_per_key(table(spark, sf_dir, "events"), "user_id", "ts", "event_id")
    return newest.select("user_id", "event_id", (F.col("event_type") == "error").alias("is_delete"))


@query
def source_vs_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a field's documents hold, and what an index that maps it to whole numbers holds."""
    df = table(spark, sf_dir, "events").select("event_type", "value")
    docs = df.select("event_type", "value", enc.source_json(df, ["value"]).alias("_source"))
    return docs.groupBy("event_type").agg(F.round(F.sum("value"), 2).alias("src_sum"), F.sum(st.indexed_value("value", "long")).cast("long").alias("idx_sum"))


@query
def ignore_above(spark: SparkSession, sf_dir: str) -> DataFrame:
    hidden = F.when(keyword(F.col("text"), IGNORE_ABOVE).isNull() & F.col("text").isNotNull(), 1).otherwise(0)
    return table(spark, sf_dir, "documents").groupBy("lang").agg(F.sum(hidden).cast("long").alias("not_indexed"), F.count(F.lit(1)).alias("n"))


@query
def external_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("_id"), F.col("ts").alias("_version"), "event_id")
    out = st.versioned_upsert(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1"))
    return out.withColumnRenamed("_id", "user_id")


# -- the store, the shipper and the sink ---------------------------------------------


@query
def index_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders through ``bulk_write`` into an index of the local store and back through ``read_index``."""
    orders = table(spark, sf_dir, "orders")
    store = st.DocumentStore(spark, folder(spark))
    store.create_index("orders", shards=3)
    at = {"hosts": (f"store:{store.root}",), "api_key": "none", "index": "orders", "id_field": "o_orderkey"}
    bulk_write(orders, WriteConfig(**at), raise_on_error=True)
    return read_index(spark, ReadConfig(**at, num_slices=3), orders.schema)


@query
def store_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create, upsert, delete and scan an index of the local store; what is left, typed."""
    store = st.DocumentStore(spark, folder(spark))
    store.create_index("orders", {"o_orderkey": "long", "o_orderstatus": "keyword"}, shards=3)
    orders = table(spark, sf_dir, "orders").withColumn("_is_delete", F.col("o_orderstatus") == "F")
    cfg = WriteConfig(hosts=(f"store:{store.root}",), api_key="none", index="orders", id_field="o_orderkey", has_deletes=True, delete_flag_column="_is_delete")
    outcome.reconcile_or_raise(store.write(orders.withColumn("_is_delete", F.lit(False)), cfg), index="orders")
    outcome.reconcile_or_raise(store.write(orders, cfg), index="orders")
    return typed(store.query("orders", {"bool": {"must_not": [{"term": {"o_orderstatus": "O"}}]}}), orders.drop("_is_delete").schema, ReadConfig(**HOST, index="orders", id_field="o_orderkey"))


class _Backpressure:
    """Refuses every tenth document twice: when the chunk goes briefly and when it goes in full."""

    def __init__(self) -> None:
        self.refused: dict[str, int] = {}

    def __call__(self, n: int, actions: list[tuple]) -> list[int | None]:
        said: list[int | None] = []
        for _, key, _ in actions:
            times = self.refused.pop(key, 0)  # kept for documents in flight only
            again = int(key) % 10 == 0 and times < 2
            if again:
                self.refused[key] = times + 1
            said.append(429 if again else None)
        return said


def _pressed() -> ScriptedTransport:
    return ScriptedTransport(_Backpressure(), clock=_no_pause)


@query
def ship_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ship orders, two requests in flight, through a scripted transport that refuses some; the sums of all partitions."""
    cfg = WriteConfig(**SCRIPTED, id_field="o_orderkey", write_concurrency=2, bulk_stats=True)
    df = enc.timestamps_to_millis(enc.stringify_hostile(table(spark, sf_dir, "orders")))
    parts = enc.action_lines(df, cfg).mapInArrow(partition_writer(cfg, _pressed), summary_schema(cfg))
    names = ("total_input", "written", "deleted", "ignored", "errors", "unaccounted", "overcounted", "docs_retried", "rejected_429")
    return outcome.with_discrepancies(parts).agg(*(F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in names))


@query
def streaming_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations through the streaming sink, drained twice from one checkpoint; the index afterwards."""
    root = folder(spark)
    store = st.DocumentStore(spark, f"{root}/store")
    store.create_index("nation")
    cfg = WriteConfig(hosts=(f"store:{root}/store",), api_key="none", index="nation", id_field="n_nationkey")
    nation = table(spark, sf_dir, "nation")
    nation.write.mode("overwrite").parquet(f"{root}/in")
    for _ in range(2):
        q = spark.readStream.schema(nation.schema).parquet(f"{root}/in").writeStream.foreachBatch(make_foreach_batch(cfg)).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
        q.awaitTermination()
    return typed(store.state("nation"), nation.schema, ReadConfig(**HOST, index="nation", id_field="n_nationkey"))


@query
def external_version_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events through the sink in two batches, their instant as version: what comes late does not replace what is newer."""
    root = folder(spark)
    cfg = WriteConfig(hosts=(f"store:{root}",), api_key="none", index="users", id_field="user_id", version_field="ts", require_existing_index=False)
    write = make_foreach_batch(cfg)
    events = table(spark, sf_dir, "events")
    for odd in (0, 1):
        write(events.where(F.col("event_id") % 2 == odd).select("user_id", "ts"), odd)
    return read_index(spark, ReadConfig(hosts=cfg.hosts, api_key="none", index="users"), events.select("user_id", "ts").schema)


def read_config_json(cfg: ReadConfig) -> str:
    """Options of ``spark.read.format("docindex")``."""
    return json.dumps({f: getattr(cfg, f) for f in cfg.__dataclass_fields__})
