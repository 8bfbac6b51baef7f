"""Distributed snapshot scan of an index, decoded against a declared schema.

One partition reads one slice of one snapshot, page by page, so a task holds a page and
never a slice.  Filters that Spark pushes down are compiled into the index's query.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual
from pyspark.sql.types import DataType, StructType

from ..config import ReadConfig
from ..functions.decode import check_schema, decode, read_coerce
from .transport import Transport, connect

log = logging.getLogger("docbridge")

RAW = "_id string, _source string"


def page_through(transport: Transport, pit: str, query: dict, batch_size: int, keep_alive: str, slice_: dict | None) -> Iterator[list[dict]]:
    """Pages of hits in index order, until an empty one; each request renews the snapshot."""
    after = None
    while True:
        body: dict = {"size": batch_size, "query": query, "pit": {"id": pit, "keep_alive": keep_alive}, "sort": ["_shard_doc"], "track_total_hits": False}
        if slice_:
            body["slice"] = slice_
        if after is not None:
            body["search_after"] = after
        response = transport.search(body)
        pit = response.get("pit_id", pit)
        hits = response["hits"]["hits"]
        if not hits:
            return
        yield hits
        after = hits[-1]["sort"]


def slices(n: int) -> list[dict | None]:
    """Disjoint shares of a scan; a single one needs no slicing."""
    return [None] if n == 1 else [{"id": i, "max": n} for i in range(n)]


class Slice(InputPartition):
    def __init__(self, spec: dict | None):
        super().__init__(spec)


def filter_to_query(f: Filter) -> dict | None:
    """A pushed filter as a query clause, None if it has to stay with Spark.

    Only filters on whole numbers and booleans at the top level are exact in an index:
    strings may be analysed there, and floats and dates rounded.  Metadata (``_id``,
    ``_source``) is not indexed as a field, so nothing about it is pushed.
    """
    exact = lambda v: isinstance(v, (bool, int))
    name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
    if name is None or name.startswith("_"):
        return None
    if isinstance(f, IsNotNull):
        return {"exists": {"field": name}}
    if isinstance(f, EqualTo) and exact(f.value):
        return {"term": {name: f.value}}
    if isinstance(f, In) and all(map(exact, f.value)):
        return {"terms": {name: list(f.value)}}
    for kind, op in ((GreaterThan, "gt"), (GreaterThanOrEqual, "gte"), (LessThan, "lt"), (LessThanOrEqual, "lte")):
        if isinstance(f, kind) and exact(f.value):
            return {"range": {name: {op: f.value}}}
    return None


class IndexReader(DataSourceReader):
    def __init__(self, cfg: ReadConfig, make: Callable[[], Transport], pit: str, n: int, schema: StructType | None = None):
        self.cfg, self.make, self.pit, self.n, self.schema = cfg, make, pit, n, schema
        self.clauses: list[dict] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Narrow the index's query; all filters stay with Spark too, as indexed values may be coarser."""
        for f in filters:
            clause = filter_to_query(f)
            if clause:
                self.clauses.append(clause)
            yield f

    def partitions(self) -> list[Slice]:
        return [Slice(s) for s in slices(self.n)]

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        query = self.cfg.query or {"match_all": {}}
        if self.clauses:
            query = {"bool": {"filter": [query, *self.clauses]}}
        transport = self.make()
        try:
            for hits in page_through(transport, self.pit, query, self.cfg.batch_size, self.cfg.pit_keep_alive, partition.value):
                if self.schema is not None:
                    yield from map(self._row, hits)
                    continue
                yield pa.RecordBatch.from_arrays([pa.array([h["_id"] for h in hits], pa.string()), pa.array([json.dumps(h.get("_source") or {}) for h in hits], pa.string())], ["_id", "_source"])
        finally:
            transport.close()


    def _row(self, hit: dict) -> tuple:
        """A document as the declared columns; the id column is filled where the key is absent."""
        doc, out = hit.get("_source") or {}, []
        for f in self.schema.fields:
            fill = self.cfg.include_id and f.name == self.cfg.id_field and f.name not in doc
            out.append(read_coerce(hit["_id"] if fill else doc.get(f.name), f.dataType, f.name))
        return tuple(out)


class DocIndex(DataSource):
    """``spark.read.format("docindex")``: documents of a snapshot.

    Raw (_id, _source), or as the columns of ``.schema(...)``, whose filters on whole
    numbers and booleans then reach the index.  Options: ``config``, a JSON object of
    ReadConfig's fields.  Hosts ``store:`` are for ``read_index``.
    """

    make: Callable[[], Transport] | None = None

    @classmethod
    def name(cls) -> str:
        return "docindex"

    def schema(self) -> str:
        return RAW

    def reader(self, schema: StructType) -> IndexReader:
        cfg = ReadConfig(**json.loads(self.options["config"]))
        if cfg.hosts[0].startswith("store:"):
            raise ValueError("docindex reads over HTTP; use read_index for a store")
        declared = None
        if schema.names != ["_id", "_source"]:
            check_schema(schema)
            declared = schema
        make = type(self).make or connect(cfg)
        pit, n = open_snapshot(cfg, make)
        return IndexReader(cfg, make, pit, n, declared)


def open_snapshot(cfg: ReadConfig, make: Callable[[], Transport]) -> tuple[str, int]:
    """One snapshot for all slices, and their number: as set, else the index's shards."""
    transport = make()
    try:
        n = cfg.num_slices
        if n is None:
            try:
                n = max(1, transport.shard_count(cfg.index))
            except Exception:
                if cfg.strict_slices:
                    raise
                log.warning("index %r: the number of shards is not known; reading in one slice", cfg.index)
                n = 1
        return transport.open_pit(cfg.index, cfg.pit_keep_alive), n
    finally:
        transport.close()


def typed(raw: DataFrame, schema: StructType, cfg: ReadConfig) -> DataFrame:
    """Documents as the declared columns; only those are looked at.

    The id column is filled from ``_id`` where the document lacks the key; a key that is
    there with null stays null.
    """
    names = [f.name for f in schema.fields]
    quoted = [n.replace("\\", "\\\\").replace('"', '\\"') for n in names]
    # in steps, each used more than once by the next, so that none is evaluated twice
    parsed = raw.select("_id", F.parse_json("_source").alias("_doc"))
    values = parsed.select("_id", *(F.variant_get("_doc", f'$["{q}"]', "variant").alias(f"_v{i}") for i, q in enumerate(quoted)))
    kinds = values.select("*", *(F.schema_of_variant(f"_v{i}").alias(f"_k{i}") for i in range(len(names))))
    columns = []
    for i, f in enumerate(schema.fields):
        value = F.col(f"_v{i}")
        out = decode(value, f.dataType, f.name, F.col(f"_k{i}"))
        if cfg.include_id and f.name == cfg.id_field:
            out = F.when(value.isNull(), _from_id(f.dataType, f.name)).otherwise(out)
        columns.append(out.alias(f.name))
    return kinds.select(*columns)


def _from_id(t: DataType, name: str) -> Column:
    return decode(F.parse_json(F.to_json(F.array("_id"))).cast("array<variant>")[0], t, name)


def read_index(spark: SparkSession, cfg: ReadConfig, schema: StructType, *, transport: Callable[[], Transport] | None = None) -> DataFrame:
    """Lazy scan of an index as ``schema``; what can be refused is refused now.

    The snapshot is taken now: every action on the result sees the same documents.
    """
    if not cfg.index:
        raise ValueError("index must be named")
    check_schema(schema)
    if transport is None and cfg.hosts[0].startswith("store:"):
        from .store import DocumentStore

        store = DocumentStore(spark, cfg.hosts[0].removeprefix("store:"))
        version = store.snapshot(cfg.index).version
        n = cfg.num_slices or store.shard_count(cfg.index)
        raw = store.query(cfg.index, cfg.query, version)
        raw = raw.coalesce(n) if raw.rdd.getNumPartitions() > n and cfg.num_slices else raw
        return typed(raw, schema, cfg)
    make = transport or connect(cfg)
    pit, n = open_snapshot(cfg, make)
    reader = IndexReader(cfg, make, pit, n)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in b.column(0).to_pylist():
                yield from reader.read(Slice(slices(n)[i]))

    raw = spark.range(n, numPartitions=n).mapInArrow(scan, RAW)
    return typed(raw, schema, cfg)


def register(spark: SparkSession) -> None:
    """Make ``docindex`` known to a session, with filter pushdown, which such readers need."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(DocIndex)
