"""A local document store: versioned Parquet tables and bulk semantics as table algebra.

An index is a folder of immutable versions; a manifest names the current one, and a
commit is the appearance of the next manifest, so a reader that has resolved a manifest
keeps its snapshot while writers go on.  Everything goes through Spark's file system
layer: the folder may be in any store that the cluster reaches.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import WriteConfig
from ..functions.encode import documents
from ..operators import outcome
from .dsl import IGNORE_ABOVE, compile_query, keyword

STATE = "_id string, _source string"
#: As stored: the version is null where the last write carried none.
STORED = f"{STATE}, _version long"
OUTCOMES = ("_seq", "_op", "_id", "status", "outcome")
_NUMERIC = {"long": "long", "integer": "int", "short": "smallint", "byte": "tinyint", "double": "double", "float": "float"}


def source_field(name: str, source: Column | None = None, kind: str = "string") -> Column:
    """A top-level field of the document as a string, or as ``kind``."""
    quoted = name.replace("\\", "\\\\").replace("'", "\\'")
    value = F.get_json_object(F.col("_source") if source is None else source, f"$['{quoted}']")
    return value if kind == "string" else value.try_cast(kind)


def indexed_value(name: str, kind: str, source: Column | None = None) -> Column:
    """What queries see of a field: whole numbers lose their fraction, long keywords vanish."""
    value = source_field(name, source)
    if kind == "keyword":
        return keyword(value, IGNORE_ABOVE)
    if kind in ("double", "float"):
        return value.try_cast(_NUMERIC[kind])
    if kind in _NUMERIC:
        number = value.try_cast("double")
        return F.when(number >= 0, F.floor(number)).otherwise(F.ceil(number)).try_cast(_NUMERIC[kind])
    if kind == "boolean":
        return value.try_cast("boolean")
    return value


def rejected(mapping: dict[str, str], source: Column | None = None) -> Column:
    """Whether a document has a value that its mapped type can't hold."""
    out = F.lit(False)
    for name, kind in mapping.items():
        if kind in _NUMERIC or kind == "boolean":
            value = source_field(name, source)
            bad = value.isNotNull() & value.try_cast("boolean" if kind == "boolean" else "double").isNull()
            out = out | F.coalesce(bad, F.lit(False))
    return out


def apply_actions(state: DataFrame, actions: DataFrame, mapping: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The state after ``actions`` and the status of each.

    ``actions`` has _seq (their order), _op, _id and _source.  Each takes effect after
    those before it: a delete of what an earlier action made succeeds, a create of it is
    a conflict, and a rejected action (status 400) has no effect.  Returns (state,
    outcomes) with outcomes: _seq, _op, _id, status, outcome.
    """
    judged = judge_actions(state, actions, mapping)
    return settle_actions(state, judged), judged.select(*OUTCOMES)


def judge_actions(state: DataFrame, actions: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """``actions`` with the status and outcome of each."""
    known = state.select("_id").withColumn("_stored", F.lit(True))
    a = actions.withColumn("_bad", F.when(F.col("_op") == "delete", False).otherwise(rejected(mapping or {})))
    # one id's actions in order; their number is that of the retries of one document
    before = Window.partitionBy("_id").orderBy("_seq").rowsBetween(Window.unboundedPreceding, -1)
    effect = F.last(F.when(~F.col("_bad"), F.col("_op")), ignorenulls=True).over(before)
    a = a.withColumn("_last", effect).join(known, "_id", "left")
    there = F.when(F.col("_last").isNull(), F.coalesce("_stored", F.lit(False))).otherwise(F.col("_last") != "delete")
    status = (
        F.when(F.col("_bad"), 400)
        .when(F.col("_op") == "delete", F.when(there, 200).otherwise(404))
        .when(F.col("_op") == "create", F.when(there, 409).otherwise(201))
        .otherwise(F.when(there, 200).otherwise(201))
    )
    judged = a.withColumn("status", status)
    return judged.select(*actions.columns, "status", outcome.classify_column(F.col("_op"), F.col("status")).alias("outcome"))


def settle_actions(state: DataFrame, judged: DataFrame) -> DataFrame:
    """The state after judged actions."""
    return _merge(state, winners(judged.where(F.col("status") < 300)))


def winners(actions: DataFrame) -> DataFrame:
    """The last action of each id (partial aggregation: a hot id costs no more than its tasks)."""
    top = actions.groupBy("_id").agg(F.max_by(F.struct("_op", "_source"), "_seq").alias("w"))
    return top.select("_id", F.col("w._op").alias("_op"), F.col("w._source").alias("_new"))


def _merge(state: DataFrame, last: DataFrame) -> DataFrame:
    both = state.join(last, "_id", "full_outer")
    version = [F.when(F.col("_op").isNull(), F.col("_version")).alias("_version")] if "_version" in state.columns else []
    return both.where(F.coalesce(F.col("_op") != "delete", F.lit(True))).select("_id", F.when(F.col("_op").isNotNull(), F.col("_new")).otherwise(F.col("_source")).alias("_source"), *version)


def upsert(state: DataFrame, actions: DataFrame) -> DataFrame:
    """State after actions of op index alone: last write wins, no window needed."""
    return _merge(state, winners(actions))


def create(state: DataFrame, actions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Append-only: the first action of an unknown id is written, all others are conflicts."""
    judged = judge_creates(state, actions)
    return settle_creates(state, judged), judged.select(*OUTCOMES)


def judge_creates(state: DataFrame, actions: DataFrame, _: dict[str, str] | None = None) -> DataFrame:
    fresh = actions.groupBy("_id").agg(F.min("_seq").alias("_first")).join(state.select("_id"), "_id", "left_anti")
    known = actions.join(fresh, "_id", "left")
    status = F.when(F.coalesce(F.col("_first") == F.col("_seq"), F.lit(False)), 201).otherwise(409)
    return known.withColumn("status", status).select(*actions.columns, "status", outcome.classify_column(F.col("_op"), F.col("status")).alias("outcome"))


def settle_creates(state: DataFrame, judged: DataFrame) -> DataFrame:
    return state.unionByName(judged.where(F.col("status") == 201).select("_id", "_source"), allowMissingColumns=True)


def apply_versions(state: DataFrame, actions: DataFrame, mapping: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The state after writes that carry a version, and the status of each.

    ``state`` and ``actions`` have _version.  A write older than what the document then
    holds is a conflict (409) that is ignored; an equal version is written, so that a
    batch may be sent again.  Returns (state, outcomes) as ``apply_actions`` does.
    """
    judged = judge_versions(state, actions, mapping)
    return settle_versions(state, judged), judged.select(*OUTCOMES)


def judge_versions(state: DataFrame, actions: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    known = state.select("_id", F.col("_version").alias("_stored"), F.lit(True).alias("_known"))
    a = actions.withColumn("_bad", rejected(mapping or {}))
    before = Window.partitionBy("_id").orderBy("_seq").rowsBetween(Window.unboundedPreceding, -1)
    newest = F.max(F.when(~F.col("_bad"), F.col("_version"))).over(before)
    a = a.withColumn("_newest", newest).join(known, "_id", "left")
    held = F.greatest("_newest", "_stored")  # null only if both are
    there = F.col("_newest").isNotNull() | F.col("_known").isNotNull()
    status = F.when(F.col("_bad"), 400).when(F.col("_version") < held, 409).otherwise(F.when(there, 200).otherwise(201))
    judged = a.withColumn("status", status)
    result = F.when(F.col("status") == 409, outcome.IGNORED).otherwise(outcome.classify_column(F.col("_op"), F.col("status")))
    return judged.select(*actions.columns, "status", result.alias("outcome"))


def settle_versions(state: DataFrame, judged: DataFrame) -> DataFrame:
    top = judged.where(F.col("status") < 300).groupBy("_id").agg(F.max_by(F.struct("_source", "_version"), F.struct("_version", "_seq")).alias("w"))
    both = state.select("_id", F.struct("_source", "_version").alias("_old")).join(top, "_id", "full_outer")
    now = F.coalesce("w", "_old")
    return both.select("_id", now["_source"].alias("_source"), now["_version"].alias("_version"))


def versioned_upsert(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """_id and outcome of writes that carry a version: one that is older than the stored is a conflict."""
    new = incoming.groupBy("_id").agg(F.max("_version").alias("_version"))
    old = stored.groupBy("_id").agg(F.max("_version").alias("_stored"))
    return new.join(old, "_id", "left").select("_id", F.when(F.col("_stored").isNull() | (F.col("_version") >= F.col("_stored")), outcome.WRITTEN).otherwise("conflict").alias("outcome"))


@dataclass(frozen=True)
class Snapshot:
    """A resolved version: its files never change."""

    index: str
    version: int
    path: str
    mapping: dict


class DocumentStore:
    """Indexes under one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.jvm = spark.sparkContext._jvm
        self.fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, p: str) -> Any:
        return self.jvm.org.apache.hadoop.fs.Path(p)

    def _read(self, p: str) -> dict:
        stream = self.fs.open(self._path(p))
        try:
            return json.loads(bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def _write(self, p: str, value: dict) -> bool:
        """Write a small file under a new name; False if the name is taken."""
        draft = f"{self.root}/.draft-{uuid.uuid4().hex}"
        stream = self.fs.create(self._path(draft), False)
        stream.write(bytearray(json.dumps(value).encode()))
        stream.close()
        if self.fs.exists(self._path(p)) or not self.fs.rename(self._path(draft), self._path(p)):
            self.fs.delete(self._path(draft), False)
            return False
        return True

    def _manifests(self, index: str) -> list[int]:
        folder = self._path(f"{self.root}/{index}/manifests")
        if not self.fs.exists(folder):
            return []
        return sorted(int(s.getPath().getName().removesuffix(".json")) for s in self.fs.listStatus(folder) if s.getPath().getName().endswith(".json"))

    def exists(self, index: str) -> bool:
        return bool(self._manifests(index))

    def create_index(self, index: str, mapping: dict[str, str] | None = None, shards: int = 1) -> None:
        if self.exists(index):
            raise ValueError(f"index {index!r} exists")
        self.fs.mkdirs(self._path(f"{self.root}/{index}/manifests"))
        self._commit(index, 0, self.spark.createDataFrame([], STORED), {"mapping": mapping or {}, "shards": shards})

    def _commit(self, index: str, version: int, state: DataFrame, meta: dict) -> None:
        path = f"{self.root}/{index}/data-{version}-{uuid.uuid4().hex[:8]}"
        state.select("_id", "_source", F.col("_version") if "_version" in state.columns else F.lit(None).cast("long").alias("_version")).write.parquet(path)
        if not self._write(f"{self.root}/{index}/manifests/{version}.json", meta | {"path": path}):
            self.fs.delete(self._path(path), True)
            raise RuntimeError(f"index {index!r}: another writer committed version {version} first")

    def snapshot(self, index: str, version: int | None = None) -> Snapshot:
        """The current version, or a given one."""
        versions = self._manifests(index)
        if not versions:
            raise ValueError(f"index {index!r} does not exist")
        v = versions[-1] if version is None else version
        meta = self._read(f"{self.root}/{index}/manifests/{v}.json")
        return Snapshot(index, v, meta["path"], meta["mapping"])

    def shard_count(self, index: str) -> int:
        return self._read(f"{self.root}/{index}/manifests/{self._manifests(index)[-1]}.json")["shards"]

    def state(self, index: str, version: int | None = None) -> DataFrame:
        return self._stored(index, version).select("_id", "_source")

    def _stored(self, index: str, version: int | None = None) -> DataFrame:
        return self.spark.read.schema(STORED).parquet(self.snapshot(index, version).path)

    def write(self, df: DataFrame, cfg: WriteConfig) -> dict:
        """Apply the rows of ``df`` as actions, commit, and account for each."""
        if not self.exists(cfg.index):
            self.create_index(cfg.index)
        now = self.snapshot(cfg.index)
        meta = self._read(f"{self.root}/{cfg.index}/manifests/{now.version}.json")
        version = now.version + 1
        staged = f"{self.root}/{cfg.index}/actions-{version}-{uuid.uuid4().hex[:8]}"
        # written once: ids of chance and the order of rows must not change between uses
        rows = documents(df, cfg).withColumn("_seq", F.monotonically_increasing_id())
        rows.write.parquet(staged)
        actions = self.spark.read.schema(rows.schema).parquet(staged)
        try:
            if not actions.where("_id is null").isEmpty():
                raise ValueError(f"rows have no usable value in id column {cfg.id_field!r}; nothing was written")
            if cfg.version_field and not actions.where("_version is null").isEmpty():
                raise ValueError(f"rows have no usable value in version column {cfg.version_field!r}; nothing was written")
            state = self._stored(cfg.index)
            if cfg.version_field:
                judge, settle = judge_versions, settle_versions
            elif cfg.op_type == "create" and not now.mapping:
                judge, settle = judge_creates, settle_creates
            else:
                judge, settle = judge_actions, settle_actions
            # judged once: the counts, the samples and the new state read the verdicts
            verdicts = judge(state, actions, now.mapping)
            verdicts.write.parquet(f"{staged}-judged")
            outcomes = self.spark.read.schema(verdicts.schema).parquet(f"{staged}-judged")
            counts = {r["outcome"]: r["n"] for r in outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n")).collect()}
            samples = [outcome.error_sample(r["_op"], r["status"], {"_id": r["_id"], "error": {"reason": "a value does not fit its mapped type"}}) for r in outcomes.where(F.col("outcome") == outcome.ERROR).orderBy("_seq").limit(outcome.SAMPLE_CAP).collect()]
            total = actions.count()
            self._commit(cfg.index, version, settle(state, outcomes), {"mapping": meta["mapping"], "shards": meta["shards"]})
        finally:
            for path in (staged, f"{staged}-judged"):
                self.fs.delete(self._path(path), True)
        row = {"total_input": total, "written": counts.get(outcome.WRITTEN, 0), "deleted": counts.get(outcome.DELETED, 0), "ignored": counts.get(outcome.IGNORED, 0), "errors": counts.get(outcome.ERROR, 0), "error_samples": json.dumps(samples)}
        return outcome.merge([row])

    def query(self, index: str, query: dict | None, version: int | None = None) -> DataFrame:
        """Documents whose indexed values match."""
        snap = self.snapshot(index, version)

        return self.state(index, snap.version).where(compile_query(query, IndexedFields(snap.mapping), F.col("_id")))


class IndexedFields:
    """The columns of an index's fields: as mapped, else as text."""

    def __init__(self, mapping: dict[str, str]):
        self.mapping = mapping

    def __call__(self, name: str) -> Column:
        base = name.removesuffix(".keyword")
        if name != base:
            return indexed_value(base, "keyword")
        return indexed_value(name, self.mapping[name]) if name in self.mapping else source_field(name)

    def like(self, name: str, value: Any) -> Column:
        """The field for a comparison with ``value``: text that is no such value compares as null, it is no error."""
        c = self(name)
        if self.mapping.get(name) in (*_NUMERIC, "boolean") or isinstance(value, str):
            return c
        if isinstance(value, bool):
            return c.try_cast("boolean")
        return c.try_cast("decimal(38,6)" if isinstance(value, int) and abs(value) >= 1 << 53 else "double")
