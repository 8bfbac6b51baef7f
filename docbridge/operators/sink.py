"""The sink: check, encode, ship or apply, account."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType

from ..config import WriteConfig
from ..functions.encode import action_lines, stringify_hostile, timestamps_to_millis
from ..sources.transport import Transport, connect
from . import outcome
from .ship import STAT_NAMES, partition_writer, summary_schema

#: Settings that name columns; each must be checked before a row is written.
COLUMN_SETTINGS = ("id_field", "drop_fields", "delete_flag_column", "version_field")


def check_columns(df: DataFrame, cfg: WriteConfig) -> None:
    """Refuse settings that name columns which are not there, or a flag that is not boolean."""
    have = set(df.columns)
    for name in COLUMN_SETTINGS:
        value = getattr(cfg, name)
        if name == "drop_fields" and not cfg.strict_drop_fields:
            continue
        missing = [v for v in ((value,) if isinstance(value, str) else value or ()) if v not in have]
        if missing:
            raise ValueError(f"{name} names {missing}, which the data does not have (columns: {df.columns})")
    if cfg.has_deletes and not isinstance(df.schema[cfg.delete_flag_column].dataType, BooleanType):
        raise TypeError(f"delete_flag_column {cfg.delete_flag_column!r} must be boolean, not {df.schema[cfg.delete_flag_column].dataType.simpleString()}")


def bulk_write(df: DataFrame, cfg: WriteConfig, *, raise_on_error: bool = False, transport: Callable[[], Transport] | None = None) -> dict:
    """Write every row of ``df`` and say exactly what became of it.

    Hosts of the form ``store:<folder>`` are a local document store, to which the rows
    are applied as a table operation; others are reached by executors over HTTP, or
    through ``transport``, a picklable function that makes a connection.
    """
    local = transport is None and cfg.hosts[0].startswith("store:")
    if local:
        from ..sources.store import DocumentStore

        store = DocumentStore(df.sparkSession, cfg.hosts[0].removeprefix("store:"))
        check_columns(df, cfg)
        if cfg.require_existing_index and not store.exists(cfg.index):
            raise ValueError(f"index {cfg.index!r} does not exist")
        result = store.write(df, cfg)
    else:
        make = transport or connect(cfg)
        df = timestamps_to_millis(stringify_hostile(df))
        check_columns(df, cfg)
        if cfg.require_existing_index:
            client = make()
            try:
                if not client.index_exists(cfg.index):
                    raise ValueError(f"index {cfg.index!r} does not exist")
            finally:
                client.close()
        began = time.perf_counter()
        rows = action_lines(df, cfg).mapInArrow(partition_writer(cfg, make), summary_schema(cfg)).collect()  # a row for each partition
        ended = time.perf_counter()
        result = outcome.merge(rows, STAT_NAMES)
        if cfg.bulk_stats:
            result |= {"collect_ms": (ended - began) * 1e3, "merge_ms": (time.perf_counter() - ended) * 1e3}
    return outcome.reconcile_or_raise(result, index=cfg.index) if raise_on_error else result
