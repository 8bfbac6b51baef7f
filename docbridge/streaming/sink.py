"""A fail-closed streaming sink, and what callers of change streams need."""

from __future__ import annotations

import logging
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import WriteConfig
from ..operators import outcome
from ..operators.sink import bulk_write

log = logging.getLogger("docbridge")

POLICIES = ("raise", "log", "ignore")


def make_foreach_batch(cfg: WriteConfig, on_batch: Callable[[dict, int], None] | None = None, on_error: str = "raise", **write: Any) -> Callable[[DataFrame, int], None]:
    """A function for ``writeStream.foreachBatch`` that writes each micro-batch.

    ``on_batch(result, batch_id)`` sees every result first.  With ``raise`` a batch that
    did not wholly succeed fails and is not committed; ``log`` warns and goes on;
    ``ignore`` goes on in silence.  An empty batch is not written.
    """
    if on_error not in POLICIES:
        raise ValueError(f"on_error must be one of {POLICIES}")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            if on_batch:
                on_batch(outcome.empty_result() | {"empty": True}, batch_id)
            return
        result = bulk_write(batch, cfg, **write)
        if on_batch:
            on_batch(result, batch_id)
        if on_error == "raise":
            outcome.reconcile_or_raise(result, index=cfg.index)
        elif on_error == "log":
            if result["overcounted"]:
                log.error("batch %d to index %r: %d more outcomes than rows", batch_id, cfg.index, result["overcounted"])
            if result["errors"] or result["unaccounted"]:
                log.warning("batch %d to index %r did not wholly succeed: %r", batch_id, cfg.index, result)

    return write_batch


def latest_per_key(changes: DataFrame, key: str, *newest: str) -> DataFrame:
    """The newest change of each key: greatest in the columns ``newest``, in their order; null is oldest.

    One partial aggregation: a hot key sends one row per task.
    """
    whole = F.struct(*(F.col(f"`{c}`") for c in changes.columns))
    top = changes.groupBy(key).agg(F.max_by(whole, F.struct(*newest)).alias("__row"))
    return top.select("__row.*")
