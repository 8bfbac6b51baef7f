"""Outcomes of single documents, and exact accounting of whole writes.

Each rule exists twice: as a Column expression for data and as a scalar for the writer.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Iterable, Iterator
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

log = logging.getLogger("docbridge")

WRITTEN, DELETED, IGNORED, ERROR = "written", "deleted", "ignored", "error"
#: Error samples kept for a result, and the length of a reason.
SAMPLE_CAP, REASON_LENGTH = 20, 300
#: Names of the diagnostic counters.
DIAGNOSTICS = ("docs_retried", "rejected_429", "rejected_409", "rejected_4xx_other", "rejected_5xx", "docs_deduped")
COUNTS = ("written", "deleted", "errors", "ignored", "coerced_nonfinite", "total_input")


def classify(op: str, status: int) -> str:
    """What one response item means; deleting the absent and creating the present are no-ops."""
    if 200 <= status < 300:
        return DELETED if op == "delete" else WRITTEN
    if (op, status) in (("delete", 404), ("create", 409)):
        return IGNORED
    return ERROR


def classify_column(op: Column, status: Column) -> Column:
    ok = status.between(200, 299)
    no_op = ((op == "delete") & (status == 404)) | ((op == "create") & (status == 409))
    return F.when(ok, F.when(op == "delete", DELETED).otherwise(WRITTEN)).when(no_op, IGNORED).otherwise(ERROR)


def bucket(status: int) -> str:
    """The counter of a rejection: backpressure, conflict, other fault of the request, fault of the server."""
    if status in (429, 409):
        return f"rejected_{status}"
    return "rejected_4xx_other" if 400 <= status < 500 else "rejected_5xx"


def bucket_column(status: Column) -> Column:
    return (
        F.when(status.isin(429, 409), F.concat(F.lit("rejected_"), status.cast("string")))
        .when(status.between(400, 499), "rejected_4xx_other")
        .otherwise("rejected_5xx")
    )


def read_items(items: Iterable[dict]) -> Iterator[tuple[str, int, dict, str]]:
    """op, status, body and outcome of each response item; a missing status counts as 500."""
    for item in items:
        op, body = next(iter(item.items()), ("", {})) if isinstance(item, dict) else ("", {})
        body = body if isinstance(body, dict) else {}
        status = int(body.get("status") or 500)
        yield op, status, body, classify(op, status)


def error_sample(op: str | None, status: int | None, body: dict) -> dict:
    """A bounded, actionable description of one failure."""
    fault = body.get("error")
    reason = (fault.get("reason") or fault.get("type") or str(fault)) if isinstance(fault, dict) else str(fault or "")
    return {"_id": body.get("_id"), "op_type": op, "status": status, "reason": str(reason)[:REASON_LENGTH]}


def with_discrepancies(parts: DataFrame) -> DataFrame:
    """Per partition summary, what lacks an outcome and what has one too many.

    The two are never set off against each other, within a sum or across partitions.
    """
    delta = F.col("total_input") - F.col("written") - F.col("deleted") - F.col("ignored") - F.col("errors")
    return parts.withColumns({"unaccounted": F.greatest(delta, F.lit(0)), "overcounted": F.greatest(-delta, F.lit(0))})


def totals(parts: DataFrame) -> DataFrame:
    """One row: the counts of all partitions, discrepancies kept apart by sign."""
    names = ("total_input", "written", "deleted", "ignored", "errors", "unaccounted", "overcounted")
    return with_discrepancies(parts).agg(*(F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in names))


def merge(rows: Iterable[Any], stat_names: tuple[str, ...] = ()) -> dict:
    """The result of a write from its partitions' summary rows (mappings or Spark rows)."""
    out: dict[str, Any] = dict.fromkeys((*COUNTS, "unaccounted", "overcounted"), 0)
    samples: list = []
    stats: list[dict] = []
    for row in rows:
        r = row.asDict() if hasattr(row, "asDict") else dict(row)
        for name in COUNTS:
            out[name] += int(r.get(name) or 0)
        delta = int(r.get("total_input") or 0) - sum(int(r.get(n) or 0) for n in ("written", "deleted", "errors", "ignored"))
        out["unaccounted" if delta > 0 else "overcounted"] += abs(delta)
        if r.get("error_samples") and len(samples) < SAMPLE_CAP:
            samples += json.loads(r["error_samples"])
        if "n_sends" in r:
            stats.append({n: r.get(n) for n in stat_names})
    out["error_samples"] = samples[:SAMPLE_CAP]
    if stats:
        out["bulk_stats"] = stats
    return out


def empty_result() -> dict:
    return merge([])


class WriteError(RuntimeError):
    """A write that did not wholly succeed; ``result`` holds its counts and samples."""

    def __init__(self, message: str, result: dict):
        super().__init__(message)
        self.result = result


def reconcile_or_raise(result: dict, *, index: str = "") -> dict:
    """The result itself if every row has a good outcome, else a ``WriteError``.

    More outcomes than rows can only be a fault of this library: it is logged, never
    raised, and never hides a loss.
    """
    errors, lost, over = (int(result.get(n) or 0) for n in ("errors", "unaccounted", "overcounted"))
    if lost < 0:  # results of the older shape carry one signed number
        lost, over = 0, over - lost
    if over:
        log.error("index %r: %d more outcomes than rows; an accounting fault, not one of the data: %r", index, over, result)
    faults = [f"{errors} documents rejected"] * bool(errors) + [f"{lost} rows without an outcome"] * bool(lost)
    if not faults:
        return result
    shown = (result.get("error_samples") or [])[:3]
    counts = ", ".join(f"{n}={result.get(n)}" for n in ("total_input", "written", "deleted", "ignored"))
    raise WriteError(f"write to index {index!r}: {' and '.join(faults)} ({counts}){f'; first: {shown}' if shown else ''}", result)
