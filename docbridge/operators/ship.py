"""Executors ship action lines in chunks and account for every one of them."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa

from ..config import WriteConfig
from ..sources.transport import Transport, TransportTimeout
from .outcome import COUNTS, DELETED, DIAGNOSTICS, ERROR, IGNORED, REASON_LENGTH, SAMPLE_CAP, WRITTEN, bucket, error_sample, read_items

#: Longest pause between two attempts, in seconds.
LONGEST_PAUSE = 30
_COUNTED = {WRITTEN: "written", DELETED: "deleted", IGNORED: "ignored", ERROR: "errors"}

_TIMED = ("rtt_ms", "http_ms", "took_ms")
#: Summary columns with their types; the second part only with ``bulk_stats``.
SUMMARY = [*((n, "long") for n in COUNTS), ("error_samples", "string")]
STATS = [
    ("n_sends", "long"), ("docs_sent", "long"), ("bytes_sent", "long"), ("send_busy_ms", "double"), ("send_cpu_ms", "double"), ("partition_wall_ms", "double"),
    ("timeout_sends", "long"), ("timeout_wait_ms", "double"), ("error_sends", "long"), ("error_wait_ms", "double"),
    *((n, "long") for n in DIAGNOSTICS),
    *((f"{t}_{s}", "double") for t in _TIMED for s in ("mean", "p50", "p95", "max")),
    *((f"gil_wait_ms_{s}", "double") for s in ("total", "p50", "p95", "max")), ("gil_wait_samples", "long"),
]
STAT_NAMES = tuple(n for n, _ in STATS)


def summary_schema(cfg: WriteConfig) -> str:
    return ", ".join(f"{n} {t}" for n, t in SUMMARY + STATS * cfg.bulk_stats)


@dataclass
class Send:
    """One request: what it carried, how long it took, how it ended."""

    docs: int
    size: int
    rtt_ms: float
    cpu_ms: float
    outcome: str = "ok"
    took_ms: float | None = None
    http_ms: float | None = None


@dataclass
class Account:
    """What became of some lines; private to its owner until merged."""

    counts: dict[str, int] = field(default_factory=lambda: dict.fromkeys(_COUNTED.values(), 0))
    samples: list[dict] = field(default_factory=list)
    sends: list[Send] = field(default_factory=list)
    diagnostics: dict[str, int] = field(default_factory=lambda: dict.fromkeys(DIAGNOSTICS, 0))

    def add(self, other: Account) -> None:
        for mine, theirs in ((self.counts, other.counts), (self.diagnostics, other.diagnostics)):
            for k, v in theirs.items():
                mine[k] += v
        self.samples += other.samples[: SAMPLE_CAP - len(self.samples)]
        self.sends += other.sends

    def fail(self, n: int, fault: Exception) -> None:
        """A whole request failed: all its lines are errors, with one sample."""
        self.counts["errors"] += n
        if len(self.samples) < SAMPLE_CAP:
            self.samples.append({"_id": None, "op_type": "bulk", "status": None, "reason": f"{type(fault).__name__}: {fault}"[:REASON_LENGTH]})


def pause(attempt: int) -> float:
    return min(2**attempt, LONGEST_PAUSE)


def _rest(transport: Transport, attempt: int) -> None:
    """Pause before the next attempt; a stand-in may keep a clock of its own."""
    getattr(transport, "wait", time.sleep)(pause(attempt))


def _request(transport: Transport, cfg: WriteConfig, lines: list[str], account: Account, brief: bool) -> dict:
    """One request, sent again after a timeout if the settings say that the writer does so."""
    for attempt in range(cfg.transport_max_retries + 1):
        start, cpu = time.perf_counter(), time.thread_time()

        def spent(outcome: str, since: float = start, cpu_since: float = cpu, **more: Any) -> None:
            if cfg.bulk_stats:
                account.sends.append(Send(len(lines), sum(map(len, lines)), (time.perf_counter() - since) * 1e3, (time.thread_time() - cpu_since) * 1e3, outcome, **more))

        try:
            response = transport.bulk(lines, ("errors,took" if cfg.bulk_stats else "errors") if brief else None)
        except TransportTimeout:
            spent("timeout")
            if not cfg.retry_transport_timeout or attempt == cfg.transport_max_retries:
                raise
            _rest(transport, attempt + 1)
        except Exception:
            spent("error")
            raise
        else:
            spent("ok", took_ms=response.get("took"), http_ms=response.get("_http_ms"))
            return response
    raise AssertionError


def ship_chunk(transport: Transport, cfg: WriteConfig, lines: list[str]) -> Account:
    """Send one chunk, retry its refused documents, and account for each line.

    The brief way asks only whether anything failed; unless the answer is a plain no,
    the same chunk goes again in full and is judged item by item.  Deletes, creates
    (whose second send would find its own first) and settings that say so go in full at
    once.
    """
    account = Account()
    try:
        if not (cfg.has_deletes or cfg.bypass_fast_path or cfg.op_type == "create"):
            if _request(transport, cfg, lines, account, brief=True).get("errors") is False:
                account.counts["written"] += len(lines)
                return account
        pending, attempt = list(lines), 0
        while pending:
            try:
                response = _request(transport, cfg, pending, account, brief=False)
            except Exception as fault:  # noqa: BLE001  every line must have an outcome
                account.fail(len(pending), fault)
                return account
            again = []
            results = list(read_items(response.get("items") or []))
            for line, (op, status, body, outcome) in zip(pending, results):
                if cfg.version_field and status == 409:
                    outcome = IGNORED  # the index holds a newer version
                    account.diagnostics["rejected_409"] += 1
                if outcome == ERROR:
                    account.diagnostics[bucket(status)] += 1
                    if status in cfg.retry_on_doc_status and attempt < cfg.max_retries_per_doc:
                        again.append(line)
                        continue
                    if len(account.samples) < SAMPLE_CAP:
                        account.samples.append(error_sample(op, status, body))
                elif outcome == IGNORED and op == "create":
                    account.diagnostics["docs_deduped"] += 1
                account.counts[_COUNTED[outcome]] += 1
            # lines beyond the items of the response stay without an outcome: reconciliation shows them
            pending = again
            if pending:
                attempt += 1
                account.diagnostics["docs_retried"] += len(pending)
                _rest(transport, attempt)
    except Exception as fault:  # noqa: BLE001
        account.fail(len(lines), fault)
    return account


class Pipeline:
    """At most ``write_concurrency`` chunks in flight, across Arrow batches; closed without loss."""

    def __init__(self, transport: Transport, cfg: WriteConfig):
        self.transport, self.cfg, self.account = transport, cfg, Account()
        self.pool = ThreadPoolExecutor(cfg.write_concurrency) if cfg.write_concurrency > 1 else None
        self.flying: set[Future] = set()

    def feed(self, lines: list[str]) -> None:
        if self.pool is None:
            self.account.add(ship_chunk(self.transport, self.cfg, lines))
            return
        while len(self.flying) >= self.cfg.write_concurrency:
            self._land(FIRST_COMPLETED)
        self.flying.add(self.pool.submit(ship_chunk, self.transport, self.cfg, lines))

    def _land(self, when: str) -> None:
        done, self.flying = wait(self.flying, return_when=when)
        for f in done:
            self.account.add(f.result())  # raises what a worker raised

    def close(self) -> Account:
        while self.flying:
            self._land(FIRST_COMPLETED)
        return self.account

    def stop(self) -> None:
        if self.pool is not None:
            self.pool.shutdown(wait=True, cancel_futures=True)


def chunks(lines: Iterator[str], count: int, size: int) -> Iterator[list[str]]:
    """Lines in lists of at most ``count`` lines and, unless a single line is longer, ``size`` bytes."""
    held: list[str] = []
    weight = 0
    for line in lines:
        n = len(line.encode()) + 1
        if held and (len(held) >= count or weight + n > size):
            yield held
            held, weight = [], 0
        held.append(line)
        weight += n
    if held:
        yield held


class LockWaitProbe:
    """Samples how long a thread that is due must wait for the interpreter lock."""

    STEP = 0.005

    def __init__(self) -> None:
        self.waits: list[float] = []
        self._stop = threading.Event()
        self._thread = threading.Thread(target=self._run, daemon=True)
        self._thread.start()

    def _run(self) -> None:
        while not self._stop.is_set():
            start = time.perf_counter()
            time.sleep(self.STEP)
            self.waits.append(max(0.0, (time.perf_counter() - start - self.STEP) * 1e3))

    def close(self) -> list[float]:
        self._stop.set()
        self._thread.join(1)
        return self.waits


def percentile(values: list[float], q: float) -> float | None:
    """Percentile with linear interpolation, None of nothing."""
    if not values:
        return None
    v = sorted(values)
    at = (len(v) - 1) * q / 100
    lo = int(at)
    hi = min(lo + 1, len(v) - 1)
    return float(v[lo] + (v[hi] - v[lo]) * (at - lo))


def spread(name: str, values: list[float], *, total: bool = False) -> dict[str, float | None]:
    out = {f"{name}_total": float(sum(values))} if total else {f"{name}_mean": sum(values) / len(values) if values else None}
    return out | {f"{name}_p50": percentile(values, 50), f"{name}_p95": percentile(values, 95), f"{name}_max": float(max(values)) if values else None}


def stats_of(sends: list[Send]) -> dict[str, Any]:
    """Summary columns of a partition's requests; failed ones count apart, with the time they cost."""
    ok = [s for s in sends if s.outcome == "ok"]
    out: dict[str, Any] = {"n_sends": len(ok), "docs_sent": sum(s.docs for s in ok), "bytes_sent": sum(s.size for s in ok), "send_busy_ms": float(sum(s.rtt_ms for s in ok)), "send_cpu_ms": float(sum(s.cpu_ms for s in ok))}
    for kind in ("timeout", "error"):
        bad = [s.rtt_ms for s in sends if s.outcome == kind]
        out |= {f"{kind}_sends": len(bad), f"{kind}_wait_ms": float(sum(bad))}
    for name in _TIMED:
        out |= spread(name, [v for s in ok if (v := getattr(s, name)) is not None])
    return out


def partition_writer(cfg: WriteConfig, connect: Callable[[], Transport]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function that ships a partition of action lines and yields one summary row."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        began, total = time.perf_counter(), 0

        def lines() -> Iterator[str]:
            nonlocal total
            for b in batches:
                col = b.column(0)
                if col.null_count:
                    raise ValueError(f"{col.null_count} rows have no usable value in id column {cfg.id_field!r}{f' or version column {cfg.version_field!r}' if cfg.version_field else ''}; refusing to write them under ids of chance")
                total += len(col)
                yield from col.to_pylist()

        transport = connect()
        probe = LockWaitProbe() if cfg.bulk_stats else None
        pipeline = Pipeline(transport, cfg)
        try:
            for chunk in chunks(lines(), cfg.chunk_size, cfg.chunk_bytes):
                pipeline.feed(chunk)
            account = pipeline.close()
        finally:
            pipeline.stop()
            waits = probe.close() if probe else []
            transport.close()
        row: dict[str, Any] = {**account.counts, "coerced_nonfinite": 0, "total_input": total, "error_samples": json.dumps(account.samples)}
        if cfg.bulk_stats:
            row |= stats_of(account.sends) | account.diagnostics | spread("gil_wait_ms", waits, total=True)
            row |= {"gil_wait_samples": len(waits), "partition_wall_ms": (time.perf_counter() - began) * 1e3}
        kinds = {"long": pa.int64(), "double": pa.float64(), "string": pa.string()}
        columns = SUMMARY + STATS * cfg.bulk_stats
        yield pa.RecordBatch.from_arrays([pa.array([row[n]], kinds[t]) for n, t in columns], [n for n, _ in columns])

    return write
