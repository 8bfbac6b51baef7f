"""The wire behind an interface: a bulk request, point-in-time searches, index checks."""

from __future__ import annotations

import base64
import functools
import gzip
import http.client
import json
import ssl
import threading
import time
from collections.abc import Callable
from typing import Any, Protocol
from urllib.parse import quote, urlsplit

from ..config import Connection


#: Connections to a node where the settings name none.
CONNECTIONS = 10


class TransportTimeout(Exception):
    """No answer in time: whether the request took effect is unknown."""


class TransportError(Exception):
    """The request failed as a whole."""


class Transport(Protocol):
    def bulk(self, lines: list[str], filter_path: str | None = None) -> dict: ...
    def index_exists(self, index: str) -> bool: ...
    def shard_count(self, index: str) -> int: ...
    def open_pit(self, index: str, keep_alive: str) -> str: ...
    def search(self, body: dict) -> dict: ...
    def close(self) -> None: ...


def gzip_body(lines: list[str]) -> bytes:
    return gzip.compress(("\n".join(lines) + "\n").encode(), 6, mtime=0)


class HttpTransport:
    """Newline-delimited JSON over HTTP; a connection for each thread, hosts in turn."""

    def __init__(self, cfg: Connection):
        self.cfg = cfg
        self.local = threading.local()
        self.turn = 0
        #: As many requests at once as the settings give a node connections.
        self.slots = threading.BoundedSemaphore(cfg.client_kwargs().get("connections_per_node", CONNECTIONS))

    def _connection(self) -> http.client.HTTPConnection:
        if getattr(self.local, "connection", None) is None:
            host = urlsplit(self.cfg.hosts[self.turn % len(self.cfg.hosts)])
            self.turn += 1
            if host.scheme == "https":
                context = ssl.create_default_context(cafile=self.cfg.ca_certs)
                if not self.cfg.verify_certs:
                    context.check_hostname, context.verify_mode = False, ssl.CERT_NONE
                self.local.connection = http.client.HTTPSConnection(host.hostname, host.port, timeout=self.cfg.request_timeout, context=context)
            else:
                self.local.connection = http.client.HTTPConnection(host.hostname, host.port, timeout=self.cfg.request_timeout)
        return self.local.connection

    def _headers(self, kind: str | None) -> dict[str, str]:
        out = {"Accept": "application/json"}
        if self.cfg.api_key:
            out["Authorization"] = f"ApiKey {self.cfg.api_key}"
        elif self.cfg.basic_auth:
            out["Authorization"] = "Basic " + base64.b64encode(":".join(self.cfg.basic_auth).encode()).decode()
        if kind:
            out["Content-Type"] = kind
        if self.cfg.http_compress:
            out["Accept-Encoding"] = "gzip"
            if kind:
                out["Content-Encoding"] = "gzip"
        return out

    def _call(self, method: str, path: str, body: bytes | None = None, kind: str | None = None) -> tuple[int, dict, float]:
        retry = self.cfg.client_kwargs()["retry_on_timeout"]
        if body is not None and self.cfg.http_compress:
            body = gzip.compress(body, 6, mtime=0)
        for attempt in range(self.cfg.transport_max_retries + 1):
            last = attempt == self.cfg.transport_max_retries
            start = time.perf_counter()
            try:
                with self.slots:
                    c = self._connection()
                    c.request(method, path, body, self._headers(kind if body is not None else None))
                    r = c.getresponse()
                    data = r.read()
            except TimeoutError as e:
                self._drop()
                if last or not retry:
                    raise TransportTimeout(str(e)) from e
                continue
            except (OSError, http.client.HTTPException) as e:
                self._drop()
                if last:
                    raise TransportError(f"{type(e).__name__}: {e}") from e
                continue
            spent = (time.perf_counter() - start) * 1e3
            if r.status in (502, 503, 504) and not last:
                continue
            if r.headers.get("Content-Encoding") == "gzip":
                data = gzip.decompress(data)
            return r.status, json.loads(data) if data.strip() else {}, spent
        raise AssertionError

    def _drop(self) -> None:
        if getattr(self.local, "connection", None) is not None:
            self.local.connection.close()
            self.local.connection = None

    def _ok(self, status: int, out: dict) -> dict:
        if not 200 <= status < 300:
            raise TransportError(f"status {status}: {json.dumps(out)[:300]}")
        return out

    def bulk(self, lines: list[str], filter_path: str | None = None) -> dict:
        path = "/_bulk" + (f"?filter_path={filter_path}" if filter_path else "")
        status, out, spent = self._call("POST", path, ("\n".join(lines) + "\n").encode(), "application/x-ndjson")
        return self._ok(status, out) | {"_http_ms": spent}

    def index_exists(self, index: str) -> bool:
        status, out, _ = self._call("HEAD", f"/{quote(index, safe='')}")
        if status not in (200, 404):
            self._ok(status, out)
        return status == 200

    def shard_count(self, index: str) -> int:
        status, out, _ = self._call("GET", f"/{quote(index, safe='')}/_settings")
        return sum(int(v["settings"]["index"]["number_of_shards"]) for v in self._ok(status, out).values())

    def open_pit(self, index: str, keep_alive: str) -> str:
        status, out, _ = self._call("POST", f"/{quote(index, safe='')}/_pit?keep_alive={keep_alive}")
        return self._ok(status, out)["id"]

    def search(self, body: dict) -> dict:
        status, out, _ = self._call("POST", "/_search", json.dumps(body).encode(), "application/json")
        return self._ok(status, out)

    def close(self) -> None:
        self._drop()


def connect(cfg: Connection) -> Callable[[], Transport]:
    """A picklable maker of connections for the hosts of ``cfg``."""
    return functools.partial(HttpTransport, cfg)


class ScriptedTransport:
    """A programmable stand-in: documents in memory, faults and delays on request.

    ``script(n, actions)`` is called with the request's number and its parsed actions
    ``(op, id, source)``.  It may raise, return a list of statuses (None: as the store
    would answer), or a whole response; returning None leaves the request alone.
    ``clock`` passes the writer's pauses instead of sleeping.  ``deal(place, id)`` is a
    document's number, whose remainder is its slice.  Searches see all documents: the
    query is not looked at.
    """

    def __init__(self, script: Callable[[int, list[tuple]], Any] | None = None, latency: float = 0.0, indexes: tuple[str, ...] = ("docs",), clock: Callable[[float], None] | None = None, deal: Callable[[int, str], int] | None = None):
        self.script, self.latency, self.indexes = script, latency, set(indexes)
        if clock:
            self.wait = clock
        self.deal = deal or (lambda place, _: place)
        self.documents: dict[str, dict] = {}
        self.versions: dict[str, int] = {}
        self.requests: list[tuple[int, str | None]] = []
        self.flying = self.most_flying = 0
        self.closed = False
        self.lock = threading.Lock()
        self.ids = 0

    def bulk(self, lines: list[str], filter_path: str | None = None) -> dict:
        actions: list[tuple] = []
        versions: list[int | None] = []
        for line in lines:
            head, _, doc = line.partition("\n")
            ((op, meta),) = json.loads(head).items()
            actions.append((op, meta.get("_id"), json.loads(doc) if doc else None))
            versions.append(meta.get("version"))
        with self.lock:
            n = len(self.requests)
            self.requests.append((len(lines), filter_path))
            self.flying += 1
            self.most_flying = max(self.most_flying, self.flying)
        try:
            if self.latency:
                time.sleep(self.latency)
            said = self.script(n, actions) if self.script else None
            if isinstance(said, dict):
                return said
            with self.lock:
                items = [self._apply(op, i, doc, status, v) for (op, i, doc), status, v in zip(actions, said or [None] * len(actions), versions)]
        finally:
            with self.lock:
                self.flying -= 1
        errors = any(next(iter(x.values()))["status"] >= 300 for x in items)
        whole = {"took": 1, "errors": errors, "items": items}
        return {k: whole[k] for k in (filter_path or "took,errors,items").split(",")}

    def _apply(self, op: str, key: str | None, doc: dict | None, status: int | None, version: int | None = None) -> dict:
        if key is None:
            self.ids += 1
            key = f"auto-{self.ids}"
        if status is None:
            there = key in self.documents
            stale = version is not None and version < self.versions.get(key, version)
            status = (200 if there else 404) if op == "delete" else 409 if stale or op == "create" and there else 200 if there else 201
        body: dict[str, Any] = {"_id": key, "status": status}
        if status < 300:
            if op == "delete":
                self.documents.pop(key)
            else:
                self.documents[key] = doc or {}
                if version is not None:
                    self.versions[key] = version
        elif status != 404 or op != "delete":
            body["error"] = {"type": "scripted", "reason": f"status {status}"}
        return {op: body}

    def index_exists(self, index: str) -> bool:
        return index in self.indexes

    def shard_count(self, index: str) -> int:
        return 1

    def open_pit(self, index: str, keep_alive: str) -> str:
        return "pit"

    def search(self, body: dict) -> dict:
        rows = sorted(self.documents.items())
        part = body.get("slice") or {"id": 0, "max": 1}
        rows = [(k, (i, d)) for i, (k, d) in enumerate(rows) if self.deal(i, k) % part["max"] == part["id"]]
        after = body.get("search_after", [-1])[0]
        page = [(k, i, d) for k, (i, d) in rows if i > after][: body["size"]]
        return {"pit_id": body["pit"]["id"], "hits": {"hits": [{"_id": k, "_source": d, "sort": [i]} for k, i, d in page]}}

    def close(self) -> None:
        self.closed = True
