"""Frozen, serialisable settings; every mistake that can be seen here is refused here."""

from __future__ import annotations

import functools
import inspect
import warnings
from dataclasses import dataclass
from typing import Any

OP_TYPES = ("index", "create")


@dataclass(frozen=True)
class Connection:
    """How to reach a document index."""

    hosts: tuple[str, ...] = ()
    api_key: str | None = None
    basic_auth: tuple[str, str] | None = None
    verify_certs: bool = True
    ca_certs: str | None = None
    http_compress: bool = True
    request_timeout: float = 60
    transport_max_retries: int = 3
    retry_on_timeout: bool = True

    def __post_init__(self) -> None:
        object.__setattr__(self, "hosts", (self.hosts,) if isinstance(self.hosts, str) else tuple(self.hosts))
        if not self.hosts:
            raise ValueError("hosts must name at least one address")
        if (self.api_key is None) == (self.basic_auth is None):
            raise ValueError("set exactly one of api_key and basic_auth")
        if self.ca_certs and not self.verify_certs:
            raise ValueError("ca_certs has no effect when verify_certs is off")
        if self.transport_max_retries < 0:
            raise ValueError("transport_max_retries must not be negative")

    def client_kwargs(self) -> dict[str, Any]:
        """Arguments for a transport client; unset ones are left out."""
        out: dict[str, Any] = {"hosts": list(self.hosts), "http_compress": self.http_compress, "request_timeout": self.request_timeout, "max_retries": self.transport_max_retries, "retry_on_timeout": self.retry_on_timeout, "verify_certs": self.verify_certs}
        for name in ("api_key", "basic_auth", "ca_certs"):
            if getattr(self, name) is not None:
                out[name] = getattr(self, name)
        return out


@dataclass(frozen=True)
class WriteConfig(Connection):
    """How to write a DataFrame to an index."""

    index: str = ""
    id_field: str | None = None
    chunk_size: int = 500
    chunk_bytes: int = 100 * 1024 * 1024
    write_concurrency: int = 1
    max_retries_per_doc: int = 3
    retry_on_doc_status: tuple[int, ...] = (429,)
    retry_transport_timeout: bool = False
    bulk_stats: bool = False
    drop_fields: tuple[str, ...] = ()
    strict_drop_fields: bool = True
    require_existing_index: bool = True
    has_deletes: bool = False
    delete_flag_column: str | None = None
    op_type: str = "index"
    bypass_fast_path: bool = False
    version_field: str | None = None

    def __post_init__(self) -> None:
        super().__post_init__()
        object.__setattr__(self, "drop_fields", tuple(self.drop_fields))
        object.__setattr__(self, "retry_on_doc_status", tuple(self.retry_on_doc_status))
        if not self.index:
            raise ValueError("index must be named")
        for name, least in (("chunk_size", 1), ("chunk_bytes", 1), ("write_concurrency", 1), ("max_retries_per_doc", 0)):
            if getattr(self, name) < least:
                raise ValueError(f"{name} must be at least {least}")
        if self.max_retries_per_doc and not self.retry_on_doc_status:
            raise ValueError("retry_on_doc_status must not be empty while max_retries_per_doc is above 0")
        if self.max_retries_per_doc == 0 and self.transport_max_retries > 3:
            warnings.warn("transport_max_retries does not retry single documents, and max_retries_per_doc is 0", stacklevel=3)
        if self.has_deletes != (self.delete_flag_column is not None):
            raise ValueError("has_deletes and delete_flag_column go together")
        if self.has_deletes and not self.id_field:
            raise ValueError("deletes need an id_field")
        if self.op_type not in OP_TYPES:
            raise ValueError(f"op_type must be one of {OP_TYPES}")
        if self.op_type == "create" and not self.id_field:
            raise ValueError("op_type create needs an id_field: without one nothing can be recognised as present")
        if self.version_field and (not self.id_field or self.op_type != "index" or self.has_deletes):
            raise ValueError("version_field needs an id_field and op_type index, and knows no deletes")
        if self.op_type == "create" and self.has_deletes:
            raise ValueError("op_type create only appends and can't be mixed with deletes")

    def client_kwargs(self) -> dict[str, Any]:
        out = super().client_kwargs()
        if self.retry_transport_timeout:
            out["retry_on_timeout"] = False  # timeouts are then retried, and counted, by the writer
        if self.write_concurrency > 1:
            out["connections_per_node"] = self.write_concurrency
        return out


@dataclass(frozen=True)
class ReadConfig(Connection):
    """How to scan an index into a DataFrame."""

    index: str = ""
    id_field: str | None = None
    query: dict | None = None
    num_slices: int | None = None
    batch_size: int = 1000
    pit_keep_alive: str = "5m"
    include_id: bool = True
    strict_slices: bool = True

    def __post_init__(self) -> None:
        super().__post_init__()
        if self.num_slices is not None and self.num_slices < 1:
            raise ValueError("num_slices must be at least 1")
        if self.batch_size < 1:
            raise ValueError("batch_size must be at least 1")


#: Fields that retry something, by the layer they belong to.
RETRY_LAYERS = ("transport_max_retries", "max_retries_per_doc")


def _umbrella(cls: type) -> type:
    """Let ``max_retries=n`` stand for every retry layer of ``cls``, and read it back.

    It is an argument, not a field, and can't be mixed with a layer of its own.  A
    subclass that generates another constructor must decorate itself again.
    """
    made = cls.__init__
    layers = [f for f in RETRY_LAYERS if f in cls.__dataclass_fields__]

    @functools.wraps(made)
    def __init__(self: Any, *args: Any, max_retries: int | None = None, **kwargs: Any) -> None:
        if max_retries is not None:
            mixed = [f for f in layers if f in kwargs]
            if mixed:
                raise ValueError(f"max_retries sets {', '.join(layers)}; it can't be mixed with {', '.join(mixed)}")
            kwargs.update(dict.fromkeys(layers, max_retries))
        made(self, *args, **kwargs)

    own = inspect.signature(made)
    extra = inspect.Parameter("max_retries", inspect.Parameter.KEYWORD_ONLY, default=None, annotation="int | None")
    __init__.__signature__ = own.replace(parameters=[*own.parameters.values(), extra])  # type: ignore[attr-defined]
    cls.__init__ = __init__  # type: ignore[misc]
    return cls


def _shared_retries(self: Any) -> int | None:
    """The value that all retry layers share, or None."""
    values = {getattr(self, f) for f in RETRY_LAYERS if hasattr(self, f)}
    return values.pop() if len(values) == 1 else None


for _cls in (Connection, WriteConfig, ReadConfig):
    _umbrella(_cls)
    _cls.max_retries = property(_shared_retries)  # type: ignore[attr-defined]

#: The write settings under their older name.
Config = WriteConfig
