"""docbridge: data movement between Spark DataFrames and document indexes, with exact accounting."""

from __future__ import annotations

import importlib
from typing import Any

__version__ = "0.1.0"

#: Public names and where they live; loaded on first use, so that workers load what they need.
_PUBLIC = {
    "Config": "config", "Connection": "config", "ReadConfig": "config", "WriteConfig": "config",
    "ReadSchemaMismatch": "functions.decode", "read_coerce": "functions.decode",
    "sanitize_for_arrow": "functions.encode",
    "WriteError": "operators.outcome", "reconcile_or_raise": "operators.outcome",
    "bulk_write": "operators.sink",
    "read_index": "sources.scan",
    "make_foreach_batch": "streaming.sink",
}
__all__ = sorted(_PUBLIC)


def __getattr__(name: str) -> Any:
    if name not in _PUBLIC:
        raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
    return getattr(importlib.import_module(f"{__name__}.{_PUBLIC[name]}"), name)
