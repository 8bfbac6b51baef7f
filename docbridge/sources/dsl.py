"""The query language of document indexes, compiled to Column expressions."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Longest string that a keyword index holds; longer ones are stored but not found.
IGNORE_ABOVE = 256
_RANGE = {"gt": "__gt__", "gte": "__ge__", "lt": "__lt__", "lte": "__le__"}

Field = Callable[[str], Column]


def compile_query(query: dict | None, field: Field, doc_id: Column | None = None) -> Column:
    """A boolean column that is true for the documents that ``query`` matches.

    ``field`` gives the column of a field name.  Forms: match_all, term, terms, range,
    exists, ids, prefix, wildcard, match, bool (must, filter, should, must_not,
    minimum_should_match).  Other forms are refused, not ignored.
    """
    if not query:
        return F.lit(True)
    if len(query) != 1:
        raise ValueError(f"a query has one form, not {sorted(query)}")
    ((form, body),) = query.items()
    if form not in _FORMS:
        raise ValueError(f"query form {form!r} is not supported; known are {sorted(_FORMS)}")
    return F.coalesce(_FORMS[form](body, field, doc_id), F.lit(False))


def _one(body: dict) -> tuple[str, Any]:
    if len(body) != 1:
        raise ValueError(f"one field expected, not {sorted(body)}")
    return next(iter(body.items()))


def _near(field: Field, name: str, value: Any) -> Column:
    """The field as something that compares with ``value``, where its column may be of another kind."""
    return field.like(name, value) if hasattr(field, "like") else field(name)


def _value(v: Any, key: str = "value") -> Any:
    return v[key] if isinstance(v, dict) else v


def _term(body: dict, field: Field, _: Column | None) -> Column:
    name, v = _one(body)
    return _near(field, name, _value(v)) == F.lit(_value(v))


def _terms(body: dict, field: Field, _: Column | None) -> Column:
    name, values = _one(body)
    kinds = {isinstance(v, str): [w for w in values if isinstance(w, str) == isinstance(v, str)] for v in values}
    out = F.lit(False)
    for same in kinds.values():
        out |= _near(field, name, max(same, key=abs) if not isinstance(same[0], str) else same[0]).isin(*same)
    return out


def _range(body: dict, field: Field, _: Column | None) -> Column:
    name, limits = _one(body)
    unknown = set(limits) - set(_RANGE)
    if unknown:
        raise ValueError(f"range knows {sorted(_RANGE)}, not {sorted(unknown)}")
    out = F.lit(True)
    for k, v in limits.items():
        out &= getattr(_near(field, name, v), _RANGE[k])(F.lit(v))
    return out


def _match(body: dict, field: Field, _: Column | None) -> Column:
    name, v = _one(body)
    words = F.split(F.lower(field(name).cast("string")), r"[^\p{L}\p{N}]+")
    wanted = [w for w in str(_value(v, "query")).lower().split() if w]
    found = [F.array_contains(words, w) for w in wanted]
    every = isinstance(v, dict) and v.get("operator", "or").lower() == "and"
    out = F.lit(every)
    for f in found:
        out = (out & f) if every else (out | f)
    return out


def _wildcard(body: dict, field: Field, _: Column | None) -> Column:
    name, v = _one(body)
    text = str(_value(v))
    for a, b in (("\\", "\\\\"), ("%", "\\%"), ("_", "\\_"), ("*", "%"), ("?", "_")):
        text = text.replace(a, b)
    return field(name).like(text)


def _ids(body: dict, _: Field, doc_id: Column | None) -> Column:
    if doc_id is None:
        raise ValueError("ids needs a document id")
    return doc_id.isin(*body["values"]) if body["values"] else F.lit(False)


def _bool(body: dict, field: Field, doc_id: Column | None) -> Column:
    unknown = set(body) - {"must", "filter", "should", "must_not", "minimum_should_match"}
    if unknown:
        raise ValueError(f"bool does not know {sorted(unknown)}")

    def clauses(key: str) -> list[Column]:
        v = body.get(key) or []
        return [compile_query(q, field, doc_id) for q in (v if isinstance(v, list) else [v])]

    out = F.lit(True)
    for c in clauses("must") + clauses("filter"):
        out &= c
    for c in clauses("must_not"):
        out &= ~c
    should = clauses("should")
    least = body.get("minimum_should_match", 0 if body.get("must") or body.get("filter") else 1)
    if should and least:
        hits = F.lit(0)
        for c in should:
            hits += c.cast("int")
        out &= hits >= least
    return out


_FORMS: dict[str, Callable[[Any, Field, Column | None], Column]] = {
    "match_all": lambda *_: F.lit(True),
    "match_none": lambda *_: F.lit(False),
    "term": _term,
    "terms": _terms,
    "range": _range,
    "exists": lambda body, field, _: field(body["field"]).isNotNull(),
    "ids": _ids,
    "prefix": lambda body, field, _: field(_one(body)[0]).startswith(_value(_one(body)[1])),
    "wildcard": _wildcard,
    "match": _match,
    "bool": _bool,
}


def keyword(c: Column, ignore_above: int = IGNORE_ABOVE) -> Column:
    """A string as a keyword index sees it: nothing, if too long."""
    return F.when(F.char_length(c) <= ignore_above, c)
