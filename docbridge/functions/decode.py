"""Documents back to declared types, refusing what would lose a value.

``decode`` builds Catalyst expressions over VARIANT for whole columns; ``read_coerce``
is the same contract for a single Python value.  Nothing is inferred and nothing turns
to null in silence: a value that does not fit raises.
"""

from __future__ import annotations

import base64
import datetime as dt
from decimal import Decimal
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, ByteType, CharType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, MapType, NullType, ShortType, StringType, StructType, TimestampNTZType, TimestampType, VarcharType,
)

#: Strings that stand for a boolean, in any case, trimmed.
TRUE_STRINGS = ("true", "t", "1", "yes", "y")
FALSE_STRINGS = ("false", "f", "0", "no", "n")
_WIDTH = {ByteType: 8, ShortType: 16, IntegerType: 32, LongType: 64}
_EPOCH = dt.datetime(1970, 1, 1)
MISMATCH = "schema mismatch: "
#: Largest number that rounds to a finite float.
_FLOAT_MAX = 3.4028235677973362e38


class ReadSchemaMismatch(TypeError):
    """A stored value that the declared type can't hold."""


def check_schema(schema: StructType) -> None:
    """Refuse, before anything is read, types that can't be declared."""
    if not schema.fields:
        raise ValueError("the schema declares no fields")
    for f in schema.fields:
        _check(f.dataType, f.name)


def _check(t: DataType, path: str) -> None:
    if isinstance(t, (CharType, VarcharType, NullType)):
        raise ReadSchemaMismatch(f"{path}: type {t.simpleString()} can't be declared; use string")
    if isinstance(t, StructType):
        for f in t.fields:
            _check(f.dataType, f"{path}.{f.name}")
    elif isinstance(t, ArrayType):
        _check(t.elementType, f"{path}[]")
    elif isinstance(t, MapType):
        if not isinstance(t.keyType, StringType):
            raise ReadSchemaMismatch(f"{path}: document keys are strings, so a map with {t.keyType.simpleString()} keys can't be declared; use map<string,...>")
        _check(t.valueType, f"{path}{{}}")


def _bounds(t: DataType) -> tuple[int, int]:
    half = 1 << (_WIDTH[type(t)] - 1)
    return -half, half - 1


# -- Column expressions -------------------------------------------------------


def _fail(path: str, what: str) -> Column:
    return F.raise_error(F.lit(f"{MISMATCH}{path}: {what}"))


def decode(value: Column, t: DataType, path: str = "value", kind: Column | None = None) -> Column:
    """``value`` (VARIANT) as type ``t``; SQL null and JSON null are null.

    ``kind`` is its schema, where a column has it already.
    """
    kind = F.schema_of_variant(value) if kind is None else kind
    out = _present(value, t, path, kind)
    return F.when(value.isNull() | (kind == "VOID"), F.lit(None).cast(t)).otherwise(out)


def _text(value: Column) -> Column:
    return F.variant_get(value, "$", "string")


def _scalar(t: DataType, path: str, kind: Column, value: Column) -> Column:
    nested = kind.startswith("ARRAY") | kind.startswith("OBJECT")
    return F.when(nested, _fail(path, f"an array or object where {t.simpleString()} is declared; declare it as such").cast(t)).otherwise(value)


def _number(value: Column, kind: Column, path: str, wanted: str) -> Column:
    """A number, a boolean as 0 or 1, or a numeric string, as a decimal."""
    wide = "decimal(38,6)"
    parsed = F.when(kind == "BOOLEAN", F.when(F.variant_get(value, "$", "boolean"), 1).otherwise(0).cast(wide)).otherwise(_text(value).try_cast(wide))
    return F.when(parsed.isNull(), _fail(path, f"not a number where {wanted} is declared").cast(wide)).otherwise(parsed)


def _fraction(value: Column, kind: Column) -> Column:
    """Whether a number, as written, is not whole; told before any rounding."""
    text = _text(value)
    real = text.try_cast("double")
    by_value = kind.startswith("DOUBLE") | kind.startswith("FLOAT") | text.rlike("[eE]")
    return F.when(kind == "BOOLEAN", False).when(by_value, real != F.floor(real)).otherwise(text.rlike(r"\.[0-9]*[1-9]"))


def _integer(value: Column, kind: Column, t: DataType, path: str) -> Column:
    low, high = _bounds(t)
    # what a document holds nearly always: a whole number that fits a long
    whole = F.variant_get(value, "$", "bigint")
    if not isinstance(t, LongType):
        whole = F.when(whole.between(low, high), whole).otherwise(_fail(path, f"out of range of {t.simpleString()}").cast("bigint")).cast(t)
    number = _number(value, kind, path, t.simpleString())
    exact = (
        F.when(_fraction(value, kind), _fail(path, f"a fraction where {t.simpleString()} is declared").cast(t))
        .when((number < F.lit(low).cast("decimal(38,0)")) | (number > F.lit(high).cast("decimal(38,0)")), _fail(path, f"out of range of {t.simpleString()}").cast(t))
        .otherwise(number.cast("decimal(38,0)").cast(t))
    )
    return F.when(kind == "BIGINT", whole).otherwise(exact)


def _real(value: Column, kind: Column, t: DataType, path: str) -> Column:
    """A float or double; what is no number, or beyond the type, is refused."""
    wide = F.when(kind == "BOOLEAN", F.variant_get(value, "$", "boolean").cast("int").cast("double")).otherwise(_text(value).try_cast("double"))
    out = wide.cast(t)
    over = (F.abs(out) == float("inf")) & (F.abs(wide) < float("inf"))
    return F.when(wide.isNull(), _fail(path, f"not a number where {t.simpleString()} is declared").cast(t)).when(over, _fail(path, f"out of range of {t.simpleString()}").cast(t)).otherwise(out)


def _decimal(value: Column, t: DecimalType, path: str) -> Column:
    """A decimal with all its digits; what would be rounded is refused."""
    text = F.trim(_text(value))
    out = text.try_cast(t)
    more = text.rlike(rf"\.[0-9]{{{t.scale}}}[0-9]*[1-9]") & ~text.rlike("[eE]") | text.rlike("[eE]") & (text.try_cast("double") != out.cast("double"))
    return F.when(out.isNull(), _fail(path, f"no {t.simpleString()}").cast(t)).when(more, _fail(path, f"more digits than {t.simpleString()} holds").cast(t)).otherwise(out)


def _boolean(value: Column, kind: Column, path: str) -> Column:
    s = F.lower(F.trim(_text(value)))
    by_text = F.when(s.isin(*TRUE_STRINGS), True).when(s.isin(*FALSE_STRINGS), False).otherwise(_fail(path, "a string that is no boolean").cast("boolean"))
    return F.when(kind == "BOOLEAN", F.variant_get(value, "$", "boolean")).when(kind == "STRING", by_text).otherwise(_text(value).cast("double") != 0)


def _present(value: Column, t: DataType, path: str, kind: Column) -> Column:
    if isinstance(t, StructType):
        fields = [decode(F.variant_get(value, "$[\"" + f.name.replace("\\", "\\\\").replace('"', '\\"') + "\"]", "variant"), f.dataType, f"{path}.{f.name}").alias(f.name) for f in t.fields]
        return F.when(~kind.startswith("OBJECT"), _fail(path, "no object where a struct is declared").cast(t)).otherwise(F.struct(*fields))
    if isinstance(t, ArrayType):
        items = F.when(kind.startswith("ARRAY"), F.variant_get(value, "$", "array<variant>")).otherwise(F.array(value))
        return F.transform(items, lambda x: decode(x, t.elementType, f"{path}[]"))
    if isinstance(t, MapType):
        entries = F.when(kind.startswith("OBJECT"), F.variant_get(value, "$", "map<string,variant>")).otherwise(_fail(path, "no object where a map is declared").cast("map<string,variant>"))
        return F.transform_values(entries, lambda _, x: decode(x, t.valueType, f"{path}{{}}"))
    if isinstance(t, BooleanType):
        out = _boolean(value, kind, path)
    elif type(t) in _WIDTH:
        out = _integer(value, kind, t, path)
    elif isinstance(t, (FloatType, DoubleType)):
        out = _real(value, kind, t, path)
    elif isinstance(t, DecimalType):
        out = _decimal(value, t, path)
    elif isinstance(t, TimestampType):
        out = F.timestamp_millis(_integer(value, kind, LongType(), path))
    elif isinstance(t, TimestampNTZType):
        ms = _integer(value, kind, LongType(), path)
        out = F.timestamp_add("MILLISECOND", ms, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    elif isinstance(t, DateType):
        out = F.date_from_unix_date(F.floor(_integer(value, kind, LongType(), path) / 86_400_000).cast("int"))
    elif isinstance(t, BinaryType):
        out = F.unbase64(_text(value))
    else:
        out = _text(value).cast(t)
    return _scalar(t, path, kind, out)


# -- single values ------------------------------------------------------------


def read_coerce(value: Any, t: DataType, path: str = "value") -> Any:
    """One parsed JSON value as the Python value of type ``t``, or ``ReadSchemaMismatch``."""
    if isinstance(t, (CharType, VarcharType, NullType)):
        _check(t, path)
    if value is None:
        return None
    if isinstance(t, ArrayType):
        return [read_coerce(v, t.elementType, f"{path}[]") for v in (value if isinstance(value, list) else [value])]
    if isinstance(t, (MapType, StructType)):
        if not isinstance(value, dict):
            raise ReadSchemaMismatch(f"{path}: no object where {t.simpleString()} is declared")
        if isinstance(t, MapType):
            return {k: read_coerce(v, t.valueType, f"{path}{{}}") for k, v in value.items()}
        return {f.name: read_coerce(value.get(f.name), f.dataType, f"{path}.{f.name}") for f in t.fields}
    if isinstance(value, (list, dict)):
        raise ReadSchemaMismatch(f"{path}: an array or object where {t.simpleString()} is declared; declare it as such")
    if isinstance(t, BooleanType):
        return _coerce_boolean(value, path)
    if type(t) in _WIDTH:
        return _coerce_integer(value, t, path)
    if isinstance(t, (FloatType, DoubleType)):
        return _coerce_real(value, t, path)
    if isinstance(t, DecimalType):
        return _coerce_decimal(value, t, path)
    if isinstance(t, (TimestampType, TimestampNTZType, DateType)):
        at = _EPOCH + dt.timedelta(milliseconds=_coerce_integer(value, LongType(), path))
        if isinstance(t, DateType):
            return at.date()
        return at if isinstance(t, TimestampNTZType) else at.replace(tzinfo=dt.timezone.utc)
    if isinstance(t, BinaryType):
        return base64.b64decode(value)
    if isinstance(t, StringType):
        return value if isinstance(value, str) else {True: "true", False: "false"}[value] if isinstance(value, bool) else str(value)
    return value


def _coerce_boolean(value: Any, path: str) -> bool:
    if not isinstance(value, str):
        return bool(value)
    s = value.strip().lower()
    if s not in TRUE_STRINGS + FALSE_STRINGS:
        raise ReadSchemaMismatch(f"{path}: {value!r} is no boolean")
    return s in TRUE_STRINGS


def _coerce_integer(value: Any, t: DataType, path: str) -> int:
    if isinstance(value, float) and not value.is_integer():
        raise ReadSchemaMismatch(f"{path}: fraction {value!r} where {t.simpleString()} is declared")
    try:
        out = Decimal(value.strip()) if isinstance(value, str) else Decimal(value)
        if out != out.to_integral_value():
            raise ReadSchemaMismatch(f"{path}: fraction {value!r} where {t.simpleString()} is declared")
        out = int(out)
    except (ArithmeticError, ValueError) as e:
        raise ReadSchemaMismatch(f"{path}: {value!r} is not a number where {t.simpleString()} is declared") from e
    low, high = _bounds(t)
    if not low <= out <= high:
        raise ReadSchemaMismatch(f"{path}: {out} is out of range of {t.simpleString()}")
    return out


def _coerce_real(value: Any, t: DataType, path: str) -> float:
    try:
        out = float(value)
    except ValueError as e:
        raise ReadSchemaMismatch(f"{path}: {value!r} is not a number where {t.simpleString()} is declared") from e
    if isinstance(t, FloatType) and abs(out) > _FLOAT_MAX and abs(out) != float("inf"):
        raise ReadSchemaMismatch(f"{path}: {value!r} is out of range of {t.simpleString()}")
    return out


def _coerce_decimal(value: Any, t: DecimalType, path: str) -> Decimal:
    try:
        out = Decimal(str(value).strip())
        whole = out.scaleb(t.scale)
        fits = whole == whole.to_integral_value() and abs(whole) < 10**t.precision
    except ArithmeticError as e:
        raise ReadSchemaMismatch(f"{path}: {value!r} is no {t.simpleString()}") from e
    if not fits:
        raise ReadSchemaMismatch(f"{path}: {value!r} does not fit {t.simpleString()}")
    return out
