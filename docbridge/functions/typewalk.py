"""One recursion over nested types that rewrites leaves and leaves clean subtrees alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DayTimeIntervalType, MapType, StructType, VariantType, YearMonthIntervalType

Pred = Callable[[DataType], bool]
Leaf = Callable[[Column, DataType], Column]


def contains(dt: DataType, pred: Pred, keys: bool = False) -> bool:
    """Whether a leaf that ``pred`` accepts occurs in ``dt``; map keys count only if asked."""
    if pred(dt):
        return True
    if isinstance(dt, StructType):
        return any(contains(f.dataType, pred, keys) for f in dt.fields)
    if isinstance(dt, ArrayType):
        return contains(dt.elementType, pred, keys)
    if isinstance(dt, MapType):
        return contains(dt.valueType, pred, keys) or (keys and contains(dt.keyType, pred, keys))
    return False


def rewrite(value: Column, dt: DataType, pred: Pred, leaf: Leaf) -> Column:
    """``value`` with every leaf that ``pred`` accepts replaced by ``leaf``.

    Null structs, arrays and maps stay null; map keys are never rewritten, as rewritten
    keys could collide.
    """
    if pred(dt):
        return leaf(value, dt)
    if not contains(dt, pred):
        return value
    if isinstance(dt, StructType):
        fields = [rewrite(value.getField(f.name), f.dataType, pred, leaf).alias(f.name) for f in dt.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(dt, ArrayType):
        return F.transform(value, lambda x: rewrite(x, dt.elementType, pred, leaf))
    return F.transform_values(value, lambda _, v: rewrite(v, dt.valueType, pred, leaf))


def column(name: str) -> Column:
    """A top-level column by its exact name, dots and back-ticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_interval(dt: DataType) -> bool:
    return isinstance(dt, (DayTimeIntervalType, YearMonthIntervalType))


def is_variant(dt: DataType) -> bool:
    return isinstance(dt, VariantType)
