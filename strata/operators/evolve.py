"""Columns and types of a table that changes over time."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Integers and the decimal digits that hold all of them.
_INTEGERS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_ORDER = list(_INTEGERS)
_MOST_DIGITS = 38  # of a decimal


class SchemaConflict(ValueError):
    """A batch that cannot be one with its table; nothing of it was written."""


def common_type(one: T.DataType, other: T.DataType) -> T.DataType | None:
    """The type that holds every value of both without loss, or None.

    These are the widenings that Spark's Parquet reader makes by itself: a file is read as the
    wider type, whatever narrower one it was written with.
    """
    for a, b in ((one, other), (other, one)):
        found = _wider(a, b)
        if found is not None:
            return found
    return None


def _wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type for both, where ``a`` is the narrower one or of the same kind."""
    if isinstance(a, T.NullType):
        return b
    if type(a) in _INTEGERS and type(b) in _INTEGERS:
        return max(a, b, key=lambda x: _ORDER.index(type(x)))
    if isinstance(b, T.DecimalType) and (type(a) in _INTEGERS or isinstance(a, T.DecimalType)):
        scale = a.scale if isinstance(a, T.DecimalType) else 0
        whole = a.precision - scale if isinstance(a, T.DecimalType) else _INTEGERS[type(a)]
        scale, whole = max(scale, b.scale), max(whole, b.precision - b.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= _MOST_DIGITS else None
    if isinstance(b, T.DoubleType) and isinstance(a, (T.ByteType, T.ShortType, T.IntegerType, T.FloatType)):
        return b
    if isinstance(a, T.DateType) and isinstance(b, T.TimestampNTZType):
        return b
    if type(a) is not type(b):
        return None
    if isinstance(a, T.ArrayType):
        element = common_type(a.elementType, b.elementType)
        return element and T.ArrayType(element, a.containsNull or b.containsNull)
    if isinstance(a, T.MapType):
        key, value = common_type(a.keyType, b.keyType), common_type(a.valueType, b.valueType)
        return key and value and T.MapType(key, value, a.valueContainsNull or b.valueContainsNull)
    if isinstance(a, T.StructType):
        kinds = [common_type(x.dataType, y.dataType) for x, y in zip(a, b)]
        if a.names != b.names or None in kinds:
            return None
        return T.StructType([
            T.StructField(x.name, kind, x.nullable or y.nullable) for x, y, kind in zip(a, b, kinds)
        ])
    return a if a == b else None


def _alike(a: T.DataType, b: T.DataType) -> bool:
    return a.simpleString() == b.simpleString()


def _one_name_each(names: list[str]) -> None:
    by_name = Counter(name.lower() for name in names)
    repeated = sorted(name for name in names if by_name[name.lower()] > 1)
    if repeated:
        raise SchemaConflict(f"columns that differ at most in case: {', '.join(repeated)}")


def reconciled(batch: DataFrame, known: T.StructType, *, fixed: str | None = None) -> DataFrame:
    """The batch with its columns as wide as those of the table, or wider.

    Raises where a name differs from one of the table in case only, where a type and that of the
    table have no common one, and where the type of the column ``fixed`` changes.
    """
    _one_name_each(batch.columns)
    of_table = {field.name: field.dataType for field in known}
    _one_name_each([*of_table, *(name for name in batch.columns if name not in of_table)])
    casts = {}
    for field in batch.schema:
        old, new = of_table.get(field.name), field.dataType
        kind = new if old is None else common_type(old, new)
        if kind is None or (field.name == fixed and old is not None and not _alike(kind, old)):
            raise SchemaConflict(
                f"column {field.name} is {old.simpleString()} in the table and {new.simpleString()} in the batch"
            )
        if isinstance(kind, T.NullType):
            raise SchemaConflict(f"column {field.name} has no type")
        if not _alike(kind, new):
            casts[field.name] = F.col(f"`{field.name}`").cast(kind)
    return batch.withColumns(casts) if casts else batch


def as_declared(declared: T.StructType, known: T.StructType) -> T.StructType:
    """The declared columns, each as wide as the table has it, then the table's others."""
    of_table = {field.name: field for field in known}
    found = []
    for field in declared:
        old = of_table.get(field.name)
        kind = field.dataType if old is None else common_type(old.dataType, field.dataType)
        if kind is None:
            raise SchemaConflict(
                f"column {field.name} is {old.dataType.simpleString()} in the table, "
                f"{field.dataType.simpleString()} was asked for"
            )
        found.append(T.StructField(field.name, kind, field.nullable))
    return T.StructType([*found, *(f for f in known if f.name not in declared.names)])
