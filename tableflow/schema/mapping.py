"""Mapping a Spark schema to the column types a warehouse table declares."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import types as T

from tableflow.errors import Code, TableflowError

# The column stamped on staged merge rows, the largest scale of the plain
# decimal type, and the field names of a map entry.
SEQUENCE_COLUMN = "_row_seq"
MAX_NUMERIC_SCALE = 9
MAP_KEY, MAP_VALUE = "key", "value"

# The declared type of each flat Spark type.
_FLAT = {
    T.ByteType: "INTEGER",
    T.ShortType: "INTEGER",
    T.IntegerType: "INTEGER",
    T.LongType: "INTEGER",
    T.FloatType: "FLOAT",
    T.DoubleType: "FLOAT",
    T.StringType: "STRING",
    T.VarcharType: "STRING",
    T.CharType: "STRING",
    T.BinaryType: "BYTES",
    T.BooleanType: "BOOLEAN",
    T.DateType: "DATE",
    T.TimestampType: "TIMESTAMP",
    T.TimestampNTZType: "DATETIME",
    T.TimeType: "TIME",
}

# The modern spelling of a type name and the spelling used here.
_SPELLING = {"INT64": "INTEGER", "FLOAT64": "FLOAT", "BOOL": "BOOLEAN", "STRUCT": "RECORD"}


class MappedColumn(NamedTuple):
    path: str
    type: str
    mode: str
    precision: int | None
    scale: int | None


def canonical_type(name: str | None) -> str:
    return _SPELLING.get(name, name or "")


def schema_map(schema: T.StructType) -> list[MappedColumn]:
    """Every column of a write, nested ones under their dotted path, in schema order.

    Raises for a type that has no place in the target, naming its path.
    """
    return [row for field in schema.fields for row in map_column(field.name, field.dataType)]


def map_column(path: str, data_type: T.DataType) -> list[MappedColumn]:
    mode = "REPEATED" if is_repeated(data_type) else "NULLABLE"
    element = element_type(path, data_type)
    if isinstance(element, T.StructType):
        if not element.fields:
            raise _unsupported(path, data_type, "a record needs at least one field")
        nested = [row for f in element.fields for row in map_column(f"{path}.{f.name}", f.dataType)]
        return [MappedColumn(path, "RECORD", mode, None, None), *nested]
    if isinstance(element, T.DecimalType):
        name = "NUMERIC" if element.scale <= MAX_NUMERIC_SCALE else "BIGNUMERIC"
        return [MappedColumn(path, name, mode, element.precision, element.scale)]
    name = _FLAT.get(type(element))
    if name is None:
        raise _unsupported(path, data_type)
    return [MappedColumn(path, name, mode, None, None)]


def is_repeated(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.ArrayType, T.MapType))


def element_type(path: str, data_type: T.DataType) -> T.DataType:
    """What a repeated column repeats (a map repeats its entries); any other type is itself."""
    if isinstance(data_type, T.MapType):
        return T.StructType(
            [T.StructField(MAP_KEY, data_type.keyType, False), T.StructField(MAP_VALUE, data_type.valueType)]
        )
    if isinstance(data_type, T.ArrayType):
        if is_repeated(data_type.elementType):
            raise _unsupported(path, data_type, "an array cannot hold arrays or maps")
        return data_type.elementType
    return data_type


def same_type(one: T.DataType, other: T.DataType) -> bool:
    """Equal apart from what may be NULL inside."""
    return one.simpleString() == other.simpleString()


def field_mode(field: T.StructField) -> str:
    if is_repeated(field.dataType):
        return "REPEATED"
    return "NULLABLE" if field.nullable else "REQUIRED"


def flat_fields(schema: T.StructType, prefix: str = "") -> Iterator[tuple[str, T.StructField]]:
    """Every field with its dotted path, descending through arrays and structs."""
    for field in schema.fields:
        path = prefix + field.name
        yield path, field
        inner = field.dataType
        while isinstance(inner, T.ArrayType):
            inner = inner.elementType
        if isinstance(inner, T.StructType):
            yield from flat_fields(inner, path + ".")


def _unsupported(path: str, data_type: T.DataType, reason: str = "") -> TableflowError:
    detail = f" ({reason})" if reason else ""
    return TableflowError(
        Code.UNSUPPORTED_TYPE, f"column '{path}' has type {data_type.simpleString()}, which cannot be written{detail}"
    )
