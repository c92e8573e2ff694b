"""Comparing the schema of a write with the schema of an existing table."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

from tableflow.errors import Code, TableflowError
from tableflow.schema.mapping import element_type, is_repeated, map_column

# Spark stores integers and floats at a width; a wider value has no room in a narrower column.
_WIDTH = {
    T.ByteType: 8,
    T.ShortType: 16,
    T.IntegerType: 32,
    T.LongType: 64,
    T.FloatType: 32,
    T.DoubleType: 64,
}


class SchemaProblem(NamedTuple):
    path: str
    problem: str
    have: str | None
    want: str


def schema_diff(existing: T.StructType, wanted: T.StructType) -> list[SchemaProblem]:
    """Why ``wanted`` cannot be written into ``existing``, in write column order.

    Columns only the target has, and columns it requires, are no problem.
    """
    return _diff_fields(existing, wanted, "")


def check_write(existing: T.StructType, wanted: T.StructType, target: str) -> None:
    problems = schema_diff(existing, wanted)
    if problems:
        lines = "; ".join(f"{p.path}: {p.problem} (target {p.have}, write {p.want})" for p in problems)
        raise TableflowError(Code.SCHEMA_MISMATCH, f"the write does not fit {target}: {lines}")


def _diff_fields(existing: T.StructType, wanted: T.StructType, prefix: str) -> list[SchemaProblem]:
    by_name = {field.name: field.dataType for field in existing.fields}
    by_lower = {field.name.lower(): field.name for field in existing.fields}
    problems = []
    for field in wanted.fields:
        path, want = prefix + field.name, field.dataType
        if field.name in by_name:
            problems += _diff_type(path, by_name[field.name], want)
        elif field.name.lower() in by_lower:
            problems.append(
                SchemaProblem(path, "name differs only by case", by_lower[field.name.lower()], field.name)
            )
        else:
            problems.append(SchemaProblem(path, "missing from the target", None, want.simpleString()))
    return problems


def _diff_type(path: str, have: T.DataType, want: T.DataType) -> list[SchemaProblem]:
    def problem(text: str) -> list[SchemaProblem]:
        return [SchemaProblem(path, text, have.simpleString(), want.simpleString())]

    if is_repeated(have) != is_repeated(want):
        return problem("repeated in the target only" if is_repeated(have) else "repeated in the write only")
    have_element, want_element = element_type(path, have), element_type(path, want)
    if isinstance(have_element, T.StructType) and isinstance(want_element, T.StructType):
        return _diff_fields(have_element, want_element, path + ".")
    if _declared(path, have_element) != _declared(path, want_element):
        return problem("type differs")
    if isinstance(want_element, T.DecimalType):
        if (have_element.precision, have_element.scale) != (want_element.precision, want_element.scale):
            return problem("precision or scale differs")
    elif _WIDTH.get(type(have_element), 0) < _WIDTH.get(type(want_element), 0):
        return problem("target is narrower")
    return []


def _declared(path: str, data_type: T.DataType) -> str:
    return map_column(path, data_type)[0].type
