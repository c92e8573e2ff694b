"""Incremental bounds: a cursor column compared with typed literals.

Every literal is built in the type of the column it is compared with, so the
comparison needs no cast on the column and reaches the Parquet scan.
"""

from __future__ import annotations

import re
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.columns import col
from tableflow.errors import Code, TableflowError

# The accepted spelling of a bound, by kind of column.
_NUMBER = re.compile(r"-?[0-9]+(\.[0-9]+)?\Z")
_DATE = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}\Z")
_TIMESTAMP = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?\Z")

_INTEGER_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def typed_literal(data_type: T.DataType, text: str, column: str) -> Column:
    """``text`` as a literal fit to compare with a column of ``data_type``."""
    if isinstance(data_type, T.IntegralType):
        _require(_NUMBER, text, column, data_type)
        number = Decimal(text)
        limit = 2 ** (_INTEGER_BITS[type(data_type)] - 1)
        if number == number.to_integral_value() and -limit <= number < limit:
            return F.lit(int(number)).cast(data_type)
        # A fraction, or a number past the column's range, still compares by value.
        return _decimal_literal(number, text, column)
    if isinstance(data_type, T.FractionalType) and not isinstance(data_type, T.DecimalType):
        _require(_NUMBER, text, column, data_type)
        return F.lit(text).cast(data_type)
    if isinstance(data_type, T.DecimalType):
        _require(_NUMBER, text, column, data_type)
        number = Decimal(text)
        scale = max(0, -number.as_tuple().exponent)
        whole = len(str(abs(int(number))))
        if scale <= data_type.scale and whole <= data_type.precision - data_type.scale:
            return F.lit(text).cast(data_type)
        return _decimal_literal(number, text, column)
    if isinstance(data_type, T.DateType):
        _require(_DATE, text, column, data_type)
        _require_calendar(date.fromisoformat, text, column, data_type)
        return F.lit(text).cast(data_type)
    if isinstance(data_type, T.TimestampNTZType):
        _require(_TIMESTAMP, text, column, data_type)
        _require_calendar(datetime.fromisoformat, text, column, data_type)
        return F.lit(text).cast(data_type)
    if isinstance(data_type, T.TimestampType):
        _require(_TIMESTAMP, text, column, data_type)
        _require_calendar(datetime.fromisoformat, text, column, data_type)
        # A bound is always UTC, whatever zone the session is in.
        return F.lit(text + "+00:00").cast(data_type)
    if isinstance(data_type, (T.StringType, T.VarcharType, T.CharType)):
        return F.lit(text)
    raise TableflowError(
        Code.CURSOR_TYPE, f"cursor column '{column}' has type {data_type.simpleString()}, which has no bounds"
    )


def cursor_condition(
    schema: T.StructType,
    cursor: str | None,
    lower: str | None = None,
    upper: str | None = None,
    lower_inclusive: bool = False,
) -> Column | None:
    """The bounds as one condition, or None when there is nothing to bound.

    A row whose cursor is NULL satisfies no bound. A cursor without bounds adds
    nothing and is not looked up.
    """
    if cursor is None or (lower is None and upper is None):
        return None
    fields = {field.name: field for field in schema.fields}
    if cursor not in fields:
        raise TableflowError(Code.CURSOR_COLUMN_MISSING, f"cursor column '{cursor}' is not in the table")
    data_type = fields[cursor].dataType
    terms = []
    if lower is not None:
        literal = typed_literal(data_type, lower, cursor)
        terms.append(col(cursor) >= literal if lower_inclusive else col(cursor) > literal)
    if upper is not None:
        terms.append(col(cursor) <= typed_literal(data_type, upper, cursor))
    return terms[0] if len(terms) == 1 else terms[0] & terms[1]


def _decimal_literal(number: Decimal, text: str, column: str) -> Column:
    if len(number.as_tuple().digits) > 38:
        raise TableflowError(Code.CURSOR_VALUE, f"cursor column '{column}': {text} has more than 38 digits")
    return F.lit(number)


def _require(pattern: re.Pattern, text: str, column: str, data_type: T.DataType) -> None:
    if not isinstance(text, str) or not pattern.match(text):
        _refuse(column, data_type)


def _require_calendar(parse, text: str, column: str, data_type: T.DataType) -> None:
    try:
        parse(text)
    except ValueError:
        _refuse(column, data_type)


def _refuse(column: str, data_type: T.DataType) -> None:
    # The value itself stays out of the message.
    raise TableflowError(
        Code.CURSOR_VALUE, f"cursor column '{column}' ({data_type.simpleString()}): the bound is not in canonical form"
    )
