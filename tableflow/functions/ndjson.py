"""Newline-delimited JSON with exact value encoding, as Column expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.columns import col, require_columns
from tableflow.schema.landing import landed, null_elements, row_label
from tableflow.schema.mapping import MAP_KEY, MAP_VALUE, schema_map

# The spelling of instants and of zone-less date-times.
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timeZone": "UTC",
}


def ndjson_column(schema: T.StructType, key: Sequence[str] = ()) -> Column:
    """A row as one JSON object, columns in schema order.

    NULL is written out; a NULL array or map is ``[]``; decimals are digit strings; NaN
    and the infinities are strings; bytes are base64; a map is an array of key/value
    objects. A NULL array element raises, naming the path and the row's ``key``.
    """
    schema_map(schema)
    where = row_label(key)
    fields = [landed(col(f.name), f.dataType, f.name, where, wire=True).alias(f.name) for f in schema.fields]
    return F.to_json(F.struct(*fields), {**JSON_OPTIONS, "ignoreNullFields": "false"})


def to_ndjson(df: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """One ``value`` string per row, ready for ``write.text``."""
    require_columns(key, df.columns, "key column")
    return df.select(ndjson_column(df.schema, key).alias("value"))


def null_element_report(df: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """``(path, bad_rows)`` for every array at any depth: rows with a NULL element there.

    One pass with partial aggregation, however many arrays there are. With ``order_by``, columns that order the rows
    totally, also ``first_bad_row``: the number, from 1, of the first such row in that order, NULL where there is none.
    Then rows are sorted in ranges by the key and the marks alone, and numbered by the counts of the ranges before.
    """
    require_columns(order_by, df.columns, "key column")
    checks = [(path, bad(col(f.name))) for f in df.schema.fields for path, bad in _null_checks(f.dataType, f.name)]
    fields = ["bad_rows", "first_bad_row"] if order_by else ["bad_rows"]
    if not checks:
        return df.sparkSession.createDataFrame([], "path string, " + ", ".join(f"{f} long" for f in fields))
    marks = [F.coalesce(bad, F.lit(False)) for _, bad in checks]
    if order_by:
        counts = _numbered(df, marks, order_by)
    else:
        counts = df.agg(*[F.count_if(mark).alias(f"bad_rows{i}") for i, mark in enumerate(marks)])
    rows = F.array(
        *[
            F.struct(F.lit(path).alias("path"), *[F.col(f"{f}{i}").alias(f) for f in fields])
            for i, (path, _) in enumerate(checks)
        ]
    )
    return counts.select(F.inline(rows))


def _numbered(df: DataFrame, marks: Sequence[Column], order_by: Sequence[str]) -> DataFrame:
    """``bad_rows<i>`` and ``first_bad_row<i>`` of each mark, with one row for each range before they are added up."""
    keys = [f"_k{i}" for i in range(len(order_by))]
    narrow = df.select(*[col(c).alias(k) for c, k in zip(order_by, keys)], *[m.alias(f"_m{i}") for i, m in enumerate(marks)])
    ordered = narrow.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # The id of a row: its range in the upper bits, its place in the range in the lower 33.
    placed = ordered.withColumn("_id", F.monotonically_increasing_id())
    place = F.col("_id").bitwiseAND((1 << 33) - 1)
    ranges = placed.groupBy(F.shiftright("_id", 33).alias("_range")).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(f"_m{i}").alias(f"_c{i}") for i in range(len(marks))],
        *[F.min(F.when(F.col(f"_m{i}"), place)).alias(f"_f{i}") for i in range(len(marks))],
    )
    before = F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")
    return ranges.withColumn("_before", before).agg(
        *[F.coalesce(F.sum(f"_c{i}"), F.lit(0)).alias(f"bad_rows{i}") for i in range(len(marks))],
        *[F.min(F.col("_before") + F.col(f"_f{i}") + 1).alias(f"first_bad_row{i}") for i in range(len(marks))],
    )


_Check = Callable[[Column], Column]


def _null_checks(data_type: T.DataType, path: str) -> list[tuple[str, _Check]]:
    """Each array inside a type, with the condition on a value that it holds a NULL element."""
    if isinstance(data_type, T.StructType):
        return [
            (inner, _of_field(f.name, check))
            for f in data_type.fields
            for inner, check in _null_checks(f.dataType, f"{path}.{f.name}")
        ]
    if isinstance(data_type, T.MapType):
        keys = _null_checks(data_type.keyType, f"{path}.{MAP_KEY}")
        values = _null_checks(data_type.valueType, f"{path}.{MAP_VALUE}")
        return [(inner, _of_some(F.map_keys, check)) for inner, check in keys] + [
            (inner, _of_some(F.map_values, check)) for inner, check in values
        ]
    if isinstance(data_type, T.ArrayType):
        elements = _null_checks(data_type.elementType, path)
        return [(path, null_elements)] + [(inner, _of_some(lambda array: array, check)) for inner, check in elements]
    return []


def _of_field(name: str, check: _Check) -> _Check:
    return lambda value: check(value.getField(name))


def _of_some(elements: _Check, check: _Check) -> _Check:
    return lambda value: F.exists(elements(value), lambda x: F.coalesce(check(x), F.lit(False)))
