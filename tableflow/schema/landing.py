"""Column expressions that put a value into the shape a target stores.

``landed`` applies the array rules (a NULL array is stored empty, a NULL element is
refused); ``conformed`` casts a value to the type a target column has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.columns import col
from tableflow.schema.mapping import MAP_KEY, MAP_VALUE, same_type


def landed(
    value: Column, data_type: T.DataType, path: str, where: Column | None = None, wire: bool = False
) -> Column:
    """``value`` with the array rules applied at every depth.

    ``wire`` also spells decimals as digits and maps as arrays of entries, as JSON
    needs them. ``where`` is text about the row, put into a refusal.
    """
    if not needs_landing(data_type, wire):
        return value
    if isinstance(data_type, T.ArrayType):
        return _landed_array(value, data_type, path, where, wire)
    if isinstance(data_type, T.MapType):
        return _landed_map(value, data_type, path, where, wire)
    if isinstance(data_type, T.StructType):
        fields = [
            landed(value.getField(f.name), f.dataType, f"{path}.{f.name}", where, wire).alias(f.name)
            for f in data_type.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(data_type, T.TimeType):
        return time_text(value)
    return decimal_text(value, data_type)


def needs_landing(data_type: T.DataType, wire: bool = False) -> bool:
    if isinstance(data_type, T.StructType):
        return any(needs_landing(f.dataType, wire) for f in data_type.fields)
    if isinstance(data_type, (T.ArrayType, T.MapType, T.TimeType)):
        return True
    return wire and isinstance(data_type, T.DecimalType)


def landed_frame(df: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    if not needs_landing(df.schema):
        return df
    where = row_label(key)
    return df.select(*[landed(col(f.name), f.dataType, f.name, where).alias(f.name) for f in df.schema.fields])


def row_label(key: Sequence[str]) -> Column | None:
    """Text that tells which row a refusal is about."""
    if not key:
        return None
    parts = [F.concat(F.lit(f"{k}="), F.coalesce(col(k).cast("string"), F.lit("NULL"))) for k in key]
    return F.concat_ws(", ", *parts)


def null_elements(value: Column) -> Column:
    return F.exists(value, lambda x: x.isNull())


def decimal_text(value: Column, data_type: T.DecimalType) -> Column:
    """Plain digits with the whole scale, in either ANSI mode."""
    if SparkSession.active().conf.get("spark.sql.ansi.enabled") == "true":
        return value.cast("string")
    # With ANSI mode off the cast prints a small decimal as 0E-9.
    return F.translate(F.format_number(value, data_type.scale), ",", "")


def time_text(value: Column) -> Column:
    """The time of day with all six digits of its fraction; Spark prints only those it needs."""
    text = value.cast("string")
    return F.rpad(F.when(F.contains(text, F.lit(".")), text).otherwise(F.concat(text, F.lit("."))), 15, "0")


def _landed_array(value, data_type, path, where, wire):
    element = data_type.elementType
    if needs_landing(element, wire):
        inner = lambda x: landed(x, element, path, where, wire)
        if data_type.containsNull:
            rows = F.transform(value, lambda x: F.when(x.isNull(), refusal(path, where)).otherwise(inner(x)))
        else:
            rows = F.transform(value, inner)
    elif data_type.containsNull:
        rows = F.when(null_elements(value), refusal(path, where)).otherwise(value)
    else:
        rows = value
    return F.coalesce(rows, F.array())


def _landed_map(value, data_type, path, where, wire):
    value_type, value_path = data_type.valueType, f"{path}.{MAP_VALUE}"
    if wire and not needs_landing(data_type.keyType, wire) and not needs_landing(value_type, wire):
        return F.coalesce(F.map_entries(value), F.array())
    if wire:
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.struct(
                landed(e[MAP_KEY], data_type.keyType, f"{path}.{MAP_KEY}", where, wire).alias(MAP_KEY),
                landed(e[MAP_VALUE], value_type, value_path, where, wire).alias(MAP_VALUE),
            ),
        )
        return F.coalesce(entries, F.array())
    if needs_landing(value_type):
        value = F.transform_values(value, lambda _, v: landed(v, value_type, value_path, where))
    return F.coalesce(value, F.create_map())


def refusal(path: str, where: Column | None) -> Column:
    text = F.lit(f"column '{path}': an array element is NULL; filter it out before writing")
    return F.raise_error(text if where is None else F.concat(text, F.lit(" ("), where, F.lit(")")))


def conformed(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """``value`` in the type of the target column, nested fields matched by name."""
    if same_type(have, want):
        return value
    if not isinstance(want, (T.StructType, T.ArrayType, T.MapType)):
        return value.cast(want)
    if isinstance(want, T.StructType):
        types = {f.name: f.dataType for f in have.fields}
        fields = [
            conformed(value.getField(f.name), types[f.name], f.dataType).alias(f.name)
            if f.name in types
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in want.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(want, T.MapType):
        entries = value if isinstance(have, T.ArrayType) else F.map_entries(value)
        return F.map_from_entries(_conformed_elements(entries, _entry(have), _entry(want)))
    elements = F.map_entries(value) if isinstance(have, T.MapType) else value
    return _conformed_elements(elements, _entry(have), _entry(want))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns of ``schema``; a column it lacks is NULL."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            (conformed(col(f.name), types[f.name], f.dataType) if f.name in types else F.lit(None).cast(f.dataType)).alias(
                f.name
            )
            for f in schema.fields
        ]
    )


def _conformed_elements(value: Column, have: T.DataType, want: T.DataType) -> Column:
    return value if same_type(have, want) else F.transform(value, lambda x: conformed(x, have, want))


def _entry(data_type: T.DataType) -> T.DataType:
    if isinstance(data_type, T.ArrayType):
        return data_type.elementType
    return T.StructType([T.StructField(MAP_KEY, data_type.keyType), T.StructField(MAP_VALUE, data_type.valueType)])
