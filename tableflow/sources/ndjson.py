"""Loading NDJSON files under a given schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.functions.ndjson import JSON_OPTIONS
from tableflow.schema.landing import conform
from tableflow.schema.mapping import element_type, schema_map

_ROW = "_row"


def read_ndjson(
    spark: SparkSession, path: str, schema: T.StructType, *, ignore_unknown: bool = False, check_unread: bool = False
) -> DataFrame:
    """The files as ``schema``; a row that does not fit fails the load.

    Spark's default would turn a bad cell into NULL, and drop a member the schema does not
    name; here both are refused, at any depth. ``ignore_unknown`` drops such members after
    all. A row is parsed once, by the reader, into a variant; members are looked for and
    cells are cast from that. A query that uses some columns checks the values of only
    those; with ``check_unread`` every cell of every row is checked whatever is used.
    """
    schema_map(schema)
    wire = _wire_type(schema)
    options = {"mode": "FAILFAST", **JSON_OPTIONS}
    if ignore_unknown and not check_unread:
        return conform(spark.read.schema(wire).options(**options).json(path), schema)
    rows = spark.read.options(**options).option("singleVariantColumn", _ROW).json(path)
    row = F.col(_ROW)
    checked = F.when(F.try_variant_get(row, "$", "map<string,variant>").isNull(), _refusal("a row that is no object", row))
    if not ignore_unknown:
        checked = checked.when(_has_unknown(row, wire), _refusal("a member the table has no column for", row))
    rows = rows.where(checked.otherwise(F.lit(True)))
    # Cast at once to the shape of the row, with text for every value.
    rows = rows.select(F.variant_get(row, "$", _text_type(wire)).alias(_ROW))
    cells = [_cell(row.getField(f.name), f.dataType, f.name).alias(f.name) for f in wire.fields]
    if check_unread:
        # A condition that always holds and that no optimiser sees through.
        rows = rows.where(F.hash(*cells).bitwiseAND(1) < 2)
    return conform(rows.select(*cells), schema)


def _text_type(data_type: T.DataType) -> str:
    if isinstance(data_type, T.StructType):
        fields = ["`" + f.name.replace("`", "``") + "`:" + _text_type(f.dataType) for f in data_type.fields]
        return f"struct<{','.join(fields)}>"
    if isinstance(data_type, T.ArrayType):
        return f"array<{_text_type(data_type.elementType)}>"
    return "string"


def _refusal(what: str, value: Column) -> Column:
    text = F.substring(F.coalesce(value.cast("string"), F.lit("null")), 1, 500)
    return F.raise_error(F.concat(F.lit(f"{what} [MALFORMED_RECORD_IN_PARSING]: "), text))


def _member(value: Column, name: str) -> Column:
    quoted = f"['{name}']" if "'" not in name else f'["{name}"]'
    return F.try_variant_get(value, f"${quoted}", "variant")


def _has_unknown(value: Column, data_type: T.DataType) -> Column:
    """Whether a variant holds a member that ``data_type`` does not name, at any depth.

    NULL, and a value of another shape than its column's, count as known: the cast refuses the latter.
    """
    if isinstance(data_type, T.StructType):
        names = F.array(*[F.lit(f.name) for f in data_type.fields])
        members = F.map_keys(F.try_variant_get(value, "$", "map<string,variant>"))
        found = F.coalesce(F.size(F.array_except(members, names)) > 0, F.lit(False))
        for field in data_type.fields:
            if _holds_objects(field.dataType):
                found = found | _has_unknown(_member(value, field.name), field.dataType)
        return found
    if not _holds_objects(data_type):
        return F.lit(False)
    elements = F.try_variant_get(value, "$", "array<variant>")
    return F.coalesce(F.exists(elements, lambda x: _has_unknown(x, data_type.elementType)), F.lit(False))


def _holds_objects(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _holds_objects(data_type.elementType)
    return isinstance(data_type, T.StructType)


def _cell(value: Column, data_type: T.DataType, path: str) -> Column:
    """A value given as text, or as a struct or array of texts, as a column's type; a refusal if it does not fit."""
    if isinstance(data_type, T.StringType):
        return value
    if isinstance(data_type, T.StructType):
        fields = [_cell(value.getField(f.name), f.dataType, f"{path}.{f.name}").alias(f.name) for f in data_type.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(data_type, T.ArrayType):
        return F.transform(value, lambda x: _cell(x, data_type.elementType, path))
    refused = _refusal(f"a value that does not fit {path}", value)
    return F.when(value.isNotNull(), F.coalesce(_scalar(value, data_type), refused))


# The spellings of instants that ``JSON_OPTIONS`` names, with as many digits of the second as there are.
_DATE = r"^\d{4,6}-\d\d-\d\d"
_DATE_TIME = _DATE + r"T\d\d:\d\d:\d\d(\.\d{1,6})?"


def _scalar(text: Column, data_type: T.DataType) -> Column:
    """Text as a type without parts, NULL where it does not fit."""
    if isinstance(data_type, T.BooleanType):
        return F.when(text.isin("true", "false"), text == "true")
    if isinstance(data_type, T.BinaryType):
        return F.try_to_binary(text, F.lit("base64"))
    if isinstance(data_type, T.TimestampType):
        return F.when(text.rlike(_DATE_TIME + "Z$"), text.try_cast(data_type))
    if isinstance(data_type, T.TimestampNTZType):
        return F.when(text.rlike(_DATE_TIME + "$"), text.try_cast(data_type))
    if isinstance(data_type, T.DateType):
        return F.when(text.rlike(_DATE + "$"), text.try_cast(data_type))
    return text.try_cast(data_type)


def _wire_type(data_type: T.DataType) -> T.DataType:
    """The type a value has in the file: a map is an array of entries."""
    if isinstance(data_type, T.StructType):
        return T.StructType([T.StructField(f.name, _wire_type(f.dataType)) for f in data_type.fields])
    if isinstance(data_type, (T.ArrayType, T.MapType)):
        return T.ArrayType(_wire_type(element_type("", data_type)))
    if isinstance(data_type, T.TimeType):
        return T.StringType()
    return data_type
