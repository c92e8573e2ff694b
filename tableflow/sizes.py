"""Size checks behind every choice between a broadcast and a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.columns import col

# A fixed-width value in a row of Spark takes one word of this many bytes.
_WORD = 8
# Rows being sorted take about this many times their bytes in a Parquet file (line items: four columns, two keys).
_SORTED = 16


def broadcast_limit(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes; below zero means never."""
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def estimated_bytes(df: DataFrame) -> int:
    """What Catalyst takes the plan's result to be; for files, their compressed size."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def joined_bytes(df: DataFrame) -> int:
    """``estimated_bytes``, but of a join the sum of its sides, where Catalyst may multiply them."""
    return _joined_bytes(df._jdf.queryExecution().optimizedPlan())[0]


def _joined_bytes(plan) -> tuple[int, bool]:
    """The bytes of a logical plan, and whether a join is in it."""
    children = plan.children()
    inner = [_joined_bytes(children.apply(i)) for i in range(children.size())]
    if plan.nodeName() == "Join" or any(joined for _, joined in inner):
        return sum(size for size, _ in inner), True
    return int(str(plan.stats().sizeInBytes())), False


def sorted_bytes(df: DataFrame) -> int:
    """What the rows take in the memory of the tasks that sort them, over all tasks."""
    return _SORTED * joined_bytes(df)


def row_bytes(schema: T.StructType) -> Column:
    """The size of a row in memory: its words, its text and bytes, and those of its nested values."""
    return sum((_value_bytes(col(f.name), f.dataType) for f in schema.fields), F.lit(0)).cast("long")


def _value_bytes(value: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, (T.StringType, T.VarcharType, T.CharType, T.BinaryType)):
        return F.lit(_WORD) + F.coalesce(F.octet_length(value), F.lit(0))
    if isinstance(data_type, T.StructType):
        return sum((_value_bytes(value.getField(f.name), f.dataType) for f in data_type.fields), F.lit(_WORD))
    if isinstance(data_type, T.MapType):
        keys = _value_bytes(F.map_keys(value), T.ArrayType(data_type.keyType))
        return keys + _value_bytes(F.map_values(value), T.ArrayType(data_type.valueType))
    if not isinstance(data_type, T.ArrayType):
        return F.lit(_WORD)
    element = data_type.elementType
    if isinstance(element, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        inner = F.size(value) * _WORD
    else:
        inner = F.aggregate(value, F.lit(0).cast("long"), lambda sum_, x: sum_ + _value_bytes(x, element))
    return F.lit(_WORD) + F.coalesce(inner, F.lit(0))
