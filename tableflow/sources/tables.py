"""Reading a table by name, with pruning, a predicate and incremental bounds."""

from __future__ import annotations

import threading
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession

from tableflow.columns import col, require_columns
from tableflow.errors import Code, TableflowError
from tableflow.files import declared_table
from tableflow.schema.mapping import field_mode, flat_fields
from tableflow.sources.cursor import cursor_condition
from tableflow.sources.names import TableName, parse_table_name

_QUOTED_IDENTIFIERS = "spark.sql.ansi.doubleQuotedIdentifiers"
_ANSI = "spark.sql.ansi.enabled"
_quoted_lock = threading.Lock()


def resolve_name(spark: SparkSession, name: str, datasets: Mapping[str, str] | None) -> tuple[TableName, str | None]:
    """The parsed name, and its path when its dataset is a folder of Parquet tables."""
    parsed = parse_table_name(name, spark.catalog.currentCatalog())
    folder = (datasets or {}).get(parsed.dataset)
    return parsed, None if folder is None else f"{folder.rstrip('/')}/{parsed.table}.parquet"


def open_table(
    spark: SparkSession, name: str, datasets: Mapping[str, str] | None = None, allow_views: bool = False
) -> DataFrame:
    """The whole table, lazily. ``datasets`` maps a dataset to a folder; others are in the catalog."""
    parsed, path = resolve_name(spark, name, datasets)
    try:
        if path is not None:
            return read_folder(spark, path)
        if not allow_views and spark.catalog.getTable(parsed.sql).tableType in ("VIEW", "TEMPORARY"):
            raise TableflowError(
                Code.TABLE_IS_VIEW, f"{parsed} is a view; read it as a query: select * from {parsed.sql}"
            )
        return spark.table(parsed.sql)
    except AnalysisException as error:
        if error.getCondition() in ("TABLE_OR_VIEW_NOT_FOUND", "PATH_NOT_FOUND", "SCHEMA_NOT_FOUND"):
            raise TableflowError(Code.TABLE_NOT_FOUND, f"there is no table {parsed}") from error
        raise


def read_folder(spark: SparkSession, path: str) -> DataFrame:
    """A folder of Parquet files, partition columns in the types the table was declared with, where it says so."""
    declared = declared_table(spark, path)
    return spark.read.parquet(path) if declared is None else spark.read.schema(declared.schema).parquet(path)


def read_table(
    spark: SparkSession,
    name: str,
    *,
    datasets: Mapping[str, str] | None = None,
    allow_views: bool = False,
    **hints,
) -> DataFrame:
    """Read ``name``; ``hints`` are the keywords of :func:`apply_hints`."""
    return apply_hints(open_table(spark, name, datasets, allow_views), **hints)


def apply_hints(
    df: DataFrame,
    *,
    columns: Sequence[str] | None = None,
    predicate: str | Column | None = None,
    cursor: str | None = None,
    lower: str | None = None,
    upper: str | None = None,
    lower_inclusive: bool = False,
    max_partitions: int | float | None = None,
) -> DataFrame:
    """Predicate, then bounds, then columns in the order asked, then the partition ceiling.

    Filters come before the projection, so they may use columns that are not
    selected; Catalyst still prunes the scan to what is used.
    """
    ceiling = _partition_ceiling(max_partitions)
    bounds = cursor_condition(df.schema, cursor, lower, upper, lower_inclusive)
    if columns:
        require_columns(columns, df.columns, "column")
    if predicate is not None and not (isinstance(predicate, str) and predicate == ""):
        df = _where(df, predicate)
    if bounds is not None:
        df = df.where(bounds)
    if columns:
        df = df.select(*[col(name) for name in columns])
    return df if ceiling is None else df.coalesce(ceiling)


def describe_table(
    spark: SparkSession, name: str, *, datasets: Mapping[str, str] | None = None, allow_views: bool = False
) -> DataFrame:
    """One row per column, nested ones by dotted path. Reads metadata only, no rows."""
    schema = open_table(spark, name, datasets, allow_views).schema
    rows = [(path, field.dataType.simpleString(), field_mode(field)) for path, field in flat_fields(schema)]
    return spark.createDataFrame(rows, "column string, type string, mode string")


def _where(df: DataFrame, predicate: str | Column) -> DataFrame:
    if isinstance(predicate, Column) or '"' not in predicate:
        return df.where(predicate if isinstance(predicate, Column) else f"({predicate})")
    # By default Spark reads "x" as a string. In a predicate it names a column, so the
    # text is parsed with that setting on; parsing happens inside where(), not later.
    conf = df.sparkSession.conf
    with _quoted_lock:
        before = {key: conf.get(key) for key in (_ANSI, _QUOTED_IDENTIFIERS)}
        try:
            for key in before:
                conf.set(key, "true")
            return df.where(f"({predicate})")
        finally:
            for key, value in before.items():
                conf.set(key, value)


def _partition_ceiling(value: int | float | None) -> int | None:
    if value is None:
        return None
    whole = isinstance(value, (int, float)) and not isinstance(value, bool) and value == value // 1
    if not whole or value < 1:
        raise TableflowError(Code.BAD_OPTION, f"max_partitions must be a whole number of 1 or more, not {value!r}")
    return int(value)
