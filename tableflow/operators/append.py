"""Appending by column name."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tableflow.schema.diff import check_write
from tableflow.schema.landing import conform


def append_rows(target: DataFrame, source: DataFrame) -> DataFrame:
    """All rows of both. The target's types apply and its extra columns are NULL."""
    check_write(target.schema, source.schema, "the target")
    return target.union(conform(source, target.schema))
