"""Keeping the last row of every key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableflow.columns import col, require_columns
from tableflow.errors import Code, TableflowError
from tableflow.session import size_shuffles
from tableflow.sizes import sorted_bytes

_RANK = "_dedup_rank"


def dedup_last(df: DataFrame, keys: Sequence[str], sequence_by: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``sequence_by``. NULL keys are one key.

    ``sequence_by`` should order the rows of a key totally; among rows that tie, any
    may win. Spark ranks inside every task before the shuffle (WindowGroupLimit), so
    a hot key sends one row per task, not all of its rows, to the task that owns it.
    """
    if not keys or not sequence_by:
        raise TableflowError(Code.BAD_OPTION, "deduplication needs key columns and sequence columns")
    require_columns([*keys, *sequence_by], df.columns, "key or sequence column")
    size_shuffles(df.sparkSession, sorted_bytes(df))
    window = Window.partitionBy(*[col(k) for k in keys]).orderBy(*[col(c).desc() for c in sequence_by])
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)
