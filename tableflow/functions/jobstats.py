"""Summing the statistics that finished jobs report as JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.columns import col, require_columns

# Fixed value: the members read. Every number is an int64 spelled as text.
STATISTICS = (
    "startTime string, endTime string, totalBytesProcessed string, totalSlotMs string, "
    "query struct<totalBytesBilled: string, totalBytesProcessed: string>"
)


def job_stats(df: DataFrame, json_col: str, by: Sequence[str]) -> DataFrame:
    """Per group: jobs, bytes billed, remote milliseconds, slot milliseconds, bytes processed.

    A measure no job of the group reports is NULL. Absent or malformed text reports
    nothing and is never an error; sums are decimals, so they cannot overflow either.
    """
    require_columns([json_col, *by], df.columns, "column")
    parsed = df.select(*[col(c) for c in by], F.from_json(col(json_col), STATISTICS).alias("_s"))
    processed = F.coalesce(F.col("_s.totalBytesProcessed"), F.col("_s.query.totalBytesProcessed"))
    # The numbers first, each read once; then the rules on them.
    numbers = parsed.select(
        *[col(c) for c in by],
        _int64("_s.query.totalBytesBilled").alias("_billed"),
        _int64("_s.startTime").alias("_start"),
        _int64("_s.endTime").alias("_end"),
        _int64("_s.totalSlotMs").alias("slot_ms"),
        _int64(processed).alias("bytes_processed"),
    )
    measures = numbers.select(
        *[col(c) for c in by],
        F.when(F.col("_billed") > 0, F.col("_billed")).alias("bytes_billed"),
        F.when(F.col("_end") > F.col("_start"), F.col("_end") - F.col("_start")).alias("remote_ms"),
        "slot_ms",
        "bytes_processed",
    )
    names = ("bytes_billed", "remote_ms", "slot_ms", "bytes_processed")
    return measures.groupBy(*[col(c) for c in by]).agg(
        F.count(F.lit(1)).alias("jobs"), *[F.sum(F.col(n).cast("decimal(20,0)")).alias(n) for n in names]
    )


def _int64(text: str | Column) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.when(text.rlike(r"\A[0-9]+\z"), text.try_cast("bigint"))
