"""Writing a DataFrame as NDJSON files, and loading such files into a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.functions.ndjson import to_ndjson
from tableflow.sinks.write import WriteResult, write_table
from tableflow.sources.ndjson import read_ndjson
from tableflow.sources.tables import open_table


# Fixed value: how large a file gets before the next one begins.
FILE_BYTES = 64 * 1024 * 1024

#: One row in so many is encoded to measure the mean size.
MEASURED = 100


def write_ndjson(
    df: DataFrame,
    path: str,
    *,
    max_bytes_per_file: int = FILE_BYTES,
    max_records_per_file: int | None = None,
    key: Sequence[str] = (),
) -> None:
    """One file or more per partition, into a folder that must not exist yet.

    A partition's file rolls at about ``max_bytes_per_file``: Spark rolls by rows, so their mean size is
    measured first, over about one row in ``MEASURED``, or all where that finds none. ``max_records_per_file``
    gives the number of rows instead, without measuring.
    """
    encoded = to_ndjson(df, key)
    if max_records_per_file is None:
        size = F.avg(F.octet_length("value") + 1)
        mean = to_ndjson(df.sample(1 / MEASURED, 0), key).agg(size).first()[0] or encoded.agg(size).first()[0]
        max_records_per_file = max(1, int(max_bytes_per_file / mean)) if mean else 0
    encoded.write.option("maxRecordsPerFile", max_records_per_file).text(path)


def load_ndjson(
    spark: SparkSession,
    path: str,
    target: str,
    *,
    datasets: Mapping[str, str] | None = None,
    ignore_unknown: bool = False,
) -> WriteResult:
    """Append NDJSON files to an existing table, under the table's own schema.

    A missing table is refused. One row that does not fit, or that holds a member the table has no
    column for, fails the load, and none lands; ``ignore_unknown`` drops such members instead.
    """
    schema = open_table(spark, target, datasets).schema
    rows = read_ndjson(spark, path, schema, ignore_unknown=ignore_unknown)
    return write_table(rows, target, "append", datasets=datasets)
