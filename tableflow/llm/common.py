"""What the text operators share: tables, staging, word rules, and worker-lifetime memory."""

from __future__ import annotations

import sys
import types
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.files import Files
from tableflow.session import staging_root

# The six ASCII white-space characters that part words.
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
# The two maps with which Python's ``translate`` lower-cases A-Z alone, in text and in bytes.
LOWER_TEXT = str.maketrans(UPPER, LOWER)
LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The ``[^\\x20\\x09-\\x0D]+`` runs of a text; an empty array for null and blank texts."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, "[ \\t-\\r]+")).otherwise(F.array().cast("array<string>"))


def n_words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t-\\r]+")), F.lit(0)).cast("long")


def staged(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage, survives lost executors.

    The staging sweep of the library removes what nobody dropped, by its prefix and age.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark)}/load_llm_{name}_{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    again = spark.read.schema(df.schema).parquet(path)
    again.staged_path = path
    return again


def drop_staged(df: DataFrame) -> None:
    """Remove a staged table nothing will read again."""
    path = df.staged_path
    Files(df.sparkSession, path).delete(path)


def worker_memory() -> dict:
    """A dict that lives as long as this Python worker process, for bounded caches."""
    name = "_tableflow_llm_worker"
    return vars(sys.modules.setdefault(name, types.ModuleType(name)))


def partitions_for(spark: SparkSession) -> int:
    """The number of partitions the session asks shuffles to have."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
