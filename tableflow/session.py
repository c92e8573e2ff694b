"""Session settings the library expects, and the place staged tables go."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

from tableflow.errors import Code, TableflowError

# The settings a session should be built with.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024
# What one task gets of a shuffle or of files, in bytes as compressed; sorted or hashed they take some 20 times as many.
TASK_BYTES = 16 * 1024 * 1024
_TASK_SIZES = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")
_MOST_PARTITIONS = 2**31 - 1


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``SETTINGS``; all of them are runtime settings."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Let shuffles start with partitions of about ``SHUFFLE_PARTITION_BYTES`` of the input.

    AQE coalesces what turns out small, so the number is a start and not a cost. It only grows, as a plan sized
    earlier may run later. An estimate beyond what the setting can count is Spark's word for an unknown size, and
    changes nothing. Returns the number. The sizes of ``_TASK_SIZES`` that are above ``TASK_BYTES`` are brought down
    to it, so that the memory of a task does not grow with the input.
    """
    number_of = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for size in _TASK_SIZES:
        if number_of(spark.conf.get(size)) > TASK_BYTES:
            spark.conf.set(size, str(TASK_BYTES))
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    wanted = -(-input_bytes // SHUFFLE_PARTITION_BYTES)
    if wanted > _MOST_PARTITIONS:
        wanted = 0
    number = max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.conf.get(key, None) or 0))
    spark.conf.set(key, str(number))
    return number


def staging_root(spark: SparkSession, staging_dir: str | None = None) -> str:
    """The shared folder for staged tables: the argument, else ``spark.checkpoint.dir``.

    A machine-local temporary folder is used only when Spark itself runs on this
    one machine; on a cluster a missing setting is refused.
    """
    if staging_dir:
        return staging_dir.rstrip("/")
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if shared is None and context.master.startswith("local"):
        context.setCheckpointDir("file:" + tempfile.mkdtemp(prefix="tableflow-"))
        shared = context.getCheckpointDir()
    if shared:
        return shared.rstrip("/") + "/tableflow"
    raise TableflowError(
        Code.STAGING_REQUIRED,
        "no place to stage rows: pass staging_dir or set spark.checkpoint.dir to a shared folder",
    )
