"""Exact deduplication by a stateful stream: disk-backed state keyed by digest, with hits checked byte by byte."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.llm.common import SPACES, partitions_for, staged
from tableflow.session import staging_root

#: Bytes of files that one micro-batch takes; a job that is lost repeats at most one of them.
BATCH_BYTES = 256 << 30
#: Digests of groups that are sent to every task, to shuffle the texts of those groups alone; beyond, all are shuffled.
BROADCAST_DIGESTS = 100_000

# The state store on disk, with bounded memory for all stores of an executor, and unloaded between batches: an open
# store holds 4 MiB of disk, however little is in it.
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "400",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def normalised(text: Column) -> Column:
    """Null as empty, and every run of white space as one space; texts without such runs are left as they are."""
    text = F.coalesce(text, F.lit(""))
    return F.when(text.rlike("[\t-\r]|  "), F.regexp_replace(text, f"[{SPACES}]+", " ")).otherwise(text)


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _keyed(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """``digest, keep, text``: ``keep`` orders documents by id, none last, then by where they are."""
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    text = normalised(F.col("text"))
    keep = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), at.alias("at"))
    return docs.select(digest(text).alias("digest"), keep.alias("keep"), text.alias("text"))


class ExactDedup:
    """Exact deduplication of a folder of Parquet files to which files are only added.

    ``update`` streams the files not met before through a keyed state without expiry: for each digest the document that
    stays (``doc_id``, and file and row where its text is) and the number of documents. Tasks combine copies before the
    shuffle. The state is RocksDB's under ``checkpoint``; the same checkpoint goes on where the last run ended, so
    neither earlier files nor lost executors cost a second reading. ``documents`` gives every row its group.

    Null texts are empty. Of equal texts the smallest ``doc_id`` stays, a null one only without another, and of equal
    ids the first by file and row. Rows may repeat; other columns are never read. An empty folder gives no rows.
    Documents whose digests agree and whose bytes differ are groups of their own.
    """

    def __init__(
        self,
        spark: SparkSession,
        source: str,
        checkpoint: str | None = None,
        digest: Callable[[Column], Column] = sha256,
        max_files: int | None = None,
    ):
        self._spark, self._source, self._digest = spark, source, digest
        self.checkpoint = checkpoint or f"{staging_root(spark)}/load_llm_exact_dedup_{uuid.uuid4().hex}"
        self._limit = ("maxFilesPerTrigger", str(max_files)) if max_files else ("maxBytesPerTrigger", str(BATCH_BYTES))

    def update(self) -> None:
        """Take in all files that are there and were not met before."""
        # A session of its own, so that the settings of the caller's stay as they are.
        session = self._spark.newSession()
        for key, value in {**_STATE, "spark.sql.shuffle.partitions": str(partitions_for(self._spark))}.items():
            session.conf.set(key, value)
        schema = self._spark.read.parquet(self._source).schema
        # A pattern, as a stream takes no path of a single file.
        files = f"{self._source[:-1]}[{self._source[-1]}]"
        docs = session.readStream.schema(schema).option(*self._limit).parquet(files)
        groups = _keyed(docs, self._digest).groupBy("digest").agg(F.min("keep").alias("keep"), F.count(F.lit(1)).alias("n"))
        query = (
            groups.writeStream.format("noop").outputMode("update")
            .option("checkpointLocation", self.checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()

    def state(self) -> DataFrame:
        """``digest, keep, n`` of every digest, from the state's last version."""
        stored = self._spark.read.format("statestore").load(self.checkpoint)
        return stored.select("key.digest", F.col("value.min").alias("keep"), F.col("value.count").alias("n"))

    def documents(self) -> DataFrame:
        """``doc_id, digest, keep_id, group_size, kept`` of every row, dropped ones too.

        A hit is a document of a digest with several. The texts of hits are grouped by digest and bytes, copies first
        within their tasks, and each group is held against the document the state points to; whatever does not share
        its bytes is a group of its own.
        """
        state = staged(self.state(), "dedup_state")
        rows = _keyed(self._spark.read.parquet(self._source), self._digest)
        hits = state.where("n > 1").select("digest")
        many = hits.limit(BROADCAST_DIGESTS + 1).count() > BROADCAST_DIGESTS
        texts = rows if many else rows.join(F.broadcast(hits), "digest", "left_semi")
        checked = texts.groupBy("digest", "text").agg(F.min("keep").alias("first"), F.count(F.lit(1)).alias("size"))
        apart = staged(
            checked.select("digest", "first").join(state, "digest").where("first.at <> keep.at").select("digest").distinct(),
            "dedup_apart",
        )
        grouped = rows.drop("text").withColumnRenamed("keep", "own").join(state, "digest")
        if not apart.isEmpty():
            # Digests that several texts share: their groups are those of the bytes.
            shared = rows.join(apart, "digest", "left_semi")
            groups = shared.groupBy("digest", "text").agg(F.min("keep").alias("keep"), F.count(F.lit(1)).alias("n"))
            members = shared.withColumnRenamed("keep", "own").join(groups, ["digest", "text"]).drop("text")
            grouped = grouped.join(apart, "digest", "left_anti").unionByName(members)
        return grouped.select(
            F.col("own.doc_id").alias("doc_id"),
            "digest",
            F.col("keep.doc_id").alias("keep_id"),
            F.col("n").alias("group_size"),
            (F.col("own.at") == F.col("keep.at")).alias("kept"),
        )


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    dedup = ExactDedup(spark, f"{sf_dir.rstrip('/')}/documents.parquet")
    dedup.update()
    return dedup.documents().select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


OP12_SQL = r"""
with d as (
  select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents)
select doc_id, min(doc_id) over g as keep_id, count(*) over g as group_size,
       doc_id = min(doc_id) over g as kept, text_sha256
from d window g as (partition by text_sha256)
"""
