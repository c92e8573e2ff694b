"""Writing DataFrames: append, replace and keyed merge, with one commit."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.columns import col, require_columns
from tableflow.errors import Code, TableflowError
from tableflow.leases import FolderLease
from tableflow.operators.dedup import dedup_last
from tableflow.operators.merge import check_keys, in_groups_of, merge_rows
from tableflow.schema.diff import check_write
from tableflow.schema.landing import conform, landed_frame
from tableflow.schema.mapping import SEQUENCE_COLUMN, same_type, schema_map
from tableflow.session import staging_root
from tableflow.sinks.staging import drop_quietly
from tableflow.sinks.targets import Batches, CatalogTarget, FolderTarget, OwnCommitTarget, resolve_target
from tableflow.sizes import broadcast_limit, row_bytes

MODES = ("append", "replace", "merge")
SCHEMA_POLICIES = ("fail_on_change",)

_BATCH = "_batch_no"


@dataclass(frozen=True)
class WriteResult:
    """Rows staged (before deduplication) and batches written; none of either for a batch that had been committed."""

    rows: int
    batches: int


class WriteSession:
    """Several batches, one commit. Nothing reaches the target before ``commit``.

    Each ``write`` lands its batch in a staging folder, so a batch is read once and
    keeps its order stamp. ``commit`` brings the staged rows into the target with one
    job, or, where they are the whole of a folder table, by moving the staging folder
    there. Leaving the ``with`` block without a commit, or an error in it, drops them.

    In merge mode the last row of a key wins: by ``sequence_by`` when given, then by
    batch, then by position in the batch as Spark read it. Give ``sequence_by`` when the
    order within a batch matters and the batch is not a plain scan.

    ``batch`` is a stream's name and the number of its batch, as ``foreachBatch`` gives it. A
    batch that the table holds already is not written again. See :func:`settle_batch` for one
    whose driver died.
    """

    def __init__(
        self,
        spark: SparkSession,
        target: str,
        mode: str = "append",
        *,
        keys: Sequence[str] = (),
        sequence_by: Sequence[str] = (),
        datasets: Mapping[str, str] | None = None,
        staging_dir: str | None = None,
        partition_by: Sequence[str] = (),
        schema_policy: str = "fail_on_change",
        schema: T.StructType | None = None,
        batch: tuple[str, int] | None = None,
        **options,
    ):
        if mode not in MODES:
            raise TableflowError(Code.WRITE_MODE, f"write mode {mode!r} is not one of {', '.join(MODES)}")
        if schema_policy not in SCHEMA_POLICIES:
            raise TableflowError(
                Code.SCHEMA_POLICY, f"schema policy {schema_policy!r} is not supported; align the target by hand"
            )
        if mode == "merge" and not keys:
            raise TableflowError(Code.MERGE_KEY, "a merge needs at least one key")
        if options:
            raise TableflowError(Code.BAD_OPTION, f"unknown option: {', '.join(sorted(options))}")
        if batch is not None:
            _check_batch(*batch)
        self._spark, self._mode, self._batch = spark, mode, batch
        self._keys, self._sequence_by, self._partition_by = list(keys), list(sequence_by), list(partition_by)
        self._target = resolve_target(spark, target, datasets, partition_by)
        self._schema: T.StructType | None = None
        if schema is not None:
            self._accept(schema)
        self._staging = f"{staging_root(spark, staging_dir)}/load_{uuid.uuid4().hex}"
        self._lease: FolderLease | None = None
        self._rows = self._bytes = self._batches = 0
        self._state = "open"

    def __enter__(self) -> WriteSession:
        return self

    def __exit__(self, *exc) -> None:
        if self._state == "open":
            self.abort()

    def write(self, df: DataFrame) -> None:
        self._require_open()
        self._accept(df.schema)
        rows = landed_frame(df, self._keys)
        if self._batches == 0:
            existing = self._target.open(rows.schema, self._mode)
            if existing is not None:
                check_write(existing.schema, rows.schema, self._target.name)
        layout = []
        measures = [F.count(F.lit(1)).alias("rows")]
        if self._mode == "merge":
            rows = rows.withColumn(_BATCH, F.lit(self._batches))
            rows = rows.withColumn(SEQUENCE_COLUMN, F.monotonically_increasing_id())
            measures.append(F.coalesce(F.sum(row_bytes(rows.schema)), F.lit(0)).alias("bytes"))
        else:
            # Staged as the target stores rows, so that the folder itself can become the target.
            layout = self._target.partition_by
        count = Observation(f"batch_{self._batches}")
        if self._lease is None:
            self._lease = FolderLease(self._spark, self)
            self._lease.add(self._staging)
        staged = _clustered(rows, layout).observe(count, *measures)
        staged.write.mode("append").partitionBy(*layout).parquet(self._staged_rows)
        self._batches += 1
        self._rows += count.get["rows"]
        self._bytes += count.get.get("bytes", 0)

    def commit(self) -> WriteResult:
        self._require_open()
        if self._schema is None:
            raise TableflowError(Code.SESSION_STATE, "nothing was written and no schema was given")
        self._state = "committed"
        try:
            small = self._bytes <= broadcast_limit(self._spark)
            strategy = "broadcast" if small else "shuffle"
            folder = self._staged_rows if self._batches and self._mode != "merge" else None
            landed = _land(
                self._target, self._mode, self._staged(), self._schema, self._keys, self._order(), strategy, folder,
                batch=self._batch,
            )
        finally:
            self._drop_staging()
        return WriteResult(self._rows, self._batches) if landed else WriteResult(0, 0)

    def abort(self) -> None:
        self._require_open()
        self._state = "aborted"
        self._drop_staging()

    def _drop_staging(self) -> None:
        if self._lease is not None:
            self._lease.close()
        drop_quietly(self._spark, self._staging)

    def _accept(self, schema: T.StructType) -> None:
        """Every refusal that needs only the schema, before any row is read."""
        _check_schema(schema, self._mode, self._keys, self._sequence_by, self._partition_by)
        if self._schema is None:
            self._schema = schema
        elif not same_type(schema, self._schema):
            raise TableflowError(Code.SCHEMA_MISMATCH, "the batch does not have the schema of the session")

    def _staged(self) -> DataFrame:
        # The schema after landing: what the staged files hold.
        empty = landed_frame(self._spark.createDataFrame([], self._schema))
        if self._mode == "merge":
            empty = empty.withColumn(_BATCH, F.lit(0)).withColumn(SEQUENCE_COLUMN, F.lit(0).cast("long"))
        if not self._batches:
            return empty
        staged = self._spark.read.schema(empty.schema).parquet(self._staged_rows)
        return staged.select(*[col(c) for c in empty.columns])

    @property
    def _staged_rows(self) -> str:
        return f"{self._staging}/rows"

    def _order(self) -> list[str]:
        return [*self._sequence_by, _BATCH, SEQUENCE_COLUMN]

    def _require_open(self) -> None:
        if self._state != "open":
            raise TableflowError(Code.SESSION_STATE, f"the write session is {self._state}")


def write_table(df: DataFrame, target: str, mode: str = "append", **options) -> WriteResult:
    """Write one DataFrame; ``options`` are the keywords of :class:`WriteSession`.

    An append or a replace is one job straight into place: Spark's committer, or the
    swap, already keeps the target untouched until the job has succeeded. A merge reads
    its source twice and is staged first.
    """
    spark = df.sparkSession
    session = WriteSession(spark, target, mode, **options)
    if mode == "merge":
        with session:
            session.write(df)
            return session.commit()
    session._accept(df.schema)
    count = Observation("written")
    landed = _land(session._target, mode, landed_frame(df), df.schema, count=count, batch=session._batch)
    return WriteResult(count.get["rows"], 1) if landed else WriteResult(0, 0)


def settle_batch(
    spark: SparkSession,
    target: str,
    stream: str,
    number: int,
    committed: bool,
    *,
    datasets: Mapping[str, str] | None = None,
) -> None:
    """Say whether a batch holds whose driver died while appending it, which the table alone cannot tell.

    Until then an append of the stream is refused as ``batch_unknown``. Merges and replaces
    need no such word: doing them again gives the same table.
    """
    _check_batch(stream, number)
    place = resolve_target(spark, target, datasets, ())
    with place.locked():
        known = place.batches(stream)
        if known.begun != number:
            raise TableflowError(Code.BAD_OPTION, f"batch {number} of {stream!r} is not open in {place.name}")
        place.keep_batches(stream, Batches(number if committed else known.last))


def _check_batch(stream: str, number: int) -> None:
    if not re.fullmatch(r"[A-Za-z0-9_.-]{1,100}", stream):
        raise TableflowError(Code.BAD_OPTION, f"stream name {stream!r} is not letters, digits, '_', '.' and '-'")
    if number < 0:
        raise TableflowError(Code.BAD_OPTION, f"batch number {number} is negative")


def _check_schema(
    schema: T.StructType, mode: str, keys: list[str], sequence_by: list[str], partition_by: list[str]
) -> None:
    if mode == "merge":
        check_keys(keys, schema)
    names = [field.name for field in schema.fields]
    reserved = [name for name in names if name in (SEQUENCE_COLUMN, _BATCH)]
    if reserved:
        raise TableflowError(Code.RESERVED_COLUMN, f"column name is reserved: {', '.join(reserved)}")
    if len({name.lower() for name in names}) < len(names):
        raise TableflowError(Code.SCHEMA_MISMATCH, "two columns of the write differ only by case")
    require_columns([*sequence_by, *partition_by], names, "sequence or partition column")
    schema_map(schema)


def _land(
    target: FolderTarget | CatalogTarget,
    mode: str,
    rows: DataFrame,
    schema: T.StructType,
    keys: Sequence[str] = (),
    order: Sequence[str] = (),
    strategy: str = "auto",
    folder: str | None = None,
    count: Observation | None = None,
    batch: tuple[str, int] | None = None,
) -> bool:
    """The one step that touches the target, after the schema check every mode gets; whether it did.

    ``folder`` is where ``rows`` are staged, when they are staged as the target stores them.
    """
    with target.locked():
        if batch is None:
            _land_locked(target, mode, rows, schema, keys, order, strategy, folder, count)
            return True
        stream, number = batch
        known = target.batches(stream)
        if number <= known.last:
            return False
        if mode == "append" and known.begun is not None:
            raise TableflowError(
                Code.BATCH_UNKNOWN,
                f"a driver died while it appended batch {known.begun} of {stream!r} to {target.name}; see settle_batch",
            )
        target.keep_batches(stream, Batches(known.last, number))
        try:
            _land_locked(target, mode, rows, schema, keys, order, strategy, folder, count)
        except Exception as error:
            # A failed write leaves the table as it was; who lost the lock has no say any more.
            if not (isinstance(error, TableflowError) and error.code is Code.COMMIT_LOST):
                target.keep_batches(stream, known)
            raise
        target.keep_batches(stream, Batches(number))
        return True


def _land_locked(target, mode, rows, schema, keys, order, strategy, folder, count) -> None:
    existing = target.open(rows.schema, mode)
    columns = [field.name for field in schema.fields]
    if existing is not None:
        check_write(existing.schema, rows.select(*[col(c) for c in columns]).schema, target.name)
    if mode == "merge" and existing is not None:
        _merge_into(target, existing, rows, keys, order, strategy)
        return
    if mode == "merge":
        rows = dedup_last(rows, keys, order).select(*[col(c) for c in columns])
    rows = _clustered(rows, target.partition_by)
    if count is not None:
        # Counted after any shuffle, in the tasks that write: a retried task counts once.
        rows = rows.observe(count, F.count(F.lit(1)).alias("rows"))
    if mode == "append" and existing is not None:
        target.append(conform(rows, existing.schema))
    elif folder is None or not target.adopt(folder, rows.schema):
        target.put(rows)


def _merge_into(
    target: FolderTarget | CatalogTarget,
    existing: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    strategy: str,
) -> None:
    if isinstance(target, OwnCommitTarget):
        written = [c for c in rows.columns if c in set(existing.columns)]
        latest = dedup_last(rows, keys, order).select(*[col(c) for c in written])
        target.merge(existing, conform(latest, T.StructType([f for f in existing.schema if f.name in written])), keys)
        return
    layout = target.partition_by
    # With the partition columns among the keys, a row never changes partition, so only
    # the partitions the source names need reading and writing.
    if layout and set(layout) <= set(keys):
        # The filter drops nothing. It marks the partition values as a selection, without which Spark
        # does not prune the scan of the target by them at run time.
        named = rows.where(F.col(_BATCH) >= 0).select(*[col(c) for c in layout]).distinct()
        touched = in_groups_of(existing, named, layout)
        target.put_partitions(_clustered(merge_rows(touched, rows, keys, order, strategy=strategy), layout))
        return
    target.put(_clustered(merge_rows(existing, rows, keys, order, strategy=strategy), layout))


def _clustered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of one table partition together, so that it gets few files.

    Rebalancing, unlike a repartition, lets AQE split a partition that holds too much.
    """
    return df.hint("rebalance", *[col(c) for c in partition_by]) if partition_by else df
