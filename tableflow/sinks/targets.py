"""Where a write lands: a folder of Parquet files, a managed table of the session catalog, or a table of another catalog."""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tableflow.columns import col
from tableflow.errors import Code, TableflowError
from tableflow.files import Files, declare_table, declared_table
from tableflow.leases import TableLock
from tableflow.sinks import v2
from tableflow.sinks.staging import drop_quietly, locked_table, recover_table, swap_folders
from tableflow.sources.names import TableName
from tableflow.sources.tables import read_folder, resolve_name

log = logging.getLogger(__name__)


# What a record of a stream's batches is called: a property of a catalog table, a file next to a folder table.
_BATCHES = "tableflow.batch."


class Batches(NamedTuple):
    """What a table knows of a stream: the last batch that holds, and one that began and was never settled."""

    last: int = -1
    begun: int | None = None


def resolve_target(
    spark: SparkSession, name: str, datasets: Mapping[str, str] | None, partition_by: Sequence[str]
) -> FolderTarget | CatalogTarget:
    parsed, path = resolve_name(spark, name, datasets)
    if path is None:
        kind = OwnCommitTarget if v2.commits_itself(spark, parsed) else CatalogTarget
        return kind(spark, parsed, partition_by)
    return FolderTarget(spark, path, partition_by)


class FolderTarget:
    def __init__(self, spark: SparkSession, path: str, partition_by: Sequence[str]):
        self.spark, self.name, self.partition_by = spark, path, list(partition_by)
        self._lock: TableLock | None = None

    @contextmanager
    def locked(self) -> Iterator[None]:
        """From the reading of the table to the end of the commit, no other writer may change it."""
        with locked_table(self.spark, self.name) as self._lock:
            try:
                yield
            finally:
                self._lock = None

    def open(self, schema: T.StructType, mode: str) -> DataFrame | None:
        """The existing table, or None. An existing layout holds for every mode but replace."""
        if self._lock is None:
            recover_table(self.spark, self.name)
        files = Files(self.spark, self.name)
        if not files.exists(self.name):
            return None
        declared = declared_table(self.spark, self.name)
        existing = read_folder(self.spark, self.name)
        layout = self._layout(files) if declared is None else declared.partition_by
        if declared is None:
            # Another writer's folders carry no types: a partition column has the type of the write.
            typed = [schema[f.name] if f.name in layout and f.name in schema.names else f for f in existing.schema]
            if [f.dataType for f in typed] != [f.dataType for f in existing.schema]:
                existing = self.spark.read.schema(T.StructType(typed)).parquet(self.name)
        self.partition_by = settled_layout(self.name, layout, self.partition_by, schema, mode)
        return existing

    def batches(self, stream: str) -> Batches:
        # Next to the table, so that a replace keeps it; a table that is gone has no batches.
        files, file = Files(self.spark, self.name), self._batches_file(stream)
        if not files.exists(self.name) or not files.exists(file):
            return Batches()
        return Batches(*json.loads(files.read_text(file)))

    def keep_batches(self, stream: str, batches: Batches) -> None:
        files = Files(self.spark, self.name)
        files.make_parent(self.name)
        files.write_text(self._batches_file(stream), json.dumps(batches))

    def _batches_file(self, stream: str) -> str:
        folder, _, table = self.name.rpartition("/")
        return f"{folder}/_{_BATCHES}{stream}={table}.json"

    def _layout(self, files: Files) -> list[str]:
        columns, folder = [], self.name
        while True:
            parts = [(name, path) for name, path, _ in files.children(folder) if "=" in name]
            if not parts:
                return columns
            name, folder = parts[0]
            columns.append(unquote(name.split("=", 1)[0]))

    def append(self, rows: DataFrame) -> None:
        # Spark's committer makes the new files visible when the whole job has succeeded.
        rows.write.mode("append").partitionBy(*self.partition_by).parquet(self.name)
        self.spark.catalog.refreshByPath(self.name)

    def put(self, rows: DataFrame) -> None:
        """Make ``rows`` the table: write them next to it, then swap."""
        folder, _, table = self.name.rpartition("/")
        new = f"{folder}/_new_{uuid.uuid4().hex}_{table}"
        try:
            rows.write.partitionBy(*self.partition_by).parquet(new)
            self._keep_schema(new, rows.schema)
            swap_folders(self.spark, self.name, [(new, self.name)], self._lock)
        finally:
            drop_quietly(self.spark, new)
        self.spark.catalog.refreshByPath(self.name)

    def put_partitions(self, rows: DataFrame) -> None:
        """Make ``rows`` the content of the partitions they belong to, leaving the others.

        Spark writes aside, and its committer replaces the partitions it has written when the
        job succeeds; so the plan may read the table it writes.
        """
        self._lock.check()
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*self.partition_by).parquet(self.name)
        self.spark.catalog.refreshByPath(self.name)

    def adopt(self, folder: str, schema: T.StructType) -> bool:
        """Make a folder already written in this layout the table, if a rename can."""
        if not Files(self.spark, self.name).holds(folder):
            return False
        self._keep_schema(folder, schema)
        swap_folders(self.spark, self.name, [(folder, self.name)], self._lock)
        self.spark.catalog.refreshByPath(self.name)
        return True

    def _keep_schema(self, folder: str, schema: T.StructType) -> None:
        if not self.partition_by:
            return
        # A partitioned write without rows leaves no file; an empty one holds the schema.
        names = [name for name, _, _ in Files(self.spark, folder).children(folder)]
        if not any("=" in name for name in names):
            self.spark.createDataFrame([], schema).write.mode("append").parquet(folder)
        # In the order Spark reads a partitioned folder in.
        inner = [f for f in schema.fields if f.name not in self.partition_by]
        fields = [*inner, *[schema[name] for name in self.partition_by]]
        nullable = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
        declare_table(self.spark, folder, nullable, self.partition_by)


class CatalogTarget:
    """A table in the session catalog. Replaced whole by renaming a new table over it."""

    def __init__(self, spark: SparkSession, name: TableName, partition_by: Sequence[str]):
        self.spark, self.table, self.partition_by = spark, name, list(partition_by)
        self.name = str(name)
        self._managed = True

    @contextmanager
    def locked(self) -> Iterator[None]:
        """The catalog itself settles renames of two writers."""
        yield

    def open(self, schema: T.StructType, mode: str) -> DataFrame | None:
        if not self.spark.catalog.tableExists(self.table.sql):
            return None
        kind = self.spark.catalog.getTable(self.table.sql).tableType
        if kind in ("VIEW", "TEMPORARY"):
            raise TableflowError(Code.TABLE_IS_VIEW, f"{self.name} is a view and cannot be written")
        self._managed = kind == "MANAGED"
        layout = [c.name for c in self.spark.catalog.listColumns(self.table.sql) if c.isPartition]
        self.partition_by = settled_layout(self.name, layout, self.partition_by, schema, mode)
        return self.spark.table(self.table.sql)

    def batches(self, stream: str) -> Batches:
        if not self.spark.catalog.tableExists(self.table.sql):
            return Batches()
        kept = {r.key: r.value for r in self.spark.sql(f"show tblproperties {self.table.sql}").collect()}
        return Batches(*json.loads(kept.get(_BATCHES + stream, "[]")))

    def keep_batches(self, stream: str, batches: Batches) -> None:
        # A table that is made by this commit gets its record after it.
        if self.spark.catalog.tableExists(self.table.sql):
            pair = f"'{_BATCHES}{stream}' = '{json.dumps(batches)}'"
            self.spark.sql(f"alter table {self.table.sql} set tblproperties ({pair})")

    def append(self, rows: DataFrame) -> None:
        rows.write.insertInto(self.table.sql)

    def put(self, rows: DataFrame) -> None:
        """Fill a new table, then rename it over the old one."""
        if not self._managed:
            raise TableflowError(
                Code.TARGET_KIND, f"{self.name} is an external table; write its folder as a dataset instead"
            )
        mark = uuid.uuid4().hex
        new, old = (TableName(self.table.project, self.table.dataset, f"{part}_{mark}").sql for part in ("new", "old"))
        replacing = self.spark.catalog.tableExists(self.table.sql)
        try:
            # Created empty first: a failed write then leaves a table to drop, not a stray folder.
            self._create_empty(new, rows.schema, like=self.table.sql if replacing and self._fits(rows) else None)
            filled = self.spark.table(new)
            rows.select(*[col(c) for c in filled.columns]).write.insertInto(new)
            if replacing:
                self._rename(self.table.sql, old)
            try:
                self._rename(new, self.table.sql)
            except BaseException:
                if replacing:
                    self._rename(old, self.table.sql)
                raise
        finally:
            self._drop_quietly(new)
        self._drop_quietly(old)

    def adopt(self, folder: str, schema: T.StructType) -> bool:
        return False

    def put_partitions(self, rows: DataFrame) -> None:
        # In dynamic mode Spark writes aside, and replaces only partitions it has written
        # when the job succeeds; so the plan may read the table it writes. An insert into a
        # table takes the mode from the session alone, so no other thread of this session
        # may overwrite partitions meanwhile.
        conf, key = self.spark.conf, "spark.sql.sources.partitionOverwriteMode"
        before = conf.get(key)
        conf.set(key, "dynamic")
        try:
            rows.write.insertInto(self.table.sql, overwrite=True)
        finally:
            conf.set(key, before)

    def _fits(self, rows: DataFrame) -> bool:
        """Whether the table can take ``rows`` as it is defined."""
        columns = self.spark.catalog.listColumns(self.table.sql)
        layout = [c.name for c in columns if c.isPartition]
        return {c.name for c in columns} == set(rows.columns) and layout == list(self.partition_by)

    def _create_empty(self, name: str, schema: T.StructType, like: str | None = None) -> None:
        if like is not None:
            # Format, declared types and comments come along, properties have to be carried.
            # The session catalog takes names of at most two parts here.
            self.spark.sql(f"create table {name.split('.', 1)[1]} like {like.split('.', 1)[1]}")
            comment = self.spark.catalog.getTable(like).description
            if comment is not None:
                said = comment.replace("\\", "\\\\").replace("'", "\\'")
                self.spark.sql(f"comment on table {name} is '{said}'")
            kept = {r.key: r.value for r in self.spark.sql(f"show tblproperties {like}").collect()}
            for key, value in kept.items():
                pair = [text.replace("\\", "\\\\").replace("'", "\\'") for text in (key, value)]
                self.spark.sql(f"alter table {name} set tblproperties ('{pair[0]}' = '{pair[1]}')")
            return
        writer = self.spark.createDataFrame([], schema).write.format("parquet")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.saveAsTable(name)

    def _rename(self, source: str, target: str) -> None:
        # The session catalog takes a rename target of at most two parts.
        self.spark.sql(f"alter table {source} rename to {target.split('.', 1)[1]}")

    def _drop_quietly(self, name: str) -> None:
        try:
            self.spark.sql(f"drop table if exists {name}")
        except Exception:
            log.warning("could not drop %s", name, exc_info=True)


class OwnCommitTarget(CatalogTarget):
    """A table whose catalog commits each of Spark's V2 plans at once; what it cannot commit at once is refused."""

    def open(self, schema: T.StructType, mode: str) -> DataFrame | None:
        if not self.spark.catalog.tableExists(self.table.sql):
            return None
        existing = self.spark.table(self.table.sql)
        v2.check_abilities(self.name, mode, set(existing.columns) == set(schema.names), self._abilities())
        # Rows are laid out by the table's own definition, of which an existing one may hide parts.
        columns = [c.name for c in self.spark.catalog.listColumns(self.table.sql) if c.isPartition]
        self.partition_by = settled_layout(self.name, columns, self.partition_by, schema, mode)
        return existing

    def append(self, rows: DataFrame) -> None:
        rows.writeTo(self.table.sql).append()

    def put(self, rows: DataFrame) -> None:
        abilities = self._abilities()
        same = abilities.table is not None and self._fits(rows)
        v2.overwrite(self.table, rows, abilities, same, self.partition_by)

    def merge(self, existing: DataFrame, latest: DataFrame, keys: Sequence[str]) -> None:
        v2.merge_into(self.table, existing.schema, latest, keys)

    def _abilities(self) -> v2.Abilities:
        return v2.Abilities(self.spark, self.table)


def settled_layout(
    name: str, layout: list[str], asked: list[str], schema: T.StructType, mode: str
) -> list[str]:
    if mode == "replace":
        kept = [c for c in layout if c in schema.names]
        return asked or (kept if len(kept) < len(schema.names) else [])
    if asked and asked != layout:
        raise TableflowError(Code.BAD_OPTION, f"{name} is partitioned by {layout}, not by {asked}")
    missing = [c for c in layout if c not in schema.names]
    if missing:
        raise TableflowError(Code.UNKNOWN_COLUMN, f"{name} is partitioned by {', '.join(missing)}, not in the write")
    return layout
