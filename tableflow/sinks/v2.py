"""Tables of catalogs that commit writes themselves: Spark's V2 plans, chosen by what the table can do."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.java_gateway import JavaObject, is_instance_of
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.columns import col, quoted
from tableflow.errors import Code, TableflowError
from tableflow.sources.names import TableName

SESSION_CATALOG = "spark_catalog"
_CONNECTOR = "org.apache.spark.sql.connector.catalog"
_SOURCE = "_merge_s"


class Abilities:
    """What the catalog and the loaded table declare; nothing of it reads rows."""

    def __init__(self, spark: SparkSession, name: TableName):
        gateway = spark.sparkContext._gateway
        catalog = spark._jsparkSession.sessionState().catalogManager().catalog(name.project)
        self._gateway, self._table = gateway, None
        self.replaces_atomically = is_instance_of(gateway, catalog, f"{_CONNECTOR}.StagingTableCatalog")
        if spark.catalog.tableExists(name.sql):
            folder = gateway.new_array(gateway.jvm.java.lang.String, 1)
            folder[0] = name.dataset
            identifier = getattr(gateway.jvm, f"{_CONNECTOR}.Identifier").of(folder, name.table)
            self._table = catalog.loadTable(identifier)

    @property
    def table(self) -> JavaObject | None:
        return self._table

    @property
    def is_session_table(self) -> bool:
        """Whether Spark writes the table itself, file by file."""
        return self._table is None or is_instance_of(self._gateway, self._table, f"{_CONNECTOR}.V1Table")

    @property
    def merges(self) -> bool:
        return self._table is not None and is_instance_of(
            self._gateway, self._table, f"{_CONNECTOR}.SupportsRowLevelOperations"
        )

    @property
    def overwrites(self) -> bool:
        if self._table is None:
            return False
        able = {str(one) for one in self._table.capabilities()}
        return bool(able & {"TRUNCATE", "OVERWRITE_BY_FILTER"})


def commits_itself(spark: SparkSession, name: TableName) -> bool:
    """Whether writes to the table go through a V2 catalog: any but the session's own, or one put in its place."""
    configured = spark.conf.get(f"spark.sql.catalog.{name.project}", None)
    if name.project != SESSION_CATALOG:
        if configured is None:
            raise TableflowError(Code.TARGET_KIND, f"{name}: no catalog {name.project} is configured")
        return True
    return configured not in (None, "builtin") and not Abilities(spark, name).is_session_table


def check_abilities(name: str, mode: str, same_columns: bool, abilities: Abilities) -> None:
    """Refuse, before any row moves, what the table could not do in one commit."""
    if mode == "merge" and not abilities.merges:
        raise TableflowError(Code.TARGET_KIND, f"{name} takes no row-level operations, so no merge in one commit")
    if mode == "replace" and not (abilities.replaces_atomically or same_columns and abilities.overwrites):
        raise TableflowError(Code.TARGET_KIND, f"neither {name} nor its catalog replaces rows in one commit")


def overwrite(name: TableName, rows: DataFrame, abilities: Abilities, same_columns: bool, layout: Sequence[str]) -> None:
    """Make ``rows`` the table. One of the same columns keeps its definition, hidden partitions and properties too."""
    if abilities.table is not None and same_columns and abilities.overwrites:
        rows.writeTo(name.sql).overwrite(F.lit(True))
        return
    writer = rows.writeTo(name.sql)
    if layout:
        writer = writer.partitionedBy(*[col(c) for c in layout])
    if abilities.table is None:
        writer.create()
    else:
        writer.createOrReplace()


def merge_clauses(
    name: TableName, target: T.StructType, source: Sequence[str], keys: Sequence[str]
) -> tuple[Column, dict[str, Column], dict[str, Column]]:
    """When rows match, what a match sets, and what a row without a match inserts.

    NULL keys match NULL keys. A match takes every column of the source but the keys, NULLs
    included; columns the source lacks stay in a match and are NULL in an insert.
    """
    theirs = {c: F.col(f"{_SOURCE}.{quoted(c)}") for c in source}
    condition = None
    for key in keys:
        same = F.col(f"{name.sql}.{quoted(key)}").eqNullSafe(theirs[key])
        condition = same if condition is None else condition & same
    sets = {quoted(c): value for c, value in theirs.items() if c not in set(keys)}
    inserts = {quoted(f.name): theirs.get(f.name, F.lit(None).cast(f.dataType)) for f in target.fields}
    return condition, sets, inserts


def merge_into(name: TableName, target: T.StructType, latest: DataFrame, keys: Sequence[str]) -> None:
    """Spark's own merge. ``latest`` has one row for each key, in the target's types."""
    condition, sets, inserts = merge_clauses(name, target, latest.columns, keys)
    writer = latest.alias(_SOURCE).mergeInto(name.sql, condition)
    if sets:
        writer = writer.whenMatched().update(sets)
    writer.whenNotMatched().insert(inserts).merge()
