"""Catalogs that commit writes themselves. None with row-level operations is at hand here, so
the choice, the refusals and the plans are tested, and the session catalog stands in where its
tables can take the same call."""

from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException, UnsupportedOperationException
from pyspark.sql import types as T

from tableflow import Code, TableflowError, WriteSession, write_table
from tableflow.sinks import v2
from tableflow.sinks.targets import CatalogTarget, OwnCommitTarget, resolve_target
from tableflow.sources.names import TableName

DEPOT = TableName(v2.SESSION_CATALOG, "depot", "parts")


def able(**having):
    return SimpleNamespace(**{"merges": False, "overwrites": False, "replaces_atomically": False, "table": None, **having})


@pytest.fixture
def depot(spark):
    spark.sql("create database if not exists depot")
    spark.sql("drop table if exists depot.parts")
    yield "depot.parts"
    spark.sql("drop table if exists depot.parts")


@pytest.fixture
def own_commits(monkeypatch):
    """The tables of the session catalog, taken for such that commit themselves, with the given abilities."""

    def use(**having):
        monkeypatch.setattr(v2, "commits_itself", lambda spark, name: True)
        monkeypatch.setattr(
            v2, "Abilities", lambda spark, name: able(**having, table=spark.catalog.tableExists(name.sql) or None)
        )

    return use


def test_a_name_of_no_catalog_is_refused_and_not_cut(spark, depot):
    with pytest.raises(TableflowError) as error:
        WriteSession(spark, "elsewhere.depot.parts")
    assert error.value.code is Code.TARGET_KIND and "elsewhere" in str(error.value)


def test_tables_of_the_session_catalog_are_written_as_before(spark, depot):
    assert type(resolve_target(spark, depot, None, ())) is CatalogTarget
    spark.sql("create table depot.parts (bin bigint, label string) using parquet")
    found = v2.Abilities(spark, DEPOT)
    assert found.is_session_table and not found.merges and not found.replaces_atomically


@pytest.mark.parametrize(
    "mode, same, having, ok",
    [
        ("append", False, {}, True),
        ("merge", True, {}, False),
        ("merge", True, {"overwrites": True, "replaces_atomically": True}, False),
        ("merge", False, {"merges": True}, True),
        ("replace", True, {}, False),
        ("replace", True, {"overwrites": True}, True),
        ("replace", False, {"overwrites": True}, False),
        ("replace", False, {"replaces_atomically": True}, True),
    ],
)
def test_what_cannot_be_one_commit_is_refused(mode, same, having, ok):
    if ok:
        v2.check_abilities("c.d.t", mode, same, able(**having))
        return
    with pytest.raises(TableflowError) as error:
        v2.check_abilities("c.d.t", mode, same, able(**having))
    assert error.value.code is Code.TARGET_KIND


def test_refused_before_rows_are_staged(spark, depot, own_commits, tmp_path):
    spark.sql("create table depot.parts (bin bigint, label string) using parquet")
    own_commits()
    rows = spark.createDataFrame([(3, "cog")], "bin bigint, label string")
    session = WriteSession(spark, depot, "merge", keys=["bin"], staging_dir=str(tmp_path / "st"))
    with pytest.raises(TableflowError) as error:
        session.write(rows)
    assert error.value.code is Code.TARGET_KIND
    assert not (tmp_path / "st").exists()


def test_a_missing_table_is_created(spark, depot, own_commits):
    own_commits()
    rows = spark.createDataFrame([(3, "cog"), (4, "cam")], "bin bigint, label string")
    assert write_table(rows, depot, partition_by=["label"]).rows == 2
    assert sorted(tuple(r) for r in spark.table(depot).select("bin", "label").collect()) == [(3, "cog"), (4, "cam")]
    assert [c.name for c in spark.catalog.listColumns(depot) if c.isPartition] == ["label"]


def test_which_write_a_table_gets(spark, depot, own_commits, monkeypatch):
    spark.sql("create table depot.parts (bin bigint, label string) using parquet")
    calls = []

    class Writer:
        def __init__(self, name):
            calls.append(name)

        def __getattr__(self, call):
            return lambda *given: calls.append(call) or self

    rows = spark.createDataFrame([(3, "cog")], "bin bigint, label string")
    monkeypatch.setattr(type(rows), "writeTo", lambda rows, name: Writer(name))
    target = OwnCommitTarget(spark, DEPOT, [])
    for having, df in [({"overwrites": True}, rows), ({"replaces_atomically": True}, rows.select("bin"))]:
        own_commits(**having)
        target.put(df)
    target.append(rows)
    assert calls == [DEPOT.sql, "overwrite", DEPOT.sql, "createOrReplace", DEPOT.sql, "append"]


def test_a_merge_hands_over_one_row_for_each_key(spark, depot, own_commits, monkeypatch, tmp_path):
    spark.sql("create table depot.parts (bin bigint, label string, shelf string) using parquet")
    own_commits(merges=True)
    merged = []
    monkeypatch.setattr(v2, "merge_into", lambda name, target, latest, keys: merged.append((latest.schema, latest.collect(), keys)))
    with WriteSession(spark, depot, "merge", keys=["bin"], staging_dir=str(tmp_path / "st")) as session:
        session.write(spark.createDataFrame([(3, "cog"), (None, "nut")], "bin int, label string"))
        session.write(spark.createDataFrame([(3, None), (None, "bolt")], "bin int, label string"))
        assert session.commit().rows == 4
    [(schema, rows, keys)] = merged
    assert [(f.name, f.dataType) for f in schema] == [("bin", T.LongType()), ("label", T.StringType())]
    assert {tuple(r) for r in rows} == {(3, None), (None, "bolt")} and keys == ["bin"]


def test_the_merge_resolves_up_to_the_table_that_cannot_take_it(spark, depot):
    """Spark resolves condition and clauses before it finds that a plain Parquet table takes no merge."""
    spark.sql("create table depot.parts (bin bigint, `a.b` string, shelf string) using parquet")
    target = spark.table(depot).schema
    latest = spark.createDataFrame([(3, "cog")], "bin bigint, `a.b` string")
    with pytest.raises(UnsupportedOperationException) as error:
        v2.merge_into(DEPOT, target, latest, ["bin"])
    assert error.value.getCondition() == "UNSUPPORTED_FEATURE.TABLE_OPERATION" and "MERGE INTO" in str(error.value)
    # With a column that neither side has, it does not get that far.
    with pytest.raises(AnalysisException) as error:
        v2.merge_into(DEPOT, T.StructType([*target, T.StructField("none", T.LongType())]), latest, ["bin"])
    assert "UNRESOLVED" in error.value.getCondition()
    condition, sets, inserts = v2.merge_clauses(DEPOT, target, latest.columns, ["bin", "a.b"])
    assert sets == {} and list(inserts) == ["`bin`", "`a.b`", "`shelf`"]
    assert str(condition).count("<=>") == 2 and "AND" in str(condition).upper()
