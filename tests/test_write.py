import gc
import os
import time
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tableflow.leases
import tableflow.sinks.staging
import tableflow.sinks.targets
from tableflow import Code, ReadSession, TableflowError, WriteSession, expire_staging, read_table, write_table
from tableflow.files import Files
from tableflow.leases import TableLock
from tableflow.operators.merge import in_groups_of

ID_NAME = "id bigint, name string"


def refused(code, call, *args, **kwargs):
    with pytest.raises(TableflowError) as error:
        call(*args, **kwargs)
    assert error.value.code is code
    return str(error.value)


@pytest.fixture(params=["folder", "catalog"])
def place(request, spark, tmp_path):
    """Keywords for a write, for both kinds of target, under the name ``wh.t``."""
    if request.param == "folder":
        return {"datasets": {"wh": str(tmp_path / "wh")}, "staging_dir": str(tmp_path / "st")}
    spark.sql("create database if not exists wh")
    for row in spark.catalog.listTables("wh"):
        if not row.isTemporary:
            spark.sql(f"drop table wh.`{row.name}`")
    return {"staging_dir": str(tmp_path / "st")}


def frame(spark, data, schema=ID_NAME):
    return spark.createDataFrame(data, schema)


def table(spark, place):
    return read_table(spark, "wh.t", datasets=place.get("datasets"))


def content(spark, place):
    return sorted(tuple(r) for r in table(spark, place).collect())


def staged(place):
    root = place["staging_dir"]
    return os.listdir(root) if os.path.exists(root) else []


def leftovers(spark, place):
    if "datasets" in place:
        return [n for n in os.listdir(place["datasets"]["wh"]) if n != "t.parquet" and not n.startswith(".")]
    return [r.name for r in spark.catalog.listTables("wh") if not r.isTemporary and r.name != "t"]


def test_append_creates_then_adds(spark, place):
    result = write_table(frame(spark, [(1, "a"), (2, "b"), (3, "c")]), "wh.t", "append", **place)
    assert (result.rows, result.batches) == (3, 1)
    result = write_table(frame(spark, [(4, "d"), (5, "e"), (6, "f")]), "wh.t", "append", **place)
    assert result.rows == 3
    assert [r[0] for r in content(spark, place)] == [1, 2, 3, 4, 5, 6]
    assert leftovers(spark, place) == []


def test_append_goes_by_name_and_target_type(spark, place):
    write_table(frame(spark, [(1, "a", "x")], "id bigint, name string, extra string"), "wh.t", **place)
    write_table(frame(spark, [("b", 2)], "name string, id int"), "wh.t", **place)
    assert table(spark, place).schema["id"].dataType == T.LongType()
    assert sorted((r.id, r.name, r.extra) for r in table(spark, place).collect()) == [(1, "a", "x"), (2, "b", None)]


def test_replace_takes_the_schema_of_the_write(spark, place):
    write_table(frame(spark, [(1, "a", 1)], "id bigint, name string, extra int"), "wh.t", "replace", **place)
    result = write_table(frame(spark, [(i, "n") for i in range(10)]), "wh.t", "replace", **place)
    assert result.rows == 10
    assert table(spark, place).columns == ["id", "name"]
    assert content(spark, place) == [(i, "n") for i in range(10)]
    assert leftovers(spark, place) == []


def test_replace_is_checked_like_any_write(spark, place):
    write_table(frame(spark, [(1, 1)], "id bigint, name int"), "wh.t", **place)
    message = refused(Code.SCHEMA_MISMATCH, write_table, frame(spark, [(1, "a")]), "wh.t", "replace", **place)
    assert "name" in message and "id:" not in message
    assert content(spark, place) == [(1, 1)]


def test_merge_into_a_missing_then_an_existing_target(spark, place):
    for _ in range(2):
        with WriteSession(spark, "wh.t", "merge", keys=["id"], **place) as session:
            session.write(frame(spark, [(40, "draft"), (41, "pear")]))
            session.write(frame(spark, [(40, "final")]))
            result = session.commit()
        assert (result.rows, result.batches) == (3, 2)
        assert content(spark, place) == [(40, "final"), (41, "pear")]
    write_table(frame(spark, [(3, "fig"), (41, "plum")]), "wh.t", "merge", keys=["id"], **place)
    assert content(spark, place) == [(3, "fig"), (40, "final"), (41, "plum")]
    assert staged(place) == [] and leftovers(spark, place) == []


def test_rows_are_counted_before_deduplication(spark, place):
    result = write_table(frame(spark, [(1,), (1,), (2,)], "id bigint"), "wh.t", "merge", keys=["id"], **place)
    assert result.rows == 3
    assert content(spark, place) == [(1,), (2,)]


def test_sequence_column_beats_batch_order(spark, place):
    with WriteSession(spark, "wh.t", "merge", keys=["id"], sequence_by=["at"], **place) as session:
        session.write(frame(spark, [(1, 9), (2, 1)], "id bigint, at int"))
        session.write(frame(spark, [(1, 3), (2, 5)], "id bigint, at int"))
        session.commit()
    assert content(spark, place) == [(1, 9), (2, 5)]


def test_merge_keeps_columns_the_write_lacks(spark, place):
    write_table(frame(spark, [(1, "a", "x")], "id bigint, name string, extra string"), "wh.t", **place)
    write_table(frame(spark, [(1, "b"), (2, "c")]), "wh.t", "merge", keys=["id"], **place)
    assert sorted((r.id, r.name, r.extra) for r in table(spark, place).collect()) == [(1, "b", "x"), (2, "c", None)]


@pytest.mark.parametrize("mode", ["append", "replace", "merge"])
@pytest.mark.parametrize("exists", [True, False])
def test_empty_writes(spark, place, mode, exists):
    if exists:
        write_table(frame(spark, [(1, "a")]), "wh.t", **place)
    empty = frame(spark, [(1, "a")]).where("id < 0")
    result = write_table(empty, "wh.t", mode, keys=["id"] if mode == "merge" else (), **place)
    assert result.rows == 0
    kept = [(1, "a")] if exists and mode != "replace" else []
    assert content(spark, place) == kept
    assert table(spark, place).columns == ["id", "name"]


def test_empty_relation_and_batchless_session(spark, place):
    assert write_table(frame(spark, []), "wh.t", **place).rows == 0
    schema = table(spark, place).schema
    with WriteSession(spark, "wh.t", "append", schema=schema, **place) as session:
        assert session.commit().batches == 0
    with WriteSession(spark, "wh.t", "append", **place) as session:
        refused(Code.SESSION_STATE, session.commit)


def test_abort_leaves_no_trace(spark, place):
    session = WriteSession(spark, "wh.t", "append", **place)
    session.write(frame(spark, [(1, "a")]))
    assert len(staged(place)) == 1
    session.abort()
    assert staged(place) == []
    refused(Code.TABLE_NOT_FOUND, table, spark, place)
    for call in (session.commit, session.abort):
        refused(Code.SESSION_STATE, call)


def test_an_error_in_the_block_aborts(spark, place):
    with pytest.raises(RuntimeError):
        with WriteSession(spark, "wh.t", "append", **place) as session:
            session.write(frame(spark, [(1, "a")]))
            raise RuntimeError
    assert staged(place) == []
    refused(Code.TABLE_NOT_FOUND, table, spark, place)


def test_one_commit_only(spark, place):
    with WriteSession(spark, "wh.t", "append", **place) as session:
        session.write(frame(spark, [(1, "a")]))
        session.commit()
        for call in (session.commit, session.abort, lambda: session.write(frame(spark, [(1, "a")]))):
            refused(Code.SESSION_STATE, call)
    assert content(spark, place) == [(1, "a")]


def test_a_refused_write_leaves_no_staging(spark, place):
    write_table(frame(spark, [(1, 1)], "id bigint, name int"), "wh.t", **place)
    with WriteSession(spark, "wh.t", "append", **place) as session:
        refused(Code.SCHEMA_MISMATCH, session.write, frame(spark, [(1, "a")]))
    assert staged(place) == [] and content(spark, place) == [(1, 1)]


@pytest.mark.parametrize("mode", ["append", "replace", "merge"])
def test_a_failing_job_leaves_the_target_alone(spark, place, mode):
    write_table(frame(spark, [(1, "a")]), "wh.t", **place)
    bad = spark.range(100).select("id", F.when(F.col("id") == 77, F.raise_error(F.lit("boom"))).otherwise("x").alias("name"))
    with pytest.raises(Exception, match="boom"):
        write_table(bad, "wh.t", mode, keys=["id"] if mode == "merge" else (), **place)
    assert content(spark, place) == [(1, "a")]
    assert leftovers(spark, place) == [] and staged(place) == []


def test_a_failed_swap_puts_the_old_folder_back(spark, tmp_path, monkeypatch):
    place = {"datasets": {"wh": str(tmp_path / "wh")}, "staging_dir": str(tmp_path / "st")}
    write_table(frame(spark, [(1, "a")]), "wh.t", **place)
    real = tableflow.sinks.staging.Files.rename

    def fail_second(self, source, target):
        if "_new_" in source:
            raise OSError("store went away")
        real(self, source, target)

    monkeypatch.setattr(tableflow.sinks.staging.Files, "rename", fail_second)
    with pytest.raises(OSError, match="went away"):
        write_table(frame(spark, [(2, "b")]), "wh.t", "replace", **place)
    monkeypatch.undo()
    assert content(spark, place) == [(1, "a")] and leftovers(spark, place) == []


def test_a_failed_catalog_rename_puts_the_old_table_back(spark, tmp_path, monkeypatch):
    spark.sql("create database if not exists wh")
    spark.sql("drop table if exists wh.t")
    place = {"staging_dir": str(tmp_path / "st")}
    write_table(frame(spark, [(1, "a")]), "wh.t", **place)
    real = tableflow.sinks.targets.CatalogTarget._rename

    def fail_second(self, source, target):
        if ".`new_" in source:
            raise OSError("catalog went away")
        real(self, source, target)

    monkeypatch.setattr(tableflow.sinks.targets.CatalogTarget, "_rename", fail_second)
    with pytest.raises(OSError, match="went away"):
        write_table(frame(spark, [(2, "b")]), "wh.t", "replace", **place)
    monkeypatch.undo()
    assert content(spark, place) == [(1, "a")] and leftovers(spark, place) == []


def test_failed_cleanup_does_not_hide_a_success(spark, place, monkeypatch):
    def broken(self, path):
        raise OSError("cannot delete")

    with WriteSession(spark, "wh.t", "append", **place) as session:
        session.write(frame(spark, [(1, "a")]))
        monkeypatch.setattr(tableflow.sinks.staging.Files, "delete", broken)
        assert session.commit().rows == 1
    monkeypatch.undo()
    assert content(spark, place) == [(1, "a")] and len(staged(place)) == 1
    assert expire_staging(spark, place["staging_dir"]) == []
    assert len(expire_staging(spark, place["staging_dir"], timedelta(0))) == 1
    assert staged(place) == []


def test_the_sweep_leaves_other_folders(spark, tmp_path):
    for name in ("load_1", "query_2", "precious"):
        (tmp_path / "st" / name).mkdir(parents=True)
    expire_staging(spark, str(tmp_path / "st"), timedelta(0))
    assert os.listdir(tmp_path / "st") == ["precious"]
    assert expire_staging(spark, str(tmp_path / "absent")) == []


def test_staging_defaults_to_the_shared_folder(spark, tmp_path):
    session = WriteSession(spark, "wh.t", datasets={"wh": str(tmp_path)})
    assert session._staging.startswith(spark.conf.get("spark.checkpoint.dir") + "/")


@pytest.mark.parametrize(
    "code, options",
    [
        (Code.WRITE_MODE, {"mode": "upsert"}),
        (Code.SCHEMA_POLICY, {"schema_policy": "evolve"}),
        (Code.MERGE_KEY, {"mode": "merge"}),
        (Code.BAD_OPTION, {"colour": "red"}),
    ],
)
def test_refusals_before_a_session_opens(spark, place, code, options):
    refused(code, WriteSession, spark, "wh.t", **options, **place)


def test_bad_target_names(spark):
    for name in ("t", "a.b.c.d", "`wh`.`t`", "wh.bad name"):
        refused(Code.BAD_NAME, WriteSession, spark, name)


@pytest.mark.parametrize(
    "code, schema, options",
    [
        (Code.MERGE_KEY, "id int", {"mode": "merge", "keys": ["absent"]}),
        (Code.MERGE_KEY, "id struct<a:int>", {"mode": "merge", "keys": ["id"]}),
        (Code.MERGE_KEY, "id array<int>", {"mode": "merge", "keys": ["id"]}),
        (Code.MERGE_KEY, "id map<string,int>", {"mode": "merge", "keys": ["id"]}),
        (Code.RESERVED_COLUMN, "id int, _row_seq int", {"mode": "append"}),
        (Code.RESERVED_COLUMN, "id int, _row_seq int", {"mode": "replace"}),
        (Code.RESERVED_COLUMN, "id int, _row_seq int", {"mode": "merge", "keys": ["id"]}),
        (Code.UNKNOWN_COLUMN, "id int", {"mode": "merge", "keys": ["id"], "sequence_by": ["s"]}),
        (Code.UNKNOWN_COLUMN, "id int", {"partition_by": ["day"]}),
        (Code.UNSUPPORTED_TYPE, "id int, x array<array<int>>", {}),
        (Code.UNSUPPORTED_TYPE, "id int, x void", {}),
    ],
)
def test_refusals_before_any_row_is_read(spark, place, code, schema, options):
    session = WriteSession(spark, "wh.t", **options, **place)
    refused(code, session.write, frame(spark, [], schema))
    refused(code, write_table, frame(spark, [], schema), "wh.t", **options, **place)
    refused(code, WriteSession, spark, "wh.t", schema=frame(spark, [], schema).schema, **options, **place)
    assert staged(place) == []


def test_batches_share_one_schema(spark, place):
    with WriteSession(spark, "wh.t", **place) as session:
        session.write(frame(spark, [(1, "a")]))
        refused(Code.SCHEMA_MISMATCH, session.write, frame(spark, [(1, 1)], "id bigint, name int"))


def test_batches_may_differ_in_what_is_nullable(spark, place):
    with WriteSession(spark, "wh.t", **place) as session:
        session.write(spark.sql("select 1L id, array('a') xs, named_struct('n', 1) r"))
        session.write(frame(spark, [(2, ["b"], (None,))], "id bigint, xs array<string>, r struct<n:int>"))
        assert session.commit().rows == 2
    assert sorted((r.id, r.xs[0], r.r.n) for r in table(spark, place).collect()) == [(1, "a", 1), (2, "b", None)]


@pytest.mark.parametrize("mode", ["append", "replace", "merge"])
def test_a_write_may_read_its_own_target(spark, place, mode):
    write_table(frame(spark, [(1, "a"), (2, "b")]), "wh.t", **place)
    shifted = table(spark, place).select((F.col("id") + 1).alias("id"), "name")
    write_table(shifted, "wh.t", mode, keys=["id"] if mode == "merge" else (), **place)
    assert content(spark, place) == {
        "append": [(1, "a"), (2, "a"), (2, "b"), (3, "b")],
        "replace": [(2, "a"), (3, "b")],
        "merge": [(1, "a"), (2, "a"), (3, "b")],
    }[mode]


def test_views_are_not_written(spark, tmp_path):
    spark.sql("create database if not exists wh")
    spark.sql("create or replace view wh.v as select 1L id")
    refused(Code.TABLE_IS_VIEW, write_table, frame(spark, [(1,)], "id bigint"), "wh.v", staging_dir=str(tmp_path))
    spark.sql("drop view wh.v")


def test_external_tables_are_not_replaced(spark, tmp_path):
    spark.sql("create database if not exists wh")
    spark.sql("drop table if exists wh.ext")
    spark.sql(f"create table wh.ext (id bigint, p int) using parquet partitioned by (p) location '{tmp_path / 'ext'}'")
    write_table(frame(spark, [(1, 1), (2, 2)], "id bigint, p int"), "wh.ext", "append")
    refused(Code.TARGET_KIND, write_table, frame(spark, [(2, 2)], "id bigint, p int"), "wh.ext", "replace")
    refused(Code.TARGET_KIND, write_table, frame(spark, [(2, 2)], "id bigint, p int"), "wh.ext", "merge", keys=["id"])
    write_table(frame(spark, [(2, 2), (3, 3)], "id bigint, p int"), "wh.ext", "merge", keys=["id", "p"])
    assert sorted(r.id for r in spark.table("wh.ext").collect()) == [1, 2, 3]
    spark.sql("drop table wh.ext")


def test_type_matrix(spark, place):
    df = spark.sql(
        "select -7L i, 0.125D f, cast('8.25' as decimal(38,9)) num, cast('77.0000000031' as decimal(38,10)) bignum,"
        " 'grüße' s, false flag, date'1999-12-31' d, timestamp_ntz'2001-05-06 23:59:58.700000' dt,"
        " timestamp'2001-05-06 23:59:58.7 UTC' ts, time'21:00:09.25' t, time'00:00:01' t0, X'00ff' b"
    )
    expected = (
        -7, 0.125, Decimal("8.250000000"), Decimal("77.0000000031"), "grüße", False, date(1999, 12, 31),
        datetime(2001, 5, 6, 23, 59, 58, 700000), datetime(2001, 5, 6, 23, 59, 58, 700000), "21:00:09.250000",
        "00:00:01.000000", b"\x00\xff",
    )
    for mode in ("append", "append", "replace", "merge"):
        write_table(df, "wh.t", mode, keys=["i"] if mode == "merge" else (), **place)
    assert [tuple(r) for r in table(spark, place).collect()] == [expected]


NESTED = "id bigint, box struct<size:int,marks:array<string>>, hits array<bigint>, stock map<string,int>, legs array<struct<port:string,miles:double>>"


def nested(spark):
    full = (8, (20, ["red", "blue"]), [], {"bolts": None, "nuts": 60}, [("Oslo", 310.25), ("Bergen", 0.5)])
    return frame(spark, [full, (9, None, [4], None, None)], NESTED)


def test_null_arrays_are_stored_empty(spark, place):
    for mode in ("append", "merge"):
        write_table(nested(spark), "wh.t", mode, keys=["id"] if mode == "merge" else (), **place)
    full, bare = table(spark, place).orderBy("id").collect()
    assert (full.box.size, full.box.marks, full.hits, full.stock) == (20, ["red", "blue"], [], {"bolts": None, "nuts": 60})
    assert [tuple(leg) for leg in full.legs] == [("Oslo", 310.25), ("Bergen", 0.5)]
    assert (bare.box, bare.hits, bare.stock, bare.legs) == (None, [4], {}, [])


def test_a_map_lands_in_a_repeated_record(spark, place):
    write_table(frame(spark, [(0, [("z", 0)])], "id bigint, m array<struct<key:string,value:int>>"), "wh.t", **place)
    write_table(frame(spark, [(1, {"a": 1})], "id bigint, m map<string,int>"), "wh.t", **place)
    write_table(frame(spark, [(1, {"b": 2})], "id bigint, m map<string,int>"), "wh.t", "merge", keys=["id"], **place)
    got = {r.id: [tuple(e) for e in r.m] for r in table(spark, place).collect()}
    assert got == {0: [("z", 0)], 1: [("b", 2)]}


def test_nested_into_scalar_is_refused(spark, place):
    write_table(frame(spark, [(1, "r")], "id bigint, box string"), "wh.t", **place)
    assert "box" in refused(Code.SCHEMA_MISMATCH, write_table, nested(spark).select("id", "box"), "wh.t", **place)


@pytest.mark.parametrize("mode", ["append", "replace", "merge"])
def test_null_elements_are_refused(spark, place, mode):
    df = frame(spark, [(1, ["a"]), (2, ["b", None])], "id bigint, tags array<string>")
    said = "column 'tags': an array element is NULL" + (r".*\(id=2\)" if mode == "merge" else "")
    with pytest.raises(Exception, match=said):
        write_table(df, "wh.t", mode, keys=["id"] if mode == "merge" else (), **place)
    refused(Code.TABLE_NOT_FOUND, table, spark, place)


# Partitioned folders.


def day_place(tmp_path, **options):
    return {"datasets": {"wh": str(tmp_path / "wh")}, "staging_dir": str(tmp_path / "st"), "partition_by": ["day"], **options}


def day_files(tmp_path, day):
    folder = tmp_path / "wh" / "t.parquet" / f"day={day}"
    return sorted(n for n in os.listdir(folder) if n.endswith(".parquet"))


def test_a_partitioned_merge_rewrites_only_touched_partitions(spark, tmp_path):
    place = day_place(tmp_path)
    schema = "day date, id bigint, v string"
    d1, d2, d3 = (date(2026, 1, i) for i in (1, 2, 3))
    write_table(frame(spark, [(d1, 1, "a"), (d1, 2, "b"), (d2, 1, "c"), (None, 5, "n")], schema), "wh.t", **place)
    before = day_files(tmp_path, "2026-01-02")
    update = frame(spark, [(d1, 2, "B"), (d3, 9, "new"), (None, 5, "N")], schema)
    write_table(update, "wh.t", "merge", keys=["day", "id"], **place)
    got = {(r.day, r.id): r.v for r in table(spark, place).collect()}
    assert got == {(d1, 1): "a", (d1, 2): "B", (d2, 1): "c", (None, 5): "N", (d3, 9): "new"}
    assert day_files(tmp_path, "2026-01-02") == before
    assert staged(place) == [] and sorted(os.listdir(tmp_path / "wh")) == ["t.parquet"]
    assert [n for n in os.listdir(tmp_path / "wh" / "t.parquet") if n.startswith("_old")] == []


def test_a_partitioned_catalog_merge_rewrites_only_touched_partitions(spark, tmp_path):
    spark.sql("create database if not exists wh")
    spark.sql("drop table if exists wh.t")
    place = {"staging_dir": str(tmp_path / "st")}
    schema = "day date, id bigint, v string"
    d1, d2, d3 = (date(2026, 1, i) for i in (1, 2, 3))
    rows = frame(spark, [(d1, 1, "a"), (d1, 2, "b"), (d2, 1, "c"), (None, 5, "n")], schema)
    write_table(rows, "wh.t", partition_by=["day"], **place)
    files = lambda: sorted(f for f in spark.table("wh.t").inputFiles() if "day=2026-01-02" in f)
    before = files()
    update = frame(spark, [(d1, 2, "B"), (d3, 9, "new"), (None, 5, "N")], schema)
    write_table(update, "wh.t", "merge", keys=["day", "id"], **place)
    got = {(r.day, r.id): r.v for r in spark.table("wh.t").collect()}
    assert got == {(d1, 1): "a", (d1, 2): "B", (d2, 1): "c", (None, 5): "N", (d3, 9): "new"}
    assert files() == before and len(before) == 1
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "STATIC"


def test_a_partitioned_merge_that_fails_leaves_every_partition(spark, tmp_path):
    place = day_place(tmp_path)
    schema = "day date, id bigint, v string"
    d1, d2 = (date(2026, 1, i) for i in (1, 2))
    write_table(frame(spark, [(d1, 1, "a"), (d2, 1, "c")], schema), "wh.t", **place)
    # A check of the target's own rows, so that the merge fails in the job that writes its partitions.
    folder = tmp_path / "wh" / "t.parquet" / "day=2026-01-02"
    for name in os.listdir(folder):
        (folder / name).write_bytes(b"no longer a table")
    before = {d: day_files(tmp_path, d) for d in ("2026-01-01", "2026-01-02")}
    with pytest.raises(Exception, match="(?i)parquet|checksum"):
        write_table(frame(spark, [(d1, 1, "A"), (d2, 1, "C")], schema), "wh.t", "merge", keys=["day", "id"], **place)
    assert {d: day_files(tmp_path, d) for d in before} == before
    assert sorted(os.listdir(tmp_path / "wh")) == ["t.parquet"] and staged(place) == []


def test_a_partitioned_merge_leaves_the_settings_of_the_session(spark, tmp_path, monkeypatch):
    place = day_place(tmp_path)
    schema = "day date, id bigint, v string"
    d1, d2 = (date(2026, 1, i) for i in (1, 2))
    write_table(frame(spark, [(d1, 1, "a"), (d2, 1, "c")], schema), "wh.t", **place)
    asked = []
    monkeypatch.setattr(type(spark.conf), "set", lambda self, key, value: asked.append(key))
    monkeypatch.setattr(tableflow.sinks.staging.Files, "rename", None)
    write_table(frame(spark, [(d1, 1, "A")], schema), "wh.t", "merge", keys=["day", "id"], **place)
    monkeypatch.undo()
    assert "spark.sql.sources.partitionOverwriteMode" not in asked
    assert sorted((r.day, r.v) for r in table(spark, place).collect()) == [(d1, "A"), (d2, "c")]


def test_a_merge_whose_keys_lack_the_partition_rewrites_all(spark, tmp_path):
    place = day_place(tmp_path)
    schema = "day date, id bigint, v string"
    d1, d2 = (date(2026, 1, i) for i in (1, 2))
    write_table(frame(spark, [(d1, 1, "a"), (d2, 2, "c")], schema), "wh.t", **place)
    del place["partition_by"]
    write_table(frame(spark, [(d2, 1, "moved")], schema), "wh.t", "merge", keys=["id"], **place)
    assert sorted((r.id, r.day, r.v) for r in table(spark, place).collect()) == [(1, d2, "moved"), (2, d2, "c")]
    write_table(frame(spark, [(d1, 7, "x")], schema), "wh.t", "append", **place)
    assert table(spark, place).where("day = '2026-01-01'").count() == 1


def test_a_two_column_merge_rewrites_the_named_pairs_alone(spark, tmp_path):
    place = day_place(tmp_path) | {"partition_by": ["p", "q"]}
    schema = "p int, q string, id bigint, v string"
    write_table(frame(spark, [(p, q, 1, "old") for p in (1, 2) for q in ("x", "y", None)], schema), "wh.t", **place)
    root = tmp_path / "wh" / "t.parquet"
    files = lambda: {str(f.relative_to(root)) for f in root.rglob("*.parquet")}
    before = files()
    write_table(frame(spark, [(1, "x", 1, "new"), (2, None, 1, "new")], schema), "wh.t", "merge", keys=["p", "q", "id"], **place)
    changed = {f.rsplit("/", 1)[0] for f in before ^ files()}
    assert changed == {"p=1/q=x", "p=2/q=__HIVE_DEFAULT_PARTITION__"}
    assert {(r.p, r.q) for r in table(spark, place).where("v = 'new'").collect()} == {(1, "x"), (2, None)}
    assert table(spark, place).count() == 6


def test_the_scan_of_a_partitioned_merge_is_pruned_at_run_time(spark, tmp_path):
    place = day_place(tmp_path)
    target = frame(spark, [(date(2026, 1, 1 + i), i) for i in range(9)], "day date, id bigint")
    write_table(target, "wh.t", **place)
    named = frame(spark, [(date(2026, 1, 2), 0)], "day date, _batch_no int")
    named.write.parquet(str(tmp_path / "named"))
    named = spark.read.parquet(str(tmp_path / "named")).where("_batch_no >= 0").select("day").distinct()
    touched = in_groups_of(table(spark, place), named, ["day"])
    assert "dynamicpruning" in touched._jdf.queryExecution().executedPlan().toString()
    assert [r.id for r in touched.collect()] == [1]


@pytest.mark.parametrize(
    "kind,values",
    [("string", ["007", "010", "2026-01-02", "x"]), ("bigint", [1, 2**40]), ("date", [date(2026, 1, 2)]), ("timestamp", [datetime(2026, 1, 2, 3, 4, 5)])],
)
def test_partition_columns_keep_their_type(spark, tmp_path, kind, values):
    place = day_place(tmp_path) | {"partition_by": ["p"]}
    rows = frame(spark, [(i, v) for i, v in enumerate([*values, None])], f"id bigint, p {kind}")
    write_table(rows, "wh.t", **place)
    back = table(spark, place)
    assert dict(back.dtypes)["p"] == kind and {r.p for r in back.collect()} == {*values, None}
    for _ in range(2):
        write_table(table(spark, place), "wh.t", "merge", keys=["p", "id"], **place)
    assert sorted(r.id for r in table(spark, place).collect()) == list(range(len(values) + 1))
    other = frame(spark, [(1, True)], "id bigint, p boolean")
    refused(Code.SCHEMA_MISMATCH, write_table, other, "wh.t", "append", **place)
    with WriteSession(spark, "wh.t", "merge", keys=["p", "id"], **place) as session:
        refused(Code.SCHEMA_MISMATCH, session.write, other)
        assert staged(place) == []


def test_a_catalog_table_stays_as_it_is_defined(spark, tmp_path):
    spark.sql("create database if not exists wh")
    spark.sql("drop table if exists wh.own")
    spark.sql(
        "create table wh.own (id bigint comment 'the key', name varchar(5)) using orc comment 'kept' tblproperties ('team' = 'o''k', 'x' = '1')"
    )
    place = {"staging_dir": str(tmp_path / "st")}
    told = lambda: spark.sql("show create table wh.own").first()[0]
    before = told()
    rows = frame(spark, [(1, "a"), (2, "b")], "id bigint, name string")
    write_table(rows, "wh.own", "merge", keys=["id"], **place)
    write_table(rows.where("id = 2"), "wh.own", "replace", **place)
    write_table(rows, "wh.own", "merge", keys=["id"], **place)
    assert told() == before and "orc" in before.lower() and "VARCHAR(5)" in before
    assert sorted(r.id for r in spark.table("wh.own").collect()) == [1, 2]
    spark.sql("drop table wh.own")


def test_a_session_that_still_writes_is_not_swept(spark, tmp_path):
    place = {"datasets": {"wh": str(tmp_path / "wh")}, "staging_dir": str(tmp_path / "st")}
    with WriteSession(spark, "wh.t", "append", **place) as session:
        session.write(frame(spark, [(1, "a")]))
        for folder in (tmp_path / "st").iterdir():
            os.utime(folder, (0, 0))
        assert expire_staging(spark, place["staging_dir"]) == []
        session.write(frame(spark, [(2, "b")]))
        session.commit()
    assert content(spark, place) == [(1, "a"), (2, "b")]


@pytest.mark.parametrize("moves", [0, 1, 2])
def test_a_commit_that_a_dead_driver_left_half_way_is_undone(spark, tmp_path, monkeypatch, moves):
    place = folder_place(tmp_path)
    write_table(frame(spark, [(1, "a")]), "wh.t", **place)
    real, done = tableflow.sinks.staging.Files.rename, []

    class Dead(BaseException):
        pass

    def die_later(self, source, target):
        if len(done) == moves:
            raise Dead
        done.append(source)
        real(self, source, target)
        if len(done) == moves:
            raise Dead

    monkeypatch.setattr(tableflow.sinks.staging.Files, "rename", die_later)
    monkeypatch.setattr(tableflow.sinks.staging, "undo_swap", lambda *a: None)
    monkeypatch.setattr(tableflow.sinks.targets, "drop_quietly", lambda *a: None)
    monkeypatch.setattr(TableLock, "release", lambda self: self._heartbeat.stop())
    with pytest.raises(Dead):
        write_table(frame(spark, [(2, "b")]), "wh.t", "replace", **place)
    monkeypatch.undo()
    # Nothing tells a dead owner from a live one until its lock has not been renewed for a while.
    refused(Code.COMMIT_IN_PROGRESS, write_table, frame(spark, [(3, "c")]), "wh.t", **place)
    expire_staging(spark, place["staging_dir"], timedelta(0), datasets=[str(tmp_path / "wh")])
    outdate(tmp_path / "wh" / "_lock_t.parquet")
    write_table(frame(spark, [(3, "c")]), "wh.t", **place)
    assert content(spark, place) == [(1, "a"), (3, "c")]
    expire_staging(spark, place["staging_dir"], timedelta(0), datasets=[str(tmp_path / "wh")])
    assert os.listdir(tmp_path / "wh") == ["t.parquet"]


def folder_place(tmp_path):
    return {"datasets": {"wh": str(tmp_path / "wh")}, "staging_dir": str(tmp_path / "st")}


def outdate(path):
    os.utime(path, (0, 0))


@pytest.mark.parametrize("mode", ["append", "replace", "merge"])
def test_a_second_writer_is_refused_while_a_commit_moves_folders(spark, tmp_path, monkeypatch, mode):
    place = folder_place(tmp_path)
    write_table(frame(spark, [(1, "a")]), "wh.t", **place)
    real, met = tableflow.sinks.staging.Files.rename, []

    def second_writer(self, source, target):
        real(self, source, target)
        if not met:
            met.append(source)
            keys = ["id"] if mode == "merge" else ()
            refused(Code.COMMIT_IN_PROGRESS, write_table, frame(spark, [(9, "z")]), "wh.t", mode, keys=keys, **place)

    monkeypatch.setattr(tableflow.sinks.staging.Files, "rename", second_writer)
    write_table(frame(spark, [(2, "b")]), "wh.t", "replace", **place)
    assert met and content(spark, place) == [(2, "b")]
    write_table(frame(spark, [(3, "c")]), "wh.t", **place)
    assert content(spark, place) == [(2, "b"), (3, "c")]
    assert os.listdir(tmp_path / "wh") == ["t.parquet"] and staged(place) == []


def test_a_writer_that_lost_its_lock_stops(spark, tmp_path, monkeypatch):
    place = folder_place(tmp_path)
    write_table(frame(spark, [(1, "a")]), "wh.t", **place)
    real = tableflow.sinks.targets.swap_folders

    def taken_over(*args):
        Files(spark, str(tmp_path)).write_text(str(tmp_path / "wh" / "_lock_t.parquet"), "somebody else")
        real(*args)

    monkeypatch.setattr(tableflow.sinks.targets, "swap_folders", taken_over)
    refused(Code.COMMIT_LOST, write_table, frame(spark, [(2, "b")]), "wh.t", "replace", **place)
    monkeypatch.undo()
    assert content(spark, place) == [(1, "a")]


def test_a_long_commit_renews_its_lock(spark, tmp_path, monkeypatch):
    place = folder_place(tmp_path)
    write_table(frame(spark, [(1, "a")]), "wh.t", **place)
    monkeypatch.setattr(tableflow.leases, "RENEWAL", timedelta(seconds=0.25))
    real = tableflow.sinks.targets.swap_folders

    def slow(*args):
        time.sleep(2)
        refused(Code.COMMIT_IN_PROGRESS, write_table, frame(spark, [(9, "z")]), "wh.t", **place)
        real(*args)

    monkeypatch.setattr(tableflow.sinks.targets, "swap_folders", slow)
    write_table(frame(spark, [(2, "b")]), "wh.t", "replace", **place)
    assert content(spark, place) == [(2, "b")]


def test_an_idle_session_is_not_swept_and_an_abandoned_one_is(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tableflow.leases, "RENEWAL", timedelta(seconds=0.25))
    place = folder_place(tmp_path)
    session = WriteSession(spark, "wh.t", "append", **place)
    session.write(frame(spark, [(1, "a")]))
    reads = ReadSession(spark, place["staging_dir"])
    rows = reads.read_query("select 5 as x")
    for folder, _, names in os.walk(tmp_path / "st"):
        for name in [".", *names]:
            outdate(os.path.join(folder, name))
    time.sleep(1.5)
    assert expire_staging(spark, place["staging_dir"], timedelta(0)) == []
    assert rows.first().x == 5 and len(staged(place)) == 2
    del session, reads
    gc.collect()
    time.sleep(1.5)
    assert len(expire_staging(spark, place["staging_dir"], timedelta(0))) == 2


def test_an_empty_partitioned_merge_changes_nothing(spark, tmp_path):
    place = day_place(tmp_path)
    write_table(frame(spark, [(date(2026, 1, 1), 1)], "day date, id bigint"), "wh.t", **place)
    empty = frame(spark, [], "day date, id bigint")
    write_table(empty, "wh.t", "merge", keys=["day", "id"], **place)
    assert table(spark, place).count() == 1


def test_an_existing_layout_is_kept_and_checked(spark, place):
    day = "day string, id bigint"
    write_table(frame(spark, [("2026", 1), ("01", 2)], day), "wh.t", partition_by=["day"], **place)
    write_table(frame(spark, [("2026", 3)], day), "wh.t", "append", **place)
    write_table(frame(spark, [("01", 2), ("1", 4)], day), "wh.t", "merge", keys=["id", "day"], **place)
    write_table(frame(spark, [("2027", 1)], day), "wh.t", "merge", keys=["id"], **place)
    refused(Code.BAD_OPTION, write_table, frame(spark, [("x", 3)], day), "wh.t", partition_by=["id"], **place)
    refused(Code.UNKNOWN_COLUMN, write_table, frame(spark, [(3,)], "id bigint"), "wh.t", **place)
    if "datasets" in place:
        folder = place["datasets"]["wh"] + "/t.parquet"
        got = spark.read.schema("id bigint, day string").parquet(folder)
        assert sorted(n for n in os.listdir(folder) if "=" in n) == ["day=01", "day=1", "day=2026", "day=2027"]
    else:
        got = spark.table("wh.t")
        assert [c.name for c in spark.catalog.listColumns("wh.t") if c.isPartition] == ["day"]
    assert sorted((r.day, r.id) for r in got.collect()) == [("01", 2), ("1", 4), ("2026", 3), ("2027", 1)]


def test_a_replace_may_change_the_layout(spark, place):
    rows = frame(spark, [(1, "a"), (2, "b")])
    write_table(rows, "wh.t", "replace", partition_by=["name"], **place)
    write_table(rows, "wh.t", "replace", partition_by=["id"], **place)
    assert sorted((r.id, r.name) for r in table(spark, place).collect()) == [(1, "a"), (2, "b")]
    write_table(rows.select("id"), "wh.t", "replace", **place)
    assert sorted(tuple(r) for r in table(spark, place).collect()) == [(1,), (2,)]


def test_rows_of_a_partition_are_written_together(spark, tmp_path):
    place = day_place(tmp_path)
    rows = spark.range(0, 4000, 1, 16).selectExpr("date_add(date'2026-01-01', cast(id % 3 as int)) day", "id")
    assert write_table(rows, "wh.t", **place).rows == 4000
    assert [len(day_files(tmp_path, f"2026-01-0{i}")) for i in (1, 2, 3)] == [1, 1, 1]


@pytest.mark.parametrize("exists", [True, False])
def test_a_session_moves_its_staging_folder_into_place(spark, tmp_path, exists, monkeypatch):
    place = day_place(tmp_path)
    schema = "day date, id bigint"
    d1, d2 = (date(2026, 1, i) for i in (1, 2))
    if exists:
        write_table(frame(spark, [(d1, 0)], schema), "wh.t", **place)
    monkeypatch.setattr(tableflow.sinks.targets.FolderTarget, "put", None)
    with WriteSession(spark, "wh.t", "replace", **place) as session:
        session.write(frame(spark, [(d1, 1), (d2, 2)], schema))
        session.write(frame(spark, [(d2, 3)], schema))
        assert session.commit().rows == 3
    assert sorted((r.id, r.day) for r in table(spark, place).collect()) == [(1, d1), (2, d2), (3, d2)]
    assert staged(place) == [] and os.listdir(tmp_path / "wh") == ["t.parquet"]


def test_a_staging_folder_on_another_store_is_copied(spark, tmp_path, monkeypatch):
    place = {"datasets": {"wh": str(tmp_path / "wh")}, "staging_dir": str(tmp_path / "st")}
    monkeypatch.setattr(tableflow.sinks.targets.Files, "holds", lambda self, path: False)
    with WriteSession(spark, "wh.t", "replace", **place) as session:
        session.write(frame(spark, [(1, "a")]))
        session.commit()
    assert content(spark, place) == [(1, "a")] and staged(place) == []


@pytest.mark.parametrize("in_session", [True, False])
def test_a_partitioned_table_may_become_empty(spark, tmp_path, in_session):
    place = day_place(tmp_path)
    rows = frame(spark, [(date(2026, 1, 1), 1)], "day date, id bigint")
    write_table(rows, "wh.t", **place)
    if in_session:
        with WriteSession(spark, "wh.t", "replace", **place) as session:
            session.write(rows.where("id < 0"))
            session.commit()
    else:
        write_table(rows.where("id < 0"), "wh.t", "replace", **place)
    assert table(spark, place).collect() == [] and sorted(table(spark, place).columns) == ["day", "id"]
    for _ in range(2):
        write_table(rows, "wh.t", **place)
    assert [(r.day, r.id) for r in table(spark, place).collect()] == [(date(2026, 1, 1), 1)] * 2
    assert (tmp_path / "wh" / "t.parquet" / "day=2026-01-01").is_dir()


def test_partition_values_with_odd_characters(spark, tmp_path):
    place = day_place(tmp_path, partition_by=["k/=%"])
    schema = "`k/=%` string, id bigint"
    for mode, rows in (("append", [("a/b", 1), ("x=%", 2)]), ("merge", [("a/b", 1), ("é ", 3)])):
        keys = ["k/=%", "id"] if mode == "merge" else []
        write_table(frame(spark, rows, schema), "wh.t", mode, keys=keys, **place)
    assert sorted((r[1], r[0]) for r in table(spark, place).collect()) == [("a/b", 1), ("x=%", 2), ("é ", 3)]
