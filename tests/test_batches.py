"""Batches of a stream, committed once however often they are given."""

import pytest
from pyspark.sql import functions as F

from tableflow import Code, TableflowError, WriteResult, WriteSession, read_table, settle_batch, write_table
from tableflow.sinks.targets import CatalogTarget, FolderTarget

PORT = "code bigint, port string"


@pytest.fixture(params=["folder", "catalog"])
def place(request, spark, tmp_path):
    if request.param == "folder":
        return {"datasets": {"sea": str(tmp_path / "sea")}, "staging_dir": str(tmp_path / "st")}
    spark.sql("create database if not exists sea")
    spark.sql("drop table if exists sea.ports")
    return {"staging_dir": str(tmp_path / "st")}


def ports(spark, *names):
    return spark.createDataFrame([(len(n), n) for n in names], PORT)


def put(spark, place, number, *names, mode="append", stream="harbour", **options):
    return write_table(ports(spark, *names), "sea.ports", mode, batch=(stream, number), **place, **options)


def content(spark, place):
    return sorted(r.port for r in read_table(spark, "sea.ports", datasets=place.get("datasets")).collect())


def refused(code, call, *args, **options):
    with pytest.raises(TableflowError) as error:
        call(*args, **options)
    assert error.value.code is code


def test_a_replayed_append_changes_nothing(spark, place):
    assert put(spark, place, 4, "Oslo") == WriteResult(1, 1)
    assert put(spark, place, 4, "Oslo") == WriteResult(0, 0)
    put(spark, place, 5, "Genoa", "Kiel")
    put(spark, place, 4, "Oslo")
    put(spark, place, 4, "Turku", stream="ferry")
    write_table(ports(spark, "Split"), "sea.ports", **place)
    assert content(spark, place) == ["Genoa", "Kiel", "Oslo", "Split", "Turku"]


def test_a_replayed_session_changes_nothing(spark, place):
    for want in (WriteResult(3, 2), WriteResult(0, 0)):
        with WriteSession(spark, "sea.ports", batch=("harbour", 0), **place) as out:
            out.write(ports(spark, "Oslo"))
            out.write(ports(spark, "Kiel", "Turku"))
            assert out.commit() == want
    assert content(spark, place) == ["Kiel", "Oslo", "Turku"]


@pytest.mark.parametrize("mode", ["replace", "merge"])
def test_merges_and_replaces_keep_the_record(spark, place, mode):
    keys = {"keys": ["code"]} if mode == "merge" else {}
    put(spark, place, 0, "Oslo")
    put(spark, place, 1, "Kiel", mode=mode, **keys)
    put(spark, place, 0, "Oslo")
    assert content(spark, place) == ["Kiel"]
    put(spark, place, 1, "Pula", mode=mode, **keys)
    assert content(spark, place) == ["Kiel"]


def test_a_failed_batch_may_be_given_again(spark, place):
    put(spark, place, 0, "Oslo")
    bad = ports(spark, "Kiel").withColumn("port", F.raise_error(F.lit("storm")).cast("string"))
    with pytest.raises(Exception, match="storm"):
        write_table(bad, "sea.ports", batch=("harbour", 1), **place)
    put(spark, place, 1, "Kiel")
    assert content(spark, place) == ["Kiel", "Oslo"]


@pytest.mark.parametrize("landed", [False, True])
def test_a_batch_whose_driver_died_is_settled_by_hand(spark, place, landed, monkeypatch):
    put(spark, place, 0, "Oslo")
    kind = FolderTarget if "datasets" in place else CatalogTarget
    append = kind.append

    class Death(BaseException):
        pass

    def dying(self, rows):
        if landed:
            append(self, rows)
        raise Death

    with monkeypatch.context() as patch:
        patch.setattr(kind, "append", dying)
        with pytest.raises(Death):
            put(spark, place, 1, "Kiel")
    datasets = place.get("datasets")
    for number in (1, 2):
        refused(Code.BATCH_UNKNOWN, put, spark, place, number, "Kiel")
    refused(Code.BAD_OPTION, settle_batch, spark, "sea.ports", "harbour", 2, True, datasets=datasets)
    settle_batch(spark, "sea.ports", "harbour", 1, landed, datasets=datasets)
    put(spark, place, 1, "Kiel")
    put(spark, place, 2, "Turku")
    assert content(spark, place) == ["Kiel", "Oslo", "Turku"]


def test_a_table_that_is_gone_has_no_batches(spark, place, tmp_path):
    put(spark, place, 3, "Oslo")
    if "datasets" in place:
        (tmp_path / "sea" / "ports.parquet").rename(tmp_path / "away")
    else:
        spark.sql("drop table sea.ports")
    put(spark, place, 0, "Kiel")
    assert content(spark, place) == ["Kiel"]


@pytest.mark.parametrize("batch", [("", 0), ("a b", 0), ("x='y'", 0), ("n" * 101, 0), ("harbour", -1)])
def test_odd_batches_are_refused(spark, place, batch):
    refused(Code.BAD_OPTION, write_table, ports(spark, "Oslo"), "sea.ports", batch=batch, **place)


def test_a_stream_that_starts_over_appends_once(spark, place, tmp_path):
    source = str(tmp_path / "arrivals")
    ports(spark, "Oslo", "Kiel").write.parquet(source)
    for attempt in range(2):
        # A new checkpoint: every batch comes again.
        query = (
            spark.readStream.schema(PORT).parquet(source).writeStream
            .foreachBatch(lambda rows, number: write_table(rows, "sea.ports", batch=("arrivals", number), **place) and None)
            .option("checkpointLocation", str(tmp_path / f"checkpoint{attempt}")).trigger(availableNow=True).start()
        )
        query.awaitTermination(120)
    assert content(spark, place) == ["Kiel", "Oslo"]
