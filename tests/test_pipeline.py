"""Whole pipelines: read, transform, write, read again."""

from tableflow import ReadSession, WriteSession, read_table, write_table


def test_relay(spark, datasets):
    """Read a table, order it in a query, append it elsewhere."""
    people = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "id bigint, name string")
    write_table(people, "wh.src", datasets=datasets)
    read_table(spark, "wh.src", datasets=datasets).createOrReplaceTempView("src")
    with ReadSession(spark) as session:
        rows = session.read_query("select id, name from src order by id")
        assert write_table(rows, "wh.dst", "append", datasets=datasets).rows == 3
    assert sorted(tuple(r) for r in read_table(spark, "wh.dst", datasets=datasets).collect()) == [
        (1, "a"), (2, "b"), (3, "c"),
    ]


def test_incremental_load(spark, datasets, sf_dir):
    """Windows of a cursor merged one after another give the table that one read gives."""
    source = {"main": sf_dir}
    bounds = ["2024-01-08T00:00:00", "2024-01-15T12:00:00.5", "2024-01-20T00:00:00"]
    windows = zip([None, *bounds], [*bounds, None])
    for lower, upper in windows:
        with WriteSession(
            spark, "wh.latest", "merge", keys=["user_id", "event_type"], sequence_by=["event_id"], datasets=datasets
        ) as session:
            session.write(read_table(spark, "main.events", datasets=source, cursor="ts", lower=lower, upper=upper))
            session.commit()
    write_table(
        read_table(spark, "main.events", datasets=source), "wh.whole", "merge",
        keys=["user_id", "event_type"], sequence_by=["event_id"], datasets=datasets,
    )
    one, other = (read_table(spark, f"wh.{n}", datasets=datasets) for n in ("latest", "whole"))
    assert one.count() == other.count() > 0
    assert one.exceptAll(other).count() == 0
