import threading
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow import (
    Code,
    ReadSession,
    TableflowError,
    apply_hints,
    cursor_condition,
    describe_table,
    read_query,
    read_table,
    typed_literal,
)


def refused(code, call, *args, **kwargs):
    with pytest.raises(TableflowError) as error:
        call(*args, **kwargs)
    assert error.value.code is code
    return str(error.value)


@pytest.fixture
def small(spark, datasets):
    """120 rows (id, name) as wh.small."""
    df = spark.range(120).select(F.col("id"), F.lpad(F.col("id").cast("string"), 90, "n").alias("name"))
    df.repartition(6).write.parquet(datasets["wh"] + "/small.parquet")
    return datasets


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_columns_come_in_the_order_asked(spark, small):
    df = read_table(spark, "wh.small", datasets=small, columns=["name", "id"])
    assert df.columns == ["name", "id"]
    assert sorted(r.id for r in df.collect()) == list(range(120))
    assert all(r.name == str(r.id).rjust(90, "n") for r in df.collect())


def test_pruning_reaches_the_scan(spark, small):
    assert "ReadSchema: struct<name:string>" in plan(read_table(spark, "wh.small", datasets=small, columns=["name"]))


def test_empty_column_list_is_all_columns(spark, small):
    assert read_table(spark, "wh.small", datasets=small, columns=[]).columns == ["id", "name"]


def test_unknown_column_is_named_exactly(spark, small):
    assert "ID" in refused(Code.UNKNOWN_COLUMN, read_table, spark, "wh.small", datasets=small, columns=["ID"])


def test_predicate_may_use_unselected_columns_and_is_pushed(spark, small):
    df = read_table(spark, "wh.small", datasets=small, columns=["name"], predicate="id >= 100 or id < 0")
    assert df.count() == 20
    assert "GreaterThanOrEqual(id,100)" in plan(df)


def test_empty_predicate_is_no_predicate(spark, small):
    assert read_table(spark, "wh.small", datasets=small, predicate="").count() == 120


def test_predicate_as_a_column(spark, small):
    assert read_table(spark, "wh.small", datasets=small, predicate=F.col("id") < 5).count() == 5


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_double_quotes_name_a_column(spark, small, ansi):
    df = spark.range(10).select(F.col("id").alias("Weird Col"))
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        found = apply_hints(df, predicate='"Weird Col" > 1 and \'"x"\' = \'"x"\'', cursor="Weird Col", upper="5")
        assert sorted(r[0] for r in found.collect()) == [2, 3, 4, 5]
        assert spark.conf.get("spark.sql.ansi.enabled") == ansi
        assert spark.conf.get("spark.sql.ansi.doubleQuotedIdentifiers") == "false"
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_settings_are_restored_after_a_bad_predicate(spark, small):
    with pytest.raises(Exception):
        read_table(spark, "wh.small", datasets=small, predicate='"nope" > 1')
    assert spark.conf.get("spark.sql.ansi.doubleQuotedIdentifiers") == "false"


def test_bounded_window(spark, small):
    def ids(**bounds):
        df = read_table(spark, "wh.small", datasets=small, cursor="id", **bounds)
        return sorted(r.id for r in df.collect())

    assert ids(lower="3", upper="7") == [4, 5, 6, 7]
    assert ids(lower="3", upper="7", lower_inclusive=True) == [3, 4, 5, 6, 7]
    assert ids(lower="117") == [118, 119]
    assert ids(upper="1") == [0, 1]
    assert ids() == list(range(120))


def test_bounds_reach_the_scan(spark, small):
    scan = plan(read_table(spark, "wh.small", datasets=small, cursor="id", lower="3", upper="7"))
    assert "GreaterThan(id,3)" in scan and "LessThanOrEqual(id,7)" in scan


def test_all_hints_together(spark, small):
    df = read_table(
        spark, "wh.small", datasets=small, columns=["id"], predicate="id % 2 = 0 or id = 9",
        cursor="id", lower="3", upper="9", max_partitions=2,
    )
    assert sorted(r.id for r in df.collect()) == [4, 6, 8, 9]
    assert df.rdd.getNumPartitions() <= 2


def test_a_cursor_without_bounds_is_not_looked_up(spark, small):
    assert read_table(spark, "wh.small", datasets=small, cursor="absent").count() == 120
    refused(Code.CURSOR_COLUMN_MISSING, read_table, spark, "wh.small", datasets=small, cursor="absent", lower="1")


def test_null_cursor_rows_satisfy_no_bound(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 1)], "id int, c int")
    assert [r.id for r in apply_hints(df, cursor="c", lower="2").collect()] == [2]
    assert [r.id for r in apply_hints(df, cursor="c", upper="2").collect()] == [3]


def test_temporal_bounds(spark):
    df = spark.createDataFrame(
        [(i, datetime(2026, 1, 1 + i), date(2026, 1, 1 + i)) for i in range(10)], "id int, ts timestamp, d date"
    )
    ids = lambda **b: sorted(r.id for r in apply_hints(df, **b).collect())
    assert ids(cursor="ts", lower="2026-01-01T00:00:00.000000") == list(range(1, 10))
    assert ids(cursor="d", lower="2026-01-05") == list(range(5, 10))


def test_zoned_bound_is_utc_in_any_session_zone(spark):
    df = spark.sql("select timestamp'2026-01-01 12:00:00 UTC' ts")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert apply_hints(df, cursor="ts", upper="2026-01-01 12:00:00").count() == 1
        assert apply_hints(df, cursor="ts", upper="2026-01-01 11:59:59.999999").count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "data_type, text, value",
    [
        (T.LongType(), "42", 42),
        (T.IntegerType(), "-7", -7),
        (T.DoubleType(), "42.5", 42.5),
        (T.FloatType(), "0.5", 0.5),
        (T.DecimalType(10, 2), "1.50", Decimal("1.50")),
        (T.DecimalType(20, 2), "1.50", Decimal("1.50")),
        (T.DateType(), "2024-01-02", date(2024, 1, 2)),
        (T.TimestampNTZType(), "2024-01-02T03:04:05.678900", datetime(2024, 1, 2, 3, 4, 5, 678900)),
        (T.TimestampNTZType(), "2024-01-02 03:04:05.6", datetime(2024, 1, 2, 3, 4, 5, 600000)),
        (T.TimestampNTZType(), "2024-01-02 03:04:05.1234", datetime(2024, 1, 2, 3, 4, 5, 123400)),
        (T.TimestampType(), "2024-01-02T03:04:05.678900", datetime(2024, 1, 2, 3, 4, 5, 678900)),
        (T.StringType(), "a\\b'c", "a\\b'c"),
    ],
)
def test_literals(spark, data_type, text, value):
    literal = typed_literal(data_type, text, "c")
    row = spark.range(1).select(literal.alias("v"))
    assert row.schema["v"].dataType == data_type
    assert row.first().v == value


@pytest.mark.parametrize(
    "data_type, text",
    [
        (T.LongType(), "not-a-number"),
        (T.LongType(), "1.2.3"),
        (T.LongType(), "+1"),
        (T.LongType(), "1e3"),
        (T.LongType(), "٣"),
        (T.LongType(), "1\n"),
        (T.DateType(), "01/02/2024"),
        (T.DateType(), "2024-02-30"),
        (T.TimestampNTZType(), "not-a-timestamp"),
        (T.TimestampType(), "2024-01-02T03:04:05.1234567"),
        (T.TimestampType(), "2024-01-02T25:04:05"),
        (T.DecimalType(10, 2), "1,5"),
    ],
)
def test_bounds_not_in_canonical_form(data_type, text):
    message = refused(Code.CURSOR_VALUE, typed_literal, data_type, text, "c")
    assert text not in message


@pytest.mark.parametrize(
    "data_type", [T.BooleanType(), T.BinaryType(), T.ArrayType(T.LongType()), T.StructType(), T.TimeType()]
)
def test_types_without_bounds(data_type):
    refused(Code.CURSOR_TYPE, typed_literal, data_type, "x", "c")


def test_a_fraction_bounds_an_integer_column_by_value(spark):
    df = spark.range(10)
    assert apply_hints(df, cursor="id", lower="3.5").count() == 6
    assert apply_hints(df, cursor="id", upper="3.5").count() == 4
    assert apply_hints(df.select(F.col("id").cast("int")), cursor="id", upper="99999999999").count() == 10


def test_a_long_fraction_bounds_a_decimal_column_by_value(spark):
    df = spark.sql("select cast(i as decimal(10,2)) c from range(5) t(i)")
    assert apply_hints(df, cursor="c", lower="1.999").count() == 3
    refused(Code.CURSOR_VALUE, typed_literal, T.DecimalType(10, 2), "1." + "1" * 40, "c")


def test_decimal_and_date_bounds_reach_the_scan(spark, datasets):
    path = datasets["wh"] + "/t.parquet"
    spark.sql("select cast(i as decimal(10,2)) c, date'2026-01-01' + cast(i as int) d from range(9) t(i)").write.parquet(path)
    assert "GreaterThan(c,1.50)" in plan(read_table(spark, "wh.t", datasets=datasets, cursor="c", lower="1.5"))
    assert "GreaterThan(d,2026-01-02)" in plan(read_table(spark, "wh.t", datasets=datasets, cursor="d", lower="2026-01-02"))


def test_no_bounds_no_condition():
    assert cursor_condition(T.StructType(), None) is None
    assert cursor_condition(T.StructType(), "c") is None


@pytest.mark.parametrize("ceiling", [1, 8, 64, 65, 100_000, 1.0, 8.0])
def test_partition_ceiling(spark, small, ceiling):
    df = read_table(spark, "wh.small", datasets=small, max_partitions=ceiling)
    used = df.select(F.spark_partition_id().alias("p"), "id").collect()
    assert len({r.p for r in used}) <= ceiling
    assert sorted(r.id for r in used) == list(range(120))
    assert "Exchange" not in plan(df)


@pytest.mark.parametrize("ceiling", [0, "4", 1.5, -1, True, float("nan"), float("inf")])
def test_bad_partition_ceiling(spark, small, ceiling):
    refused(Code.BAD_OPTION, read_table, spark, "wh.small", datasets=small, max_partitions=ceiling)


def test_reading_twice_gives_the_same(spark, small):
    one, two = (read_table(spark, "wh.small", datasets=small) for _ in range(2))
    assert one.rdd.getNumPartitions() == two.rdd.getNumPartitions()
    assert one.collect() == two.collect()


def test_empty_table_keeps_its_schema(spark, datasets):
    spark.range(5).where("id < 0").write.parquet(datasets["wh"] + "/empty.parquet")
    df = read_table(spark, "wh.empty", datasets=datasets)
    assert df.count() == 0 and df.schema["id"].dataType == T.LongType()


NESTED = (
    "select 1L id, named_struct('n', 7, 's', 'x') rec, array('a','b') tags,"
    " array(named_struct('k','x','v',1.5D), named_struct('k','y','v',2.5D)) items"
)


def test_nested_values_stay_typed(spark, datasets):
    spark.sql(NESTED).write.parquet(datasets["wh"] + "/nested.parquet")
    df = read_table(spark, "wh.nested", datasets=datasets)
    row = df.first()
    assert (row.rec.n, row.rec.s, row.tags, [(i.k, i.v) for i in row["items"]]) == (7, "x", ["a", "b"], [("x", 1.5), ("y", 2.5)])
    assert "ReadSchema: struct<rec:struct<n:int>>" in plan(df.select("rec.n"))


def test_describe_reads_no_rows(spark, datasets):
    spark.sql(NESTED).write.parquet(datasets["wh"] + "/nested.parquet")
    rows = describe_table(spark, "wh.nested", datasets=datasets).collect()
    assert [(r.column, r.mode) for r in rows] == [
        ("id", "NULLABLE"), ("rec", "NULLABLE"), ("rec.n", "NULLABLE"), ("rec.s", "NULLABLE"), ("tags", "REPEATED"),
        ("items", "REPEATED"), ("items.k", "NULLABLE"), ("items.v", "NULLABLE"),
    ]


def test_missing_tables_are_named(spark, datasets):
    assert "wh.absent" in refused(Code.TABLE_NOT_FOUND, read_table, spark, "wh.absent", datasets=datasets)
    assert "default.absent" in refused(Code.TABLE_NOT_FOUND, read_table, spark, "default.absent")
    refused(Code.TABLE_NOT_FOUND, read_table, spark, "nowhere.absent")
    refused(Code.BAD_NAME, read_table, spark, "absent")


def test_catalog_tables_and_views(spark):
    spark.sql("drop table if exists default.base")
    spark.range(2).write.saveAsTable("default.base")
    spark.sql("create or replace view default.seen as select * from default.base")
    assert read_table(spark, "default.base").count() == 2
    assert read_table(spark, "spark_catalog.default.base", columns=["id"]).count() == 2
    message = refused(Code.TABLE_IS_VIEW, read_table, spark, "default.seen")
    assert "select * from" in message
    assert read_table(spark, "default.seen", allow_views=True).count() == 2
    assert read_query(spark, "select * from default.seen").count() == 2


@pytest.fixture
def numbers(spark):
    spark.range(20).select("id", F.concat(F.lit("n"), "id").alias("name")).createOrReplaceTempView("numbers")


def staged(root):
    return sorted(p.name for p in root.iterdir()) if root.exists() else []


def test_query_read_lands_once_and_is_dropped(spark, numbers, tmp_path):
    with ReadSession(spark, str(tmp_path / "st")) as session:
        first = session.read_query("select id, name from numbers where id < 10")
        again = session.read_query("\n select id, name from numbers where id < 10  ")
        assert first.count() == again.count() == 10
        assert len(staged(tmp_path / "st")) == 1
        narrowed = session.read_query(
            "select id, name from numbers where id < 10", columns=["id"], predicate="id >= 5"
        )
        assert sorted(r.id for r in narrowed.collect()) == [5, 6, 7, 8, 9]
        assert "GreaterThanOrEqual(id,5)" in plan(narrowed)
        assert len(staged(tmp_path / "st")) == 1
    assert staged(tmp_path / "st") == []
    refused(Code.SESSION_STATE, session.read_query, "select 1")


def test_query_text_may_end_in_one_semicolon(spark, numbers, tmp_path):
    with ReadSession(spark, str(tmp_path / "st")) as session:
        assert session.read_query("select id from numbers;   ").count() == 20
        with pytest.raises(Exception):
            session.read_query("select id from numbers;;")
    assert read_query(spark, "select id from numbers -- all\n;").count() == 20
    refused(Code.BAD_OPTION, read_query, spark, "  ; ")


def test_a_failed_query_is_tried_again(spark, tmp_path):
    with ReadSession(spark, str(tmp_path / "st")) as session:
        with pytest.raises(Exception):
            session.read_query("select id from later")
        spark.range(3).createOrReplaceTempView("later")
        assert session.read_query("select id from later").count() == 3
        with pytest.raises(Exception):
            session.read_query("select raise_error('no') x from later")
    assert staged(tmp_path / "st") == []


def test_racing_readers_share_one_job(spark, numbers, tmp_path):
    with ReadSession(spark, str(tmp_path / "st")) as session:
        gate, counts = threading.Barrier(6), []

        def read():
            gate.wait()
            counts.append(session.read_query("select id from numbers where id < 7").count())

        threads = [threading.Thread(target=read) for _ in range(6)]
        [t.start() for t in threads]
        [t.join() for t in threads]
        assert counts == [7] * 6
        assert len(staged(tmp_path / "st")) == 1


def test_lazy_query_is_optimised_with_its_hints(spark, small):
    read_table(spark, "wh.small", datasets=small).createOrReplaceTempView("small_view")
    df = read_query(spark, "select id, name from small_view", columns=["name"], cursor="id", lower="100")
    assert df.count() == 19
    assert "GreaterThan(id,100)" in plan(df)
