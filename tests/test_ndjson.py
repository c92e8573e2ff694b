import json
import os
import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow import (
    Code,
    TableflowError,
    load_ndjson,
    null_element_report,
    read_ndjson,
    read_table,
    to_ndjson,
    write_ndjson,
    write_table,
)


def lines(df, **options):
    return [r.value for r in to_ndjson(df, **options).collect()]


def one(spark, expressions):
    [line] = lines(spark.sql(f"select {expressions}"))
    return line


@pytest.mark.parametrize(
    "expressions, line",
    [
        ("7 id, 'x' name", '{"id":7,"name":"x"}'),
        ("cast(null as int) id, cast(null as string) name", '{"id":null,"name":null}'),
        ("cast(1 as tinyint) a, cast(-2 as smallint) b, 9223372036854775807L c", '{"a":1,"b":-2,"c":9223372036854775807}'),
        ("true a, false b", '{"a":true,"b":false}'),
        ("cast(-1.5 as decimal(38,9)) d", '{"d":"-1.500000000"}'),
        ("cast(0 as decimal(38,9)) d, cast(18446744073709551615 as decimal(20,0)) u", '{"d":"0.000000000","u":"18446744073709551615"}'),
        ("cast(1234567.5 as decimal(38,10)) d", '{"d":"1234567.5000000000"}'),
        ("cast('99999999999999999999999999999.999999999' as decimal(38,9)) d", '{"d":"99999999999999999999999999999.999999999"}'),
        ("cast('NaN' as double) a, cast('Infinity' as double) b, cast('-Infinity' as float) c",
         '{"a":"NaN","b":"Infinity","c":"-Infinity"}'),
        ("cast(1.1 as float) a, 1.1D b", '{"a":1.1,"b":1.1}'),
        ("X'6869' b", '{"b":"aGk="}'),
        ("date'2026-01-02' d", '{"d":"2026-01-02"}'),
        ("timestamp'2026-01-02 03:04:05 UTC' z, timestamp_ntz'2026-01-02 03:04:05.000006' n",
         '{"z":"2026-01-02T03:04:05.000000Z","n":"2026-01-02T03:04:05.000006"}'),
        ("named_struct('at', timestamp'2026-01-02 03:04:05 UTC', 'n', timestamp_ntz'2026-01-02 03:04:05') rec",
         '{"rec":{"at":"2026-01-02T03:04:05.000000Z","n":"2026-01-02T03:04:05.000000"}}'),
        ("time'03:04:05.000006' t, time'03:04:05' u", '{"t":"03:04:05.000006","u":"03:04:05.000000"}'),
        ("array('a','b') tags", '{"tags":["a","b"]}'),
        ("cast(null as array<string>) tags, cast(array() as array<string>) e", '{"tags":[],"e":[]}'),
        ("named_struct('n', 7, 's', 'x') rec", '{"rec":{"n":7,"s":"x"}}'),
        ("cast(null as struct<n:int,xs:array<int>>) rec", '{"rec":null}'),
        ("named_struct('xs', cast(null as array<int>)) rec", '{"rec":{"xs":[]}}'),
        ("map('k1', 1, 'k2', null) m", '{"m":[{"key":"k1","value":1},{"key":"k2","value":null}]}'),
        ("cast(null as map<string,int>) m, cast(map() as map<string,int>) e", '{"m":[],"e":[]}'),
        ("map('k', array(1.50BD)) m", '{"m":[{"key":"k","value":["1.50"]}]}'),
        ("array(named_struct('x', 1, 'd', 2.5BD)) items", '{"items":[{"x":1,"d":"2.5"}]}'),
        ("1 `a.b`, 2 `c d`", '{"a.b":1,"c d":2}'),
    ],
)
def test_one_row(spark, expressions, line):
    assert one(spark, expressions) == line


def test_text_is_equal_as_json(spark):
    text = 'quote " backslash \\ newline \n tab \t é 漢 😀 \u0001'
    [line] = lines(spark.createDataFrame([(text,)], "s string"))
    assert json.loads(line) == {"s": text} and "\n" not in line


@pytest.mark.parametrize("setting", ["spark.sql.session.timeZone=Asia/Tokyo", "spark.sql.ansi.enabled=false"])
def test_encoding_does_not_depend_on_the_session(spark, setting):
    key, value = setting.split("=")
    before = spark.conf.get(key)
    df = spark.sql("select timestamp'2026-01-02 03:04:05 UTC' z, cast('0' as decimal(38,9)) d")
    spark.conf.set(key, value)
    try:
        assert lines(df) == ['{"z":"2026-01-02T03:04:05.000000Z","d":"0.000000000"}']
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize(
    "schema, good, bad, path",
    [
        ("id int, tags array<string>", (1, ["a"]), (12, ["b", None]), "tags"),
        ("id int, rec struct<xs:array<int>>", (1, ([1],)), (12, ([None],)), "rec.xs"),
        ("id int, items array<struct<xs:array<int>>>", (1, [([1],)]), (12, [([1],), ([2, None],)]), "items.xs"),
        ("id int, items array<struct<x:int>>", (1, [(1,)]), (12, [(1,), None]), "items"),
        ("id int, m map<string,array<int>>", (1, {"a": [1]}), (12, {"a": [1], "b": [None]}), "m.value"),
    ],
)
def test_null_elements_are_refused_and_reported(spark, schema, good, bad, path):
    df = spark.createDataFrame([good, bad, (3, None)], schema)
    with pytest.raises(Exception, match=rf"column '{path}': an array element is NULL.*\(id=12\)"):
        lines(df, key=["id"])
    with pytest.raises(Exception, match=f"column '{path}'"):
        lines(df)
    assert {r.path: r.bad_rows for r in null_element_report(df).collect() if r.bad_rows} == {path: 1}
    assert len(lines(df.where("id <> 12"))) == 2


def test_the_first_bad_row_in_order_of_a_key(spark):
    random.seed(11)
    rows = [(k, [None] if random.random() < 0.02 else [k], ([None, 1],) if k == 4321 else None) for k in range(5000)]
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "k int, a array<int>, r struct<b:array<int>>").repartition(7)
    first = min(k for k, a, _ in rows if a == [None])
    bad = sum(a == [None] for _, a, _ in rows)
    got = {tuple(r) for r in null_element_report(df, order_by=["k"]).collect()}
    assert got == {("a", bad, first + 1), ("r.b", 1, 4322)}
    none = {tuple(r) for r in null_element_report(df.where("k < 0"), order_by=["k"]).collect()}
    assert none == {("a", 0, None), ("r.b", 0, None)}
    assert null_element_report(df.select("k"), order_by=["k"]).columns == ["path", "bad_rows", "first_bad_row"]


def test_report_lists_every_array(spark):
    df = spark.sql("select 1 id, array(1) a, named_struct('b', array(named_struct('c', array(1)))) r, map('k', array(1)) m")
    assert sorted(r.path for r in null_element_report(df).collect()) == ["a", "m.value", "r.b", "r.b.c"]
    assert null_element_report(df.select("id")).collect() == []


def test_unsupported_types_are_refused(spark):
    with pytest.raises(TableflowError) as error:
        to_ndjson(spark.sql("select array(array(1)) x"))
    assert error.value.code is Code.UNSUPPORTED_TYPE


SCHEMA = (
    "i bigint, f double, g float, num decimal(38,9), s string, flag boolean, b binary, d date, n timestamp_ntz,"
    " ts timestamp, xs array<decimal(10,2)>, rec struct<n:int,tags:array<string>>, m map<string,array<decimal(5,1)>>,"
    " items array<struct<k:string,v:double>>"
)
DATA = [
    (1, 2.5, 1.1, Decimal("-1.5"), 'a"b\n漢', True, b"hi", date(2026, 1, 2), datetime(2026, 1, 2, 3, 4, 5, 6),
     datetime(2026, 1, 2, 3, 4, 5, 6), [Decimal("1.50")], (7, ["t"]), {"k": [Decimal("2.5")]}, [("x", 1.5)]),
    (2, float("inf"), 1e10, None, None, None, None, None, None, None, [], None, {}, []),
]


def test_round_trip_over_several_files(spark, tmp_path):
    df = spark.createDataFrame(DATA, SCHEMA)
    many = df.unionByName(df.withColumn("i", F.col("i") + 10)).unionByName(df.withColumn("i", F.col("i") + 20))
    write_ndjson(many.coalesce(1), str(tmp_path / "out"), max_records_per_file=2)
    assert len([n for n in os.listdir(tmp_path / "out") if n.endswith(".txt")]) == 3
    back = read_ndjson(spark, str(tmp_path / "out"), df.schema)
    assert [f.dataType for f in back.schema] == [f.dataType for f in df.schema]
    assert sorted(map(str, back.collect())) == sorted(map(str, many.collect()))


def test_files_roll_by_bytes(spark, tmp_path):
    df = spark.range(0, 2000, 1, 1).selectExpr("id", "repeat('x', 100) as pad")
    write_ndjson(df, str(tmp_path / "out"), max_bytes_per_file=50_000)
    sizes = [os.path.getsize(tmp_path / "out" / n) for n in os.listdir(tmp_path / "out") if n.endswith(".txt")]
    assert len(sizes) == 5 and max(sizes) < 52_000
    assert read_ndjson(spark, str(tmp_path / "out"), df.schema).count() == 2000
    write_ndjson(df, str(tmp_path / "one"))
    assert len([n for n in os.listdir(tmp_path / "one") if n.endswith(".txt")]) == 1


UNKNOWN = "i int, rec struct<n:int,inner:struct<z:int>>, items array<struct<k:string>>, m map<string,int>"


@pytest.mark.parametrize(
    "line",
    [
        '{"i":1,"more":2}', '{"rec":{"n":1,"more":2}}', '{"rec":{"inner":{"z":1,"more":null}}}',
        '{"items":[{"k":"a"},{"k":"b","more":1}]}', '{"m":[{"key":"a","value":1,"more":1}]}',
    ],
)
def test_unknown_members_fail_the_load(spark, tmp_path, line):
    fine = '{"i":1,"rec":{"n":1,"inner":{"z":2}},"items":[{"k":"a"}],"m":[{"key":"a","value":1}]}'
    (tmp_path / "in.json").write_text(f"{fine}\n\n{line}\n")
    schema = T._parse_datatype_string(UNKNOWN)
    for action in ("count", "collect"):
        with pytest.raises(Exception, match="has no column for"):
            getattr(read_ndjson(spark, str(tmp_path / "in.json"), schema), action)()
    assert read_ndjson(spark, str(tmp_path / "in.json"), schema, ignore_unknown=True).count() == 2
    (tmp_path / "fine.json").write_text(fine)
    assert read_ndjson(spark, str(tmp_path / "fine.json"), schema).first().m == {"a": 1}


def test_a_load_refuses_unknown_members_unless_told(spark, tmp_path, datasets):
    write_table(spark.sql("select 1 i"), "wh.t", datasets=datasets)
    (tmp_path / "in.json").write_text('{"i":2,"more":3}\n')
    with pytest.raises(Exception, match="has no column for"):
        load_ndjson(spark, str(tmp_path / "in.json"), "wh.t", datasets=datasets)
    load_ndjson(spark, str(tmp_path / "in.json"), "wh.t", datasets=datasets, ignore_unknown=True)
    assert sorted(r.i for r in read_table(spark, "wh.t", datasets=datasets).collect()) == [1, 2]


def test_unread_columns_are_checked_on_demand(spark, tmp_path):
    (tmp_path / "in.json").write_text('{"i":1,"s":"a"}\n{"i":"x","s":"b"}\n')
    schema = T._parse_datatype_string("i int, s string")
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING|FAILFAST"):
        read_ndjson(spark, str(tmp_path / "in.json"), schema, check_unread=True).count()


def test_write_does_not_overwrite(spark, tmp_path):
    write_ndjson(spark.range(1), str(tmp_path / "out"))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_ndjson(spark.range(1), str(tmp_path / "out"))


@pytest.mark.parametrize("line", ['{"i":"x"}', '{"i":1', "[1]", '{"i":1.5}', '{"i":99999999999}'])
def test_malformed_rows_fail_the_load(spark, tmp_path, line):
    (tmp_path / "in.json").write_text('{"i":1}\n' + line + "\n")
    df = read_ndjson(spark, str(tmp_path / "in.json"), T._parse_datatype_string("i int"))
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING|FAILFAST"):
        df.collect()


def test_time_columns_are_text_in_files(spark, tmp_path):
    df = spark.sql("select 1 i, time'03:04:05.000006' t")
    write_ndjson(df, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).first().t == "03:04:05.000006"


def test_load_appends_to_an_existing_table_only(spark, datasets, tmp_path):
    df = spark.createDataFrame(DATA, SCHEMA)
    write_ndjson(df, str(tmp_path / "out"))
    with pytest.raises(TableflowError) as error:
        load_ndjson(spark, str(tmp_path / "out"), "wh.t", datasets=datasets)
    assert error.value.code is Code.TABLE_NOT_FOUND
    write_table(df, "wh.t", datasets=datasets)
    assert load_ndjson(spark, str(tmp_path / "out"), "wh.t", datasets=datasets).rows == 2
    got = read_table(spark, "wh.t", datasets=datasets).collect()
    assert sorted(map(str, got)) == sorted(map(str, [*read_ndjson(spark, str(tmp_path / "out"), df.schema).collect()] * 2))


def test_a_load_with_one_bad_row_lands_nothing(spark, datasets, tmp_path):
    write_table(spark.range(3), "wh.t", datasets=datasets)
    (tmp_path / "in.json").write_text('{"id":4}\n{"id":"x"}\n')
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING|FAILFAST"):
        load_ndjson(spark, str(tmp_path / "in.json"), "wh.t", datasets=datasets)
    assert read_table(spark, "wh.t", datasets=datasets).count() == 3
