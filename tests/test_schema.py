import pytest
from pyspark.sql import types as T

from tableflow import Code, TableflowError, canonical_type, check_write, schema_diff, schema_map


def ddl(text):
    return T._parse_datatype_string(text)


def struct(**types):
    return T.StructType([T.StructField(name, t) for name, t in types.items()])


@pytest.mark.parametrize(
    "data_type, declared",
    [
        (T.ByteType(), ("INTEGER", None, None)),
        (T.ShortType(), ("INTEGER", None, None)),
        (T.IntegerType(), ("INTEGER", None, None)),
        (T.LongType(), ("INTEGER", None, None)),
        (T.FloatType(), ("FLOAT", None, None)),
        (T.DoubleType(), ("FLOAT", None, None)),
        (T.DecimalType(20, 0), ("NUMERIC", 20, 0)),
        (T.DecimalType(38, 9), ("NUMERIC", 38, 9)),
        (T.DecimalType(38, 10), ("BIGNUMERIC", 38, 10)),
        (T.StringType(), ("STRING", None, None)),
        (T.VarcharType(5), ("STRING", None, None)),
        (T.BinaryType(), ("BYTES", None, None)),
        (T.BooleanType(), ("BOOLEAN", None, None)),
        (T.DateType(), ("DATE", None, None)),
        (T.TimestampType(), ("TIMESTAMP", None, None)),
        (T.TimestampNTZType(), ("DATETIME", None, None)),
        (T.TimeType(), ("TIME", None, None)),
    ],
)
def test_flat_types(data_type, declared):
    [row] = schema_map(struct(c=data_type))
    assert (row.path, row.mode) == ("c", "NULLABLE")
    assert (row.type, row.precision, row.scale) == declared


def test_nested_types_map_recursively(spark):
    schema = ddl("id bigint, rec struct<n:int,tags:array<string>>, xs array<bigint>, m map<string,array<int>>, items array<struct<k:string,v:double>>")
    assert [(r.path, r.type, r.mode) for r in schema_map(schema)] == [
        ("id", "INTEGER", "NULLABLE"),
        ("rec", "RECORD", "NULLABLE"), ("rec.n", "INTEGER", "NULLABLE"), ("rec.tags", "STRING", "REPEATED"),
        ("xs", "INTEGER", "REPEATED"),
        ("m", "RECORD", "REPEATED"), ("m.key", "STRING", "NULLABLE"), ("m.value", "INTEGER", "REPEATED"),
        ("items", "RECORD", "REPEATED"), ("items.k", "STRING", "NULLABLE"), ("items.v", "FLOAT", "NULLABLE"),
    ]


def test_not_null_columns_map_to_nullable():
    [row] = schema_map(T.StructType([T.StructField("c", T.LongType(), nullable=False)]))
    assert row.mode == "NULLABLE"


@pytest.mark.parametrize(
    "data_type, path",
    [
        (T.NullType(), "c"),
        (T.DayTimeIntervalType(), "c"),
        (T.YearMonthIntervalType(), "c"),
        (T.CalendarIntervalType(), "c"),
        (T.VariantType(), "c"),
        (T.StructType([]), "c"),
        (T.ArrayType(T.ArrayType(T.LongType())), "c"),
        (T.ArrayType(T.MapType(T.StringType(), T.LongType())), "c"),
        (struct(a=struct(b=T.NullType())), "c.a.b"),
        (T.MapType(T.StringType(), T.NullType()), "c.value"),
        (T.ArrayType(struct(x=T.ArrayType(T.ArrayType(T.LongType())))), "c.x"),
    ],
)
def test_types_without_a_place_are_refused_by_path(data_type, path):
    with pytest.raises(TableflowError) as error:
        schema_map(struct(c=data_type))
    assert error.value.code is Code.UNSUPPORTED_TYPE
    assert f"'{path}'" in str(error.value)


def problems(existing, wanted):
    return [(p.path, p.problem) for p in schema_diff(ddl(existing), ddl(wanted))]


@pytest.mark.parametrize(
    "existing, wanted, expected",
    [
        ("a bigint, b string", "a bigint, b string", []),
        ("a bigint", "a bigint, b string", [("b", "missing from the target")]),
        ("a string", "a bigint", [("a", "type differs")]),
        ("a array<bigint>", "a bigint", [("a", "repeated in the target only")]),
        ("a bigint", "a array<bigint>", [("a", "repeated in the write only")]),
        ("r struct<n:int,m:int,extra:string>", "r struct<n:int,m:int>", []),
        ("r struct<n:string>", "r struct<n:int,m:int>", [("r.n", "type differs"), ("r.m", "missing from the target")]),
        ("r array<struct<k:string>>", "r array<struct<k:string>>", []),
        ("r array<struct<k:string>>", "r array<struct<k:int>>", [("r.k", "type differs")]),
        ("r string", "r struct<n:int>", [("r", "type differs")]),
        ("a bigint not null", "a bigint", []),
        ("a bigint, extra string", "a bigint", []),
        ("a bigint", "a int", []),
        ("a int", "a bigint", [("a", "target is narrower")]),
        ("a double", "a float", []),
        ("a float", "a double", [("a", "target is narrower")]),
        ("a decimal(38,9)", "a decimal(10,2)", [("a", "precision or scale differs")]),
        ("a decimal(38,9)", "a decimal(38,10)", [("a", "type differs")]),
        ("a timestamp", "a timestamp_ntz", [("a", "type differs")]),
        ("m array<struct<key:string,value:int>>", "m map<string,int>", []),
        ("m map<string,int>", "m array<struct<key:string,value:int>>", []),
        ("m map<string,int>", "m map<string,string>", [("m.value", "type differs")]),
        ("A bigint", "a bigint", [("a", "name differs only by case")]),
        ("a string, b string", "b bigint, c int, a bigint",
         [("b", "type differs"), ("c", "missing from the target"), ("a", "type differs")]),
    ],
)
def test_diff(spark, existing, wanted, expected):
    assert problems(existing, wanted) == expected


def test_every_problem_is_in_the_refusal(spark):
    with pytest.raises(TableflowError) as error:
        check_write(ddl("a string"), ddl("a bigint, b int"), "wh.t")
    assert error.value.code is Code.SCHEMA_MISMATCH
    assert "a: type differs" in str(error.value) and "b: missing" in str(error.value)


def test_type_names_have_one_spelling():
    names = ["INT64", "FLOAT64", "BOOL", "STRUCT", "STRING", None]
    assert [canonical_type(n) for n in names] == ["INTEGER", "FLOAT", "BOOLEAN", "RECORD", "STRING", ""]
