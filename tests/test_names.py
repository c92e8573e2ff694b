import pytest
from pyspark.sql import Row

from tableflow import Code, TableflowError, parse_table_name, parse_table_names


@pytest.mark.parametrize(
    "name, expected",
    [
        ("sales.orders", ("my-proj", "sales", "orders")),
        ("p.sales.orders", ("p", "sales", "orders")),
        ("sales.order-2026", ("my-proj", "sales", "order-2026")),
        ("sales.größe", ("my-proj", "sales", "größe")),
    ],
)
def test_good_names(name, expected):
    parsed = parse_table_name(name, "my-proj")
    assert (parsed.project, parsed.dataset, parsed.table) == expected


@pytest.mark.parametrize(
    "name",
    ["orders", "a.b.c.d", "`sales`.`orders`", "sales.bad name", "sales.", ".orders", "sa-les.t", "P.sales.t", "sales.t\n"],
)
def test_bad_names(name):
    with pytest.raises(TableflowError) as error:
        parse_table_name(name, "my-proj")
    assert error.value.code is Code.BAD_NAME


def test_quoted_name_doubles_a_backtick():
    from tableflow import TableName

    assert TableName("p", "d", "weird`table").sql == "`p`.`d`.`weird``table`"


def test_name_column(spark):
    names = ["sales.orders", "p.sales.orders", "sales.order-2026", "sales.größe",
             "orders", "a.b.c.d", "`s`.`o`", "sales.bad name", "sa-les.t", "P_.sales.t", "sales.", None]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, name string")
    rows = parse_table_names(df, "name", "my-proj").orderBy("i").collect()
    good = [(r.project, r.dataset, r.table) for r in rows if r.error is None]
    assert good == [("my-proj", "sales", "orders"), ("p", "sales", "orders"),
                    ("my-proj", "sales", "order-2026"), ("my-proj", "sales", "größe")]
    assert [r.error for r in rows if r.error] == [
        "not dataset.table or project.dataset.table",
        "not dataset.table or project.dataset.table",
        "backticks are not part of a name",
        "illegal table: bad name",
        "illegal dataset: sa-les",
        "illegal project: P_",
        "illegal table: ",
        "no name",
    ]
    assert all(r.table is None for r in rows if r.error)


def test_name_column_checks_the_default_project(spark):
    df = spark.createDataFrame([Row(name="sales.orders")])
    assert parse_table_names(df, "name", "Bad").first().error == "illegal project: Bad"
