import pytest

import __spark_entry__ as entry
from check import compare, connect
from tableflow.plans import ORACLES, QUERIES


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", list(QUERIES))
def test_query_agrees_with_its_sql(spark, sf_dir, key):
    assert compare(spark, connect(sf_dir), entry.queries()[key], entry.oracle_sql()[key], sf_dir) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["l_shipdate", "l_orderkey", "l_extendedprice"]
