"""What the registered queries share: the dataset they read and a folder they write."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tableflow.session import staging_root
from tableflow.sources.tables import read_table

# Two dates that cut the orders into an early load, an increment, and their overlap.
OVERLAP_FROM = "1997-06-30T00:00:00"
LOADED_TO = "1999-02-28T00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str, **hints) -> DataFrame:
    return read_table(spark, f"main.{name}", datasets={"main": sf_dir}, **hints)


def views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    """Make tables visible to query texts."""
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def scratch(spark: SparkSession) -> dict[str, str]:
    """A fresh dataset ``out`` in the shared folder; the staging sweep removes it later."""
    return {"out": f"{staging_root(spark)}/load_{uuid.uuid4().hex}"}


def loaded_orders(spark: SparkSession, sf_dir: str, **hints) -> DataFrame:
    """Every order up to the end of the first load."""
    return table(spark, sf_dir, "orders", cursor="o_orderdate", upper=LOADED_TO, **hints)


def order_increment(spark: SparkSession, sf_dir: str, after: str = LOADED_TO, **hints) -> DataFrame:
    """Every order after a date; from OVERLAP_FROM the increment overlaps the first load."""
    return table(spark, sf_dir, "orders", cursor="o_orderdate", lower=after, **hints)
