"""Registered merges and deduplications as pure DataFrame plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableflow.operators.dedup import dedup_last
from tableflow.operators.merge import merge_rows
from tableflow.plans.common import LOADED_TO, OVERLAP_FROM, loaded_orders, order_increment, table, views
from tableflow.sources.queries import read_query

_LOADED = f"o_orderdate <= timestamp '{LOADED_TO}'"
_INCREMENT = f"o_orderdate > timestamp '{OVERLAP_FROM}'"
_LINE_ORDER = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
    "l_linestatus",
]


def dedup_last_event(spark, sf_dir):
    return dedup_last(table(spark, sf_dir, "events"), ["user_id"], ["event_id"])


def dedup_composite_key(spark, sf_dir):
    return dedup_last(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], _LINE_ORDER)


KEYED_EVENTS = "select *, nullif(event_type, 'error') as kind from events"


def dedup_null_key(spark, sf_dir):
    """Five keys over the whole table, one of them NULL: every key is a hot one."""
    views(spark, sf_dir, "events")
    return dedup_last(read_query(spark, KEYED_EVENTS), ["kind"], ["event_id"])


# An order merge: key o_orderkey, the increment overlapping the load.


def _overlap(spark, sf_dir):
    target = loaded_orders(spark, sf_dir, columns=["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"])
    source = order_increment(spark, sf_dir, after=OVERLAP_FROM, columns=["o_orderkey", "o_totalprice", "o_orderdate"])
    return target, source.withColumn("o_totalprice", F.col("o_totalprice") * 2)


def merge_insert_extra_cols(spark, sf_dir):
    target, source = _overlap(spark, sf_dir)
    return merge_rows(target, source, ["o_orderkey"], ["o_orderdate"])


def merge_shuffled(spark, sf_dir):
    target, source = _overlap(spark, sf_dir)
    return merge_rows(target, source, ["o_orderkey"], ["o_orderdate"], strategy="shuffle")


def merge_idempotent(spark, sf_dir):
    target, source = _overlap(spark, sf_dir)
    once = merge_rows(target, source, ["o_orderkey"], ["o_orderdate"])
    return merge_rows(once, source, ["o_orderkey"], ["o_orderdate"])


def merge_update_to_null(spark, sf_dir):
    target = loaded_orders(spark, sf_dir, columns=["o_orderkey", "o_orderpriority"])
    source = order_increment(spark, sf_dir, after=OVERLAP_FROM, columns=["o_orderkey", "o_orderpriority", "o_orderdate"])
    source = source.withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("1-URGENT")))
    return merge_rows(target, source, ["o_orderkey"], ["o_orderdate"])


NULL_KEYED = "select nullif(o_orderstatus, 'P') as status, o_custkey, o_totalprice, o_orderkey, o_orderdate from orders"


def merge_null_keys(spark, sf_dir):
    """A third of the rows on both sides have a NULL in the key, and target keys repeat."""
    views(spark, sf_dir, "orders")
    columns = ["status", "o_custkey", "o_totalprice", "o_orderkey"]
    target = read_query(spark, NULL_KEYED, columns=columns[:3], cursor="o_orderdate", upper=LOADED_TO)
    source = read_query(spark, NULL_KEYED, columns=columns, cursor="o_orderdate", lower=OVERLAP_FROM)
    return merge_rows(target, source, ["status", "o_custkey"], ["o_orderkey"])


def merge_key_only(spark, sf_dir):
    keys = ["o_custkey", "o_orderstatus"]
    target = loaded_orders(spark, sf_dir, columns=keys)
    source = order_increment(spark, sf_dir, after=OVERLAP_FROM, columns=[*keys, "o_orderkey"])
    return merge_rows(target, source, keys, ["o_orderkey"])


def merge_target_dups(spark, sf_dir):
    """Every line of an order takes the status of the order; an order without lines is inserted."""
    target = table(spark, sf_dir, "lineitem", columns=["l_orderkey", "l_returnflag", "l_linestatus"])
    source = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("l_returnflag"), "o_orderdate"
    )
    return merge_rows(target, source, ["l_orderkey"], ["o_orderdate"])


QUERIES = {
    "dedup_last": dedup_last_event,
    "dedup_composite_key": dedup_composite_key,
    "dedup_null_key": dedup_null_key,
    "merge_insert_extra_cols": merge_insert_extra_cols,
    "merge_shuffled": merge_shuffled,
    "merge_idempotent": merge_idempotent,
    "merge_update_to_null": merge_update_to_null,
    "merge_null_keys": merge_null_keys,
    "merge_key_only": merge_key_only,
    "merge_target_dups": merge_target_dups,
}


def _merge_sql(target, source, keys, values=(), extra=()):
    """A merge in SQL: the updated target rows, then the inserted source rows."""
    match = " and ".join(f"t.{k} is not distinct from s.{k}" for k in keys)
    updated = ", ".join(
        [f"t.{k}" for k in keys]
        + [f"case when s.hit then s.{v} else t.{v} end as {v}" for v in values]
        + [f"t.{e}" for e in extra]
    )
    inserted = ", ".join([f"s.{c}" for c in (*keys, *values)] + ["null"] * len(extra))
    return f"""
        with t as ({target}), s as (select *, true as hit from ({source}))
        select {updated} from t left join s on {match}
        union all
        select {inserted} from s where not exists (select 1 from t where {match})"""


_OVERLAP_SQL = _merge_sql(
    f"select * from orders where {_LOADED}",
    f"select o_orderkey, o_totalprice * 2 as o_totalprice from orders where {_INCREMENT}",
    ["o_orderkey"],
    ["o_totalprice"],
    ["o_orderstatus", "o_orderpriority"],
)
_DESCENDING = ", ".join(f"{c} desc" for c in _LINE_ORDER)

ORACLES = {
    "dedup_last": "select * from events qualify row_number() over (partition by user_id order by event_id desc) = 1",
    "dedup_composite_key": f"""
        select * from lineitem
        qualify row_number() over (partition by l_orderkey, l_linenumber order by {_DESCENDING}) = 1""",
    "dedup_null_key": f"""
        select * from ({KEYED_EVENTS}) qualify row_number() over (partition by kind order by event_id desc) = 1""",
    "merge_insert_extra_cols": _OVERLAP_SQL,
    "merge_shuffled": _OVERLAP_SQL,
    "merge_idempotent": _OVERLAP_SQL,
    "merge_update_to_null": _merge_sql(
        f"select * from orders where {_LOADED}",
        f"select o_orderkey, nullif(o_orderpriority, '1-URGENT') as o_orderpriority from orders where {_INCREMENT}",
        ["o_orderkey"],
        ["o_orderpriority"],
    ),
    "merge_null_keys": _merge_sql(
        f"select * from ({NULL_KEYED}) where {_LOADED}",
        f"""select * from ({NULL_KEYED}) where {_INCREMENT}
            qualify row_number() over (partition by status, o_custkey order by o_orderkey desc) = 1""",
        ["status", "o_custkey"],
        ["o_totalprice"],
    ),
    "merge_key_only": _merge_sql(
        f"select * from orders where {_LOADED}",
        f"select distinct o_custkey, o_orderstatus from orders where {_INCREMENT}",
        ["o_custkey", "o_orderstatus"],
    ),
    "merge_target_dups": _merge_sql(
        "select * from lineitem",
        "select o_orderkey as l_orderkey, o_orderstatus as l_returnflag from orders",
        ["l_orderkey"],
        ["l_returnflag"],
        ["l_linestatus"],
    ),
}
