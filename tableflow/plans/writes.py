"""Registered writes: each lands rows in a fresh folder table and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableflow.operators.append import append_rows
from tableflow.operators.dedup import dedup_last
from tableflow.plans.common import LOADED_TO, OVERLAP_FROM, loaded_orders, order_increment, scratch, table
from tableflow.sinks.write import WriteSession, write_table
from tableflow.sources.tables import read_table

TARGET = "out.target"
_ORDER = ["o_orderkey", "o_orderstatus", "o_totalprice"]
_LOADED = f"o_orderdate <= timestamp '{LOADED_TO}'"
_DIAGONAL = "(o_orderpriority < '2' and o_orderstatus = 'F') or (o_orderpriority > '5' and o_orderstatus = 'O')"
_LATER = f"o_orderdate > timestamp '{LOADED_TO}'"


def append_create(spark, sf_dir):
    out = scratch(spark)
    write_table(table(spark, sf_dir, "orders"), TARGET, "append", datasets=out)
    return read_table(spark, TARGET, datasets=out)


def append_existing(spark, sf_dir):
    out = scratch(spark)
    write_table(loaded_orders(spark, sf_dir, columns=_ORDER), TARGET, "append", datasets=out)
    # By name: the increment comes in another column order.
    write_table(order_increment(spark, sf_dir, columns=_ORDER[::-1]), TARGET, "append", datasets=out)
    return read_table(spark, TARGET, datasets=out)


def append_extra_cols(spark, sf_dir):
    out = scratch(spark)
    first = loaded_orders(spark, sf_dir, columns=[*_ORDER, "o_orderpriority"])
    write_table(first, TARGET, "append", datasets=out)
    write_table(order_increment(spark, sf_dir, columns=_ORDER), TARGET, "append", datasets=out)
    return read_table(spark, TARGET, datasets=out)


def append_union(spark, sf_dir):
    """The append as a plan, without a write."""
    first = loaded_orders(spark, sf_dir, columns=[*_ORDER, "o_orderpriority"])
    return append_rows(first, order_increment(spark, sf_dir, columns=_ORDER))


def append_partitioned(spark, sf_dir):
    out = scratch(spark)
    columns = [*_ORDER, "o_orderpriority"]
    for rows in (loaded_orders(spark, sf_dir, columns=columns), order_increment(spark, sf_dir, columns=columns)):
        write_table(rows, TARGET, "append", datasets=out, partition_by=["o_orderpriority"])
    return read_table(spark, TARGET, datasets=out)


def append_replayed(spark, sf_dir):
    """Each batch of a stream is appended twice, as after a failure, and counts once."""
    out = scratch(spark)
    first, second = (read(spark, sf_dir, columns=_ORDER) for read in (loaded_orders, order_increment))
    for number, rows in ((0, first), (0, first), (1, second), (0, first), (1, second)):
        write_table(rows, TARGET, "append", datasets=out, batch=("orders", number))
    return read_table(spark, TARGET, datasets=out)


def replace(spark, sf_dir):
    out = scratch(spark)
    first = loaded_orders(spark, sf_dir, columns=[*_ORDER, "o_orderpriority"])
    write_table(first, TARGET, "replace", datasets=out)
    write_table(order_increment(spark, sf_dir, columns=_ORDER), TARGET, "replace", datasets=out)
    return read_table(spark, TARGET, datasets=out)


def _after_empty(mode):
    """The whole of the orders, then a write of an increment that turns out to be empty."""

    def run(spark, sf_dir):
        out = scratch(spark)
        write_table(table(spark, sf_dir, "orders", columns=_ORDER), TARGET, "append", datasets=out)
        nothing = table(spark, sf_dir, "orders", columns=_ORDER, cursor="o_totalprice", lower="100000000")
        keys = ["o_orderkey"] if mode == "merge" else []
        write_table(nothing, TARGET, mode, keys=keys, datasets=out)
        return read_table(spark, TARGET, datasets=out)

    return run


def write_counts(spark, sf_dir):
    """Rows are counted as staged, before deduplication."""
    out = scratch(spark)
    cut = "2024-01-12T00:00:00"
    with WriteSession(spark, TARGET, "merge", keys=["user_id"], sequence_by=["event_id"], datasets=out) as session:
        session.write(table(spark, sf_dir, "events", cursor="ts", upper=cut))
        session.write(table(spark, sf_dir, "events", cursor="ts", lower=cut))
        result = session.commit()
    return read_table(spark, TARGET, datasets=out).agg(
        F.lit(result.rows).cast("long").alias("rows_staged"),
        F.lit(result.batches).cast("long").alias("batches"),
        F.count(F.lit(1)).alias("rows_landed"),
    )


def merge_create(spark, sf_dir):
    out = scratch(spark)
    write_table(
        table(spark, sf_dir, "events"), TARGET, "merge", keys=["user_id"], sequence_by=["event_id"], datasets=out
    )
    return read_table(spark, TARGET, datasets=out)


def merge_existing(spark, sf_dir):
    out = scratch(spark)
    first = loaded_orders(spark, sf_dir, columns=[*_ORDER, "o_orderpriority"])
    write_table(first, TARGET, "append", datasets=out)
    increment = order_increment(spark, sf_dir, after=OVERLAP_FROM, columns=_ORDER)
    increment = increment.withColumn("o_orderstatus", F.lit("X")).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    write_table(increment, TARGET, "merge", keys=["o_orderkey"], datasets=out)
    return read_table(spark, TARGET, datasets=out)


def merge_two_batches(spark, sf_dir):
    """The later batch of a session wins where two batches hold one key."""
    out = scratch(spark)
    write_table(loaded_orders(spark, sf_dir, columns=_ORDER), TARGET, "append", datasets=out)
    with WriteSession(spark, TARGET, "merge", keys=["o_orderkey"], datasets=out) as session:
        for after, status in (("1996-05-05T00:00:00", "1"), (OVERLAP_FROM, "2")):
            batch = order_increment(spark, sf_dir, after=after, columns=_ORDER)
            session.write(batch.withColumn("o_orderstatus", F.lit(status)))
        session.commit()
    return read_table(spark, TARGET, datasets=out)


def merge_partitioned(spark, sf_dir):
    """The partition column is a key, so only the partitions the increment names are rewritten."""
    out = scratch(spark)
    columns = [*_ORDER, "o_orderpriority"]
    where = {"datasets": out, "partition_by": ["o_orderpriority"]}
    write_table(table(spark, sf_dir, "orders", columns=columns), TARGET, "append", **where)
    urgent = order_increment(
        spark, sf_dir, after=OVERLAP_FROM, columns=columns, predicate="o_orderpriority < '3-MEDIUM'"
    )
    urgent = urgent.withColumn("o_orderstatus", F.lit("U"))
    write_table(urgent, TARGET, "merge", keys=["o_orderpriority", "o_orderkey"], **where)
    return read_table(spark, TARGET, datasets=out)


def merge_partitioned_two_columns(spark, sf_dir):
    """Both partition columns are keys: exactly the pairs that the increment names are rewritten."""
    out = scratch(spark)
    columns = [*_ORDER, "o_orderpriority"]
    where = {"datasets": out, "partition_by": ["o_orderpriority", "o_orderstatus"]}
    write_table(table(spark, sf_dir, "orders", columns=columns), TARGET, "append", **where)
    diagonal = order_increment(spark, sf_dir, after=OVERLAP_FROM, columns=columns, predicate=_DIAGONAL)
    doubled = diagonal.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    write_table(doubled, TARGET, "merge", keys=["o_orderpriority", "o_orderstatus", "o_orderkey"], **where)
    return read_table(spark, TARGET, datasets=out)


def partitioned_types_remerge(spark, sf_dir):
    """A zero-padded text as partition column: merging the table into itself changes nothing."""
    out = scratch(spark)
    lines = dedup_last(
        table(spark, sf_dir, "lineitem").select(
            F.lpad(F.col("l_linenumber").cast("string"), 3, "0").alias("line"), "l_orderkey", "l_quantity", "l_partkey"
        ),
        ["line", "l_orderkey"],
        ["l_partkey", "l_quantity"],
    ).drop("l_partkey")
    where = {"datasets": out, "partition_by": ["line"]}
    write_table(lines, TARGET, "append", **where)
    write_table(read_table(spark, TARGET, datasets=out), TARGET, "merge", keys=["line", "l_orderkey"], **where)
    return read_table(spark, TARGET, datasets=out)


QUERIES = {
    "append_create": append_create,
    "append_existing": append_existing,
    "append_extra_cols": append_extra_cols,
    "append_union": append_union,
    "append_partitioned": append_partitioned,
    "append_replayed": append_replayed,
    "replace": replace,
    "empty_append": _after_empty("append"),
    "empty_replace": _after_empty("replace"),
    "empty_merge": _after_empty("merge"),
    "write_counts": write_counts,
    "merge_create": merge_create,
    "merge_existing": merge_existing,
    "merge_two_batches": merge_two_batches,
    "merge_partitioned": merge_partitioned,
    "merge_partitioned_two_columns": merge_partitioned_two_columns,
    "partitioned_types_remerge": partitioned_types_remerge,
}

_ALL = "select o_orderkey, o_orderstatus, o_totalprice from orders"

ORACLES = {
    "append_create": "select * from orders",
    "append_existing": _ALL,
    "append_extra_cols": f"""
        select o_orderkey, o_orderstatus, o_totalprice, case when {_LOADED} then o_orderpriority end as o_orderpriority
        from orders""",
    "append_union": f"""
        select o_orderkey, o_orderstatus, o_totalprice, case when {_LOADED} then o_orderpriority end as o_orderpriority
        from orders""",
    "append_partitioned": "select o_orderkey, o_orderstatus, o_totalprice, o_orderpriority from orders",
    "append_replayed": _ALL,
    "replace": f"{_ALL} where {_LATER}",
    "empty_append": _ALL,
    "empty_replace": f"{_ALL} where o_totalprice > 100000000",
    "empty_merge": _ALL,
    "write_counts": """
        select count(*) as rows_staged, 2::bigint as batches, count(distinct user_id) as rows_landed from events""",
    "merge_create": "select * from events qualify row_number() over (partition by user_id order by event_id desc) = 1",
    "merge_existing": f"""
        select o_orderkey,
               case when o_orderdate > timestamp '{OVERLAP_FROM}' then 'X' else o_orderstatus end as o_orderstatus,
               case when o_orderdate > timestamp '{OVERLAP_FROM}' then o_totalprice * 2 else o_totalprice end
                   as o_totalprice,
               case when {_LOADED} then o_orderpriority end as o_orderpriority
        from orders""",
    "merge_two_batches": f"""
        select o_orderkey, o_totalprice,
               case when o_orderdate > timestamp '{OVERLAP_FROM}' then '2'
                    when o_orderdate > timestamp '1996-05-05' then '1' else o_orderstatus end as o_orderstatus
        from orders""",
    "merge_partitioned": f"""
        select o_orderkey, o_totalprice, o_orderpriority,
               case when o_orderdate > timestamp '{OVERLAP_FROM}' and o_orderpriority < '3-MEDIUM' then 'U'
                    else o_orderstatus end as o_orderstatus
        from orders""",
    "merge_partitioned_two_columns": f"""
        select o_orderkey, o_orderstatus, o_orderpriority,
               case when o_orderdate > timestamp '{OVERLAP_FROM}' and ({_DIAGONAL}) then o_totalprice * 2
                    else o_totalprice end as o_totalprice
        from orders""",
    "partitioned_types_remerge": """
        select line, l_orderkey, l_quantity from (
          select lpad(l_linenumber::varchar, 3, '0') as line, l_orderkey, l_quantity,
                 row_number() over (partition by l_linenumber, l_orderkey order by l_partkey desc, l_quantity desc) as n
          from lineitem) where n = 1""",
}
