"""Registered reads: hints, incremental bounds, query reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableflow.plans.common import table, views
from tableflow.sources.queries import ReadSession, read_query

QUERIES = {}
ORACLES = {}


def _read(key, name, oracle, **hints):
    QUERIES[key] = lambda spark, sf_dir: table(spark, sf_dir, name, **hints)
    ORACLES[key] = oracle


_read("read_table", "customer", "select * from customer")
_read("read_pruned", "lineitem", "select l_orderkey, l_quantity from lineitem", columns=["l_orderkey", "l_quantity"])
_read(
    "read_reordered",
    "orders",
    "select o_totalprice, o_orderdate, o_orderkey from orders",
    columns=["o_totalprice", "o_orderdate", "o_orderkey"],
)
_read(
    "read_predicate",
    "orders",
    "select o_orderkey, o_totalprice from orders where o_orderstatus = 'F' or o_totalprice > 400000",
    columns=["o_orderkey", "o_totalprice"],
    predicate="o_orderstatus = 'F' or o_totalprice > 400000",
)
_read(
    "read_predicate_quoted",
    "orders",
    """select * from orders where "o_totalprice" > 250000 and "o_orderstatus" <> 'P'""",
    predicate="""\"o_totalprice" > 250000 and "o_orderstatus" <> 'P'""",
)
_read("read_partitioned", "lineitem", "select * from lineitem", max_partitions=64)
_read("read_empty", "lineitem", "select * from lineitem where l_quantity > 50", cursor="l_quantity", lower="50")

_read(
    "wm_exclusive_int", "lineitem", "select * from lineitem where l_linenumber > 3", cursor="l_linenumber", lower="3"
)
_read(
    "wm_inclusive_int",
    "lineitem",
    "select * from lineitem where l_linenumber >= 3",
    cursor="l_linenumber",
    lower="3",
    lower_inclusive=True,
)
_read("wm_upper_only", "lineitem", "select * from lineitem where l_linenumber <= 5", cursor="l_linenumber", upper="5")
_read(
    "wm_window_int",
    "lineitem",
    "select * from lineitem where l_linenumber > 2 and l_linenumber <= 6",
    cursor="l_linenumber",
    lower="2",
    upper="6",
)
_read(
    "wm_fraction_int",
    "lineitem",
    "select l_orderkey, l_linenumber from lineitem where l_linenumber > 2.5",
    columns=["l_orderkey", "l_linenumber"],
    cursor="l_linenumber",
    lower="2.5",
)
_read(
    "wm_ts",
    "events",
    "select * from events where ts > timestamp '2024-01-10 06:30:00.25'",
    cursor="ts",
    lower="2024-01-10T06:30:00.250000",
)
_read(
    "wm_window_ts",
    "events",
    "select * from events where ts > timestamp '2024-01-08 00:00:00' and ts <= timestamp '2024-01-22 12:00:00.5'",
    cursor="ts",
    lower="2024-01-08T00:00:00",
    upper="2024-01-22 12:00:00.5",
)
_read(
    "wm_double",
    "orders",
    "select * from orders where o_totalprice > 250000.5",
    cursor="o_totalprice",
    lower="250000.5",
)
_read(
    "wm_string",
    "orders",
    "select * from orders where o_orderpriority > '2-HIGH'",
    cursor="o_orderpriority",
    lower="2-HIGH",
)
_read(
    "read_all_hints",
    "lineitem",
    """select l_shipdate, l_orderkey, l_extendedprice from lineitem
       where (l_returnflag <> 'N' or l_quantity >= 25)
         and l_shipdate > timestamp '1996-06-01' and l_shipdate <= timestamp '2000-12-31 12:00:00'""",
    columns=["l_shipdate", "l_orderkey", "l_extendedprice"],
    predicate="l_returnflag <> 'N' or l_quantity >= 25",
    cursor="l_shipdate",
    lower="1996-06-01T00:00:00",
    upper="2000-12-31T12:00:00",
)

# Query texts: the oracle runs the same text.

TYPED_ORDERS = """
select o_orderkey, cast(o_orderdate as date) as day, cast(o_totalprice as decimal(18,2)) as price
from orders"""

NULL_CURSOR = "select l_orderkey, l_partkey, nullif(l_linenumber, 7) as line from lineitem"

JOIN_AGG = """
select n.n_name, o.o_orderpriority, count(*) as orders, max(o.o_orderdate) as last_order,
       cast(sum(cast(o.o_totalprice as decimal(18,2))) as double) as total
from orders o
join customer c on o.o_custkey = c.c_custkey
join nation n on c.c_nationkey = n.n_nationkey
where o.o_orderstatus <> 'P'
group by n.n_name, o.o_orderpriority"""

CUSTOMER_TOTALS = """
select o_custkey, count(*) as orders, max(o_totalprice) as top, min(o_orderdate) as since
from orders group by o_custkey"""

NESTED_LINES = """
select l_orderkey, l_linenumber,
       named_struct('flag', l_returnflag, 'price', l_extendedprice) as rec,
       array(l_returnflag, l_linestatus) as tags,
       array(named_struct('k', l_linestatus, 'v', l_quantity), named_struct('k', l_returnflag, 'v', l_tax)) as items
from lineitem"""


def wm_date(spark, sf_dir):
    views(spark, sf_dir, "orders")
    orders = read_query(spark, TYPED_ORDERS, cursor="day", lower="1996-02-28", upper="2000-03-01")
    return orders.select("o_orderkey", F.col("day").cast("string").alias("day"))


def wm_decimal(spark, sf_dir):
    views(spark, sf_dir, "orders")
    orders = read_query(spark, TYPED_ORDERS, cursor="price", lower="100000.50", lower_inclusive=True)
    return orders.select("o_orderkey", F.col("price").cast("string").alias("price"))


def wm_null_cursor(spark, sf_dir):
    views(spark, sf_dir, "lineitem")
    return read_query(spark, NULL_CURSOR, cursor="line", lower="2")


def query_read(spark, sf_dir):
    views(spark, sf_dir, "customer", "nation")
    return ReadSession(spark).read_query(QUERY_READ + ";\n")


QUERY_READ = """
select c.c_custkey, c.c_acctbal, n.n_name
from customer c join nation n on c.c_nationkey = n.n_nationkey
where c.c_acctbal > 0"""


def query_read_join_agg(spark, sf_dir):
    views(spark, sf_dir, "orders", "customer", "nation")
    return read_query(spark, JOIN_AGG)


def query_read_pushdown(spark, sf_dir):
    views(spark, sf_dir, "orders")
    return ReadSession(spark).read_query(
        CUSTOMER_TOTALS,
        columns=["top", "o_custkey"],
        predicate="orders >= 8",
        cursor="since",
        upper="1996-12-31T00:00:00",
    )


def query_read_reuse(spark, sf_dir):
    views(spark, sf_dir, "orders")
    session = ReadSession(spark)
    counts = session.read_query(CUSTOMER_TOTALS, columns=["o_custkey", "orders"])
    tops = session.read_query(CUSTOMER_TOTALS + "\n", columns=["o_custkey", "top"], predicate="orders > 9")
    return counts.join(tops, "o_custkey")


def read_nested(spark, sf_dir):
    views(spark, sf_dir, "lineitem")
    lines = ReadSession(spark).read_query(NESTED_LINES, columns=["items", "tags", "rec", "l_orderkey"])
    return lines.select(
        "l_orderkey",
        F.col("rec.price").alias("price"),
        F.get("tags", F.lit(1)).alias("second_tag"),
        F.get("items", F.lit(0))["k"].alias("first_k"),
        F.aggregate("items", F.lit(0.0), lambda total, item: total + item["v"]).alias("total_v"),
    )


QUERIES |= {
    f.__name__: f
    for f in (
        wm_date,
        wm_decimal,
        wm_null_cursor,
        query_read,
        query_read_join_agg,
        query_read_pushdown,
        query_read_reuse,
        read_nested,
    )
}
ORACLES |= {
    "wm_date": f"""
        select o_orderkey, day::varchar as day from ({TYPED_ORDERS})
        where day > date '1996-02-28' and day <= date '2000-03-01'""",
    "wm_decimal": f"select o_orderkey, price::varchar as price from ({TYPED_ORDERS}) where price >= 100000.50",
    "wm_null_cursor": f"select * from ({NULL_CURSOR}) where line > 2",
    "query_read": QUERY_READ,
    "query_read_join_agg": JOIN_AGG,
    "query_read_pushdown": f"""
        select top, o_custkey from ({CUSTOMER_TOTALS}) where orders >= 8 and since <= timestamp '1996-12-31'""",
    "query_read_reuse": f"""
        select a.o_custkey, a.orders, b.top from ({CUSTOMER_TOTALS}) a join ({CUSTOMER_TOTALS}) b
        on a.o_custkey = b.o_custkey where b.orders > 9""",
    "read_nested": """
        select l_orderkey, l_extendedprice as price, l_linestatus as second_tag, l_linestatus as first_k,
               0.0::double + l_quantity + l_tax as total_v from lineitem""",
}
