"""Registered NDJSON jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableflow.functions.ndjson import null_element_report, to_ndjson
from tableflow.plans.common import loaded_orders, order_increment, scratch, table, views
from tableflow.sinks.ndjson import load_ndjson, write_ndjson
from tableflow.sinks.write import write_table
from tableflow.sources.ndjson import read_ndjson
from tableflow.sources.queries import read_query
from tableflow.sources.tables import read_table

FLAT = """
select event_id, user_id, nullif(event_type, 'error') as kind, event_type = 'view' as seen,
       cast(ts as date) as day, ts, cast(value as decimal(18,4)) as value, props
from events"""

# The text of the encoding in SQL, once per column.
_FLAT_JSON = """
select to_json({'event_id': event_id, 'user_id': user_id, 'kind': kind, 'seen': seen,
                'day': strftime(day, '%Y-%m-%d'), 'ts': strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'),
                'value': value::varchar, 'props': props})::varchar as value"""

NESTED = """
select l_orderkey, l_linenumber,
       case when l_returnflag <> 'N' then named_struct('flag', l_returnflag, 'price', cast(l_extendedprice as decimal(18,2))) end as rec,
       case when l_linestatus = 'F' then array(l_returnflag, l_linestatus) end as tags,
       map(l_returnflag, cast(l_quantity as int)) as counts,
       array(named_struct('at', l_shipdate, 'd', cast(l_tax as decimal(9,3)))) as items
from lineitem"""

_NESTED_JSON = """
select to_json({'l_orderkey': l_orderkey, 'l_linenumber': l_linenumber,
    'rec': case when l_returnflag <> 'N'
           then {'flag': l_returnflag, 'price': cast(l_extendedprice as decimal(18,2))::varchar} end,
    'tags': case when l_linestatus = 'F' then [l_returnflag, l_linestatus] else [] end,
    'counts': [{'key': l_returnflag, 'value': cast(l_quantity as int)}],
    'items': [{'at': strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%f'), 'd': cast(l_tax as decimal(9,3))::varchar}]
    })::varchar as value
from lineitem"""

HOLED = """
select array(l_returnflag, nullif(l_linestatus, 'O')) as flags,
       named_struct('parts', array(l_partkey, nullif(l_suppkey, 3))) as rec,
       array(named_struct('xs', array(l_quantity, nullif(l_discount, 0)))) as items,
       array(l_orderkey) as whole
from lineitem"""


def ndjson_encode(spark, sf_dir):
    views(spark, sf_dir, "events")
    return to_ndjson(read_query(spark, FLAT), key=["event_id"])


def ndjson_nested(spark, sf_dir):
    views(spark, sf_dir, "lineitem")
    return to_ndjson(read_query(spark, NESTED))


def _written_and_read(spark, df, **options):
    path = f"{scratch(spark)['out']}/rows"
    write_ndjson(df, path, **options)
    return read_ndjson(spark, path, df.schema)


def ndjson_roundtrip(spark, sf_dir):
    views(spark, sf_dir, "lineitem")
    back = _written_and_read(spark, read_query(spark, NESTED))
    return back.select(
        "l_orderkey",
        "l_linenumber",
        F.col("rec.price").cast("string").alias("price"),
        F.size("tags").alias("n_tags"),
        F.get(F.map_keys("counts"), F.lit(0)).alias("flag"),
        F.get(F.map_values("counts"), F.lit(0)).alias("quantity"),
        F.get("items", F.lit(0))["at"].alias("shipped"),
        F.get("items", F.lit(0))["d"].cast("string").alias("tax"),
    )


def ndjson_multi_file(spark, sf_dir):
    """Files of about 256 KiB, whatever the size of the table."""
    return _written_and_read(spark, table(spark, sf_dir, "lineitem"), max_bytes_per_file=256 * 1024)


NUMBERS = """
select l_orderkey * 100 + l_linenumber as id,
       case l_linenumber when 1 then double('NaN') when 2 then double('Infinity') when 3 then double('-Infinity')
            else l_extendedprice / 7 end as wide, cast(l_quantity as float) as narrow
from lineitem"""


def ndjson_values_roundtrip(spark, sf_dir):
    """Doubles, NaN and infinities, floats, bytes and instants, written and read back."""
    views(spark, sf_dir, "lineitem", "documents", "events")
    numbers = _written_and_read(spark, read_query(spark, NUMBERS))
    odd = F.when(F.isnan("wide") | F.col("wide").isin(float("inf"), float("-inf")), F.col("wide").cast("string"))
    texts = _written_and_read(spark, read_query(spark, "select doc_id as id, encode(text, 'UTF-8') as raw from documents"))
    times = _written_and_read(spark, read_query(spark, "select event_id as id, cast(ts as timestamp) as at from events"))
    empty = F.lit(None)
    return (
        numbers.select(
            F.lit("number").alias("kind"), "id", F.when(odd.isNull(), F.col("wide")).alias("wide"),
            F.col("narrow").cast("double").alias("narrow"), odd.alias("text"), empty.cast("long").alias("micros"),
        )
        .union(texts.select(F.lit("bytes"), "id", empty, empty, F.md5("raw"), F.octet_length("raw").cast("long")))
        .union(times.select(F.lit("instant"), "id", empty, empty, empty, F.unix_micros("at")))
    )


def ndjson_load(spark, sf_dir):
    """Files loaded on top of a table that already holds the first load of orders."""
    out = scratch(spark)
    path = f"{out['out']}/rows"
    write_table(loaded_orders(spark, sf_dir), "out.target", datasets=out)
    write_ndjson(order_increment(spark, sf_dir), path)
    load_ndjson(spark, path, "out.target", datasets=out)
    return read_table(spark, "out.target", datasets=out)


def null_elements(spark, sf_dir):
    views(spark, sf_dir, "lineitem")
    return null_element_report(read_query(spark, HOLED))


def null_element_first_rows(spark, sf_dir):
    """The first line item with a NULL element, in order of the key; the other columns settle equal keys."""
    views(spark, sf_dir, "lineitem")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
    rows = read_query(spark, HOLED.replace("select ", f"select {', '.join(order)}, ", 1))
    return null_element_report(rows, order_by=order)


QUERIES = {
    "ndjson_encode": ndjson_encode,
    "ndjson_nested": ndjson_nested,
    "ndjson_roundtrip": ndjson_roundtrip,
    "ndjson_multi_file": ndjson_multi_file,
    "ndjson_values_roundtrip": ndjson_values_roundtrip,
    "ndjson_load": ndjson_load,
    "null_element_report": null_elements,
    "null_element_first_rows": null_element_first_rows,
}

ORACLES = {
    "ndjson_encode": f"{_FLAT_JSON} from ({FLAT})",
    "ndjson_nested": _NESTED_JSON,
    "ndjson_roundtrip": """
        select l_orderkey, l_linenumber,
               case when l_returnflag <> 'N' then cast(l_extendedprice as decimal(18,2))::varchar end as price,
               case when l_linestatus = 'F' then 2 else 0 end as n_tags, l_returnflag as flag,
               cast(l_quantity as int) as quantity, l_shipdate as shipped, cast(l_tax as decimal(9,3))::varchar as tax
        from lineitem""",
    "ndjson_multi_file": "select * from lineitem",
    "ndjson_values_roundtrip": """
        select 'number' as kind, l_orderkey * 100 + l_linenumber as id,
               case when l_linenumber > 3 then l_extendedprice / 7 end as wide,
               cast(cast(l_quantity as float) as double) as narrow,
               case l_linenumber when 1 then 'NaN' when 2 then 'Infinity' when 3 then '-Infinity' end as text,
               null::bigint as micros
        from lineitem
        union all select 'bytes', doc_id, null, null, md5(text), strlen(text) from documents
        union all select 'instant', event_id, null, null, null, epoch_us(ts) from events""",
    "ndjson_load": "select * from orders",
    "null_element_report": """
        select 'flags' as path, count(*) filter (where l_linestatus = 'O') as bad_rows from lineitem
        union all select 'rec.parts', count(*) filter (where l_suppkey = 3) from lineitem
        union all select 'items', 0 from lineitem
        union all select 'items.xs', count(*) filter (where l_discount = 0) from lineitem
        union all select 'whole', 0 from lineitem""",
}
ORACLES["null_element_report"] = f"select path, max(bad_rows) as bad_rows from ({ORACLES['null_element_report']}) group by path"
ORACLES["null_element_first_rows"] = """
    with numbered as (
        select *, row_number() over (order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) as n
        from lineitem)
    select path, coalesce(sum(bad::int), 0)::bigint as bad_rows, min(case when bad then n end) as first_bad_row
    from (select unnest(['flags', 'rec.parts', 'items', 'items.xs', 'whole']) as path,
                 unnest([l_linestatus = 'O', l_suppkey = 3, false, l_discount = 0, false]) as bad, n from numbered)
    group by path"""
