"""Keyed merge (upsert) as two joins.

Update arm: every target row, left-joined with the deduplicated source. Insert arm:
source rows whose key the target lacks. A full outer join would do both at once, but
Spark cannot split a skewed partition of a full outer join, and one hot target key
would then be one task. A left join it can split (AQE skew join), and the insert arm
only needs the distinct target keys, which are combined before their shuffle.

When the source is small it is broadcast, and no target row is shuffled at all. A write
session measures its staged source for that; here Catalyst's estimate decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.columns import col
from tableflow.errors import Code, TableflowError
from tableflow.operators.dedup import dedup_last
from tableflow.schema.diff import check_write
from tableflow.schema.landing import conform
from tableflow.session import size_shuffles
from tableflow.sizes import broadcast_limit, estimated_bytes, sorted_bytes

_ROW = "_merge_row"
_TARGET, _SOURCE = "_merge_t", "_merge_s"
_JOIN_HINTS = {"auto": None, "broadcast": "broadcast", "shuffle": "merge"}


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    sequence_by: Sequence[str] = (),
    *,
    strategy: str = "auto",
) -> DataFrame:
    """``target`` after merging ``source`` into it, with the target's columns and types.

    The last source row of a key wins by ``sequence_by``. Without one the order is that
    of the partitions read, which is only meaningful for a plain scan. Matched rows take
    every non-key source column, NULLs included; unmatched target rows stay; unmatched
    source rows are inserted. NULL keys match NULL keys.

    ``strategy`` is "auto" (Catalyst picks the joins by its size estimates), "broadcast"
    (for a source whose size has been measured) or "shuffle" (sort-merge joins whatever
    the estimates say).
    """
    if strategy not in _JOIN_HINTS:
        raise TableflowError(Code.BAD_OPTION, f"strategy must be {', '.join(_JOIN_HINTS)}, not {strategy!r}")
    check_keys(keys, source.schema)
    written = [name for name in source.columns if name not in set(sequence_by) - set(target.columns)]
    check_write(target.schema, source.select(*[col(c) for c in written]).schema, "the target")
    if not sequence_by:
        source, sequence_by = source.withColumn(_ROW, F.monotonically_increasing_id()), [_ROW]
    size_shuffles(source.sparkSession, sorted_bytes(target) + sorted_bytes(source))
    join_hint = _JOIN_HINTS[strategy]
    small = strategy == "broadcast" or (
        strategy == "auto" and estimated_bytes(source) <= broadcast_limit(source.sparkSession)
    )

    wanted = T.StructType([f for f in target.schema.fields if f.name in set(written)])
    latest = conform(dedup_last(source, keys, sequence_by).select(*[col(c) for c in written]), wanted)
    values = {name: f"_merge_value{i}" for i, name in enumerate(c for c in latest.columns if c not in set(keys))}
    # Both arms join this one frame, so its shuffle is done once and reused.
    keyed = latest.select(*_match_columns(latest, keys, _SOURCE), *[col(c).alias(v) for c, v in values.items()])
    updated = _update(target, keyed, keys, values, join_hint) if values else target
    inserted = _insert(target, keyed, keys, values, join_hint, small)
    return updated.union(conform(inserted, target.schema))


def in_groups_of(target: DataFrame, source: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows of ``target`` whose values in ``columns`` are together those of some row of ``source``."""
    left = target.select("*", *_match_columns(target, columns, _TARGET))
    typed = conform(source, T.StructType([f for f in target.schema.fields if f.name in set(columns)]))
    right = typed.select(*_match_columns(typed, columns, _SOURCE))
    return left.join(right, _matches(columns, _TARGET, _SOURCE), "left_semi").select(*[col(c) for c in target.columns])


def check_keys(keys: Sequence[str], schema: T.StructType) -> None:
    if not keys:
        raise TableflowError(Code.MERGE_KEY, "a merge needs at least one key")
    types = {field.name: field.dataType for field in schema.fields}
    missing = [k for k in keys if k not in types]
    if missing:
        raise TableflowError(Code.MERGE_KEY, f"merge key not in the write: {', '.join(missing)}")
    nested = [k for k in keys if isinstance(types[k], (T.StructType, T.ArrayType, T.MapType))]
    if nested:
        raise TableflowError(Code.MERGE_KEY, f"merge key must be a flat column: {', '.join(nested)}")


def _update(
    target: DataFrame, keyed: DataFrame, keys: Sequence[str], values: dict[str, str], join_hint: str | None
) -> DataFrame:
    left = target.select("*", *_match_columns(target, keys, _TARGET))
    joined = left.join(_hinted(keyed, join_hint), _matches(keys, _TARGET, _SOURCE), "left")
    # The mark of a match is a source column that is never NULL, not a value, which may be.
    matched = F.col(f"{_SOURCE}_null0").isNotNull()
    return joined.select(
        *[
            F.when(matched, F.col(values[c])).otherwise(col(c)).alias(c) if c in values else col(c)
            for c in target.columns
        ]
    )


def _insert(
    target: DataFrame, keyed: DataFrame, keys: Sequence[str], values: dict[str, str], join_hint: str | None, small: bool
) -> DataFrame:
    present = target.select(*_match_columns(target, keys, _TARGET))
    if small:
        # Only target keys the source has matter: at most one per source row.
        wanted = keyed.select([c for c in keyed.columns if c not in values.values()])
        present = present.join(_hinted(wanted, join_hint), _matches(keys, _TARGET, _SOURCE), "left_semi")
    present = present.distinct()
    if join_hint == "merge":
        present = present.hint(join_hint)
    unmatched = keyed.join(present, _matches(keys, _TARGET, _SOURCE), "left_anti")
    return unmatched.select(
        *[F.when(~F.col(f"{_SOURCE}_null{i}"), F.col(f"{_SOURCE}_key{i}")).alias(key) for i, key in enumerate(keys)],
        *[F.col(v).alias(c) for c, v in values.items()],
    )


def _hinted(df: DataFrame, join_hint: str | None) -> DataFrame:
    return df if join_hint is None else df.hint(join_hint)


def _match_columns(df: DataFrame, keys: Sequence[str], prefix: str) -> list[Column]:
    """Two columns per key, never NULL, so that plain equality matches NULL with NULL.

    They stand for ``<=>``. As real columns they let the distinct keys of the insert arm
    keep the partitioning their join needs.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for i, key in enumerate(keys):
        columns.append(F.coalesce(col(key), _filler(types[key])).alias(f"{prefix}_key{i}"))
        columns.append(col(key).isNull().alias(f"{prefix}_null{i}"))
    return columns


def _matches(keys: Sequence[str], left: str, right: str) -> Column:
    condition = F.lit(True)
    for i in range(len(keys)):
        condition &= F.col(f"{left}_key{i}") == F.col(f"{right}_key{i}")
        condition &= F.col(f"{left}_null{i}") == F.col(f"{right}_null{i}")
    return condition


def _filler(data_type: T.DataType) -> Column:
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01").cast(data_type)
    if isinstance(data_type, T.NumericType):
        return F.lit(0).cast(data_type)
    if isinstance(data_type, T.BooleanType):
        return F.lit(False)
    return F.lit("").cast(data_type)
