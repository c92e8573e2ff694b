"""The prefix trie of conversations: double arrays for shards of prefixes, upper nodes that shards share merged globally."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableflow.llm.common import drop_staged, partitions_for, staged, table

#: Turns of different paths in a shard, about; what shares a longer prefix than the shard's is split by longer prefixes.
SHARD_TURNS = 200_000
#: Conversations of so many neighbouring ids begin with the turns of the first of them, up to one less than ``HEADS``.
FAMILY = 5
HEADS = 9
#: Ids of conversations hashed as one block.
BLOCK_IDS = 1 << 16

#: The name of the root; a node's name is the hash of its parent's name and the key of its last turn.
ROOT = bytes(32)
# Free slots tried for the children of a node before they go behind all slots.
_TRIES = 64


def keyed_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, key, bytes``: turns in order, null first, ties by role and text; ``key`` stands for role and text.

    Null roles and texts are empty, repeated rows are repeated turns, and rows without ``conv_id`` belong to no
    conversation and are left out.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id is not null").select("conv_id", "turn", role.alias("role"), text.alias("text"))
    turn = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    keyed = rows.select("conv_id", "turn", "role", "text", F.unhex(F.sha2(turn, 256)).alias("key"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return keyed.select(
        "conv_id", (F.row_number().over(order) - 1).cast("long").alias("pos"), "key",
        F.octet_length("text").cast("long").alias("bytes"),
    )


def share_heads(turns: DataFrame, family: int = FAMILY, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns and the ids of all conversations: each begins with the first turns of its family's first one.

    Conversation ``c`` takes the first ``h = crc32(c) % heads`` turns of ``c - c % family``, as many as there are, and
    then its own turns after its first ``h``. Remainders have the sign of the id, as in SQL.
    """
    given = staged(turns, "trie_given")
    members = given.select("conv_id").distinct()
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    first = given.where((F.col("conv_id") % family == 0) & (F.col("pos") < heads - 1)).withColumnRenamed("conv_id", "first")
    head = members.withColumn("first", F.col("conv_id") - F.col("conv_id") % family).join(first, "first").where(F.col("pos") < taken)
    tail = given.where(F.col("pos") >= taken)
    return head.select("conv_id", "pos", "key", "bytes").unionByName(tail), members


_PATHS = "conv_id long, n_turns long, path binary, marks array<binary>"


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each conversation's turns in order the name of its last node, and of those at depths 2, 4, 8 and so on."""
    conv, name, n, marks = None, ROOT, 0, []

    def out(rows):
        columns = list(zip(*rows)) or [()] * 4
        types = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.binary()))
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=["conv_id", "n_turns", "path", "marks"])

    for batch in batches:
        done = []
        for conv_id, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if conv_id != conv:
                if n:
                    done.append((conv, n, name, marks))
                conv, name, n, marks = conv_id, ROOT, 0, []
            name = hashlib.sha256(name + key).digest()
            n += 1
            if n > 1 and n & (n - 1) == 0:
                marks.append(name)
        yield out(done)
    if n:
        yield out([(conv, n, name, marks)])


class DoubleArray:
    """A trie over dense codes in two arrays: the child by ``code`` of the node in slot ``s`` is in slot
    ``base[s] + code``, if ``check`` there is ``s``. Slot 0 is the root.
    """

    def __init__(self) -> None:
        self.base = np.zeros(1024, np.int64)
        self.check = np.full(1024, -1, np.int64)
        self.check[0] = 0
        self._free, self._end = 1, 1

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def add_children(self, parent: int, codes: np.ndarray) -> None:
        """Pack the children of a node: ``codes`` ascend and are all it will have."""
        spread = codes - codes[0]
        self._grow(self._end + int(spread[-1]) + 2)
        while self.check[self._free] >= 0:
            self._free += 1
        at = self._free
        for _ in range(_TRIES):
            self._grow(at + int(spread[-1]) + 2)
            if (self.check[at + spread] < 0).all():
                break
            at += 1
            while self.check[at] >= 0:
                at += 1
                self._grow(at + 2)
        else:
            at = self._end
            self._grow(at + int(spread[-1]) + 2)
        self.check[at + spread] = parent
        self.base[parent] = at - codes[0]
        self._end = max(self._end, at + int(spread[-1]) + 1)

    def step(self, slots: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The children by code of nodes; -1 where there is none."""
        to = self.base[slots] + codes
        inside = (to > 0) & (to < len(self.check))
        to = np.where(inside, to, 0)
        return np.where(inside & (self.check[to] == slots), to, -1)


def pack(paths: list[np.ndarray]) -> DoubleArray:
    """The double array of some paths of codes."""
    trie = DoubleArray()
    slots, sizes = np.zeros(len(paths), np.int64), np.array([len(p) for p in paths])
    depth = 0
    while (live := np.flatnonzero(sizes > depth)).size:
        codes = np.array([paths[i][depth] for i in live], np.int64)
        pairs = np.unique(np.stack([slots[live], codes], axis=1), axis=0)
        first = np.flatnonzero(np.r_[True, pairs[1:, 0] != pairs[:-1, 0]])
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(pairs)]):
            trie.add_children(int(pairs[a, 0]), pairs[a:b, 1])
        slots[live] = trie.step(slots[live], codes)
        depth += 1
    return trie


_NODES = (
    "upper boolean, node binary, parent binary, parent_conv_id long, above array<binary>, conv_id long, depth long, "
    "n_convs long, n_children long, n_leaves long, saved long, bytes long"
)


def _shard(rows: pa.Table) -> pa.Table:
    """The nodes of a shard: whole ones of subtrees that are in no other shard, and its part of the nodes above."""
    rows = rows.combine_chunks()
    conv, pos = rows["rep"].to_numpy(), rows["pos"].to_numpy()
    order = np.lexsort((pos, conv))
    conv = conv[order]
    starts = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
    sizes = np.diff(np.r_[starts, len(conv)])
    weight, cut = rows["n_convs"].to_numpy()[order][starts], rows["cut"].to_numpy()[order][starts]
    size_of = rows["bytes"].to_numpy()[order]
    keys = rows["key"].combine_chunks() if isinstance(rows["key"], pa.ChunkedArray) else rows["key"]
    # Dense ids of the shard's turns, by depth first, so that children of a node have near ones.
    depth_of = np.arange(len(conv)) - np.repeat(starts, sizes)
    by_depth = np.argsort(depth_of, kind="stable")
    coded = keys.take(pa.array(order[by_depth])).dictionary_encode()
    code = np.empty(len(conv), np.int64)
    code[by_depth] = coded.indices.to_numpy()
    spelled = coded.dictionary.to_pylist()
    trie = pack(np.split(code, starts[1:]))

    n = len(trie.check)
    members, smallest = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max)
    last, children, leaves, saved = (np.zeros(n, np.int64) for _ in range(4))
    upper = np.zeros(n, bool)
    upper[0] = True
    members[0], smallest[0] = weight.sum(), conv.min()
    name, levels = {0: ROOT}, [np.zeros(1, np.int64)]
    slots, depth = np.zeros(len(starts), np.int64), 0
    while (live := np.flatnonzero(sizes > depth)).size:
        at = starts[live] + depth
        slots[live] = trie.step(slots[live], code[at])
        here, seen = np.unique(slots[live], return_index=True)
        np.add.at(members, slots[live], weight[live])
        np.minimum.at(smallest, slots[live], conv[at])
        last[here] = size_of[at[seen]]
        upper[here] = depth + 1 < cut[live[seen]]
        parents = trie.check[here]
        np.add.at(children, parents, 1)
        for slot, parent, c in zip(here.tolist(), parents.tolist(), code[at[seen]].tolist()):
            name[slot] = hashlib.sha256(name[parent] + spelled[c]).digest()
        levels.append(here)
        depth += 1
    for here in reversed(levels[1:]):
        own = here[~upper[here]]
        leaves[own] += children[own] == 0
        saved[own] += (members[own] - 1) * last[own]
        np.add.at(leaves, trie.check[here], leaves[here])
        np.add.at(saved, trie.check[here], saved[here])

    slot = np.concatenate(levels)
    parent = trie.check[slot]
    level = np.repeat(np.arange(len(levels)), [len(x) for x in levels])
    up = upper[slot]
    above: list[list[bytes] | None] = []
    trail: dict[int, list[bytes]] = {}
    for s, p, is_upper in zip(slot.tolist(), parent.tolist(), up.tolist()):
        if is_upper:
            trail[s] = [] if s == 0 else [*trail[p], name[p]]
        above.append(trail[s] if is_upper else None)
    names = [name[s] for s in slot.tolist()]
    parents = [None if s == 0 else name[p] for s, p in zip(slot.tolist(), parent.tolist())]
    columns = {
        "upper": pa.array(up),
        "node": pa.array(names, pa.binary()),
        "parent": pa.array(parents, pa.binary()),
        "parent_conv_id": pa.array(smallest[parent], mask=upper[parent]),
        "above": pa.array(above, pa.list_(pa.binary())),
        "conv_id": pa.array(smallest[slot]),
        "depth": pa.array(level, pa.int64()),
        "n_convs": pa.array(members[slot]),
        "n_children": pa.array(children[slot]),
        "n_leaves": pa.array(leaves[slot]),
        "saved": pa.array(saved[slot]),
        "bytes": pa.array(last[slot]),
    }
    return pa.table(columns)


def _id_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    path, held = None, []

    def block():
        return pa.record_batch(
            [pa.array([path], pa.binary()), pa.array([held[0]], pa.int64()), pa.array([",".join(map(str, held))])],
            names=["path", "first", "ids"],
        )

    for batch in batches:
        for p, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if held and (p != path or len(held) == BLOCK_IDS):
                yield block()
                held = []
            path = p
            held.append(conv_id)
    if held:
        yield block()


def _hash_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    path, running = None, None

    def out(rows):
        columns = list(zip(*rows)) or [()] * 2
        return pa.record_batch([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.string())], names=["node", "ends_sha256"])

    for batch in batches:
        done = []
        for p, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if p != path:
                if running:
                    done.append((path, running.hexdigest()))
                path, running = p, hashlib.sha256()
            else:
                running.update(b",")
            running.update(ids.encode())
        yield out(done)
    if running:
        yield out([(path, running.hexdigest())])


def _ends(members: DataFrame) -> DataFrame:
    """``node, ends_sha256``: ids are sorted and joined in ranges, and the blocks of a node hashed one after the other."""
    n = partitions_for(members.sparkSession)
    ids = members.select("path", "conv_id").repartitionByRange(n, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    blocks = ids.mapInArrow(_id_blocks, "path binary, first long, ids string")
    return blocks.repartition(n, "path").sortWithinPartitions("path", "first").mapInArrow(_hash_blocks, "node binary, ends_sha256 string")


def _cut(paths: DataFrame, shard_turns: int) -> DataFrame:
    """``paths`` with ``part``, the prefix that decides the shard, and ``cut``, its depth: doubled where a part is too large."""
    now = paths.withColumn("round", F.lit(0))
    while True:
        part = F.coalesce(F.get("marks", F.col("round")), F.col("path"))
        now = staged(now.withColumn("part", part), "trie_paths")
        sizes = now.groupBy("part").agg(F.sum("n_turns").alias("n"), F.count(F.lit(1)).alias("paths"))
        large = sizes.where((F.col("n") > shard_turns) & (F.col("paths") > 1)).select("part", F.lit(1).alias("more"))
        if large.isEmpty():
            return now.withColumn("cut", F.expr("shiftleft(2L, round)"))
        now = now.join(large, "part", "left").withColumn("round", F.col("round") + F.coalesce("more", F.lit(0))).drop("more", "part")


def prefix_trie(turns: DataFrame, members: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Every node of the trie: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``turns`` are ``conv_id, pos, key, bytes`` as ``keyed_turns`` gives them, ``members`` the ids of all conversations,
    also those without turns. Conversations with the same turns are one path with a count before anything is dealt, so
    no shard holds a group of copies. A shard holds all paths with some prefixes; its nodes from the prefix's end on
    are whole. The nodes above, the root and one level unless a prefix was too large, are summed over the shards.
    No conversations give no nodes.
    """
    spark = turns.sparkSession
    turns = staged(turns, "trie_turns")
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "pos").select("conv_id", "key")
    named = ordered.mapInArrow(_paths, _PATHS)
    members = staged(
        members.join(named, "conv_id", "left").select(
            "conv_id", F.coalesce("n_turns", F.lit(0)).alias("n_turns"), F.coalesce("path", F.lit(ROOT)).alias("path"), "marks"
        ),
        "trie_members",
    )
    same = members.where("n_turns > 0").groupBy("path", "n_turns").agg(
        F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("n_convs"), F.first("marks").alias("marks")
    )
    paths = _cut(same, shard_turns)
    total = members.agg(F.sum("n_turns"), F.min("conv_id")).first()
    n_shards = max(partitions_for(spark), -(-(total[0] or 0) // shard_turns))
    dealt = paths.select("rep", "n_convs", "cut", F.pmod(F.xxhash64("part"), F.lit(n_shards)).alias("shard"))
    rows = turns.join(dealt, turns.conv_id == dealt.rep).select("shard", "rep", "pos", "key", "bytes", "n_convs", "cut")
    nodes = staged(rows.groupBy("shard").applyInArrow(_shard, _NODES), "trie_nodes")
    drop_staged(turns)

    silent = members.where("n_turns = 0").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    partial = nodes.where("upper").select("node", "parent", "above", "conv_id", "depth", "n_convs", "n_leaves", "saved", "bytes")
    silent = silent.where("n_convs > 0").select(
        F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"), F.array().cast("array<binary>").alias("above"),
        "conv_id", F.lit(0).cast("long").alias("depth"), "n_convs", *[F.lit(0).cast("long").alias(c) for c in ("n_leaves", "saved", "bytes")],
    )
    merged = partial.unionByName(silent).groupBy("node").agg(
        *[F.first(c).alias(c) for c in ("parent", "above", "depth", "bytes")],
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_leaves", "saved")],
    )
    whole = nodes.where("not upper")
    merged = staged(merged, "trie_upper")
    found = merged.where("parent is not null").select("parent").unionAll(whole.where("parent_conv_id is null").select("parent"))
    children = found.groupBy("parent").agg(F.count(F.lit(1)).alias("n_children")).withColumnRenamed("parent", "node")
    merged = merged.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    own = merged.select(
        F.explode(F.array_append("above", F.col("node"))).alias("node"),
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
    )
    sums = own.unionByName(merged.select("node", "n_leaves", "saved")).groupBy("node").agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved")
    )
    columns = ["node", "parent", "parent_conv_id", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved"]
    upper = merged.drop("n_leaves", "saved").join(sums, "node").withColumn("parent_conv_id", F.lit(None).cast("long"))
    both = whole.select(columns).unionByName(upper.select(columns))
    # Parents above a shard are found by name, but for the root, which would be the parent of very many.
    known = both.where("parent_conv_id is not null or depth <= 1").withColumn(
        "parent_conv_id", F.when(F.col("depth") == 1, F.lit(total[1]).cast("long")).otherwise(F.col("parent_conv_id"))
    )
    of = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("found"))
    asked = both.where("parent_conv_id is null and depth > 1").join(of, "parent").withColumn("parent_conv_id", F.col("found"))
    nothing = hashlib.sha256().hexdigest()
    return known.select(columns).unionByName(asked.select(columns)).join(_ends(members), "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*share_heads(keyed_turns(table(spark, sf_dir, "conversations"))))


# The CRC-32 of the decimal id goes bit by bit, as the dialect has no function for it.
OP11_SQL = """
with t as (
  select conv_id as c, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as k,
         strlen(coalesce(text, '')) as bytes,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as pos
  from conversations where conv_id is not null),
conv as (
  select c, xor(4294967295, list_reduce(
             list_transform(range(0, 8 * strlen(c::varchar)), lambda i: ((ascii(substr(c::varchar, (i // 8 + 1)::bigint, 1)) >> (i % 8)::int) & 1)::bigint),
             lambda a, b: case when xor(a & 1, b) = 1 then xor(a >> 1, 3988292384) else a >> 1 end, 4294967295)) % 9 as h
  from (select distinct c from t)),
rebuilt as (
  select conv.c, pos, k, bytes from conv join t on t.c = conv.c - conv.c % 5 and pos < h
  union all select conv.c, pos, k, bytes from conv join t on t.c = conv.c and pos >= h),
p as (
  select c, bytes, string_agg(k, '') over up_to as node, count(*) over up_to as depth, count(*) over (partition by c) as n
  from rebuilt window up_to as (partition by c order by pos rows unbounded preceding)),
m as (select c, bytes, node, depth, n from p
      union all select conv.c, 0, '', 0, coalesce(n, 0) from conv left join (select distinct c, n from p) using (c)),
nodes as (
  select node, depth, min(c) as conv_id, count(*) as n_convs, (count(*) - 1) * min(bytes) as saved,
         sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (n = depth), '')) as ends_sha256
  from m group by node, depth),
kids as (select left(node, 64 * (depth - 1)::bigint) as node, count(*) as n_children from nodes where depth > 0 group by 1),
full_nodes as (select nodes.*, coalesce(n_children, 0) as n_children from nodes left join kids using (node)),
sums as (
  select a.node, count(*) filter (b.n_children = 0) as n_leaves, sum(b.saved)::bigint as saved_tokens
  from full_nodes a join full_nodes b on starts_with(b.node, a.node) group by a.node)
select x.conv_id, x.depth, up.conv_id as parent_conv_id, x.n_convs, x.n_children, n_leaves, saved_tokens, x.ends_sha256
from full_nodes x join sums using (node)
left join nodes up on x.depth > 0 and up.node = left(x.node, 64 * (x.depth - 1)::bigint)
"""
