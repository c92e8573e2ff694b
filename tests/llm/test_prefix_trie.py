import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tableflow.llm.prefix_trie import DoubleArray, keyed_turns, pack, prefix_trie, share_heads


def rebuilt(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in convs.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        # The remainder has the sign of the id.
        out[c] = turns.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:]
    return out


def plain(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def below(node):
        stack = [node]
        while stack:
            x = stack.pop()
            stack.extend(children[x])
            yield x

    out = []
    for node, ids in members.items():
        tree = list(below(node))
        ends = sorted(c for c in ids if len(convs[c]) == len(node))
        out.append((
            min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(children[node]),
            sum(not children[x] for x in tree),
            sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in tree if x),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


SCHEMA = "conv_id long, turn long, role string, text string"


def conversations(n):
    random.seed(n)
    rows = []
    for c in range(n):
        same = c % 3 == 0
        for turn in range(3 if same else random.randrange(1, 14)):
            text = f"hot {turn}" if same or random.random() < 0.6 else f"é{random.randrange(4)}"
            rows.append((c, turn, "user" if turn % 2 == 0 else "assistant", text))
    return rows


ODD = [
    (7, 3, "user", "c"), (7, None, None, None), (7, 3, "user", "c"), (7, 3, "assistant", "c"), (7, 1, "user", "x" * 50_000),
    (None, 0, "user", "nobody's"), (-7, 0, "user", "a"), (-7, 1, "user", "b"), (-5, 0, "user", "z"), (9, 0, "", "1:"), (10, 0, "1", ":"),
    *[(12, k, "user", "again") for k in range(300)], *[(13, k, "user", "again") for k in range(290)],
]


@pytest.mark.parametrize("shard_turns", [1, 30, 200_000])
@pytest.mark.parametrize("rows", [conversations(90), ODD], ids=["many", "odd"])
def test_rebuilt_conversations(spark, rows, shard_turns):
    table = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", path string").repartition(3)
    got = prefix_trie(*share_heads(keyed_turns(table)), shard_turns=shard_turns).collect()
    c = rebuilt([(r[0], r[1], r[2], r[3]) for r in rows])
    assert sorted((tuple(r) for r in got), key=str) == plain(c)


def test_conversations_as_they_are_and_silent_ones(spark):
    rows = conversations(40)
    turns = keyed_turns(spark.createDataFrame(rows, SCHEMA))
    members = spark.range(0, 45).withColumnRenamed("id", "conv_id")
    convs = {c: [(r, t) for x, _, r, t in rows if x == c] for c in range(45)}
    got = prefix_trie(turns, members, shard_turns=50).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(convs)


def test_nothing(spark):
    assert prefix_trie(*share_heads(keyed_turns(spark.createDataFrame([], SCHEMA)))).collect() == []


def test_double_array_holds_its_paths_and_no_others():
    rng = np.random.default_rng(1)
    paths = [rng.integers(0, 50, rng.integers(0, 8)) for _ in range(3000)]
    trie = pack(paths)
    known = {tuple(p[:d].tolist()) for p in paths for d in range(len(p) + 1)}
    assert (trie.check >= 0).sum() == len(known)
    assert trie._end < 2 * len(known)

    def find(path):
        slot = np.zeros(1, np.int64)
        for code in path:
            slot = trie.step(slot, np.array([code]))
            if slot[0] < 0:
                return False
        return True

    assert all(find(p) for p in known)
    for _ in range(2000):
        other = tuple(rng.integers(0, 60, 4).tolist())
        assert find(other) == (other in known)


def test_children_behind_all_slots_when_none_fit():
    trie = DoubleArray()
    trie.add_children(0, np.arange(200))
    for slot in range(1, 100):
        trie.add_children(slot, np.array([0, 1, 5, 300]))
    assert all((trie.step(np.full(4, s), np.array([0, 1, 5, 300])) > 0).all() for s in range(1, 100))
