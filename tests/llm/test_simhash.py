import re

import pytest
import xxhash

from tableflow.llm.common import table
from tableflow.llm.components import _state, components
from tableflow.llm.simhash import BLOCK, first_of_each, near_duplicates, op7_simhash, simhash_links
from tableflow.session import configure


def plain_print(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints):
    """{node: smallest node reachable} over distinct prints."""
    nodes = sorted(set(prints))
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def check(docs):
    rows = docs.select("doc_id", "text").collect()
    prints = [plain_print(r.text) for r in rows]
    group = plain_groups(prints)
    first = {}
    for row, fp in zip(rows, prints):
        if row.doc_id is not None:
            first[group[fp]] = min(first.get(group[fp], row.doc_id), row.doc_id)
    want = sorted((str(r.doc_id), f"{fp:016x}", first.get(group[fp])) for r, fp in zip(rows, prints))
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in near_duplicates(docs).collect())
    assert got == want


def test_given_documents(spark, sf_dir):
    check(table(spark, sf_dir, "documents"))
    assert op7_simhash(spark, sf_dir).columns == ["doc_id", "fingerprint", "component_id"]


def test_odd_documents(odd_docs):
    check(odd_docs)
    kept = first_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    group = plain_groups([plain_print(r.text) for r in odd_docs.collect()])
    groups = [group[plain_print(r.text)] for r in kept.collect()]
    assert sorted(groups) == sorted(set(group.values()))
    assert {(r.doc_id, r.text) for r in kept.collect()} <= {(r.doc_id, r.text) for r in odd_docs.collect()}


def test_empty(no_docs):
    assert near_duplicates(no_docs).count() == 0
    assert first_of_each(no_docs).count() == 0


@pytest.mark.parametrize("base", [0, 0x0123456789ABCDEF])
def test_dense_group_over_many_blocks(spark, base):
    """A ball of near fingerprints larger than a block: one component, and no more links than a few a member."""
    ball = {base} | {base ^ (1 << i) for i in range(63)} | {base ^ (1 << i) ^ (1 << j) for i in range(63) for j in range(i)}
    assert len(ball) > BLOCK
    far = base ^ 0x7F7F7F7F7F7F7F7F
    rows = [(x - (1 << 64) if x >> 63 else x,) for x in [*ball, far]]
    links = simhash_links(spark.createDataFrame(rows, "fp long"))
    assert links.count() < 40 * len(ball)
    found = components(links)
    assert found.count() == len(ball)
    assert found.select("root").distinct().count() == 1


def test_long_chain(spark):
    links = spark.range(150).selectExpr("id as a", "id + 1 as b")
    assert {r.root for r in components(links).collect()} == {0}
    assert components(links).count() == 151


def test_state_of_many_links_does_not_overflow(spark):
    """More links than 2^24, whose 40-bit hashes no longer sum up to a long."""
    configure(spark)
    links = spark.range(1 << 25).selectExpr("id as a", "id + 1 as b")
    count, total = _state(links).first()
    assert count == 1 << 25
    assert (count, total) != tuple(_state(links.where("a > 0")).first())
