import re

import pytest

from check import compare, connect
from tableflow.llm.common import table
from tableflow.llm.mixing import OP3_SQL, mix_sources, mixed_documents, op3_mixing, source_targets


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_targets(sizes):
    """Reshare what is over a limit, again and again, until no source is above its own."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        share = sum(weight[s] for s in names if s not in capped)
        target = {s: 3 * sizes[s] if s in capped else left * weight[s] / share for s in names}
        over = {s for s in names if s not in capped and target[s] > 3 * sizes[s]}
        if not over:
            return target
        capped |= over


def check(docs):
    rows = docs.select("doc_id", "source", "text").collect()
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + len(words(r.text))
    target = plain_targets(sizes)
    mix = mix_sources(docs)
    got = mix.documents.collect()
    key = lambda r: (str(r[0]), str(r[1]), r[2])
    assert sorted(((r.doc_id, r.source, r.size) for r in got), key=key) == sorted(
        ((r.doc_id, r.source, len(words(r.text))) for r in rows), key=key
    )
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(8 * mix.block_words, 0.01 * target[s])
    slots = mix.schedule.collect()
    assert len({s.slot for s in slots}) == len(slots)
    assert len({(s.sid, s.epoch, s.block) for s in slots}) == len(slots)
    return mix


def test_given_documents(spark, sf_dir):
    check(table(spark, sf_dir, "documents"))


def test_agrees_with_its_sql(spark, sf_dir):
    assert compare(spark, connect(sf_dir), op3_mixing, OP3_SQL, sf_dir) is None


def test_prefixes_of_the_schedule_are_near_the_shares(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    slots = check(docs).schedule.orderBy("slot").select("sid").toPandas()["sid"]
    whole = slots.value_counts(normalize=True)
    for part in (0.1, 0.37, 0.8):
        some = slots[: int(part * len(slots))].value_counts(normalize=True)
        assert (some.reindex(whole.index, fill_value=0) - whole).abs().max() < 0.01


def test_odd_documents(odd_docs):
    check(odd_docs)


def test_empty(no_docs, spark):
    assert mix_sources(no_docs).documents.count() == 0
    assert mixed_documents(no_docs).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [r.taken for r in mix_sources(blank).documents.collect()] == [0, 0]


@pytest.mark.parametrize("sizes", [{"a": 1, "b": 1000, "c": 5}, {"x": 7}, {"a": 100, "b": 100, "c": 100, None: 1}, {"a": 0, "b": 9}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in source_targets(rows).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_mixed_documents(odd_docs):
    plan = {}
    for r in mix_sources(odd_docs).documents.collect():
        plan[r.doc_id, r.size] = plan.get((r.doc_id, r.size), 0) + r.taken
    mixed = mixed_documents(odd_docs)
    assert mixed.columns == odd_docs.columns
    got = {}
    texts = {(r.doc_id, r.text) for r in odd_docs.collect()}
    for r in mixed.collect():
        n = len(words(r.text))
        whole = (r.doc_id, r.text) in texts
        assert whole or any(d == r.doc_id and t and t.startswith(r.text) and len(r.text) == r.n_chars for d, t in texts)
        got[r.doc_id] = got.get(r.doc_id, 0) + n
    want = {}
    for (doc_id, _), n in plan.items():
        want[doc_id] = want.get(doc_id, 0) + n
    assert got == {d: n for d, n in want.items() if n}
