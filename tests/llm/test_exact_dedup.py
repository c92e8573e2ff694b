import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tableflow.llm.exact_dedup import ExactDedup


def text_of(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def plain(rows):
    """Groups of equal texts: the id that stays and the size, by text."""
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text_of(text), []).append(doc_id)
    named = {t: [i for i in ids if i is not None] for t, ids in groups.items()}
    return {t: (min(named[t], default=None), len(ids)) for t, ids in groups.items()}


def check(dedup, rows):
    want = plain(rows)
    got = dedup.documents().collect()
    expected = sorted(
        (str(i), hashlib.sha256(text_of(t).encode()).hexdigest(), str(want[text_of(t)])) for i, t in rows
    )
    assert sorted((str(r.doc_id), r.digest.hex(), str((r.keep_id, r.group_size))) for r in got) == expected
    assert sum(r.kept for r in got) == len(want)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "documents.parquet")


def test_odd_documents(odd_docs, folder):
    odd_docs.repartition(3).write.parquet(folder)
    dedup = ExactDedup(odd_docs.sparkSession, folder)
    dedup.update()
    check(dedup, [(r.doc_id, r.text) for r in odd_docs.collect()])


def test_every_file_a_batch_and_files_added_later(spark, odd_docs, folder):
    odd_docs.repartition(3).write.parquet(folder)
    dedup = ExactDedup(spark, folder, max_files=1)
    dedup.update()
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    more = [(-5, "one"), (-6, "  "), (900, "quite new"), (901, "one  two")]
    spark.createDataFrame(more, "doc_id long, text string").write.mode("append").parquet(folder)
    again = ExactDedup(spark, folder, dedup.checkpoint, max_files=1)
    again.update()
    check(again, rows + more)
    again.update()
    check(again, rows + more)


def test_texts_with_one_digest_are_told_apart(spark, folder):
    rows = [(i, f"text {i % 17}") for i in range(200)] + [(300, None), (301, "")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(folder)
    dedup = ExactDedup(spark, folder, digest=lambda text: F.unhex(F.substring(F.sha2(F.substring(text, 1, 6), 256), 1, 2)))
    dedup.update()
    want = plain(rows)
    got = {r.doc_id: (r.keep_id, r.group_size) for r in dedup.documents().collect()}
    assert got == {i: want[text_of(t)] for i, t in rows}


def test_nothing_but_an_empty_table(spark, no_docs, folder):
    no_docs.write.parquet(folder)
    dedup = ExactDedup(spark, folder)
    dedup.update()
    assert dedup.documents().count() == 0


def test_settings_of_the_session_stay(spark, folder):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.createDataFrame([(1, "a")], "doc_id long, text string").write.parquet(folder)
    ExactDedup(spark, folder).update()
    assert spark.conf.get(key) == before


def test_no_python_in_the_plan(spark, folder):
    spark.createDataFrame([(1, "a"), (2, "a")], "doc_id long, text string").write.parquet(folder)
    dedup = ExactDedup(spark, folder)
    dedup.update()
    plan = dedup.documents()._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
