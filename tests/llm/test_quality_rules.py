import re

from check import compare, connect
from tableflow.llm.common import table
from tableflow.llm.quality_rules import COUNTS, OP1_SQL, Rule, kept_documents, op1_quality_rules, quality_rules


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def check(docs):
    want = []
    for r in docs.select("doc_id", "text").collect():
        counts = plain_counts(r.text)
        want.append((r.doc_id, *counts, counts[0] < 50 or 100 * counts[4] > 50 * counts[0]))
    got = quality_rules(docs)
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r) for r in got.select("doc_id", *COUNTS, "base_failed").collect()), key=key) == sorted(want, key=key)
    assert got.where("base_failed and kept").count() == 0


def test_given_documents(spark, sf_dir):
    check(table(spark, sf_dir, "documents"))
    assert compare(spark, connect(sf_dir), op1_quality_rules, OP1_SQL, sf_dir) is None


def test_odd_documents(odd_docs):
    check(odd_docs)


def test_kept_documents_keep_their_columns(odd_docs):
    kept = kept_documents(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.exceptAll(odd_docs).count() == 0
    assert kept.count() == quality_rules(odd_docs).where("kept").count()


def test_empty(no_docs):
    assert kept_documents(no_docs).count() == 0
    assert quality_rules(no_docs).count() == 0


def test_junk_goes_and_prose_stays(spark):
    sf_dir = "/root/testdata/sf0.01"
    judged = quality_rules(table(spark, sf_dir, "documents")).join(table(spark, sf_dir, "labels"), "doc_id")
    assert judged.where("quality = 0 and kept").count() == 0
    assert judged.where("quality = 1 and not base_failed and not kept").count() == 0


def test_rules_are_a_table(spark):
    docs = spark.createDataFrame([(1, "word " * 60 + "end " * 2)], "doc_id long, text string")
    failed = quality_rules(docs, (Rule("few stop words", "stop_ratio", 0.9), Rule("short words", "mean_word_chars", None, 5))).first()
    assert failed.failed_rules == ["few stop words"] and not failed.kept


def test_no_python_in_the_plan(spark, sf_dir):
    plan = quality_rules(table(spark, sf_dir, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange|Join", plan)
