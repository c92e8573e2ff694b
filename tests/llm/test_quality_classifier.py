import tracemalloc
import zlib

import numpy as np
import pytest

from tableflow.llm.common import table
from tableflow.llm.quality_classifier import THRESHOLD, calibration, classify, fit_space, good_documents, op6_quality_classifier, term_counts, train


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = op6_quality_classifier(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id").toPandas()
    assert (rows.held_out == [zlib.crc32(str(d).encode()) % 5 == 0 for d in rows.doc_id]).all()
    assert rows.score.between(0, 1).all()
    assert (rows.predicted == (rows.score >= THRESHOLD)).all()
    held = rows[rows.held_out]
    assert (held.predicted == held.quality).mean() > 0.97


def test_votes_by_definition():
    import pyarrow as pa

    rng = np.random.default_rng(3)
    words = ["alpha beta", "gamma delta", "$$$ ###", "%%% &&&"]
    texts = [" ".join(rng.choice(words[2 * (i % 2) : 2 * (i % 2) + 2], 30)) for i in range(200)] + ["", "x"]
    counts = term_counts(pa.array(texts))
    space = fit_space(counts[:100], np.arange(100) % 2 == 0)
    got = space.vote(space.project(counts))
    for i, vector in enumerate(space.project(counts)):
        cosine = space.vectors @ vector
        near = np.argsort(-cosine, kind="stable")[:32]
        weight = np.maximum(cosine[near], 0) ** 4
        want = (weight * space.labels[near]).sum() / weight.sum() if weight.sum() > 1e-12 else 0
        assert got[i] == pytest.approx(want, abs=0.08)
    assert (got[:200:2] > 0.9).all() and (got[1:200:2] < 0.1).all()
    assert got[200] == 0 and space.score(counts)[200] < THRESHOLD
    # Without itself, what votes for a labelled document are its nearest others.
    others = space.vote(space.vectors, own=0)
    for i, vector in enumerate(space.vectors):
        cosine = space.vectors @ vector
        cosine[i] = -2
        near = np.argsort(-cosine, kind="stable")[:32]
        weight = np.maximum(cosine[near], 0) ** 4
        assert others[i] == pytest.approx((weight * space.labels[near]).sum() / weight.sum(), abs=0.08)


def test_scores_are_chances_and_keep_the_order_of_votes():
    rng = np.random.default_rng(2)
    votes = rng.random(3000)
    labels = (rng.random(3000) < 0.6 + 0.4 * votes).astype(float)
    at, chance = calibration(votes, labels)
    assert (np.diff(at) > 0).all() and (np.diff(chance) > 0).all()
    # Were both labels equally frequent, so many of the documents with such a vote would have label 1.
    weight = np.where(labels == 1, 0.5 / labels.sum(), 0.5 / (labels == 0).sum())
    got = np.interp(votes, at, chance)
    for low in np.arange(0, 1, 0.2):
        part = (got >= low) & (got < low + 0.2)
        if part.sum() > 100:
            assert np.average(got[part], weights=weight[part]) == pytest.approx(np.average(labels[part], weights=weight[part]), abs=0.05)
    assert [x.tolist() for x in calibration(votes, np.ones(3000))] == [[0, 1], [0, 1]]


def test_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)] + [(1, 0, 0), (4, None, 1), (None, 1, 1), (99, 1, 0)], "doc_id long, quality int, toxic int")
    got = classify(odd_docs, labels).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert classify(no_docs, labels).count() == 0
    assert {r.score for r in classify(odd_docs, labels.limit(0)).collect()} == {0.5}
    kept = good_documents(odd_docs, labels)
    assert kept.columns == odd_docs.columns
    assert kept.exceptAll(odd_docs).count() == 0


def test_the_driver_gets_the_sample_packed(spark, monkeypatch):
    """What is sent is a fraction of the counts, and the space is that of the counts as they are."""
    import pyarrow as pa

    rng = np.random.default_rng(5)
    words = "the of and a river stone light over under cloud falls moves quiet bright house tree".split()
    rows = [(7919 * i % 1000 + 1, " ".join(rng.choice(words, 120 + i))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    labels = spark.createDataFrame([(i, i % 2, 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    sent, frame = [], type(docs)
    real = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: sent.extend(got := real(self)) or got)
    space = train(docs, labels)
    learned = sorted(x for x in rows if zlib.crc32(str(x[0]).encode()) % 5)
    counts = term_counts(pa.array([text for _, text in learned]))
    assert len(sent) == len(learned) == len(space.labels)
    assert 0 < sum(len(r.counts) for r in sent) < counts.nbytes / 4
    want = fit_space(counts, np.array([i % 2 for i, _ in learned]))
    for name in ("weights", "projection", "vectors", "labels", "votes", "scores"):
        assert np.array_equal(getattr(space, name), getattr(want, name)), name


def test_fitting_takes_little_memory_beside_the_counts():
    import pyarrow as pa

    counts = np.random.default_rng(6).poisson(0.3, (3000, term_counts(pa.array([""])).shape[1])).astype(np.float32)
    tracemalloc.start()
    try:
        fit_space(counts, np.arange(len(counts)) % 2)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 2 * counts.nbytes
