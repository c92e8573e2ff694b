import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tableflow.llm.common import table
from tableflow.llm.packing import best_fit, op8_best_fit_packing, pack, pack_documents

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_best_fit(lengths, capacity):
    """Sequences that best-fit decreasing opens, one piece at a time."""
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


def check_places(rows, capacity):
    """Every sequence is filled from 0 without gaps or overlaps."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def check(docs):
    tokenizer = Tokenizer.from_file(PATH)
    want = []
    for r in docs.collect():
        ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
        for k in range(0, len(ids), 4096):
            part = ids[k : k + 4096]
            want.append((r.doc_id, k // 4096, k, len(part), zlib.crc32(part)))
    rows = pack_documents(docs, PATH).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r)[:5] for r in rows), key=key) == sorted(want, key=key)
    assert check_places(rows, 4096) == plain_best_fit([r.length for r in rows], 4096)


def test_given_documents(spark, sf_dir):
    check(table(spark, sf_dir, "documents"))
    assert "sequence_id" in op8_best_fit_packing(spark, sf_dir).columns


def test_odd_documents(odd_docs):
    check(odd_docs)


def test_empty(no_docs):
    assert pack_documents(no_docs, PATH).count() == 0


@given(st.lists(st.integers(1, 50), max_size=300))
@settings(max_examples=200, deadline=None)
def test_classes_pack_like_single_pieces(lengths):
    counts = {n: lengths.count(n) for n in set(lengths)}
    placed = best_fit(counts, 50)
    sequences = {}
    ends = dict(counts)
    for length, rank, first, offset in placed[::-1].tolist():
        for k in range(ends[length] - rank):
            sequences.setdefault(first + k, []).append((offset, length))
        ends[length] = rank
    assert not any(ends.values())
    assert len(sequences) == plain_best_fit(lengths, 50)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 50


def test_a_length_that_most_pieces_share(spark):
    rows = [(i, 0, 0, 3 if i % 3 else 1 + i % 10, 0) for i in range(3000)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long").repartition(7)
    got = pack(pieces, 10).collect()
    assert len(got) == 3000
    assert check_places(got, 10) == plain_best_fit([r[3] for r in rows], 10)
