import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tableflow.llm.common import table
from tableflow.llm.token_store import op9_token_store, pack_ids, read_token_blocks, unpack_ids, write_token_blocks

PATH = public_tokenizers.path("byte_bpe_50k.json")


@given(st.lists(st.integers(0, 2**32 - 1)))
@settings(max_examples=200, deadline=None)
def test_codes_round_trip(values):
    control, data = pack_ids(np.array(values, np.uint32))
    assert unpack_ids(control, data, len(values)).tolist() == values
    assert len(control) == -(-len(values) // 4)


def plain(docs):
    tokenizer = Tokenizer.from_file(PATH)
    rows = [(r.doc_id, tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2]) for r in docs.collect()]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, np.array(r[1], "<u2").tobytes()))


def check(docs):
    got = read_token_blocks(*write_token_blocks(docs, PATH)).collect()
    start, want = 0, []
    for doc_id, ids in plain(docs):
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4"))))
        start += len(ids)
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == want


def test_given_documents(spark, sf_dir):
    check(table(spark, sf_dir, "documents"))
    assert op9_token_store(spark, sf_dir).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_odd_documents(odd_docs):
    check(odd_docs)


def test_empty(no_docs):
    assert read_token_blocks(*write_token_blocks(no_docs, PATH)).count() == 0


def test_frequent_ids_take_one_byte(spark):
    docs = spark.createDataFrame([(1, "the the the the the the river")], "doc_id long, text string")
    blocks, id_of = write_token_blocks(docs, PATH)
    assert len(blocks.first().data) == blocks.first().n_ids == 8
    assert id_of[0] == Tokenizer.from_file(PATH).encode(" the").ids[0]
