import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tableflow.llm.collocations import chunks_of, collocations, count_phrases, word_hash


def pieces(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lowered)]


def plain(rows, least, top, cover=50):
    out = []
    for lang in {g or "und" for g, _ in rows}:
        f = Counter()
        for g, text in rows:
            if (g or "und") == lang:
                for words in pieces(text):
                    f.update(tuple(words[i : i + m]) for m in (1, 2, 3) for i in range(len(words) - m + 1))
        n = sum(c for w, c in f.items() if len(w) == 1)
        candidates = {w: a for w, a in f.items() if len(w) > 1 and a >= least}
        scored = []
        for w, a in candidates.items():
            if any(len(x) > len(w) and w in (x[:2], x[1:]) and 100 * b >= cover * a for x, b in candidates.items()):
                continue
            cuts = [(10**6 * a * a // (f[w[:k]] * f[w[k:]]), k, f[w[:k]], f[w[k:]]) for k in range(1, len(w))]
            score, _, left, right = min(cuts)
            scored.append((-score, -a, " ".join(w).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


@pytest.fixture
def phrases(spark):
    """Texts in which some phrases recur, over several languages, one of them with most of the rows."""
    random.seed(5)
    words = [f"w{i}" for i in range(40)] + ["é", "Über", "x-y", "\x1c", "中"]
    rows = []
    for _ in range(300):
        text = []
        for _ in range(random.randrange(0, 60)):
            text.append(random.choice(["New York City", "of the", "the the the", random.choice(words), random.choice(words)]))
            text.append(random.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n"]))
        rows.append((random.choice(["en", "en", "en", "de", None]), "".join(text)))
    return rows


SCHEMA = "lang string, text string"


@pytest.mark.parametrize("trigger", [1, 2, 8, 1 << 40])
def test_against_every_phrase_counted(spark, phrases, trigger):
    got = collocations(spark.createDataFrame(phrases, SCHEMA), least=4, top=50, trigger=trigger, size=16).collect()
    assert sorted(map(tuple, got)) == plain(phrases, 4, 50)


def test_filters_that_let_everything_pass_change_nothing(spark, phrases):
    docs = spark.createDataFrame(phrases, SCHEMA)
    got = sorted(map(tuple, collocations(docs, least=3, top=2000, size=3).collect()))
    assert got == plain(phrases, 3, 2000)


def test_odd_documents(odd_docs):
    got = collocations(odd_docs, least=2).collect()
    assert sorted(map(tuple, got)) == plain([(r.lang, r.text) for r in odd_docs.collect()], 2, 2000)


def test_no_documents(no_docs):
    assert collocations(no_docs).collect() == []


def test_counts_of_words(spark, phrases):
    want = Counter((g or "und", w) for g, t in phrases for p in pieces(t) for w in p)
    words = count_phrases(spark.createDataFrame(phrases, SCHEMA)).words.collect()
    assert {(r.lang, r.word): r.c for r in words} == want


def test_hashes_in_tasks_are_those_of_spark(spark):
    import xxhash

    row = spark.createDataFrame([("de", "über")], "lang string, word string").select(word_hash(3).alias("h")).first()
    seed = xxhash.xxh64_intdigest("de", xxhash.xxh64_intdigest((3).to_bytes(8, "little"), 42))
    assert row.h % (1 << 64) == xxhash.xxh64_intdigest("über", seed)


def test_chunks_overlap_by_two_words_and_own_each_start_once():
    text = "a b c d e f g. h i, j\n" + " ".join(f"x{i}" for i in range(200))
    chunks, rows = chunks_of(pa.array([text, None, " ", "one"]), 3)
    owned = Counter()
    for chunk, row in zip(chunks.to_pylist(), rows.tolist()):
        words = chunk.split(" ")
        owned.update((row, w) for w in (words[:-1] if words[-1] == "." else words[:-2]))
    assert owned == Counter((i, w) for i, t in enumerate([text, "", " ", "one"]) for p in pieces(t) for w in p)


def test_products_beyond_64_bits(spark):
    from tableflow.llm.collocations import _score

    a, left, right = 9 * 10**11, 10**13 + 7, 3 * 10**12 + 1
    got = spark.range(1).select(F.lit(a).alias("a"), F.lit(left).alias("l"), F.lit(right).alias("r")).select(_score("a", "l", "r")).first()[0]
    assert got == 10**6 * a * a // (left * right)
