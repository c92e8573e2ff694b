"""Phrase collocations by prefix-free parsing: a dictionary of overlapping chunks, counted once each and weighted."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableflow.llm.common import partitions_for, staged, table

LEAST = 10
TOP = 2000
#: A candidate goes if a longer one that holds it has so many per cent of its occurrences.
COVER = 50
#: The longest phrase; chunks overlap by one word less, so each phrase lies whole in the chunk that owns its first word.
MAX_WORDS = 3
#: One window of two words in about so many begins a chunk.
TRIGGER = 8
#: Bits of the filters of frequent words and pairs (16 MiB each). Whatever passes wrongly is counted exactly and goes.
FILTER_BITS = 27

# Every delimiter becomes this token, which no word can be.
_STOP = "."
_OVERLAP = MAX_WORDS - 1
_PARSE_ROWS = 2000
_COUNT_BYTES = 16 << 20


def _offsets(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions ``start, start + 1, ...`` of each run, one run after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def chunks_of(texts: pa.Array, trigger: int = TRIGGER) -> tuple[pa.Array, np.ndarray]:
    """The overlapping chunks of each text's pieces, words joined by spaces, and the row of each chunk.

    A chunk begins with a piece and with each window of two words whose hash is a trigger, and reaches to the end of
    the next trigger's window, or of the piece; then it ends with a stop.
    """
    marked = pc.replace_substring_regex(pc.ascii_lower(pc.fill_null(texts, "")), r"[.,;:!?\n-\r]", f" {_STOP} ")
    listed = pc.ascii_split_whitespace(pc.binary_join_element_wise(marked, _STOP, " "))
    first = listed.offsets.to_numpy()
    coded = listed.values.slice(first[0], first[-1] - first[0]).dictionary_encode()
    code, words = coded.indices.to_numpy(), coded.dictionary
    spelled = words.to_pylist()
    is_word = np.array([w not in ("", _STOP) for w in spelled], bool)[code]
    hashed = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in spelled], np.uint64)[code]
    follows = np.zeros(len(code), bool)
    follows[:-1] = is_word[:-1] & is_word[1:]
    window = np.zeros(len(code), np.uint64)
    window[:-1] = (hashed[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashed[1:] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(33)
    begins = is_word.copy()
    begins[1:] &= ~is_word[:-1]
    starts = np.flatnonzero(begins | (follows & (window % np.uint64(trigger) == 0)))
    stops = np.flatnonzero(~is_word)
    piece_end = stops[np.searchsorted(stops, starts)] if len(starts) else starts
    following = np.append(starts[1:], len(code))
    closed = following > piece_end
    ends = np.where(closed, piece_end + 1, np.minimum(following + _OVERLAP, piece_end))
    sizes = ends - starts
    values = words.take(pa.array(code[_offsets(starts, sizes)]))
    bounds = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    rows = np.searchsorted(first[1:] - first[0], starts, side="right")
    return pc.binary_join(pa.ListArray.from_arrays(bounds, values.cast(pa.string())), " "), rows


def _parse(trigger: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _PARSE_ROWS):
                some = batch.slice(at, _PARSE_ROWS)
                chunks, rows = chunks_of(some.column(1), trigger)
                yield pa.record_batch([some.column(0).take(pa.array(rows)), chunks], names=["lang", "chunk"])

    return run


def parse(docs: DataFrame, trigger: int = TRIGGER) -> DataFrame:
    """The dictionary of the parse: ``lang, chunk, n``, with ``n`` how often the chunk occurs."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    chunks = texts.mapInArrow(_parse(trigger), "lang string, chunk string")
    return chunks.groupBy("lang", "chunk").agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class _Chunks:
    """Some chunks, flat: each token's word as a number into ``lang, word`` pairs, its chunk's count, what it owns."""

    langs: list[str]
    words: list[str]
    key: np.ndarray
    n: np.ndarray
    owned: np.ndarray
    is_word: np.ndarray


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[_Chunks]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= _COUNT_BYTES:
            yield _flat(held)
            held = []
    if held:
        yield _flat(held)


def _flat(batches: list[pa.RecordBatch]) -> _Chunks:
    rows = pa.Table.from_batches(batches).combine_chunks()
    listed = pc.split_pattern(rows["chunk"].combine_chunks(), " ")
    first = listed.offsets.to_numpy()
    sizes = np.diff(first)
    coded = listed.values.slice(first[0], first[-1] - first[0]).dictionary_encode()
    lang = rows["lang"].combine_chunks().dictionary_encode()
    words = coded.dictionary.to_pylist()
    stop = words.index(_STOP) if _STOP in words else -1
    code = coded.indices.to_numpy().astype(np.int64)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(code))
    is_word = code != stop
    # The words of an overlap belong to the next chunk; only the last chunk of a piece ends with a stop.
    closed = ~is_word[np.cumsum(sizes) - 1] if len(sizes) else np.zeros(0, bool)
    owned = is_word & (np.repeat(closed, sizes) | (left > _OVERLAP))
    pairs, key = np.unique(np.repeat(lang.indices.to_numpy().astype(np.int64), sizes) * len(words) + code, return_inverse=True)
    langs = lang.dictionary.to_pylist()
    return _Chunks(
        [langs[p] for p in (pairs // len(words)).tolist()],
        [words[p] for p in (pairs % len(words)).tolist()],
        key,
        np.repeat(rows["n"].to_numpy(), sizes),
        owned,
        is_word,
    )


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n[:0]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunks in _gathered(batches):
        keys, n = _summed(chunks.key[chunks.owned], chunks.n[chunks.owned])
        langs, words = [chunks.langs[k] for k in keys.tolist()], [chunks.words[k] for k in keys.tolist()]
        yield pa.record_batch([pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(n)], names=["lang", "word", "c"])


def _hashes(chunks: _Chunks, salt: int) -> np.ndarray:
    """What ``word_hash`` gives, for each key."""
    import xxhash

    seeds: dict[str, int] = {}
    first = xxhash.xxh64_intdigest(salt.to_bytes(8, "little"), 42)
    for lang in set(chunks.langs):
        seeds[lang] = xxhash.xxh64_intdigest(lang, first)
    digest = xxhash.xxh64_intdigest
    return np.array([digest(w, seeds[g]) for g, w in zip(chunks.langs, chunks.words)], np.uint64)


def word_hash(salt: int) -> Column:
    return F.xxhash64(F.lit(salt).cast("long"), "lang", "word")


def _pair_bit(h1: Column, h2: Column) -> Column:
    return F.shiftrightunsigned(h1, 7).bitwiseXOR(h2)


def _filter(bits: DataFrame, size: int) -> np.ndarray:
    """The bytes of a bit set over the low ``size`` bits of the hashes in column ``h``; at most 2^size bits in all."""
    # Both functions count from 1.
    at = F.col("h").bitwiseAND((1 << size) - 1) + 1
    blocks = bits.select(F.bitmap_bucket_number(at).alias("block"), F.bitmap_bit_position(at).alias("bit"))
    out = np.zeros(max(1 << size, 1 << 15) // 8, np.uint8)
    for r in blocks.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        begin = (r.block - 1) * 4096
        out[begin : begin + 4096] = np.frombuffer(r.bits, np.uint8)
    return out


def _passes(bits: np.ndarray, hashes: np.ndarray, size: int) -> np.ndarray:
    at = hashes & np.uint64((1 << size) - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _frequent_words(chunks: _Chunks, words: np.ndarray, salt: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each key, and whether each token is a frequent word."""
    hashes = _hashes(chunks, salt)
    return hashes, _passes(words, hashes, size)[chunks.key] & chunks.is_word


def _count_pairs(words: np.ndarray, salt: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunks in _gathered(batches):
            hashes, frequent = _frequent_words(chunks, words, salt, size)
            at = np.flatnonzero(chunks.owned[:-1] & frequent[:-1] & frequent[1:])
            keys, n = _summed(chunks.key[at] * len(hashes) + chunks.key[at + 1], chunks.n[at])
            found = hashes.view(np.int64)
            columns = [pa.array(found[keys // len(hashes)]), pa.array(found[keys % len(hashes)]), pa.array(n)]
            yield pa.record_batch(columns, names=["h1", "h2", "c"])

    return run


def _count_triples(words: np.ndarray, pairs: np.ndarray, salt: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunks in _gathered(batches):
            hashes, frequent = _frequent_words(chunks, words, salt, size)
            token = hashes[chunks.key]
            joined = np.zeros(len(token), bool)
            joined[:-1] = frequent[:-1] & frequent[1:] & _passes(pairs, (token[:-1] >> np.uint64(7)) ^ token[1:], size)
            at = np.flatnonzero(chunks.owned[:-2] & joined[:-2] & joined[1:-1])
            # Three keys may not fit one number; the first two are numbered anew.
            two, number = np.unique(chunks.key[at] * len(hashes) + chunks.key[at + 1], return_inverse=True)
            keys, n = _summed(number * len(hashes) + chunks.key[at + 2], chunks.n[at])
            found, front = hashes.view(np.int64), two[keys // len(hashes)] if len(keys) else two
            columns = [found[front // len(hashes)], found[front % len(hashes)], found[keys % len(hashes)], n]
            yield pa.record_batch([pa.array(c) for c in columns], names=["h1", "h2", "h3", "c"])

    return run


@dataclass(frozen=True)
class Counts:
    """Exact counts: ``words`` (``lang, word, c, h``), and of at least ``least`` each ``pairs`` and ``triples`` by hash."""

    words: DataFrame
    pairs: DataFrame
    triples: DataFrame


def count_phrases(docs: DataFrame, least: int = LEAST, trigger: int = TRIGGER, size: int = FILTER_BITS) -> Counts:
    """Count words, and phrases of two and three words with ``least`` occurrences, over the chunks of the parse.

    Words are told apart by 64-bit hashes of language and word, which are checked to differ over the whole vocabulary
    and salted anew if two agree; so a row of hashes is a phrase, and no string is shuffled for it. A phrase is counted
    only if its words, and the pairs in it, have ``least`` occurrences, which changes no count that is kept.
    """
    chunks = staged(parse(docs, trigger), "phrase_chunks", "zstd")
    counted = chunks.mapInArrow(_count_words, "lang string, word string, c long").groupBy("lang", "word")
    words = staged(counted.agg(F.sum("c").alias("c")), "phrase_words")
    salt = 0
    while not words.groupBy(word_hash(salt).alias("h")).count().where("count > 1").isEmpty():
        salt += 1
    words = words.withColumn("h", word_hash(salt))
    enough = F.col("c") >= least
    word_bits = _filter(words.where(enough).select("h"), size)
    pairs = chunks.mapInArrow(_count_pairs(word_bits, salt, size), "h1 long, h2 long, c long")
    pairs = staged(pairs.groupBy("h1", "h2").agg(F.sum("c").alias("c")).where(enough), "phrase_pairs")
    pair_bits = _filter(pairs.select(_pair_bit(F.col("h1"), F.col("h2")).alias("h")), size)
    triples = chunks.mapInArrow(_count_triples(word_bits, pair_bits, salt, size), "h1 long, h2 long, h3 long, c long")
    triples = triples.groupBy("h1", "h2", "h3").agg(F.sum("c").alias("c")).where(enough)
    return Counts(words, pairs, staged(triples, "phrase_triples"))


def _score(a: str, left: str, right: str) -> Column:
    """The whole part of 1000000 * a * a / (l * r), in decimals, as products pass 64 bits."""
    wide = "cast({} as decimal(19,0))"
    a, left, right = (wide.format(x) for x in (a, left, right))
    return F.expr(f"(cast(1000000 as decimal(7,0)) * {a} * {a}) div ({left} * {right})")


def collocations(
    docs: DataFrame, least: int = LEAST, top: int = TOP, cover: int = COVER, trigger: int = TRIGGER, size: int = FILTER_BITS
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language by their lowest-scoring cut.

    Null texts are empty, a null language is ``und``; columns other than ``lang`` and ``text`` are ignored, and every
    row counts, repeated ones too. Texts without words, and no documents, give no rows. Ties go by ``a`` and then by
    the phrase's bytes. The best of a language are first found over salted parts, so no task ranks a whole language.
    """
    counts = count_phrases(docs, least, trigger, size)
    words = counts.words.where(F.col("c") >= least).select("h", "c", "lang", "word")

    def word(name: str, c: str, *more: Column) -> DataFrame:
        return words.select(F.col("h").alias(name), F.col("c").alias(c), *more)

    lang = F.col("lang")
    triples, pairs = counts.triples, counts.pairs.withColumnRenamed("c", "a")
    inside = triples.select("h1", "h2", "c").union(triples.select("h2", "h3", "c")).groupBy("h1", "h2").agg(F.max("c").alias("most"))
    kept = pairs.join(inside, ["h1", "h2"], "left").where(F.coalesce(100 * F.col("most") < cover * F.col("a"), F.lit(True)))
    two = kept.join(word("h1", "l", lang), "h1").join(word("h2", "r"), "h2").select(
        "lang", "h1", "h2", F.lit(None).cast("long").alias("h3"), "a", "l", "r", _score("a", "l", "r").alias("score")
    )
    cut = (
        triples.withColumnRenamed("c", "a")
        .join(pairs.select(F.col("h1"), F.col("h2"), F.col("a").alias("l2")), ["h1", "h2"])
        .join(pairs.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("a").alias("r1")), ["h2", "h3"])
        .join(word("h1", "l1", lang), "h1")
        .join(word("h3", "r2"), "h3")
        .withColumn("s1", _score("a", "l1", "r1"))
        .withColumn("s2", _score("a", "l2", "r2"))
    )
    early = F.col("s1") <= F.col("s2")
    three = cut.select(
        "lang", "h1", "h2", "h3", "a",
        F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"),
        F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    salt = F.pmod(F.xxhash64("h1", "h2", "h3"), F.lit(partitions_for(docs.sparkSession)))
    best = two.unionByName(three).withColumn("part", salt)
    for by in (["lang", "part"], ["lang"]):
        order = Window.partitionBy(*by).orderBy(F.desc("score"), F.desc("a"))
        best = best.withColumn("place", F.rank().over(order)).where(F.col("place") <= top)
    best = staged(best.drop("part", "place"), "phrase_best")
    for k in ("1", "2"):
        best = best.join(words.select(F.col("h").alias(f"h{k}"), F.col("word").alias(f"w{k}")), f"h{k}")
    best = best.join(words.select(F.col("h").alias("h3"), F.col("word").alias("w3")), "h3", "left")
    total = counts.words.groupBy("lang").agg(F.sum("c").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return (
        best.withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3"))
        .withColumn("rank", rank.cast("long"))
        .where(F.col("rank") <= top)
        .join(total, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
grams as (
  select lang, m, array_to_string(w[i : i + m - 1], ' ') as phrase
  from (select lang, w, m, unnest(range(1, len(w) - m + 2)) as i from w, (values (1), (2), (3)) as sizes(m))),
f as (select lang, m, phrase, count(*) as f from grams group by all),
n as (select lang, sum(f)::bigint as n from f where m = 1 group by lang),
c as (select lang, m, phrase, f as a, string_split(phrase, ' ') as w from f where m > 1 and f >= 10),
cuts as (
  select c.*, k, array_to_string(w[1 : k], ' ') as first_part, array_to_string(w[k + 1 :], ' ') as rest
  from (select c.*, unnest(range(1, m)) as k from c) as c),
scored as (
  select cuts.lang, cuts.phrase, cuts.m, a, k, x.f as l, y.f as r,
         ((1000000::hugeint * a * a) // (x.f::hugeint * y.f))::bigint as score
  from cuts join f as x on x.lang = cuts.lang and x.phrase = first_part
            join f as y on y.lang = cuts.lang and y.phrase = rest),
lowest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
longer as (
  select lang, array_to_string(w[i : i + 1], ' ') as phrase, max(a) as most
  from (select lang, w, a, unnest([1, 2]) as i from c where m = 3) group by all)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from lowest join n using (lang) left join longer using (lang, phrase)
where m = 3 or most is null or 100 * most < 50 * a
qualify rank <= 2000
"""
