"""SimHash near-duplicates: an inverted index over byte positions, count filtering, and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.llm.common import LOWER_BYTES, SPACES, staged, table
from tableflow.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42

# Bits that differ touch at most as many bytes: of eight, at least these many stay equal.
MIN_BYTES = 8 - MAX_BITS
# Among any five of eight bytes, three lie in one half: the posting lists of all triples of either half hold every
# pair that shares five bytes.
TRIPLES = [(0, 1, 2), (0, 1, 3), (0, 2, 3), (1, 2, 3), (4, 5, 6), (4, 5, 7), (4, 6, 7), (5, 6, 7)]
#: Fingerprints of a posting list that meet in one block; longer lists are dealt as pairs of blocks.
BLOCK = 1024

_BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)
_SPACES = SPACES.encode()


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """The SimHash of a text's word shingles; 0 for a text without words."""
    import xxhash

    words = text.translate(LOWER_BYTES).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[a:b], SEED) for a, b in zip(starts[: 1 - width].tolist(), ends[width - 1 :].tolist())], np.uint64
    )
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(_BITS[2 * ones > len(hashes)].sum(dtype=np.uint64))


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.large_binary())
        prints = np.array([fingerprint(t.as_py() or b"") for t in texts], np.uint64).view(np.int64)
        yield pa.record_batch([batch.column(0), pa.array(prints, pa.int64())], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp`` of every row; ``fp`` holds the 64 bits as a signed long. Null texts have no words."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_fingerprints, f"doc_id {kind}, fp long")


def _postings(fp) -> list:
    """The eight keys of a fingerprint: the number of the triple, and the values of its three bytes."""
    keys = []
    for number, triple in enumerate(TRIPLES):
        mask = sum(0xFF << (8 * k) for k in triple)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.xxhash64(F.lit(number), fp.bitwiseAND(F.lit(signed).cast("long"))))
    return keys


def _near(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that share enough bytes at their positions and then differ in few enough bits."""
    differ = a[:, None] ^ b[None, :]
    shared = (differ.view(np.uint8).reshape(len(a), len(b), 8) == 0).sum(axis=2, dtype=np.uint8)
    i, j = np.nonzero(shared >= MIN_BYTES)
    near = np.bitwise_count(differ[i, j]) <= MAX_BITS
    return i[near], j[near]


def _forest(fps: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of many links, as few as hold the same fingerprints together: each to the root of its group."""
    root = np.arange(len(fps))
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    child = np.flatnonzero(root != np.arange(len(root)))
    return fps[child], fps[root[child]]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each block of a posting list; the rows of a block come one after another."""

    def linked(side: np.ndarray, fps: np.ndarray):
        order = np.argsort(side, kind="stable")
        fps, n = fps[order].view(np.uint64), int((side == 0).sum())
        if n and n < len(fps):  # two blocks of a list meet
            i, j = _near(fps[:n], fps[n:])
            return _forest(fps, i, j + n)
        i, j = _near(fps, fps)
        return _forest(fps, i, j)

    def flush(rows):
        data = pa.Table.from_batches(rows)
        block, side, fps = (data.column(k).to_numpy() for k in range(3))
        edges = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True])
        found = [linked(side[a:b], fps[a:b]) for a, b in zip(edges[:-1], edges[1:]) if b - a > 1]
        a = np.concatenate([x for x, _ in found] or [np.zeros(0, np.uint64)])
        b = np.concatenate([x for _, x in found] or [np.zeros(0, np.uint64)])
        return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        # Blocks that end within this batch are whole; the last one may go on in the next.
        block = batch.column(0).to_numpy()
        cut = int(np.flatnonzero(block != block[-1])[-1]) + 1 if (block != block[-1]).any() else 0
        if cut or (held and held[-1].column(0)[-1].as_py() != block[0]):
            yield flush([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield flush(held)


def simhash_links(prints: DataFrame) -> DataFrame:
    """Links ``a, b`` between different fingerprints (column ``fp``, distinct) that join all within ``MAX_BITS`` bits.

    Each fingerprint is posted under eight byte triples. In a posting list, bytes shared at their positions are
    tallied for each pair, pairs below the guaranteed minimum go, and the rest are verified by their bits. Only a
    spanning forest of a block's pairs leaves the task, so a dense group gives as many links as members.
    A list longer than ``BLOCK`` is dealt over the pairs of its blocks; none is cut short.
    """
    posted = prints.select("fp", F.explode(F.array(*_postings(F.col("fp")))).alias("key"))
    sizes = posted.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    listed = posted.join(sizes, "key").withColumn("m", F.ceil(F.col("n") / BLOCK).cast("int"))
    own = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("m")).cast("int")
    # Block number x meets every other: the pair (low, high) is one task's work, with x on its side.
    meets = F.transform(
        F.sequence(F.lit(0), F.col("m") - 1),
        lambda k: F.struct(
            F.xxhash64("key", F.least(F.col("x"), k), F.greatest(F.col("x"), k)).alias("block"),
            (F.col("x") > k).cast("int").alias("side"),
        ),
    )
    dealt = listed.withColumn("x", own).select("fp", F.explode(meets).alias("at")).select("at.block", "at.side", "fp")
    return (
        dealt.repartition("block").sortWithinPartitions("block").mapInArrow(_links, "a long, b long").distinct()
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row of ``docs``; ids may be of any type with an order.

    Documents link when their fingerprints differ in at most ``MAX_BITS`` bits; ``component_id`` is the smallest
    ``doc_id`` reachable over links. Only distinct fingerprints are compared, so copies cost nothing, and no document
    is left out. Null, empty and blank texts have fingerprint zero and link like any other. Rows with one ``doc_id``
    keep a row each. A null ``doc_id`` gets a row, and a component of null only if all its documents lack one.
    """
    prints = staged(fingerprints(docs), "simhash")
    classes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "simhash_classes")
    member = components(simhash_links(classes))
    rooted = classes.join(member, classes.fp == member.node, "left").select(
        "fp", "first_doc", F.coalesce("root", "fp").alias("root")
    )
    first = rooted.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    named = rooted.join(first, "root").select("fp", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(named, "fp").select("doc_id", hexed.alias("fingerprint"), "component_id")


def first_of_each(docs: DataFrame) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest ``doc_id``.

    All columns of ``docs`` come back. Rows that share an id are told apart by their text; of equal ones one stays. A
    row without an id stays only where its group has none with an id.
    """
    marks = {"_no_id": F.col("doc_id").isNull(), "_id": F.col("doc_id"), "_text": F.xxhash64(F.coalesce("text", F.lit("")))}
    marked = docs.select(F.struct(*[c.alias(name) for name, c in marks.items()]).alias("doc_id"), "text")
    first = near_duplicates(marked).where("doc_id = component_id").select("component_id.*").distinct()
    same = F.col("_id").eqNullSafe(F.col("_first_id")) & (F.col("_text") == F.col("_first_text"))
    first = first.select(F.col("_id").alias("_first_id"), F.col("_text").alias("_first_text"))
    kept = docs.withColumns({k: marks[k] for k in ("_id", "_text")}).join(first, same, "left_semi")
    return kept.dropDuplicates(["_id", "_text"]).drop("_id", "_text")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
