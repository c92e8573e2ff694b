"""Best-fit packing of token pieces into sequences of a fixed capacity."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableflow.llm.common import staged, table
from tableflow.llm.tokens import TokenEncoder

CAPACITY = 4096
END_ID = 1

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
# A length and a rank in one sortable number: ranks stay below this power of two.
_RANK_BITS = 44


def _pieces(path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TokenEncoder(path, "words")
        for doc_ids, ids, ends in encoder.encode_batches(batches):
            rows: list[tuple] = []
            for i, doc_id in enumerate(doc_ids.to_pylist()):
                own = np.append(ids[ends[i] : ends[i + 1]], end_id).astype("<u4")
                for piece, start in enumerate(range(0, len(own), capacity)):
                    part = own[start : start + capacity]
                    rows.append((doc_id, piece, start, len(part), zlib.crc32(part)))
            columns = list(zip(*rows)) or [()] * 5
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    return run


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """Each document's ids and its end id, cut into pieces of at most ``capacity``; one piece for an empty text."""
    return docs.select("doc_id", "text").mapInArrow(_pieces(tokenizer, end_id, capacity), PIECE_SCHEMA)


def best_fit(lengths: dict[int, int], capacity: int) -> np.ndarray:
    """Placements ``(length, first rank, first sequence, offset)`` of pieces given as counts by length.

    Lengths and gaps lie between 1 and ``capacity``, so however many pieces there are, both sides are at most
    ``capacity`` classes, sorted by size. In each superstep, longest class first, a class of pieces sweeps to its
    successor, the smallest class of gaps that holds it. If either side has more members, rank decides: the lowest
    ranks and the lowest sequences match and the rest goes on to the next superstep. Then the matched gaps shrink.
    A class without a successor opens sequences. The result is best-fit decreasing, as one piece at a time would give.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}
    widths: list[int] = []
    placed: list[tuple[int, int, int, int]] = []
    opened = 0

    def add(width: int, first: int, n: int) -> None:
        if width and n:
            if width not in gaps:
                gaps[width] = []
                insort(widths, width)
            gaps[width].append((first, n))

    for length in sorted(lengths, reverse=True):
        rank, left = 0, lengths[length]
        while left:
            at = bisect_left(widths, length)
            if at == len(widths):
                fresh = max(1, left // (capacity // length))
                add(capacity, opened, fresh)
                opened += fresh
                continue
            width = widths[at]
            first, n = gaps[width].pop()
            matched = min(n, left)
            if n > matched:
                gaps[width].append((first + matched, n - matched))
            if not gaps[width]:
                del gaps[width], widths[at]
            placed.append((length, rank, first, capacity - width))
            add(width - length, first, matched)
            rank, left = rank + matched, left - matched
    return np.array(sorted(placed), np.int64).reshape(-1, 4)


def _place(placed: np.ndarray):
    keys = (placed[:, 0] << _RANK_BITS) + placed[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            at = np.searchsorted(keys, (length << _RANK_BITS) + rank, side="right") - 1
            sequence = placed[at, 2] + rank - placed[at, 1]
            columns = [batch[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.record_batch(
                [*columns, pa.array(sequence), pa.array(placed[at, 3])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` (from 0, without holes) and ``offset`` in its sequence (gapless from 0).

    The driver holds the counts by length and the placements, both bounded by ``capacity``. Pieces are ranked in their
    length by two counts, of the earlier parts and within the part that wrote them, so a length that a third of all
    pieces has is never one task's work. Every piece then finds its place by a search in the placements.
    """
    rows = staged(pieces.withColumn("part", F.spark_partition_id()), "pieces")
    by_part = rows.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    lengths = {r.length: r.n for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    placed = best_fit(lengths, capacity)
    earlier = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    within = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = rows.join(by_part.select("length", "part", earlier.alias("earlier")), ["length", "part"]).withColumn(
        "rank", F.col("earlier") + within
    )
    return ranked.drop("earlier", "part").mapInArrow(_place(placed), PIECE_SCHEMA + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with its place: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Null and empty texts are a piece of the end id alone. Rows with one ``doc_id``, or none, are packed each for itself.
    Columns other than ``doc_id`` and ``text`` are ignored. No documents give no rows.
    """
    return pack(token_pieces(docs, tokenizer, end_id, capacity), capacity)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
