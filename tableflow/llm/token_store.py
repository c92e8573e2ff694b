"""Token ids in binary blocks: frequency-ranked codes of whole bytes, with their control bytes apart."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableflow.llm.common import drop_staged, partitions_for, staged, table
from tableflow.llm.tokens import TokenEncoder

END_ID = 2
#: Ids in a block, about; a longer document makes a longer block of its own.
BLOCK_IDS = 1 << 18

BLOCK_SCHEMA = "pos long, n_ids long, doc_ids array<long>, lengths array<long>, control binary, data binary"


def pack_ids(codes: np.ndarray) -> tuple[bytes, bytes]:
    """Codes in 1 to 4 little-endian bytes each; a control byte holds four byte counts less one, lowest first."""
    codes = codes.astype("<u4")
    extra = (codes > 0xFF).astype(np.uint8) + (codes > 0xFFFF) + (codes > 0xFFFFFF)
    padded = np.zeros(-(-len(codes) // 4) * 4, np.uint8)
    padded[: len(codes)] = extra
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    used = np.arange(4, dtype=np.uint8) <= extra[:, None]
    return control.tobytes(), codes.view(np.uint8).reshape(-1, 4)[used].tobytes()


#: For each control byte, the byte counts of its four codes.
_COUNTS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def unpack_ids(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The inverse of ``pack_ids``: byte counts from the table, then one gather for each byte of a code."""
    counts = _COUNTS[np.frombuffer(control, np.uint8)].ravel()[:n].astype(np.int64)
    start = np.cumsum(counts) - counts
    raw = np.frombuffer(data, np.uint8)
    codes = raw[start].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(counts > k)
        codes[longer] |= raw[start[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return codes


def _encode(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TokenEncoder(path, "bytes")
        for doc_ids, ids, ends in encoder.encode_batches(batches):
            n = len(ends) - 1
            # The end id goes behind each document.
            out = np.insert(ids, ends[1:], end_id) if n else ids
            bounds = (ends + np.arange(n + 1)) * encoder.dtype.itemsize
            raw = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), n, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(out.tobytes())]
            )
            yield pa.record_batch([doc_ids, raw.cast(pa.binary())], names=["doc_id", "ids"])

    return run


def _id_counts(dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for raw in batch.column(0):
                seen = np.bincount(np.frombuffer(raw.as_buffer(), dtype))
                if len(seen) > len(total):
                    total = np.concatenate([total, np.zeros(len(seen) - len(total), np.int64)])
                total[: len(seen)] += seen
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used, pa.int64()), pa.array(total[used])], names=["id", "n"])

    return run


def _blocks(dtype: str, code_of: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def block():
            ids = np.concatenate([np.frombuffer(raw, dtype) for _, _, raw in held])
            control, data = pack_ids(code_of[ids])
            return pa.record_batch(
                [
                    pa.array([held[0][0]], pa.int64()),
                    pa.array([len(ids)], pa.int64()),
                    pa.array([[d for _, d, _ in held]], pa.list_(pa.int64())),
                    pa.array([[len(raw) // np.dtype(dtype).itemsize for _, _, raw in held]], pa.list_(pa.int64())),
                    pa.array([control], pa.binary()),
                    pa.array([data], pa.binary()),
                ],
                names=["pos", "n_ids", "doc_ids", "lengths", "control", "data"],
            )

        for batch in batches:
            for pos, doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                n = len(raw) // np.dtype(dtype).itemsize
                if held and size + n > BLOCK_IDS:
                    yield block()
                    held, size = [], 0
                held.append((pos, doc_id, raw))
                size += n
        if held:
            yield block()

    return run


def _read(id_of: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = id_of[unpack_ids(row["control"], row["data"], row["n_ids"])].astype("<u4")
                ends = np.cumsum(np.array(row["lengths"], np.int64))
                starts = ends - np.array(row["lengths"], np.int64)
                yield pa.record_batch(
                    [
                        pa.array([row["pos"]] * len(ends), pa.int64()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(starts),
                        pa.array(ends - starts),
                        pa.array([zlib.crc32(ids[a:b]) for a, b in zip(starts, ends)], pa.int64()),
                    ],
                    names=["pos", "doc_id", "start_in_block", "n_tokens", "ids_crc32"],
                )

    return run


def write_token_blocks(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> tuple[DataFrame, np.ndarray]:
    """Write the ids of every text, in ascending ``doc_id`` order, as a table of blocks; with it the id of each code.

    Three stages: texts are encoded once and staged; the counts of the ids, at most one for each id of the
    vocabulary, give the most frequent id the smallest code; documents are dealt by ranges of ``doc_id`` (cut at
    quantiles of the ids alone), sorted, coded and written. ``pos`` orders the blocks.

    Null texts are empty and hold the end id only. A null ``doc_id`` comes first. Rows with equal ``doc_id`` follow
    each other by their ids, so identical rows are interchangeable. No documents give no blocks.
    """
    spark = docs.sparkSession
    dtype = str(TokenEncoder(tokenizer, "bytes").dtype)
    encoded = staged(
        docs.select("doc_id", "text").mapInArrow(_encode(tokenizer, end_id), "doc_id long, ids binary"), "token_ids", "zstd"
    )
    counts = (
        encoded.select("ids").mapInArrow(_id_counts(dtype), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    )
    id_of = counts.sort_values(["n", "id"], ascending=[False, True])["id"].to_numpy(np.uint32)
    code_of = np.zeros(int(id_of.max()) + 1 if len(id_of) else 1, np.uint32)
    code_of[id_of] = np.arange(len(id_of), dtype=np.uint32)

    ordered = ordered_by_doc(encoded)
    blocks = ordered.select(F.monotonically_increasing_id().alias("pos"), "doc_id", "ids").mapInArrow(
        _blocks(dtype, code_of), BLOCK_SCHEMA
    )
    written = staged(blocks, "token_blocks", "zstd")
    drop_staged(encoded)
    return written, id_of


def ordered_by_doc(docs: DataFrame) -> DataFrame:
    """Rows in ascending ``doc_id`` order over the partitions, cut at quantiles of ``doc_id``."""
    n = partitions_for(docs.sparkSession)
    cuts = docs.stat.approxQuantile("doc_id", [k / n for k in range(1, n)], 0.1 / n) if n > 1 else []
    bounds = F.array(*[F.lit(int(c)) for c in sorted(set(cuts))]) if cuts else F.array().cast("array<bigint>")
    part = F.coalesce(F.size(F.filter(bounds, lambda c: c <= F.col("doc_id"))), F.lit(0)).cast("int")
    return docs.withColumn("_part", part).repartitionById(n, "_part").sortWithinPartitions("doc_id", *[c for c in docs.columns if c != "doc_id"])


def read_token_blocks(blocks: DataFrame, id_of: np.ndarray) -> DataFrame:
    """Per document of the written blocks: ``doc_id, start, n_tokens, ids_crc32``, read back from the bytes."""
    docs = blocks.mapInArrow(
        _read(id_of), "pos long, doc_id long, start_in_block long, n_tokens long, ids_crc32 long"
    )
    # The blocks before a block: those of earlier partitions, in bulk, and the earlier ones of its own.
    own = blocks.select("pos", "n_ids", F.shiftright("pos", 33).alias("part"))
    parts = own.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    within = F.sum("n_ids").over(Window.partitionBy("part").orderBy("pos")) - F.col("n_ids")
    starts = own.join(before, "part").select("pos", (F.col("before") + within).alias("block_start"))
    return docs.join(starts, "pos").select(
        "doc_id", (F.col("block_start") + F.col("start_in_block")).alias("start"), "n_tokens", "ids_crc32"
    )


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    blocks, id_of = write_token_blocks(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_blocks(blocks, id_of)
