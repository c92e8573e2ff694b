"""Document fingerprints by winnowing, and how alike they stay when a text is edited."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.llm.common import partitions_for, table

GRAM = 16
WINDOW = 32
_ONE = np.uint64(1)
_LOW = np.uint64(0xFFFFFFFF)


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def _gram_hashes(points: np.ndarray, gram: int) -> np.ndarray:
    """The polynomial hash of each run of ``gram`` code points, by doubling the run length."""
    base = np.uint64(0x9E3779B97F4A7C15)
    # ``whole`` covers runs of the bits of ``gram`` seen so far, ``run`` runs of a power of two.
    run, power, length = points.astype(np.uint64) + _ONE, base, 1
    whole, covered = None, 0
    while True:
        if gram & length:
            if whole is None:
                whole = run
            else:
                n = len(points) - covered - length + 1
                whole = whole[:n] * power + run[covered : covered + n]
            covered += length
        if 2 * length > gram:
            return _mixed(whole)
        run = run[: len(run) - length] * power + run[length:]
        power, length = power * power, 2 * length


def winnow(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (uint64) and positions of the grams that a text is known by, in order.

    Of every ``window`` grams in a row the smallest hash is chosen, the rightmost of equal ones. So texts that share
    ``gram + window - 1`` code points in a row share a chosen hash, and what is chosen depends on nothing outside a
    window. A text shorter than a gram is one gram, one shorter than a window is one window, an empty text has none.
    """
    points = _code_points(text)
    if not len(points):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        hashes = _gram_hashes(points, min(gram, len(points)))
    # High half: the hash; low half: larger for earlier positions, so that the minimum is the rightmost tie.
    least = (hashes & ~_LOW) | (_LOW - np.arange(len(hashes), dtype=np.uint64))
    width, span = min(window, len(hashes)), 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: span - width], least[width - span :])
    chosen = (_LOW - (least & _LOW)).astype(np.int64)
    positions = chosen[np.r_[True, chosen[1:] != chosen[:-1]]]
    return hashes[positions], positions


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of the different hashes of two fingerprints that both have; 1 for two empty ones."""
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b, assume_unique=True))
    either = len(a) + len(b) - both
    return both / either if either else 1.0


def _winnow_batches(gram: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [winnow(t.as_py() or "", gram, window) for t in batch.column(1)]
            hashes = pa.array([h.view(np.int64) for h, _ in found], pa.list_(pa.int64()))
            positions = pa.array([p for _, p in found], pa.list_(pa.int64()))
            yield pa.record_batch([batch.column(0), hashes, positions], names=["doc_id", "hashes", "positions"])

    return run


def fingerprint_documents(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``doc_id, hashes, positions`` of every whole text; a null text is empty and has no hashes.

    One pass without a shuffle. Rows that share an id are documents of their own; other columns are ignored.
    """
    return docs.select("doc_id", "text").mapInArrow(
        _winnow_batches(gram, window), "doc_id long, hashes array<long>, positions array<long>"
    )


def with_next(docs: DataFrame) -> DataFrame:
    """``docs`` (``doc_id``, ``text``) dealt so that every document is followed by the next one of a ring.

    The ring is in descending ``doc_id`` (ties by text, null ids last, null texts as empty ones); the last is followed
    by the first. Partitions are cut at quantiles of the ids, and each ends with a copy (``guest``) of the document
    that the next one begins with. So neighbours meet without a global order in one task.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = partitions_for(spark)
    cuts = docs.select("doc_id").stat.approxQuantile("doc_id", [k / n for k in range(1, n)], 0.1 / n) if n > 1 else []
    bounds = F.array(*[F.lit(int(c)) for c in sorted(set(cuts))]) if cuts else F.array().cast("array<bigint>")
    later = F.size(F.filter(bounds, lambda c: c > F.col("doc_id")))
    part = F.when(F.col("doc_id").isNull(), F.lit(len(set(cuts)))).otherwise(later).cast("int")
    parted = texts.withColumn("part", part)
    # One row for each partition, of ids alone: its first id, and the partition that ends with a copy of it.
    heads = sorted(
        (r.part, r.head) for r in docs.select("doc_id").withColumn("part", part).groupBy("part").agg(F.max("doc_id").alias("head")).collect()
    )
    guests = [(heads[i - 1][0], head) for i, (_, head) in enumerate(heads)]
    if not guests:
        return parted.withColumn("guest", F.lit(False))
    wanted = F.broadcast(spark.createDataFrame(guests, "part int, head long"))
    copies = (
        texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("head")))
        .groupBy("part", "doc_id")
        .agg(F.min("text").alias("text"))
        .select("doc_id", "text", "part", F.lit(True).alias("guest"))
    )
    dealt = parted.withColumn("guest", F.lit(False)).unionByName(copies).repartitionById(len(set(cuts)) + 1, "part")
    return dealt.sortWithinPartitions("part", "guest", F.col("doc_id").desc_nulls_last(), "text")


_COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _digest(hashes: np.ndarray, positions: np.ndarray) -> str:
    return f"{len(hashes)}:{hashlib.md5(hashes.tobytes() + positions.tobytes()).hexdigest()}"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in _COMPARED.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    last = None
    for batch in batches:
        rows = []
        for doc_id, raw, guest in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(3).to_pylist()):
            text = raw.as_py()
            print_ = winnow(text)
            if last is not None:
                own_id, own, own_print = last
                third = len(own) // 3
                edited = own[: len(own) - third] + text[:third]
                edited_print = winnow(edited)
                rows.append(
                    (
                        own_id, len(own), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                        _digest(*own_print), _digest(*edited_print),
                        likeness(own_print[0], edited_print[0]), likeness(own_print[0], print_[0]),
                    )
                )
            last = None if guest else (doc_id, text, print_)
        columns = list(zip(*rows)) or [()] * len(names)
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and how alike it is to that and to the next document's.

    The edited text ends with the first third (by code points, rounded down) of the next document of the ring of
    ``with_next`` in place of its own last third. A lone document is its own next.
    """
    return with_next(docs).select("doc_id", "text", "part", "guest").mapInArrow(_compare, _COMPARED)


def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_edits(table(spark, sf_dir, "documents"))
