"""Quality classifier: similarity-weighted votes of the nearest labelled documents in a latent-semantic space."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.llm.common import LOWER, UPPER, table

#: Labelled documents the space is fitted on and votes come from, at most.
SAMPLE = 4096
#: Buckets that the byte bigrams of a text are hashed into, the terms of the space.
TERMS = 2048
#: Dimensions of the space.
RANK = 48
NEIGHBOURS = 32
THRESHOLD = 0.3
_BLOCK = 512

#: Steps of each measure of a text's shape; a step is a term of its own.
STEPS = 8
_MEASURES = 5
_HASH = (np.arange(1 << 16, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(53)).astype(np.uint16)
# Which of four kinds a byte is: a symbol, a capital A-Z, a small a-z, an exclamation mark.
_KINDS = [np.isin(np.arange(256), list(chars)) for chars in (b"#$%&*+/<=>@[\\]^_{|}~", UPPER.encode(), LOWER.encode(), b"!")]


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _shape(raw: np.ndarray, words: list[bytes]) -> list[float]:
    """Shares between 0 and 1: words equal to the one before, repeated words, symbols, capitals, exclamation marks."""
    seen = np.bincount(raw, minlength=256)
    symbols, upper, lower, shouts = (int(seen[kind].sum()) for kind in _KINDS)
    n = max(1, len(words))
    return [
        sum(map(eq, words, words[1:])) / n,
        1 - len(set(words)) / n,
        min(1.0, symbols / n),
        upper / max(1, upper + lower),
        min(1.0, shouts / n),
    ]


def term_counts(texts: pa.Array) -> np.ndarray:
    """A row for each whole text: damped counts of its hashed byte bigrams, then a 1 at the step of each measure."""
    out = np.zeros((len(texts), TERMS + _MEASURES * STEPS), np.float32)
    for i, text in enumerate(texts):
        encoded = (text.as_py() or "").encode("utf-8", "surrogatepass")
        raw = np.frombuffer(encoded, np.uint8)
        if len(raw) > 1:
            wide = raw.astype(np.uint16)
            out[i, :TERMS] = np.log1p(np.bincount(_HASH[wide[:-1] << 8 | wide[1:]], minlength=TERMS))
            for k, share in enumerate(_shape(raw, encoded.split())):
                out[i, TERMS + k * STEPS + min(STEPS - 1, int(STEPS * share))] = 1
    return out


@dataclass(frozen=True)
class LatentSpace:
    """Term weights, projection, and the labelled vectors: what the broadcast holds, bounded by the constants."""

    weights: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    #: Votes and the scores they stand for, both ascending; between them, scores are on the line.
    votes: np.ndarray
    scores: np.ndarray

    def project(self, counts: np.ndarray) -> np.ndarray:
        """Unit vectors; a text without terms is the zero vector."""
        return _unit(_weighed(counts, self.weights) @ self.projection)

    def vote(self, vectors: np.ndarray, own: int | None = None) -> np.ndarray:
        """Votes of the nearest labelled vectors, weighted by similarity; exact products, a block at a time.

        With ``own``, the vectors are the labelled ones from there on, and none votes for itself. Where nothing is
        similar, an empty text above all, nothing speaks for label 1 and the vote is 0.
        """
        votes = np.zeros(len(vectors))
        k = min(NEIGHBOURS, len(self.labels) - (own is not None))
        if k < 1:
            return votes
        for a in range(0, len(vectors), _BLOCK):
            cosine = vectors[a : a + _BLOCK] @ self.vectors.T
            if own is not None:
                cosine[np.arange(len(cosine)), own + a + np.arange(len(cosine))] = -2
            near = np.argpartition(cosine, -k, axis=1)[:, -k:]
            weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64) ** 4
            total = weight.sum(axis=1)
            some = total > 1e-12
            votes[a : a + _BLOCK][some] = (weight * self.labels[near]).sum(axis=1)[some] / total[some]
        return np.clip(votes, 0.0, 1.0)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """The votes on the scale of chances; a hundredth of the vote itself keeps the order of what is tied there."""
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        votes = self.vote(self.project(counts))
        return 0.99 * np.interp(votes, self.votes, self.scores) + 0.01 * votes


def calibration(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The monotone map from votes to the chance of label 1 that fits best, were both labels equally frequent.

    Pool adjacent violators: neighbours in order of the vote whose chances fall are merged, and each pool's mean vote
    stands for its chance. Most labels are 1, which would otherwise lift every score.
    """
    of = np.array([(labels != 1).sum(), (labels == 1).sum()], np.float64)
    if not of.all():
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    pools: list[list[float]] = []
    for i in np.argsort(votes, kind="stable"):
        weight = 0.5 / of[int(labels[i] == 1)]
        pools.append([votes[i] * weight, labels[i] * weight, weight])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [x + y for x, y in zip(pools[-1], last)]
    vote, chance, weight = np.array(pools).T
    return vote / weight, chance / weight


def _unit(rows: np.ndarray) -> np.ndarray:
    return (rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def _weighed(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Bigrams and measures each as a unit vector, so that a text's length does not decide what counts.

    A block at a time: nothing beside the result is as large as the counts.
    """
    out = np.empty(counts.shape, np.float32)
    for a in range(0, len(counts), _BLOCK):
        rows = counts[a : a + _BLOCK] * weights
        out[a : a + _BLOCK, :TERMS] = _unit(rows[:, :TERMS])
        out[a : a + _BLOCK, TERMS:] = _unit(rows[:, TERMS:])
    return out


def _latent(weighed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The leading right singular vectors (randomised subspace iteration) and the unit vectors of the rows there."""
    n = len(weighed)
    rank = min(RANK, n)
    basis = np.random.default_rng(0).standard_normal((weighed.shape[1], rank + 16)).astype(np.float32)
    for _ in range(4 if n else 0):
        basis = np.linalg.qr(weighed.T @ (weighed @ basis))[0]
    if n:
        _, _, right = np.linalg.svd(weighed @ basis, full_matrices=False)
        basis = basis @ right[:rank].T
    projection = basis[:, :rank].astype(np.float32)
    return projection, _unit(weighed @ projection)


def fit_space(counts: np.ndarray, labels: np.ndarray) -> LatentSpace:
    """Inverse document frequencies, the space they span, and the labelled vectors with the scores of their votes."""
    weights = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
    projection, vectors = _latent(_weighed(counts, weights))
    labels = labels.astype(np.float64)
    line = np.array([0.0, 1.0])
    space = LatentSpace(weights, projection, vectors, labels, line, line)
    return LatentSpace(weights, projection, vectors, labels, *calibration(space.vote(vectors, own=0), labels))


def _sample_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts are packed, as most are zero or small: the driver gets about a tenth of them as bytes."""
    for batch in batches:
        rows = [zlib.compress(r, 1) for r in term_counts(batch.column(1))]
        yield pa.record_batch([batch.column(0), pa.array(rows, pa.binary()), batch.column(2)], names=["doc_id", "counts", "label"])


def _unpacked(rows: Sequence[Row]) -> np.ndarray:
    out = np.empty((len(rows), TERMS + _MEASURES * STEPS), np.float32)
    for i, row in enumerate(rows):
        out[i] = np.frombuffer(zlib.decompress(row.counts), np.float32)
    return out


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> LatentSpace:
    """Fit the space on at most ``sample`` labelled documents, those whose ids hash lowest, held-out ones excepted.

    Labels that are null or say both 0 and 1 of one document are left out. Ids without a document are no loss: the
    sample is drawn among labelled ids that have one.
    """
    agreed = (
        labels.where(F.col("quality").isin(0, 1) & ~is_held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("label"), F.max("quality").alias("most"))
        .where("label = most")
        .select("doc_id", F.col("label").cast("int").alias("label"))
    )
    known = agreed.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    drawn = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(drawn), "doc_id")
        .mapInArrow(_sample_counts, "doc_id long, counts binary, label int")
        .dropDuplicates(["doc_id"])
        .collect()
    )
    rows.sort(key=lambda r: r.doc_id)  # as many as the sample has, at most
    return fit_space(_unpacked(rows), np.array([r.label for r in rows], np.float64))


def score_documents(docs: DataFrame, space: LatentSpace) -> DataFrame:
    """``docs`` with ``quality_score``, from the text alone; one narrow pass over whole texts."""
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [batch.slice(i, 8 * _BLOCK).column(at) for i in range(0, batch.num_rows, 8 * _BLOCK)]
            scores = np.concatenate([space.score(term_counts(p)) for p in parts] or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*names, "quality_score"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("quality_score", T.DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    Only ``text`` enters a score. Votes become scores by a monotone map fitted to the votes on each labelled document of
    the sample by the others. Null, empty and one-byte texts have no terms, so nothing votes for them and they get the
    lowest score; without any labels every score is 0.5. Repeated rows get equal scores; other columns are ignored.
    """
    scored = score_documents(docs.select("doc_id", "text"), train(docs, labels, sample))
    return scored.select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def good_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` predicted to be good, with their columns as they are."""
    names = docs.columns
    space = train(docs, labels, sample)
    plain = docs.select(F.col("text"), *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(names)])
    good = score_documents(plain, space).where(F.col("quality_score") >= THRESHOLD)
    return good.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(names)])


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
