"""Language-model scores: a hashed maximum-entropy model with a class-factored softmax, beside a unigram base.

A word is a leaf of a tree of classes: each node's children are classes of classes or of words, and a softmax over them
is one factor of the word's chance. Classes come from the counts (a Huffman code of ``WAYS`` digits), so that a word
costs about as many factors as its surprise, and every factor sees the features of the context.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.llm.common import staged, table

#: The end of a text as a token; no word contains white space.
END = "\n"
#: Words with a leaf of their own: the most frequent ones of at most so many bytes. All others share one leaf and part
#: it by their counts.
FREQUENT = 200_000
FREQUENT_BYTES = 48
#: Children of a node, at most.
WAYS = 16
#: Kinds of features: the word before, the two skipped to before that, and the pair before.
KINDS = 4
#: Rows of weights that features are hashed into: a power of two near ``ROWS_PER_ROOT`` times the square root of the
#: training tokens, within these bounds; so all weights that are sent to tasks take 64 MiB at most.
ROWS_PER_ROOT = 32
LEAST_ROWS, MOST_ROWS = 1 << 12, 1 << 20
#: Training documents are dealt over so many rounds; the weights are averaged after each.
ROUNDS = 3
#: Tokens that a task trains on in a round, about; the number of tasks follows from the documents alone.
TASK_TOKENS = 6_000_000
RATE = 0.15
#: What the squares of the gradients begin with: how slowly a row that is met rarely moves.
CAUTION = 20
#: Sums of weights beyond this count as this: no child is more than exp(2 * LIMIT) times as likely as another.
LIMIT = np.float32(80)
# Tokens of one gradient step: more of them share rows of weights, which are then fetched and written once.
_STEP = 32768
# Rows that are worked on at once, so that they stay in the cache of a core while several sums pass over them.
_BLOCK = 16384
_SLICE = 1000
# What one row of weights is in bytes, to move rows at once; and pairs of weights, to add two at once.
_ROW, _PAIR = f"V{4 * WAYS}", np.complex64
_ONES = np.ones(WAYS, np.float32)


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


@dataclass(frozen=True)
class Tokens:
    """The tokens of some texts in a row, each text with its end, as codes into its different words."""

    words: pa.Array
    code: np.ndarray
    starts: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.starts)


def tokens_of(texts: pa.Array) -> Tokens:
    """Lower-cased words and one end for each text; ``words[0]`` is the end."""
    listed = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    first = listed.offsets.to_numpy()
    coded = listed.values.slice(first[0], first[-1] - first[0]).dictionary_encode()
    code = coded.indices.to_numpy() + 1
    # White space at either end of a text leaves an empty part.
    blank = pc.index(coded.dictionary, "").as_py()
    real = code != blank + 1 if blank >= 0 else np.ones(len(code), bool)
    ends = np.concatenate([[0], np.cumsum(real)])[first - first[0]]
    words = pa.concat_arrays([pa.array([END]), coded.dictionary.cast(pa.string())])
    return Tokens(words, np.insert(code[real], ends[1:], 0), ends + np.arange(len(ends)))


def _hashes(words: pa.Array) -> np.ndarray:
    return np.array([zlib.crc32(w) for w in words.cast(pa.binary()).to_pylist()], np.uint32)


@dataclass(frozen=True)
class Tree:
    """A Huffman tree: leaf ``i`` is reached by ``digit[a:b]`` at the nodes ``node[a:b]``, from ``start[i]`` to the next.

    ``bias`` has a row for each node, the logarithms of its children's shares; children it lacks have no chance.
    """

    start: np.ndarray
    node: np.ndarray
    digit: np.ndarray
    bias: np.ndarray


def tree_of(counts: np.ndarray) -> Tree:
    """The tree of leaves with these counts; ties go to the earlier leaf."""
    n = len(counts)
    # Empty leaves make the last node as full as the others.
    empty = -(n - 1) % (WAYS - 1) if n > 1 else WAYS - 1
    heap = [(0.0, -1 - k, None) for k in range(empty)] + [(float(c) + 1, i, i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    children: list[list] = []
    while True:
        some = [heapq.heappop(heap) for _ in range(min(WAYS, len(heap)))]
        children.append([(weight, key) for weight, _, key in some])
        if not heap:
            break
        heapq.heappush(heap, (sum(w for w, _, _ in some), n + len(children), n + len(children) - 1))
    bias = np.full((len(children), WAYS), -1e9, np.float32)
    paths: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    # The root comes last; from there down, each node knows its own path.
    above: dict[int, list[tuple[int, int]]] = {len(children) - 1: []}
    for node in range(len(children) - 1, -1, -1):
        path, total = above.pop(node), sum(w for w, _ in children[node])
        for digit, (weight, key) in enumerate(children[node]):
            if key is None:
                continue
            bias[node, digit] = np.log(weight / total)
            if key < n:
                paths[key] = [*path, (node, digit)]
            else:
                above[key - n] = [*path, (node, digit)]
    start = np.concatenate([[0], np.cumsum([len(p) for p in paths])])
    flat = np.array([step for p in paths for step in p], np.int32).reshape(-1, 2)
    return Tree(start, flat[:, 0].copy(), flat[:, 1].copy(), bias)


def _steps(tree: Tree, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which leaf of the given ones, which node and which digit, for each step down to each of them."""
    sizes = tree.start[leaves + 1] - tree.start[leaves]
    ends = np.cumsum(sizes)
    at = np.repeat(tree.start[leaves] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
    return np.repeat(np.arange(len(leaves)), sizes), tree.node[at], tree.digit[at]


def contexts(tokens: Tokens) -> np.ndarray:
    """A value for each token and kind: the word before, the ones skipped to before that, and the pair before."""
    at = np.arange(len(tokens.code)) - np.repeat(tokens.starts[:-1], tokens.sizes)
    return _contexts(_hashes(tokens.words)[tokens.code], at, 0, len(at))


def _contexts(hashed: np.ndarray, at: np.ndarray, first: int, end: int) -> np.ndarray:
    """The contexts of some tokens, from the hashes of all and the place of each in its text."""
    out = np.empty((end - first, KINDS), np.uint64)
    for k in (1, 2, 3):
        start = max(first, k)
        out[: start - first, k - 1] = k
        out[start - first :, k - 1] = hashed[start - k : max(end, start) - k]
        out[at[first:end] < k, k - 1] = k
    out[:, 3] = out[:, 0] * np.uint64(31) + (out[:, 1] << np.uint64(20))
    return out


def weight_rows(before: np.ndarray, nodes: np.ndarray, n_nodes: int, size: int) -> np.ndarray:
    """Which weight rows each step adds up: in the first line its node's bias, then the hash of node and context of each kind."""
    out = np.empty((1 + KINDS, len(nodes)), np.intp)
    out[0] = nodes
    own = nodes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    shift = np.uint64(64 - (size.bit_length() - 1))
    for kind in range(KINDS):
        mixed = before[:, kind] + np.uint64(kind + 1)
        mixed *= np.uint64(0xA0761D6478BD642F)
        mixed ^= own
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed >>= shift
        np.add(mixed.view(np.int64), n_nodes, out=out[1 + kind])
    return out


class Scratch:
    """Arrays that are used again for each step: fetching new memory for them takes longer than filling them."""

    def __init__(self) -> None:
        self._held: dict[str, np.ndarray] = {}

    def array(self, name: str, shape: tuple[int, ...], dtype: type = np.float32) -> np.ndarray:
        size = int(np.prod(shape))
        held = self._held.get(name)
        if held is None or held.size < size:
            held = self._held[name] = np.empty(size + size // 4, dtype)
        return held[:size].reshape(shape)

    def rows(self, name: str, table: np.ndarray, at: np.ndarray) -> np.ndarray:
        # "clip" alone writes to ``out`` without a copy; every place given is within the table.
        out = self.array(name, (len(at), WAYS))
        table.view(_ROW)[:, 0].take(at, out=out.view(_ROW)[:, 0], mode="clip")
        return out


def _blocks(n: int) -> Iterator[slice]:
    for at in range(0, n, _BLOCK):
        yield slice(at, min(at + _BLOCK, n))


def _logits(weights: np.ndarray, rows: np.ndarray, scratch: Scratch) -> np.ndarray:
    """The weight of each child at each step, cut where its exponential would leave the range of the type."""
    logits = scratch.rows("logits", weights, rows[0])
    for kind in rows[1:]:
        logits += scratch.rows("fetched", weights, kind)
    return np.clip(logits, -LIMIT, LIMIT, out=logits)


def log_chances(weights: np.ndarray, rows: np.ndarray, digits: np.ndarray, scratch: Scratch) -> np.ndarray:
    """The natural logarithm of the softmax at each step's own digit."""
    out = np.empty(len(digits), np.float32)
    for some in _blocks(len(digits)):
        logits = _logits(weights, rows[:, some], scratch)
        own = logits.ravel()[np.arange(len(logits)) * WAYS + digits[some]]
        out[some] = own - np.log(np.exp(logits, out=logits) @ _ONES)
    return out


def _update(
    weights: np.ndarray, squares: np.ndarray, place: np.ndarray, rows: np.ndarray, digits: np.ndarray, scratch: Scratch
) -> None:
    """One step of AdaGrad over the gradient of a few tokens; ``place`` has -1 for each row of weights."""
    # Columns two at once, as sums by row of weights are taken: several times faster than sorting the steps by row.
    pairs = scratch.array("pairs", (WAYS // 2, len(digits)), _PAIR)
    for some in _blocks(len(digits)):
        gradient = _logits(weights, rows[:, some], scratch)
        np.exp(gradient, out=gradient)
        gradient /= (gradient @ _ONES)[:, None]
        gradient.ravel()[np.arange(len(gradient)) * WAYS + digits[some]] -= 1
        pairs[:, some] = gradient.view(_PAIR).T
    place[rows.ravel()] = 0
    touched = np.flatnonzero(place == 0)
    place[touched] = np.arange(len(touched), dtype=np.int32)
    into = scratch.array("into", rows.shape, np.intp)
    for kind, to in zip(rows, into):
        to[:] = place.take(kind)
    place[touched] = -1
    sums = scratch.array("sums", (WAYS // 2, len(touched)), _PAIR)
    sums[:] = 0
    for column, values in zip(sums, pairs):
        for to in into:
            np.add.at(column, to, values)
    for some in _blocks(len(touched)):
        at = touched[some]
        total = scratch.array("total", (len(at), WAYS))
        total.view(_PAIR)[:] = sums[:, some].T
        grown = scratch.rows("grown", squares, at)
        grown += np.multiply(total, total, out=scratch.array("square", total.shape))
        squares.view(_ROW)[at] = grown.view(_ROW)
        grown += CAUTION
        np.sqrt(grown, out=grown)
        total *= -RATE
        total /= grown
        total += scratch.rows("square", weights, at)
        weights.view(_ROW)[at] = total.view(_ROW)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _SLICE):
            yield batch.slice(at, _SLICE)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        tokens = tokens_of(batch.column(0))
        counts = np.bincount(tokens.code, minlength=len(tokens.words))
        used = np.flatnonzero(counts)
        yield pa.record_batch([tokens.words.take(pa.array(used)), pa.array(counts[used])], names=["word", "c"])


@dataclass(frozen=True)
class Model:
    """What scoring sends to tasks: the tree, the weights, and the words with leaves; all bounded by the constants.

    Leaf 0 is the end, then the words of ``words``, and the last is that of all other words.
    """

    tree: Tree
    weights: np.ndarray
    words: pa.Array
    counts: np.ndarray
    #: Training tokens and different words; of those without a leaf of their own, too.
    n_tokens: int
    n_words: int
    rare_tokens: int
    rare_words: int
    #: The hashes of the leaves' words.
    hashes: np.ndarray

    @property
    def size(self) -> int:
        return len(self.weights) - len(self.tree.bias)

    def leaves(self, words: pa.Array) -> np.ndarray:
        found = pc.index_in(words, value_set=self.words)
        return pc.fill_null(found, len(self.words)).to_numpy().astype(np.int64)

    def steps(self, tokens: Tokens, leaf: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The token, the weight rows and the digit of each step, some tokens at a time."""
        hashes = np.append(self.hashes, np.uint32(0))[leaf]
        rare = np.flatnonzero(leaf == len(self.words))
        hashes[rare] = _hashes(tokens.words.take(pa.array(rare)))
        hashed = hashes[tokens.code]
        at = np.arange(len(hashed)) - np.repeat(tokens.starts[:-1], tokens.sizes)
        for first in range(0, len(hashed), _STEP):
            end = min(first + _STEP, len(hashed))
            token, nodes, digits = _steps(self.tree, leaf[tokens.code[first:end]])
            rows = weight_rows(_contexts(hashed, at, first, end)[token], nodes, len(self.tree.bias), self.size)
            yield token + first, rows, digits


def _train(model: Model):
    """The changes that a pass over the task's own documents makes to the weights, row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, squares = model.weights.copy(), np.zeros_like(model.weights)
        place, scratch = np.full(len(mine), -1, np.int32), Scratch()
        for batch in _slices(batches):
            tokens = tokens_of(batch.column(0))
            for _, rows, digits in model.steps(tokens, model.leaves(tokens.words)):
                _update(mine, squares, place, rows, digits, scratch)
        moved = np.flatnonzero((squares > 0).any(axis=1))
        for at in range(0, len(moved), 1 << 16):
            some = moved[at : at + (1 << 16)]
            change = mine[some] - model.weights[some]
            yield pa.record_batch(
                [pa.array(some, pa.int64()), *[pa.array(change[:, k].copy()) for k in range(WAYS)]],
                names=["row", *[f"w{k}" for k in range(WAYS)]],
            )

    return run


def _least_count(words: DataFrame) -> int:
    """The least count for which no more than ``FREQUENT`` words have it, to an eighth of an octave."""
    step = F.floor(8 * F.log2("c"))
    left = FREQUENT
    least = None
    for r in words.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c")).orderBy(F.desc("step")).collect():
        left -= r.n
        if left < 0:
            break
        least = r.c
    return 1 << 62 if least is None else least


def train(docs: DataFrame) -> tuple[Model, DataFrame]:
    """Fit on the documents not held out; with the model, the counts of all their words as a staged table.

    Word counts are exact: tasks count their own, Spark sums. Documents are dealt by a hash to rounds and, in each, to as
    many shards as their tokens ask for, in an order of their own, so the same documents give the same model on any
    cluster. The shards of a round start from the same weights and update their own copy by the gradient of every
    document of theirs; for each row, the changes are averaged over the shards that made one.
    """
    chosen = docs.where(~is_held_out(F.col("doc_id")))
    counted = chosen.select("text").mapInArrow(_count, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))
    vocabulary = staged(counted, "lm_words")
    total = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    short = vocabulary.where((F.octet_length("word") <= FREQUENT_BYTES) & (F.col("word") != END))
    frequent = short.where(F.col("c") >= _least_count(short)).toPandas().sort_values(["c", "word"], ascending=[False, True])
    ends = vocabulary.where(F.col("word") == END).first()
    counts = np.array([ends.c if ends else 0, *frequent["c"]], np.int64)
    rare_tokens, rare_words = total[0] - int(counts.sum()), total[1] - len(frequent) - (ends is not None)

    tree = tree_of(np.append(counts, rare_tokens))
    size = 1 << int(round(np.log2(ROWS_PER_ROOT * max(1, total[0]) ** 0.5)))
    size = min(MOST_ROWS, max(LEAST_ROWS, size))
    weights = np.concatenate([tree.bias, np.zeros((size, WAYS), np.float32)])
    words = pa.array([END, *frequent["word"]], pa.string())
    model = Model(tree, weights, words, counts, total[0], total[1], rare_tokens, rare_words, _hashes(words))
    shards = max(1, -(-total[0] // (ROUNDS * TASK_TOKENS)))
    dealt = chosen.select("text", F.xxhash64("doc_id", "text").alias("h"))
    for k in range(ROUNDS):
        part = dealt.where(F.pmod("h", F.lit(ROUNDS)) == k)
        part = part.withColumn("shard", F.pmod(F.shiftright("h", 8), F.lit(shards)).cast("int")).repartitionById(shards, "shard")
        changes = part.sortWithinPartitions("h", "text").select("text").mapInArrow(
            _train(model), "row long, " + ", ".join(f"w{k} float" for k in range(WAYS))
        )
        mean = changes.groupBy("row").agg(*[F.avg(f"w{k}").cast("float").alias(f"w{k}") for k in range(WAYS)]).toArrow()
        weights = model.weights.copy()
        weights[mean["row"].to_numpy()] += np.stack([mean[f"w{k}"].to_numpy() for k in range(WAYS)], axis=1)
        model = replace(model, weights=weights)
    return model, vocabulary


_SCANNED = "doc_id long, n_tokens long, n_known long, log_counts double, log_leaves double, n_rare long, rare array<string>"


def _scan(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scratch = Scratch()
        for batch in _slices(batches):
            tokens = tokens_of(batch.column(1))
            leaf = model.leaves(tokens.words)
            is_rare = (leaf == len(model.words))[tokens.code]
            known = np.append(model.counts, 0)[leaf][tokens.code]
            chance = np.zeros(len(tokens.code))
            for token, rows, digits in model.steps(tokens, leaf):
                chance += np.bincount(token, log_chances(model.weights, rows, digits, scratch), len(chance))
            first = tokens.starts[:-1]

            def of_each(values: np.ndarray) -> np.ndarray:
                return np.add.reduceat(values, first) if len(first) else values[:0]

            ends = np.concatenate([[0], np.cumsum(is_rare)])[tokens.starts]
            rare = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), tokens.words.take(pa.array(tokens.code[is_rare]))
            )
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array(tokens.sizes, pa.int64()),
                    pa.array(of_each((known > 0).astype(np.int64)), pa.int64()),
                    pa.array(of_each(np.log10(known + 1.0))),
                    pa.array(of_each(chance / np.log(10))),
                    pa.array(np.diff(ends), pa.int64()),
                    rare,
                ],
                names=["doc_id", "n_tokens", "n_known", "log_counts", "log_leaves", "n_rare", "rare"],
            )

    return run


def lm_scores(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs``.

    A word's chance is the product of the softmaxes on its way down the tree, each with the features of the context; a
    word without a leaf of its own has its share of the leaf that all such words have, by count, with one place for what
    was never seen. Counts of words with leaves are at hand in each task; the other words of each document are joined
    with the counts of the whole vocabulary, so no word is cut off and no hot word is shuffled. Null, empty and blank
    texts are one end. A null ``doc_id`` is never held out. Rows that share an id are documents of their own. Without
    training documents, all counts are 0 and the end and other words are equally likely.
    """
    docs = docs.select("doc_id", "text")
    model, vocabulary = train(docs)
    scanned = docs.mapInArrow(_scan(model), _SCANNED)
    scanned = staged(scanned.withColumn("row", F.monotonically_increasing_id()), "lm_scan", "zstd")
    rare = scanned.select("row", F.explode("rare").alias("word")).join(vocabulary, "word")
    rest = rare.groupBy("row").agg(
        F.count(F.lit(1)).alias("more_known"), F.sum(F.log10(F.col("c") + F.lit(1.0))).alias("more_counts")
    )
    more = F.coalesce("more_counts", F.lit(0.0))
    rare_mass = F.lit(float(np.log10(model.rare_tokens + model.rare_words + 1)))
    return scanned.drop("rare").join(rest, "row", "left").select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        (
            F.col("log_counts") + more - F.col("n_tokens") * F.lit(float(np.log10(model.n_tokens + model.n_words + 1)))
        ).alias("base_score"),
        (F.col("log_leaves") + more - F.col("n_rare") * rare_mass).alias("score"),
    )


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))
