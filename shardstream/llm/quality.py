"""Quality classifier: random-indexing word vectors pooled per document, a two-layer network, calibrated probabilities."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import MEMO_WORDS, hashed_fold, map_batches, pass_over, small_batches, some_at_a_time, text_bytes

DIMENSIONS = 48
# Terms of the vector space: hashed words, and hashed shapes of words. Fixed sizes bound the tables that are broadcast.
WORD_TERMS, SHAPE_TERMS = 1 << 13, 1 << 11
TERMS = WORD_TERMS + SHAPE_TERMS
NONZERO = 4
# The classifier is fitted on at most this many labelled rows, those with the lowest hash of their id.
SAMPLE = 20_000
# Terms whose neighbours are counted at once.
PAIRS = 1 << 18
HIDDEN, EPOCHS, BATCH, RATE, DECAY, SEED = 24, 60, 256, 3e-3, 1e-4, 7
FOLDS, HELD_OUT = 5, 0
REJECT_BELOW = 0.3


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of each term's random index vector."""
    made = np.random.default_rng(SEED)
    places = np.argsort(made.random((TERMS, DIMENSIONS)), axis=1)[:, :NONZERO].astype(np.int64)
    return places, made.choice([-1, 1], (TERMS, NONZERO)).astype(np.int64)


_RUN = re.compile(rb"(.)\1+", re.DOTALL)
_SHAPES = bytes(
    ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 or b >= 0x80 else ord("0") if 48 <= b <= 57 else b for b in range(256)
)


class Terms(dict):
    """The (word term, shape term, shape term after the same word) of a word."""

    def __missing__(self, word: bytes) -> int:
        shape = _RUN.sub(rb"\1", word.translate(_SHAPES))[:16]
        w = xxhash.xxh3_64_intdigest(word.lower()) % WORD_TERMS
        s, again = (WORD_TERMS + xxhash.xxh3_64_intdigest(x) % SHAPE_TERMS for x in (shape, b"=" + shape))
        self[word] = value = (w << 32) | (s << 16) | again
        return value

    def of(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Word terms and shape terms of a text, in order; a word that repeats the one before has a shape of its own."""
        if len(self) > MEMO_WORDS:
            self.clear()
        words = data.split()
        codes = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        shapes = (codes >> 16) & 0xFFFF
        again = np.zeros(len(codes), bool)
        again[1:] = codes[1:] == codes[:-1]
        return codes >> 32, np.where(again, codes & 0xFFFF, shapes)


def context_sums(docs: DataFrame) -> np.ndarray:
    """For each term, the sum of the index vectors of its neighbours over all documents: TERMS rows of whole numbers.

    Every task adds up its documents and hands on one row a term, so the shuffle and the result have a fixed size a task.
    """
    columns = [f"x{i}" for i in range(DIMENSIONS)]

    def run(parts):
        memo, (places, signs) = Terms(), index_vectors()
        total = np.zeros(TERMS * DIMENSIONS, np.float64)
        for part in parts:
            for centers, around in _neighbours(memo, (data for (some,) in some_at_a_time(part["data"]) for data in some)):
                for j in range(NONZERO):
                    total += np.bincount(centers * DIMENSIONS + places[around, j], signs[around, j], len(total))
        sums = total.reshape(TERMS, DIMENSIONS).astype(np.int64)
        used = np.flatnonzero(np.abs(sums).sum(1))
        yield {"term": pa.array(used), **{c: pa.array(sums[used, i]) for i, c in enumerate(columns)}}

    made = pass_over(docs, {"data": text_bytes()}, "term long, " + ", ".join(f"{c} long" for c in columns), run)
    sums = made.groupBy("term").agg(*[F.sum(c).alias(c) for c in columns])
    out = np.zeros((TERMS, DIMENSIONS))
    for row in sums.collect():
        out[row[0]] = row[1:]
    return out


def _neighbours(memo: Terms, texts: Iterable[bytes], most: int = PAIRS):
    """Pairs of terms next to each other, within words and within shapes, in arrays of bounded size."""
    held, size = [], 0
    for data in texts:
        for line in memo.of(data):
            for at in range(0, len(line) - 1, most):
                part = line[at : at + most + 1]
                held.append(part)
                size += len(part)
                if size >= most:
                    yield _both(held)
                    held, size = [], 0
    if held:
        yield _both(held)


def _both(lines: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    left, right = np.concatenate([x[:-1] for x in lines]), np.concatenate([x[1:] for x in lines])
    return np.concatenate([left, right]), np.concatenate([right, left])


def unit_vectors(sums: np.ndarray) -> np.ndarray:
    """Word vectors: own index vector for what a term is, context for what it is like, at length 1 each."""
    places, signs = index_vectors()
    own = np.zeros_like(sums)
    np.put_along_axis(own, places, signs.astype(float), 1)
    norm = np.linalg.norm(sums, axis=1, keepdims=True)
    return np.hstack([own / np.sqrt(NONZERO), sums / np.maximum(norm, 1)]).astype(np.float32)


def pooled(words: np.ndarray, shapes: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    n = len(words)
    if not n:
        return np.zeros(2 * vectors.shape[1] + 1, np.float32)
    means = [np.bincount(terms, minlength=0) for terms in (words, shapes)]
    parts = []
    for counts in means:
        used = np.flatnonzero(counts)
        parts.append((counts[used] / n).astype(np.float32) @ vectors[used])
    return np.concatenate([*parts, [np.float32(np.log1p(n) / 10)]]).astype(np.float32)


@dataclass
class Network:
    """A hidden layer of tanh units and a logistic output, with the scale of its inputs and a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh(((x - self.mean) / self.scale) @ w1 + b1) @ w2 + b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def fitted(x: np.ndarray, y: np.ndarray) -> Network:
    """Adam on the logistic loss over four fifths of the rows; the temperature makes the loss on the last fifth least."""
    made = np.random.default_rng(SEED)
    order = made.permutation(len(x))
    held, used = order[: len(x) // 5], order[len(x) // 5 :]
    net = Network(x[used].mean(0), x[used].std(0) + 1e-3, [
        made.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), made.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(()),
    ])
    z = (x - net.mean) / net.scale
    first, second, step = [np.zeros_like(p) for p in net.layers], [np.zeros_like(p) for p in net.layers], 0
    for _ in range(EPOCHS):
        for at in range(0, len(used), BATCH):
            rows = used[at : at + BATCH]
            w1, b1, w2, b2 = net.layers
            hidden = np.tanh(z[rows] @ w1 + b1)
            wrong = (1 / (1 + np.exp(-np.clip(hidden @ w2 + b2, -30, 30))) - y[rows]) / len(rows)
            back = np.outer(wrong, w2) * (1 - hidden**2)
            grads = [z[rows].T @ back + DECAY * w1, back.sum(0), hidden.T @ wrong + DECAY * w2, wrong.sum()]
            step += 1
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                net.layers[i] = net.layers[i] - RATE * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
        made.shuffle(used)
    if len(held):
        logits = net.logits(x[held])
        losses = {t: np.logaddexp(0, -np.where(y[held] > 0, 1, -1) * logits / t).mean() for t in np.geomspace(0.25, 8, 61)}
        net.temperature = float(min(losses, key=losses.get))
    return net


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The text (of repeated rows the least) and label of each labelled document; as many rows as ``labels``, dealt by doc_id."""
    return docs.select("doc_id", "text").join(F.broadcast(labels), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))


def training_labels(labels: DataFrame, label: str, folds: int, held_out: int, sample: int) -> DataFrame:
    """At most ``sample`` labelled ids outside the held-out fold, lowest hashes first; labels that disagree count by majority."""
    usable = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).filter(hashed_fold("doc_id", folds) != held_out)
    once = usable.groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("label"))
    return once.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)


@dataclass
class Model:
    """Word vectors and the network; without labels of both kinds, the share of good labels instead of a network."""

    vectors: np.ndarray
    network: Network | None
    share: float = 1.0

    def scores(self, texts: list[bytes], memo: Terms) -> np.ndarray:
        if self.network is None or not texts:
            return np.full(len(texts), self.share)
        return self.network.probabilities(np.array([pooled(*memo.of(t), self.vectors) for t in texts], np.float64))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Word vectors from all documents, the network from at most ``sample`` labelled ones."""
    vectors = unit_vectors(context_sums(docs))
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    chosen = training_labels(labels, "quality", FOLDS, HELD_OUT, sample)
    known = labelled_texts(docs, chosen)

    def run(parts):
        memo = Terms()
        for part in parts:
            yield {"label": part["label"], "features": [pooled(*memo.of(data), shared.value) for data in part["data"].to_pylist()]}

    rows = pass_over(known, {"label": F.col("label"), "data": text_bytes()}, "label int, features array<float>", run).toArrow()
    y = rows["label"].to_numpy().astype(np.float64)
    if len(np.unique(y)) < 2:
        return Model(vectors, None, float(y.mean()) if len(y) else 1.0)
    x = np.asarray(rows["features"].combine_chunks().flatten(), np.float64).reshape(len(y), -1)
    by_content = np.lexsort(np.column_stack([y, x[:, :8]]).T)  # the order of tasks must not decide how training goes
    return Model(vectors, fitted(x[by_content], y[by_content]))


def quality_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The probability that each document is of good quality: doc_id, score.

    Word vectors come from the whole table: each word's and each word shape's neighbours, by random indexing. A document is the
    means of its words' and shapes' vectors; a two-layer network, fitted on at most ``sample`` labelled documents
    outside the held-out fold, scores it. Null and empty texts pool to zeros and are scored like any text; equal
    texts score alike; without labels of both kinds every score is the share of good labels (1 without any label);
    an empty table gives no rows. A text of any length is read whole, in one task, with a few numbers held for each of its words. Only the
    text is an input, and no pass shuffles texts but those of the sample; other columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample))

    def run(parts):
        memo = Terms()
        for part in parts:
            yield {"doc_id": part["doc_id"], "score": pa.array(model.value.scores(part["data"].to_pylist(), memo))}

    return pass_over(docs, {"doc_id": F.col("doc_id"), "data": text_bytes()}, "doc_id void, score double", run)


def good_documents(docs: DataFrame, labels: DataFrame, least: float = REJECT_BELOW, sample: int = SAMPLE) -> DataFrame:
    """The documents that score at least ``least``, with all their columns as they were.

    Rows are judged one by one, also those that repeat or have no id; null and empty texts are scored as :func:`quality_scores` scores
    them; an empty table stays empty. Long texts are read whole.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample))
    at = docs.columns.index("text")

    def run(batches):
        memo = Terms()
        for batch in small_batches(batches, at):
            texts = [(t or "").encode() for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(model.value.scores(texts, memo) >= least))

    return map_batches(docs, run, docs.schema)
