"""A quality classifier on random-indexing word vectors.

A word counts twice, as itself (its letters and digits in lower case) and as its
shape (the runs of character classes it is made of), both hashed into fixed
tables. Every entry has a sparse random index vector. Its context vector is the
sum of the index vectors of all words beside it, over all documents that may be
learned from: tasks sum up what they see and the sums meet by entry. A document is
the mean of its words' index and context vectors, with a few figures of
length and repetition. A network of
two layers in NumPy learns the labels, and a temperature fitted on rows that the
network has not seen turns its outputs into probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.common import learnable, shuffle_partitions, slices

#: At most so many labelled documents are learned from: those of the smallest hashed ids.
LABELLED = 20_000
THRESHOLD = 0.7
WORD_ENTRIES = 3072
SHAPE_ENTRIES = 1024
ENTRIES = WORD_ENTRIES + SHAPE_ENTRIES
DIMS = 64
_NONZERO = 2
_CHUNK = 16
_HIDDEN = 32
_EXTRA = 6
FEATURES = 2 * DIMS + _EXTRA
_SEED = 20


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero parts of each entry's index vector."""
    rng = np.random.default_rng(_SEED)
    places = rng.integers(0, DIMS // _NONZERO, (ENTRIES, _NONZERO))
    places += np.arange(_NONZERO) * (DIMS // _NONZERO)
    return places, rng.choice([-1.0, 1.0], (ENTRIES, _NONZERO))


def _classes() -> np.ndarray:
    """Class of each byte: 0 white space, 1 small, 2 capital, 3 digit, else the byte itself."""
    table = np.arange(256, dtype=np.uint8)
    table[[9, 10, 11, 12, 13, 32]] = 0
    table[ord("a") : ord("z") + 1] = 1
    table[128:] = 1  # parts of other letters
    table[ord("A") : ord("Z") + 1] = 2
    table[ord("0") : ord("9") + 1] = 3
    return table


def _spread(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
        return h ^ (h >> np.uint64(30))


def _powers(base: int, count: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([[1], np.full(count - 1, base, np.uint64)]).astype(np.uint64))


def entries(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word entry and shape entry of every word of the texts, and words per text."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    kinds = _classes()[data]
    inside = kinds > 0
    begins = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    if not len(begins):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(texts), np.int64)
    places = np.flatnonzero(inside)
    kinds, letters = kinds[places], data[places].astype(np.uint64)
    # Positions within the word, over the bytes of words only.
    first = np.searchsorted(places, begins)
    lengths = np.diff(first, append=len(places))
    position = np.arange(len(places)) - np.repeat(first, lengths)
    with np.errstate(over="ignore"):
        lower = np.where(kinds == 2, letters + np.uint64(32), letters)
        told = np.where(kinds <= 3, lower, np.uint64(0))
        steps = _powers(0x5851F42D4C957F2D, int(lengths.max()))
        words = np.add.reduceat(told * steps[position], first)
        runs = np.append(True, (kinds[1:] != kinds[:-1]) | (position[1:] == 0))
        run = np.cumsum(runs) - 1
        run -= np.repeat(run[first], lengths)
        shape = np.where(runs, (kinds.astype(np.uint64) + np.uint64(1)) * steps[run], np.uint64(0))
        shapes = np.add.reduceat(shape, first)
    ends = np.cumsum(np.array([len(t) + 1 for t in texts], np.int64))
    counts = np.diff(np.searchsorted(begins, ends), prepend=0)
    word = (_spread(words) >> np.uint64(20)) % np.uint64(WORD_ENTRIES)
    form = (_spread(shapes) >> np.uint64(20)) % np.uint64(SHAPE_ENTRIES)
    return word.astype(np.int64), form.astype(np.int64) + WORD_ENTRIES, counts


def context_sums(texts: list[bytes]) -> np.ndarray:
    """For every entry, the sum of the index vectors of the words next to it."""
    places, signs = _index_vectors()
    word, shape, counts = entries(texts)
    out = np.zeros(ENTRIES * DIMS)
    if len(word) < 2:
        return out.reshape(ENTRIES, DIMS)
    owner = np.repeat(np.arange(len(counts)), counts)
    pair = np.flatnonzero(owner[1:] == owner[:-1])
    for own in (word, shape):
        for other in (word, shape):
            for a, b in ((pair, pair + 1), (pair + 1, pair)):
                at = own[a, None] * DIMS + places[other[b]]
                out += np.bincount(at.ravel(), signs[other[b]].ravel(), ENTRIES * DIMS)
    return out.reshape(ENTRIES, DIMS)


def _pooled(texts: list[bytes], contexts: np.ndarray) -> np.ndarray:
    """Features of each text; a text without words has zeros."""
    places, signs = _index_vectors()
    index = np.zeros((ENTRIES, DIMS), np.float32)
    np.put_along_axis(index, places, signs, axis=1)
    word, shape, counts = entries(texts)
    used = np.flatnonzero(counts)
    out = np.zeros((len(texts), FEATURES), np.float32)
    if not len(used):
        return out
    table = np.concatenate([index, contexts.astype(np.float32)], axis=1)
    # Count entries per text first: the mean is then one product per text.
    ends = np.cumsum(counts)
    same = np.append(False, word[1:] == word[:-1])
    for t in used.tolist():
        own = slice(int(ends[t] - counts[t]), int(ends[t]))
        seen = np.bincount(word[own], minlength=ENTRIES) + np.bincount(shape[own], minlength=ENTRIES)
        at = np.flatnonzero(seen)
        share = (seen[at] / (2 * counts[t])).astype(np.float32)
        out[t, : 2 * DIMS] = share @ table[at]
        out[t, 2 * DIMS] = np.sqrt((share**2).sum())
        out[t, 2 * DIMS + 1] = share.max()
        out[t, 2 * DIMS + 2] = len(at) / (2 * counts[t])
        out[t, 2 * DIMS + 3] = np.log1p(counts[t])
        out[t, 2 * DIMS + 4] = same[own][1:].sum() / counts[t]  # words that follow themselves
        out[t, 2 * DIMS + 5] = len(at) / np.sqrt(2 * counts[t])
    return out


def _bytes_of(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def learned_contexts(texts: DataFrame) -> np.ndarray:
    """Context vectors over all rows of ``text``, scaled to length one.

    A task sums up its own rows; the sums travel in chunks of a few entries and
    are added as they arrive. The whole table has a fixed size.
    """

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((ENTRIES, DIMS))
        for batch in slices(batches):
            total += context_sums(_bytes_of(batch))
        parts = total.reshape(-1, _CHUNK * DIMS)
        at = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(at, pa.int32()),
                pa.array([parts[i].astype("<f8").tobytes() for i in at], pa.binary()),
            ],
            names=["chunk", "sums"],
        )

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            pairs = zip(batch.column("chunk").to_pylist(), batch.column("sums"), strict=True)
            for chunk, part in pairs:
                part = np.frombuffer(part.as_buffer(), "<f8")
                totals[chunk] = totals[chunk] + part if chunk in totals else part
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(totals), pa.int32()),
                pa.array([t.tobytes() for t in totals.values()], pa.binary()),
            ],
            names=["chunk", "sums"],
        )

    schema = "chunk int, sums binary"
    parts = shuffle_partitions(texts.sparkSession)
    rows = texts.mapInArrow(summed, schema).repartition(parts, "chunk").mapInArrow(added, schema)
    table = np.zeros((ENTRIES // _CHUNK, _CHUNK * DIMS))
    for row in rows.collect():  # the fixed number of chunks
        table[row["chunk"]] = np.frombuffer(row["sums"], "<f8")
    table = table.reshape(ENTRIES, DIMS)
    length = np.sqrt((table**2).sum(axis=1, keepdims=True))
    return (table / np.where(length > 0, length, 1)).astype(np.float32)


@dataclass
class Model:
    """Everything a task needs to score texts."""

    contexts: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    temperature: float
    prior: float | None  # the only answer, where there was nothing to learn from

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Probability of label 1 for each text."""
        if self.prior is not None:
            return np.full(len(texts), self.prior)
        features = (_pooled(texts, self.contexts) - self.mean) / self.scale
        return _sigmoid(_outputs(features, self.weights)[1] / self.temperature)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _outputs(x: np.ndarray, weights: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    a, b, c, d = weights
    hidden = np.maximum(x @ a + b, 0)
    return hidden, (hidden @ c + d)[:, 0]


def _trained(x: np.ndarray, y: np.ndarray, epochs: int = 60) -> list[np.ndarray]:
    """Two layers, by Adam on small batches, rare labels weighing as much as common ones."""
    rng = np.random.default_rng(_SEED)
    weights = [
        rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], _HIDDEN)),
        np.zeros(_HIDDEN),
        rng.normal(0, np.sqrt(1 / _HIDDEN), (_HIDDEN, 1)),
        np.zeros(1),
    ]
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    size, t = 256, 0
    epochs = max(epochs, min(600, 60 * 2000 // max(len(x), 1)))
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        rate = 3e-3 * (1 - epoch / epochs) + 1e-4
        for k in range(0, len(x), size):
            some = order[k : k + size]
            inputs, wanted = x[some], y[some]
            hidden, out = _outputs(inputs, weights)
            error = (_sigmoid(out) - wanted)[:, None] / len(some)
            back = error @ weights[2].T * (hidden > 0)
            slopes = [inputs.T @ back, back.sum(0), hidden.T @ error, error.sum(0)]
            t += 1
            for i, slope in enumerate(slopes):
                slope = slope + 1e-4 * weights[i]
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope**2
                step = (first[i] / (1 - 0.9**t)) / (np.sqrt(second[i] / (1 - 0.999**t)) + 1e-8)
                weights[i] = weights[i] - rate * step
    return weights


def _temperature(outputs: np.ndarray, y: np.ndarray) -> float:
    """The temperature of the smallest log loss."""
    choices = np.exp(np.linspace(np.log(0.25), np.log(16), 97))
    losses = [
        -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))
        for p in (np.clip(_sigmoid(outputs / t), 1e-9, 1 - 1e-9) for t in choices)
    ]
    return float(choices[int(np.argmin(losses))])


def trained_model(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    limit: int = LABELLED,
) -> Model:
    """Learn from documents whose hashed id is not kept for testing.

    Context vectors come from all of these; the network from at most ``limit``
    labelled ones, those with the smallest hash of their id. Several labels of a
    document count with their mean; of several rows with one id, one is an example.
    Where there are no labels or only one kind, the score is the share of label 1
    (0.5 without any).
    """
    spark = documents.sparkSession
    own = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    own = own.where(learnable(F.col("key")))
    sample = (
        labels.select(F.col(key).alias("label_key"), F.col(label).cast("double").alias("label"))
        .where(learnable(F.col("label_key")) & F.col("label").isNotNull())
        .groupBy("label_key")
        .agg(F.avg("label").alias("label"))
        .orderBy(F.xxhash64("label_key"), "label_key")
        .limit(limit)
    )
    contexts = learned_contexts(own.select("text"))
    table = spark.sparkContext.broadcast(contexts)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = _pooled(_bytes_of(batch), table.value)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("label"),
                    pa.array([f.astype("<f4").tobytes() for f in found], pa.binary()),
                ],
                names=["key", "label", "features"],
            )

    # The sample is bounded, so it may be sent to every task.
    rows = (
        own.join(F.broadcast(sample), F.col("key") == F.col("label_key"))
        .select("key", "label", "text")
        .mapInArrow(features, f"key {dict(own.dtypes)['key']}, label double, features binary")
        .groupBy("key", "label")
        .agg(F.min("features").alias("features"))  # one text for each id of the sample
        .collect()
    )
    y = np.array([r["label"] for r in rows])
    blank = np.zeros(FEATURES, np.float32)
    if not len(rows) or y.min() == y.max():
        prior = float(y.mean()) if len(rows) else 0.5
        return Model(contexts, blank, blank + 1, [], 1.0, prior)
    x = np.stack([np.frombuffer(r["features"], "<f4") for r in rows])
    order = np.lexsort((x[:, 0], [str(r["key"]) for r in rows]))  # whatever order they came in
    x, y = x[order], y[order]
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    x = (x - mean) / scale
    seen = np.arange(len(x)) % 5 != 0
    if y[seen].min() == y[seen].max() or not (~seen).any():
        return Model(contexts, mean, scale, _trained(x, y), 1.0, None)
    weights = _trained(x[seen], y[seen])
    heat = _temperature(_outputs(x[~seen], weights)[1], y[~seen])
    return Model(contexts, mean, scale, weights, max(heat, 0.5), None)


def sent(spark: SparkSession, model: Model) -> Broadcast:
    """The model's numbers, on their way to the tasks."""
    return spark.sparkContext.broadcast(vars(model))


def scores(
    documents: DataFrame, model: Model, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id`` and ``score`` of every row; null and empty texts get the score of no words.

    Rows are independent, so repeated and null ids stay. Other columns are ignored.
    """
    numbers = sent(documents.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(**numbers.value)
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(own.score(_bytes_of(batch)).astype(np.float64))],
                names=["doc_id", "score"],
            )

    chosen = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(run, f"doc_id {dict(chosen.dtypes)['doc_id']}, score double")


def accepted(
    documents: DataFrame,
    model: Model,
    text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows whose score reaches the threshold, with all their columns."""
    numbers = sent(documents.sparkSession, model)
    names = documents.columns
    inner = documents.toDF(*[f"c{i}" for i in range(len(names))])
    at = [n.lower() for n in names].index(text.lower())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(**numbers.value)
        for batch in slices(batches, f"c{at}"):
            texts = [t or b"" for t in batch.column(at).cast(pa.binary()).to_pylist()]
            yield batch.filter(pa.array(own.score(texts) >= threshold))

    return inner.mapInArrow(run, inner.schema).toDF(*names)
