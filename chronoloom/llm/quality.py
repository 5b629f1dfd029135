"""A quality classifier: random-indexing word vectors, pooled per document, under a small calibrated network."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.llm import arrowtext
from chronoloom.llm.stored import fresh
from chronoloom.llm.tasks import tidy

BUCKETS = 1 << 14
"""Words share this many vectors by hash, so the model's size is fixed."""
DIMS = 32
SEEDS = 2
"""Non-zero places in a word's own random index vector."""
WINDOW = 2
LAGS = (1, 2, 5)
MAX_TRAINING_ROWS = 20_000
"""Expected number of labelled documents the network is fitted on, at most; chosen by hash. The word vectors cover all documents."""
HIDDEN = 32

KINDS = arrowtext.byte_classes(
    letters=[(0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)],
    digits=[(0x30, 0x39)],
    marks=[(0x00, 0x08), (0x0E, 0x1F), (0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)],
)
"""Words, numbers and runs of marks; capitals are kept apart, as they tell much about a text."""

SPARK_FIELDS = ", ".join(f"c{k} long" for k in range(DIMS))


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the random index vector of each bucket: fixed, sparse and ternary."""
    draw = np.random.Generator(np.random.PCG64(7))
    return draw.integers(0, DIMS, (BUCKETS, SEEDS)), draw.choice(np.array([-1.0, 1.0]), (BUCKETS, SEEDS))


def _buckets(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = arrowtext.text_bytes(batch.column(name))
    found = arrowtext.words(data, offsets, KINDS)
    return (found.hash % np.uint64(BUCKETS)).astype(np.int64), found.first


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the index vectors of the words around each word, by bucket, of one partition."""
    places, signs = index_vectors()
    sums = np.zeros(BUCKETS * DIMS, dtype=np.int64)
    for batch in arrowtext.slices(batches, "text"):
        bucket, first = _buckets(batch, "text")
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        part = np.zeros(BUCKETS * DIMS)
        for lag in range(WINDOW + 1):
            near = row[lag:] == row[: len(row) - lag] if lag else np.ones(len(row), dtype=bool)
            left, right = bucket[: len(bucket) - lag][near], bucket[lag:][near]
            word, other = (np.concatenate((left, right)), np.concatenate((right, left))) if lag else (left, left)
            for k in range(SEEDS):
                part += np.bincount(word * DIMS + places[other, k], weights=signs[other, k], minlength=BUCKETS * DIMS)
        sums += np.rint(part).astype(np.int64)
    table = sums.reshape(BUCKETS, DIMS)
    used = np.flatnonzero(table.any(axis=1))
    if len(used):
        yield pa.RecordBatch.from_arrays([pa.array(used)] + [pa.array(table[used, k]) for k in range(DIMS)], names=["bucket"] + [f"c{k}" for k in range(DIMS)])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit vectors of all word buckets and their squares, learned from the contexts of every word of ``docs(text)``.

    Contexts are whole numbers, so the sums do not depend on the order of tasks. A partition sends one row per bucket at most; the
    result has BUCKETS rows whatever the input.
    """
    summed = docs.select("text").mapInArrow(tidy(_contexts), f"bucket long, {SPARK_FIELDS}").groupBy("bucket").agg(*[F.sum(f"c{k}").alias(f"c{k}") for k in range(DIMS)])
    table = np.zeros((BUCKETS, DIMS))
    for row in summed.collect():  # BUCKETS rows at most
        table[row[0]] = row[1:]
    size = np.linalg.norm(table, axis=1, keepdims=True)
    unit = np.divide(table, size, out=np.zeros_like(table), where=size > 0)
    return np.hstack((unit, unit * unit)).astype(np.float32)


def pooled(batch: pa.RecordBatch, name: str, vectors: np.ndarray) -> np.ndarray:
    """Features of each text: mean and spread of its word vectors, the share of equal words a few places apart, the log of the word count.

    ``vectors`` has the word vectors and, beside them, their squares.

    A text without words has zeros throughout.
    """
    bucket, first = _buckets(batch, name)
    counts = np.diff(first)
    out = np.zeros((len(counts), 2 * DIMS + len(LAGS) + 1))
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    n = counts[full][:, None].astype(float)
    ends = first[full + 1]
    sums = np.empty((len(full), 2 * DIMS))
    low = 0
    while low < len(full):  # some thousand words at a time stay in the cache
        begin = first[full[low]]
        high = max(low + 1, int(np.searchsorted(ends, begin + 4096, "right")))
        sums[low:high] = np.add.reduceat(vectors[bucket[begin : ends[high - 1]]], first[full[low:high]] - begin, axis=0)
        low = high
    mean = sums[:, :DIMS] / n
    out[full, :DIMS] = mean
    out[full, DIMS : 2 * DIMS] = np.sqrt(np.maximum(sums[:, DIMS:] / n - mean * mean, 0))
    row = np.repeat(np.arange(len(counts)), counts)
    for k, lag in enumerate(LAGS):
        left = max(len(bucket) - lag, 0)  # a whole batch may have fewer words than the lag
        same = np.flatnonzero((bucket[lag:] == bucket[:left]) & (row[lag:] == row[:left]))
        out[:, 2 * DIMS + k] = np.bincount(row[same], minlength=len(counts)) / np.maximum(counts - lag, 1)
    out[:, -1] = np.log1p(counts)
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


@dataclass
class Network:
    """A hidden layer and an output over scaled features; ``temperature`` divides the logit."""

    centre: np.ndarray
    spread: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.centre) / self.spread @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x) / self.temperature)


def fit_network(x: np.ndarray, y: np.ndarray, calibration: np.ndarray, epochs: int = 60, seed: int = 1) -> Network:
    """Fit on the rows outside ``calibration`` by Adam on the cross entropy, then the temperature on those inside."""
    fit = ~calibration if (~calibration).any() else np.ones(len(x), dtype=bool)
    centre, spread = x[fit].mean(axis=0), np.maximum(x[fit].std(axis=0), 1e-3)
    z, t = (x[fit] - centre) / spread, y[fit].astype(float)
    draw = np.random.Generator(np.random.PCG64(seed))
    params = [draw.normal(0, np.sqrt(2 / z.shape[1]), (z.shape[1], HIDDEN)), np.zeros(HIDDEN), draw.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(1)]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for epoch in range(epochs):
        order = draw.permutation(len(z))
        rate = 3e-3 * (1 - epoch / epochs) + 1e-4
        for low in range(0, len(z), 128):
            i = order[low : low + 128]
            hidden = np.maximum(z[i] @ params[0] + params[1], 0)
            error = (sigmoid(hidden @ params[2] + params[3][0]) - t[i]) / len(i)
            back = np.outer(error, params[2]) * (hidden > 0)
            grads = [z[i].T @ back + 1e-4 * params[0], back.sum(axis=0), hidden.T @ error + 1e-4 * params[2], np.array([error.sum()])]
            step += 1
            for k, g in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                params[k] = params[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    net = Network(centre, spread, params[0], params[1], params[2], float(params[3][0]))
    if calibration.any():
        logit, held = net.logits(x[calibration]), y[calibration].astype(float)
        tries = np.exp(np.linspace(np.log(0.5), np.log(20), 241))  # rows that separate fully would have it at 0
        loss = [np.mean(np.logaddexp(0, np.where(held > 0, -1, 1) * logit / c)) for c in tries]
        net.temperature = float(tries[int(np.argmin(loss))])
    return net


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; fold 1 is held out from learning."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "utf-8")) % 3


def _features(vectors):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrowtext.slices(batches, "text"):
            x = pooled(batch, "text", vectors.value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(list(x), type=pa.list_(pa.float64()))], names=["doc_id", "label", "x"])

    return run


def _scores(vectors, network, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrowtext.slices(batches, "text"):
            score = network.value.scores(pooled(batch, "text", vectors.value))
            columns = [batch.column(k) for k in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(score)], names=[*batch.schema.names, name])

    return run


@dataclass
class QualityModel:
    """Word vectors and network, as learned by ``fit_quality``."""

    vectors: np.ndarray
    network: Network | None

    def score(self, docs: DataFrame, name: str = "score") -> DataFrame:
        """``docs`` with a column ``name`` from 0 to 1, higher where label 1 is likelier. Without a network, as after learning from no labels, it is 0.5.

        Null and empty texts are scored as texts without words. An existing column ``name`` is replaced.
        """
        rows = docs.drop(name)
        if self.network is None:
            return rows.withColumn(name, F.lit(0.5))
        context = docs.sparkSession.sparkContext
        vectors, network = context.broadcast(self.vectors), context.broadcast(self.network)  # of fixed size
        schema = rows.withColumn(name, F.lit(0.0)).schema
        return rows.mapInArrow(tidy(_scores(vectors, network, name)), schema)


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> QualityModel:
    """Learn from ``docs(doc_id, text)`` and ``labels(doc_id, quality)``.

    Word vectors come from every text, labelled or not. The network is fitted on the labelled documents outside the held-out fold; if there are more than
    ``max_rows``, on those whose hashed id is below the share that gives that number in expectation. One in five of them fits the
    temperature instead. Labels other than 0 and 1 and null ids are left out; an id with several labels counts once for each. With labels of
    one class only there is no network.
    """
    vectors = word_vectors(docs)
    known = labels.where("quality in (0, 1) and doc_id is not null").where(fold(F.col("doc_id")) != 1).select("doc_id", F.col("quality").cast("int").alias("label"))
    count = known.count()
    share = min(1.0, max_rows / max(count, 1))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    rows = docs.select("doc_id", "text").join(known.where(draw < share), "doc_id").select("doc_id", "text", "label")
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    found = rows.mapInArrow(tidy(_features(shared)), "doc_id long, label int, x array<double>").collect()  # max_rows rows of some 70 numbers
    found.sort(key=lambda r: (r[0], r[1], r[2]))
    y = np.array([r[1] for r in found])
    if len(set(y)) < 2:
        return QualityModel(vectors, None)
    x = np.array([r[2] for r in found])
    calibration = np.array([(r[0] * 2654435761 >> 7) % 5 == 0 for r in found])
    return QualityModel(vectors, fit_network(x, y, calibration))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every row of ``docs(doc_id, text)``: rows (doc_id, held_out, score, predicted). See ``fit_quality`` and ``QualityModel.score``.

    A null id is in the fold of the empty text; repeated rows get equal scores; an empty table gives an empty table.
    """
    model = fit_quality(docs, labels)
    return model.score(docs.select("doc_id", "text")).select(
        "doc_id", (fold(F.col("doc_id")) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` that score 0.5 or more under a model fitted on them, with all their columns."""
    (name,) = fresh(docs, "quality_score")
    return fit_quality(docs, labels).score(docs, name).where(F.col(name) >= 0.5).drop(name)
