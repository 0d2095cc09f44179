"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

Every hashed word has a sparse random index vector; its word vector adds the index vectors of the
words around it. Word vectors and network are fitted on a bounded sample of labelled documents;
all documents are scored whole, in tasks, with the fitted tables of fixed size.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import discard, stored

#: Words (letters, bytes above 127), numbers, and runs of signs.
_TOKEN = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^\sA-Za-z0-9\x80-\xff]+")
#: Words of a text that are hashed and pooled at a time, which bounds memory for long texts.
PIECE = 1 << 18
#: Average words that are added to every text.
PRIOR = 8


@dataclass(frozen=True)
class Shape:
    """Sizes of the model: hashed words, dimensions, non-zero entries, words on either side, hidden units."""

    words: int = 1 << 14
    dims: int = 48
    nonzero: int = 6
    window: int = 2
    hidden: int = 24


@dataclass(frozen=True)
class QualityModel:
    """Word vectors, the network's weights, the inputs' scale, and the temperature."""

    shape: Shape
    vectors: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    mean: np.ndarray
    scale: np.ndarray
    temperature: float
    centre: np.ndarray

    def scores(self, pooled: np.ndarray) -> np.ndarray:
        x = (steadied(pooled, self.centre) - self.mean) / self.scale
        z = np.tanh(x @ self.w1 + self.b1) @ self.w2 + self.b2
        return 1 / (1 + np.exp(-np.clip(z / self.temperature, -40, 40)))


def word_ids(text: bytes, shape: Shape) -> Iterator[np.ndarray]:
    """Hashed words in order, in pieces; a word that repeats the one before it becomes word 0."""
    last = -1
    found: list[int] = []

    def ready() -> np.ndarray:
        nonlocal last
        ids = np.array(found, np.int64)
        same = ids == np.concatenate([[last], ids[:-1]])
        last = int(ids[-1])
        return np.where(same, 0, ids)

    crc, top = zlib.crc32, shape.words - 1
    for match in _TOKEN.finditer(text) if len(text) > PIECE else ():
        found.append(crc(match[0]) % top + 1)
        if len(found) == PIECE:
            yield ready()
            found.clear()
    if len(text) <= PIECE:
        found = [crc(token) % top + 1 for token in _TOKEN.findall(text)]
    if found:
        yield ready()


def index_vectors(shape: Shape) -> np.ndarray:
    """Sparse random vectors of +1 and -1, the same everywhere."""
    rng = np.random.default_rng(7)
    out = np.zeros((shape.words, shape.dims), np.float32)
    places = np.argsort(rng.random(out.shape), axis=1)[:, : shape.nonzero]
    signs = rng.choice(np.array([-1, 1], np.float32), places.shape)
    np.put_along_axis(out, places, signs, axis=1)
    return out


def context_sums(texts: Iterator[bytes], shape: Shape) -> np.ndarray:
    """For every hashed word the sum of the index vectors of its neighbours."""
    index, out = index_vectors(shape), np.zeros((shape.words, shape.dims), np.float32)
    for text in texts:
        for ids in word_ids(text, shape):
            for step in range(1, shape.window + 1):
                if len(ids) > step:
                    np.add.at(out, ids[:-step], index[ids[step:]])
                    np.add.at(out, ids[step:], index[ids[:-step]])
    return out


def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In a task: the sum of all tables."""
    total = None
    for batch in batches:
        for value in batch.column(0):
            table = np.frombuffer(value.as_buffer(), np.float32)
            total = table.copy() if total is None else total + table
    if total is not None:
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], ["sums"])


def word_vectors(sums: np.ndarray, shape: Shape) -> np.ndarray:
    """Index vector plus direction of the context, both of length one."""
    unit = lambda a: a / np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-9)
    return (unit(index_vectors(shape)) + unit(sums)).astype(np.float32)


def pooled(text: bytes, vectors: np.ndarray, shape: Shape) -> np.ndarray:
    """The mean of the text's word vectors, the share of repeated words, and the log of the length."""
    total, n, repeats = np.zeros(shape.dims), 0, 0
    for ids in word_ids(text, shape):
        seen = np.bincount(ids, minlength=0)
        at = np.flatnonzero(seen)
        total += seen[at] @ vectors[at]
        n += len(ids)
        repeats += int(seen[0])
    return np.concatenate([total / max(n, 1), [repeats / max(n, 1), np.log1p(n)]])


def steadied(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Pooled rows with PRIOR average words added, so that a few odd words don't decide on a short text."""
    n = np.expm1(x[:, -1:])
    return np.hstack([(x[:, :-1] * n + PRIOR * centre) / (n + PRIOR), x[:, -1:]])


def fit_network(x: np.ndarray, y: np.ndarray, hidden: int, epochs: int = 60, decay: float = 1e-3) -> dict:
    """Adam on the logistic loss; a fifth of the rows is kept out to calibrate the temperature."""
    rng = np.random.default_rng(11)
    order = rng.permutation(len(x))
    kept, train = order[: len(x) // 5], order[len(x) // 5 :]
    mean, scale = x[train].mean(0), x[train].std(0) + 1e-6
    z = (x - mean) / scale
    params = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), np.zeros(hidden), 0.0]
    moments = [[np.zeros_like(np.asarray(p, float)) for p in params] for _ in range(2)]
    step = 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(train), max(1, len(train) // 128)):
            step += 1
            h = np.tanh(z[rows] @ params[0] + params[1])
            error = (1 / (1 + np.exp(-np.clip(h @ params[2] + params[3], -40, 40))) - y[rows]) / len(rows)
            back = np.outer(error, params[2]) * (1 - h * h)
            grads = [z[rows].T @ back + decay * params[0], back.sum(0), h.T @ error + decay * params[2], error.sum()]
            for i, g in enumerate(grads):
                moments[0][i] = 0.9 * moments[0][i] + 0.1 * g
                moments[1][i] = 0.999 * moments[1][i] + 0.001 * np.square(g)
                rate = 0.01 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                params[i] = params[i] - rate * moments[0][i] / (np.sqrt(moments[1][i]) + 1e-8)
    logits = np.tanh(z[kept] @ params[0] + params[1]) @ params[2] + params[3]

    def loss(t: float) -> float:
        p = 1 / (1 + np.exp(-np.clip(logits / t, -40, 40)))
        return -np.mean(y[kept] * np.log(p + 1e-9) + (1 - y[kept]) * np.log(1 - p + 1e-9))

    temperature = min(np.geomspace(0.25, 8, 41), key=loss) if len(kept) else 1.0
    return {
        "w1": params[0],
        "b1": params[1],
        "w2": params[2],
        "b2": float(params[3]),
        "mean": mean,
        "scale": scale,
        "temperature": float(temperature),
    }


def labelled_sample(documents: DataFrame, labels: DataFrame, sample: int, seed: str) -> DataFrame:
    """At most ``sample`` labelled texts: doc_id, text (binary), label; one row for an id.

    ``labels`` holds doc_id and label; rows with a null in either are left out, and those with the
    least hash of the id are taken. Of texts that share an id the least is used.
    """
    known = labels.filter("label is not null and doc_id is not null")
    known = known.select("doc_id", F.col("label").cast("int").alias("label"))
    order = F.xxhash64(F.lit(seed), "doc_id")
    chosen = known.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(order, "doc_id").limit(sample)
    # At most ``sample`` rows, so the broadcast is bounded.
    texts = documents.select("doc_id", "text").join(F.broadcast(stored(chosen, "sampled-labels")), "doc_id")
    one = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
    return stored(one.withColumn("text", F.col("text").cast("binary")), "sampled-texts")


def fit_quality(
    documents: DataFrame, labels: DataFrame, sample: int = 8_000, shape: Shape = Shape(), tasks: int = 8
) -> QualityModel:
    """Fit on at most ``sample`` labelled documents; ``labels`` holds doc_id and label (0 or 1).

    Without rows, or with one label alone, scores are that label's share.
    """
    # In few tasks, as each makes a table of the model's size.
    chosen = labelled_sample(documents, labels, sample, "quality").coalesce(tasks)

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = (value.as_py() or b"" for batch in batches for value in batch.column(1))
        yield pa.record_batch([pa.array([context_sums(texts, shape).tobytes()], pa.binary())], ["sums"])

    # A table of fixed size from each of ``tasks`` tasks; the driver gets their sum alone. The sums are
    # whole numbers, so their order does not matter.
    tables = chosen.mapInArrow(contexts, "sums binary").repartition(1).mapInArrow(added, "sums binary")
    found = [np.frombuffer(row.sums, np.float32) for row in tables.collect()]
    sums = found[0].reshape(shape.words, shape.dims) if found else np.zeros((shape.words, shape.dims))
    vectors = word_vectors(sums, shape)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [pooled(value.as_py() or b"", vectors, shape).tobytes() for value in batch.column(1)]
            yield pa.record_batch([pa.array(x, pa.binary()), batch.column(2)], ["x", "label"])

    rows = sorted((bytes(r.x), r.label) for r in chosen.mapInArrow(features, "x binary, label int").collect())
    x = np.array([np.frombuffer(r[0]) for r in rows]).reshape(len(rows), shape.dims + 2)
    y = np.array([r[1] for r in rows], float)
    n = np.expm1(x[:, -1:])
    centre = (x[:, :-1] * n).sum(0) / max(n.sum(), 1)
    x = steadied(x, centre)
    if len(set(y)) < 2:  # nothing to tell apart
        share = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
        n, h = shape.dims + 2, shape.hidden
        fitted = {
            "w1": np.zeros((n, h)),
            "b1": np.zeros(h),
            "w2": np.zeros(h),
            "b2": float(np.log(share / (1 - share))),
            "mean": np.zeros(n),
            "scale": np.ones(n),
            "temperature": 1.0,
        }
    else:
        fitted = fit_network(x, y, shape.hidden)
    discard(documents.sparkSession, chosen)
    return QualityModel(shape=shape, vectors=vectors, centre=centre, **fitted)


def score_quality(documents: DataFrame, model: QualityModel) -> DataFrame:
    """``documents`` (any columns, among them text) with ``score``: the probability of label 1.

    Null and empty texts get the score of a text without words. Whole texts are read, rows keep
    all their columns; an own column named score is replaced.
    """
    kept = [c for c in documents.columns if c.lower() != "score"]
    schema = StructType([*(documents.schema[c] for c in kept), StructField("score", DoubleType())])
    at = kept.index("text")
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            texts = batch.column(at).cast(pa.binary())
            x = np.array([pooled(v.as_py() or b"", fitted.vectors, fitted.shape) for v in texts])
            scores = fitted.scores(x.reshape(batch.num_rows, fitted.shape.dims + 2))
            yield pa.record_batch([*batch.columns, pa.array(scores, pa.float64())], [*kept, "score"])

    return documents.select(*kept).mapInArrow(score, schema)


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether the checksum of the id, as text, falls into the part that is kept out of learning."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def classify_quality(documents: DataFrame, labels: DataFrame, sample: int = 8_000, least: float = 0.3) -> DataFrame:
    """Score all ``documents``: adds held_out, score and predicted (1 if the score is ``least`` or more).

    Learns ``labels.quality`` of the rows that aren't held out (checksum of the id mod 5 is 0).
    Labels of repeated or null ids join as they come; documents keep one row each.
    """
    learn = labels.select("doc_id", F.col("quality").alias("label")).filter(~held_out(F.col("doc_id"), 5, 0))
    model = fit_quality(documents, learn, sample)
    scored = score_quality(documents, model)
    return scored.withColumns(
        {"held_out": held_out(F.col("doc_id"), 5, 0), "predicted": (F.col("score") >= least).cast("int")}
    )
