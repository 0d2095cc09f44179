"""Toxicity: a logistic model over hashed words, regularised by counterfactual identity swaps.

For every labelled text that names an identity, a counterfactual is made in which the term is
replaced by others; the fit penalises the squared change of the score between the two. So a mention
of a group alone moves no score, however often it stood in toxic examples.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import FOLD_ALNUM, discard
from .quality import held_out, labelled_sample

#: Identity terms by kind; a term is swapped for the others of its kind.
IDENTITIES = {
    "gender": ("women", "men", "woman", "man", "girls", "boys"),
    "faith": ("christian", "christians", "muslim", "muslims", "jewish", "jews", "hindu", "hindus", "buddhist", "atheists"),
    "origin": ("immigrants", "refugees", "foreigners", "natives", "african", "asian", "european", "american", "mexican"),
    "colour": ("black", "white", "brown"),
    "orientation": ("gay", "lesbian", "straight", "bisexual", "heterosexual", "homosexual", "transgender"),
    "age and body": ("old", "young", "elderly", "disabled", "deaf", "blind"),
}
#: Hashed features. A text's distinct features are at most this many.
SPACE = 1 << 18
#: First letters (bytes) of longer words that count as features of their own.
STEMS = (4, 5, 6, 7)
#: Counts from which a word or stem is a feature once more.
LEVELS = (1, 2, 4, 8)

_SWAPS = {term.encode(): tuple(t.encode() for t in terms if t != term) for terms in IDENTITIES.values() for term in terms}


@dataclass(frozen=True)
class ToxicityModel:
    """The features that count, sorted, with their weights, and the bias."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, present: np.ndarray) -> float:
        at = np.searchsorted(self.features, present)
        at = np.minimum(at, len(self.features) - 1)
        hit = self.features[at] == present if len(self.features) else np.zeros(len(present), bool)
        z = self.bias + (self.weights[at[hit]].sum() if hit.any() else 0.0)
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def word_features(words: Iterable[bytes]) -> np.ndarray:
    """Distinct hashed words and stems, each once for every level that its count reaches."""
    crc, ids = zlib.crc32, []
    counts = Counter(words)
    for n in (0, *STEMS):
        own = counts
        if n:
            own = Counter()
            for word, k in counts.items():
                if len(word) > n:
                    own[word[:n]] += k
        for level, least in enumerate(LEVELS):
            ids += [(crc(w, n) + level * 40_503) % SPACE for w, k in own.items() if k >= least]
    return np.unique(np.array(ids, np.int32))


def text_features(text: bytes) -> np.ndarray:
    """Distinct features of a whole text."""
    return word_features(text.translate(FOLD_ALNUM).split())


def swapped(text: bytes, turn: int) -> list[bytes] | None:
    """The text's words with every identity term replaced; None if it names none."""
    words = text.translate(FOLD_ALNUM).split()
    places = [i for i, w in enumerate(words) if w in _SWAPS]
    for i in places:
        others = _SWAPS[words[i]]
        words[i] = others[turn % len(others)]
    return words if places else None


def _selected(rows: list[np.ndarray], y: np.ndarray, least: int, most: int) -> np.ndarray:
    """Features that tell the labels apart: by the G statistic, in at least ``least`` texts."""
    with_1, with_0 = np.zeros(SPACE), np.zeros(SPACE)
    for row, label in zip(rows, y, strict=True):
        (with_1 if label else with_0)[row] += 1
    n1, n0 = max(y.sum(), 1), max((1 - y).sum(), 1)
    seen = with_1 + with_0
    rate = seen / (n1 + n0)

    def part(count: np.ndarray, n: float) -> np.ndarray:
        inside = count * np.log((count + 1e-9) / (n * rate + 1e-9))
        return inside + (n - count) * np.log((n - count + 1e-9) / (n * (1 - rate) + 1e-9))

    g = np.where(seen >= least, 2 * (part(with_1, n1) + part(with_0, n0)), 0)
    best = np.argsort(-g, kind="stable")[:most]
    return np.sort(best[g[best] > 10.83]).astype(np.int32)


def fit_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    sample: int = 20_000,
    most_features: int = 3_000,
    swap_penalty: float = 5.0,
    decay: float = 3e-5,
    turns: int = 2,
) -> ToxicityModel:
    """Fit on at most ``sample`` labelled documents; ``labels`` holds doc_id and label (0 or 1).

    Without both labels the score is the label's share. What comes to the driver is a row of at
    most SPACE feature numbers for each sampled text and swap.
    """
    sampled = labelled_sample(documents, labels, sample, "toxicity")
    chosen = sampled.repartition(16, "doc_id")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value, label in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                text = value.as_py() or b""
                swaps = [s for t in range(turns) if (s := swapped(text, t)) is not None]
                out.append((label, text_features(text).tobytes(), [word_features(s).tobytes() for s in swaps]))
            columns = list(zip(*out, strict=True)) or [[], [], []]
            yield pa.record_batch(
                [
                    pa.array(columns[0], pa.int32()),
                    pa.array(columns[1], pa.binary()),
                    pa.array(columns[2], pa.list_(pa.binary())),
                ],
                ["label", "x", "swaps"],
            )

    found = chosen.mapInArrow(features, "label int, x binary, swaps array<binary>").collect()
    collected = sorted(((bytes(r.x), r.label, [bytes(s) for s in r.swaps]) for r in found), key=lambda r: r[:2])
    discard(documents.sparkSession, sampled)
    rows = [np.frombuffer(r[0], np.int32) for r in collected]
    y = np.array([r[1] for r in collected], float)
    pairs = [(i, np.frombuffer(s, np.int32)) for i, r in enumerate(collected) for s in r[2]]
    return fit_rows(rows, y, pairs, most_features, swap_penalty, decay)


def fit_rows(
    rows: list[np.ndarray],
    y: np.ndarray,
    pairs: list[tuple[int, np.ndarray]],
    most_features: int,
    swap_penalty: float,
    decay: float,
) -> ToxicityModel:
    """Gradient descent on the logistic loss, weight decay, and the squared score changes of ``pairs``."""
    if len(set(y)) < 2:
        share = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.01
        return ToxicityModel(np.array([], np.int32), np.array([]), float(np.log(share / (1 - share))))
    features = _selected(rows, y, 5, most_features)
    n = len(features)

    def sparse(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Row and column numbers of the features that count."""
        hits = [np.flatnonzero(np.isin(features, x, assume_unique=True)) for x in lists]
        row = np.repeat(np.arange(len(hits)), [len(h) for h in hits])
        return row, np.concatenate([*hits, np.array([], int)]).astype(int)

    r, c = sparse(rows)
    plain = [rows[i] for i, _ in pairs]
    (pr, pc), (sr, sc) = sparse(plain), sparse([s for _, s in pairs])
    w, b = np.zeros(n), float(np.log(y.mean() / (1 - y.mean())))
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, 401):
        z = b + np.bincount(r, w[c], len(rows))
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / len(rows)
        grad = np.bincount(c, error[r], n) + decay * w
        if pairs:
            change = np.bincount(pr, w[pc], len(pairs)) - np.bincount(sr, w[sc], len(pairs))
            pull = 2 * swap_penalty * change / len(pairs)
            grad += np.bincount(pc, pull[pr], n) - np.bincount(sc, pull[sr], n)
        g = np.append(grad, error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - float(move[-1])
    return ToxicityModel(features, w, b)


def score_toxicity(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """``documents`` with ``score``, the probability of label 1; whole texts, all rows and columns.

    Null and empty texts get the score of a text without words; an own column score is replaced.
    """
    kept = [c for c in documents.columns if c.lower() != "score"]
    schema = StructType([*(documents.schema[c] for c in kept), StructField("score", DoubleType())])
    at = kept.index("text")
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            scores = [fitted.score(text_features(v.as_py() or b"")) for v in batch.column(at).cast(pa.binary())]
            yield pa.record_batch([*batch.columns, pa.array(scores, pa.float64())], [*kept, "score"])

    return documents.select(*kept).mapInArrow(score, schema)


def classify_toxicity(documents: DataFrame, labels: DataFrame, sample: int = 20_000, least: float = 0.7) -> DataFrame:
    """Score all ``documents``: adds held_out, score and predicted (1 if the score is ``least`` or more).

    Learns ``labels.toxic`` of the rows that aren't held out (checksum of the id mod 3 is 1).
    """
    out = held_out(F.col("doc_id"), 3, 1)
    learn = labels.select("doc_id", F.col("toxic").alias("label")).filter(~out)
    model = fit_toxicity(documents, learn, sample)
    scored = score_toxicity(documents, model)
    return scored.withColumns({"held_out": out, "predicted": (F.col("score") >= least).cast("int")})
