"""Katz back-off of any order, as tables: n-gram counts, discounted probabilities, back-off weights.

Every order has two stored tables, partitioned by the hash of what they hold: ``grams`` (an n-gram,
its context, its count, its discounted probability) and ``contexts`` (a context's divisor and back-off
weight). The weight is what the discounts of the context's n-grams spare, over what the next lower
order leaves to words not seen behind it, so each context's probabilities add up to one.

Evaluation starts at the single word and climbs: an order's probability is that of its n-gram if it
was seen, else the context's weight times the lower order's, and the lower order's alone where the
context was never seen. Each distinct window of words is evaluated once.

``katz`` scores by words and pairs in packed chunks and moves far less; this form has the order as a
parameter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, ascii_lower, discard, stored, words
from .katz import END, START, K, Unigrams, discounts


@dataclass(frozen=True)
class BackoffModel:
    """Tables by order, from one; order one has no contexts."""

    grams: tuple[DataFrame, ...]
    contexts: tuple[DataFrame | None, ...]
    unigrams: Unigrams


def number_texts(documents: DataFrame, train: Column, order: int) -> DataFrame:
    """Rows (row, doc_id, train, ids): tokens as 64-bit hashes, behind ``order - 1`` marks of the start."""
    start, end = F.lit(START).cast("long"), F.lit(int(END)).cast("long")
    tokens = F.transform(words(ascii_lower(F.col("text")), BLANKS), lambda w: F.xxhash64(w))
    return documents.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id"),
        F.coalesce(train, F.lit(False)).alias("train"),
        F.concat(F.array_repeat(start, order - 1), tokens, F.array(end)).alias("ids"),
    )


def windows(texts: DataFrame, order: int) -> DataFrame:
    """Rows (row, train, w): every token with the ``order - 1`` before it."""
    places = F.sequence(F.lit(1), F.size("ids") - (order - 1))
    return texts.select("row", "train", F.explode(F.transform(places, lambda i: F.slice("ids", i, order))).alias("w"))


def gram(order: int, m: int) -> Column:
    """The name of a window's last ``m`` words."""
    return F.xxhash64(F.slice("w", order - m + 1, m))


def context(order: int, m: int) -> Column:
    """The name of the ``m - 1`` words before a window's last."""
    return F.xxhash64(F.slice("w", order - m + 1, m - 1))


def count_of_counts(grams: DataFrame) -> list[int]:
    """How many were seen 1 to K + 1 times."""
    found = grams.agg(*[F.count_if(F.col("n") == r) for r in range(1, K + 2)]).first()
    return list(found)


def discounted(d: np.ndarray) -> Column:
    """The discounted count of a seen n-gram."""
    ratios = F.array(*[F.lit(float(x)) for x in d[1:]])
    return F.when(F.col("n") <= K, F.element_at(ratios, F.col("n").cast("int")) * F.col("n")).otherwise(F.col("n"))


def fit(distinct: DataFrame, order: int) -> BackoffModel:
    """The model of distinct windows (w, n), where ``n`` counts training places."""
    seen = distinct.filter("n > 0")
    single = stored(seen.groupBy(gram(order, 1).alias("g")).agg(F.sum("n").alias("n")), "backoff-grams-1")
    total, types = single.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    unigrams = Unigrams(total, types, tuple(count_of_counts(single)))
    spared = sum((1 - unigrams.d[r]) * r * unigrams.seen[r - 1] for r in range(1, K + 1))
    known = discounted(unigrams.d) / F.lit(float(max(total if spared > 0 else total + 1, 1)))
    grams, contexts = [single.withColumn("p", known)], [None]
    for m in range(2, order + 1):
        counts = seen.groupBy(
            gram(order, m).alias("g"), context(order, m).alias("context"), gram(order, m - 1).alias("shorter")
        ).agg(F.sum("n").alias("n"))
        below = grams[-1].select(F.col("g").alias("shorter"), F.col("p").alias("lower"))
        counts = stored(counts.join(below, "shorter"), f"backoff-counts-{m}")
        d = discounts(count_of_counts(counts))
        left = F.sum(F.col("n") - discounted(d))
        sums = counts.groupBy("context").agg(
            F.sum("n").alias("n"), left.alias("spared"), F.sum("lower").alias("lower")
        )
        none = F.col("spared") <= 1e-12
        divisor = F.col("n") + F.when(none, 1).otherwise(0)
        spare = F.when(none, 1.0).otherwise(F.col("spared"))
        weight = spare / divisor / F.greatest(1 - F.col("lower"), F.lit(1e-300))
        contexts.append(
            stored(sums.select("context", divisor.alias("divisor"), weight.alias("weight")), f"backoff-contexts-{m}")
        )
        p = (discounted(d) / F.col("divisor")).alias("p")
        grams.append(stored(counts.join(contexts[-1], "context").select("g", "context", "n", p), f"backoff-grams-{m}"))
        discard(distinct.sparkSession, counts)
    return BackoffModel(tuple(grams), tuple(contexts), unigrams)


def evaluate_windows(distinct: DataFrame, model: BackoffModel, order: int) -> DataFrame:
    """Rows (key, c, p) of the distinct windows: the last word's training count, the window's probability."""
    first = model.grams[0].select(F.col("g").alias("g1"), F.col("n").alias("c"), F.col("p").alias("p1"))
    unknown = 1.0 if model.unigrams.n == 0 else float(model.unigrams.unknown)
    known = distinct.withColumn("g1", gram(order, 1)).join(first, "g1", "left")
    out = known.select("w", F.coalesce("c", F.lit(0)).alias("c"), F.coalesce("p1", F.lit(unknown)).alias("p"))
    for m in range(2, order + 1):
        grams = model.grams[m - 1].select("g", F.col("p").alias("direct"))
        weights = model.contexts[m - 1].select("context", "weight")
        out = (
            out.withColumns({"g": gram(order, m), "context": context(order, m)})
            .join(weights, "context", "left")
            .join(grams, "g", "left")
            .select("w", "c", F.coalesce("direct", F.col("weight") * F.col("p"), F.col("p")).alias("p"))
        )
    return out.select(gram(order, order).alias("key"), "c", "p")


def score_by_order(documents: DataFrame, train: Column, order: int = 3) -> tuple[DataFrame, BackoffModel]:
    """Learn from the rows with ``train`` and score all, with contexts of up to ``order - 1`` words:
    doc_id, train, n_tokens, n_known, train_tokens, base_score, score.

    Defined cases are those of ``katz.score_texts``: a null or empty text is its end alone; a null
    ``train`` counts as false; null and repeated doc_ids are ordinary rows, and other columns are not
    looked at; without training texts scores are 0; an empty table gives an empty table. An ``order``
    of one scores words alone. N-grams are named by 64-bit hashes.
    """
    if order < 1:
        raise ValueError("the order must be 1 at least")
    spark = documents.sparkSession
    texts = stored(number_texts(documents, train, order), "backoff-texts")
    places = windows(texts, order)
    distinct = stored(
        places.groupBy("w").agg(F.sum(F.col("train").cast("long")).alias("n")), "backoff-windows"
    )
    model = fit(distinct, order)
    values = stored(evaluate_windows(distinct, model, order), "backoff-values")
    discard(spark, distinct)
    total, types = model.unigrams.n, model.unigrams.v
    base = (F.col("c") + 0.5) / F.lit(total + 0.5 * (types + 1))
    # A window is counted once per text, so a frequent one meets the join as a row per text at most.
    held = places.groupBy("row", gram(order, order).alias("key")).agg(F.count("*").alias("times"))
    sums = held.join(values, "key").groupBy("row").agg(
        F.sum("times").alias("n_tokens"),
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("n_known"),
        F.sum(F.col("times") * F.log10(base)).alias("base_score"),
        F.sum(F.col("times") * F.log10("p")).alias("score"),
    )
    scores = texts.select("row", "doc_id", "train").join(sums, "row").drop("row")
    return scores.withColumn("train_tokens", F.lit(total).cast("long")), model
