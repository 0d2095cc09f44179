"""Katz back-off against a plain model, and its normalisation."""

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from starloom.llm import backoff, katz
from starloom.llm.queries import REGISTRY

import brute

SF_DIR = "/root/testdata/sf0.001"


def plain(documents, trains):
    """{doc: (n, known, base, score)} by dictionaries; also the model's pieces."""
    texts = {d: [*brute.solid_words(t), None] for d, t in documents}
    uni, pairs = Counter(), Counter()
    for d, words in texts.items():
        if trains[d]:
            uni.update(words)
            pairs.update(zip(["<s>", *words], words))
    n, v = sum(uni.values()), len(uni)
    stats = lambda c: [sum(x == r for x in c.values()) for r in range(1, katz.K + 2)]
    unigrams = katz.Unigrams(n, v, tuple(stats(uni)))
    d = katz.discounts(stats(pairs))
    p1 = lambda w: float(unigrams.probability(np.array([uni[w]]))[0])
    after = defaultdict(dict)
    for (a, b), c in pairs.items():
        after[a][b] = c

    def p(a, b):
        if a not in after:
            return p1(b)
        total = sum(after[a].values())
        spared = sum((1 - d[c]) * c for c in after[a].values() if c <= katz.K)
        divisor, left = (total, spared) if spared > 1e-12 else (total + 1, 1)
        if b in after[a]:
            c = after[a][b]
            return (d[c] if c <= katz.K else 1) * c / divisor
        return left / divisor / (1 - sum(p1(w) for w in after[a])) * p1(b)

    scores = {}
    for doc, words in texts.items():
        base = sum(math.log10((uni[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        score = sum(math.log10(p(a, b)) for a, b in zip(["<s>", *words], words))
        scores[doc] = (len(words), sum(uni[w] > 0 for w in words), base, score)
    return scores, n, uni, after, p


@pytest.mark.parametrize("chunk_tokens", [katz.CHUNK_TOKENS, 3_000])
def test_equals_plain_model(spark, chunk_tokens):
    table = pq.read_table(f"{SF_DIR}/documents.parquet", columns=["doc_id", "text"])
    documents = list(zip(table["doc_id"].to_pylist(), table["text"].to_pylist()))
    documents = [*documents, (-1, None), (-2, ""), (-3, "  \n "), (-5, "neverseen the neverseen")]
    wanted, n, *_ = plain(documents, {d: not brute.in_part(d, 5, 1) for d, _ in documents})
    df = spark.createDataFrame(documents, "doc_id long, text string").repartition(3)
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1
    scores, model = katz.score_texts(df, train, chunk_tokens)
    found = {r.doc_id: r for r in scores.collect()}
    assert set(found) == set(wanted)
    for doc, (tokens, known, base, score) in wanted.items():
        r = found[doc]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (tokens, known, n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)
    assert model.words.count() >= 1 and model.pairs.agg(F.sum("n_pairs")).first()[0] > 0


def test_contexts_add_up_to_one():
    documents = [(i, t) for i, t in enumerate(["a b a b c", "a b d", "b b b b b b b b", "", "c a"])]
    _, _, uni, after, p = plain(documents, {d: True for d, _ in documents})
    for context in after:
        assert sum(p(context, w) for w in [*uni, "unseen"]) == pytest.approx(1)


def test_no_training_text(spark):
    df = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string")
    scores, _ = katz.score_texts(df, F.lit(False))
    assert sorted((r.n_tokens, r.n_known, r.score, r.base_score) for r in scores.collect()) == [(1, 0, 0, 0), (3, 0, 0, 0)]
    assert katz.score_texts(df.limit(0), F.lit(True))[0].count() == 0


def test_better_than_base(spark):
    rows = [r for r in REGISTRY["op4_katz"](spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_chunks_are_bounded_by_tokens(spark):
    """Long texts, a text longer than a chunk, and short ones behind it: whole texts, never more than the bound."""
    sizes = [2_000] * 60 + [9_000] + [3] * 500
    rows = [(i, True, " ".join(["w"] * n)) for i, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, "doc_id long, train boolean, text string").coalesce(1)
    chunks = katz.chunk_texts(df, 5_000).collect()
    held = [katz.unpack(r.lengths, np.int32) for r in chunks]
    assert sum(len(h) for h in held) == len(sizes) == len({d for r in chunks for d in r.doc_ids})
    assert all(h.sum() <= 5_000 or len(h) == 1 for h in held)
    assert len(held) <= 40


def plain_of_order(texts, trains, order):
    """{doc: score} by dictionaries and recursion, and p(context, word) itself."""
    unigrams_of = Counter(w for d, t in texts.items() if trains[d] for w in t)
    stats = lambda c: [sum(x == r for x in c.values()) for r in range(1, katz.K + 2)]
    unigrams = katz.Unigrams(sum(unigrams_of.values()), len(unigrams_of), tuple(stats(unigrams_of)))
    padded = {d: ["<s>"] * (order - 1) + t for d, t in texts.items()}
    after, d = {}, {}
    for m in range(2, order + 1):
        grams = Counter(
            (tuple(t[i - m + 1 : i]), t[i])
            for doc, t in padded.items() if trains[doc] for i in range(order - 1, len(t))
        )
        d[m] = katz.discounts(stats(grams))
        for (context, word), c in grams.items():
            after.setdefault(context, {})[word] = c
    memo = {}

    def p(context, word):
        if not context:
            return float(unigrams.probability(np.array([unigrams_of[word]]))[0])
        if context not in after:
            return p(context[1:], word)
        counts, ratios = after[context], d[len(context) + 1]
        if context not in memo:
            spared = sum((1 - ratios[c]) * c for c in counts.values() if c <= katz.K)
            total, left = (sum(counts.values()), spared) if spared > 1e-12 else (sum(counts.values()) + 1, 1)
            memo[context] = total, left / total / (1 - sum(p(context[1:], w) for w in counts))
        total, weight = memo[context]
        if word in counts:
            c = counts[word]
            return (ratios[c] if c <= katz.K else 1) * c / total
        return weight * p(context[1:], word)

    scores = {
        doc: sum(math.log10(p(tuple(t[i - order + 1 : i]), t[i])) for i in range(order - 1, len(t)))
        for doc, t in padded.items()
    }
    return scores, p, after, unigrams_of


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_every_order_equals_a_plain_recursion(spark, order):
    table = pq.read_table(f"{SF_DIR}/documents.parquet", columns=["doc_id", "text"])
    documents = list(zip(table["doc_id"].to_pylist(), table["text"].to_pylist()))
    documents = [*documents, (-1, None), (-2, ""), (-3, "  \n "), (-5, "neverseen the neverseen"), (-6, "a " * 3000)]
    texts = {d: [*brute.solid_words(t), None] for d, t in documents}
    trains = {d: not brute.in_part(d, 5, 1) for d in texts}
    wanted, p, after, seen = plain_of_order(texts, trains, order)
    df = spark.createDataFrame(documents, "doc_id long, text string").repartition(3)
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1
    clashing = df.withColumns({"ROW": F.lit(1), "W": F.lit("x"), "n": F.lit(2), "Train": F.lit("no")})
    scores, model = backoff.score_by_order(clashing, train, order)
    found = {r.doc_id: r for r in scores.collect()}
    assert set(found) == set(wanted) and len(model.grams) == order
    for doc, score in wanted.items():
        r = found[doc]
        assert r.score == pytest.approx(score, rel=1e-9) and r.train_tokens == sum(seen.values())
        assert (r.n_tokens, r.n_known) == (len(texts[doc]), sum(seen[w] > 0 for w in texts[doc]))
    if order == 2:
        pairs, _ = katz.score_texts(df, train)
        for r in pairs.collect():
            assert (r.n_tokens, r.n_known) == (found[r.doc_id].n_tokens, found[r.doc_id].n_known)
            assert r.score == pytest.approx(found[r.doc_id].score, rel=1e-9)
            assert r.base_score == pytest.approx(found[r.doc_id].base_score, rel=1e-9)


def test_contexts_of_every_length_add_up_to_one():
    texts = {i: [*t.split(), None] for i, t in enumerate(["a b a b c", "a b d", "b b b b b b b b", "", "c a b a b d"])}
    _, p, after, seen = plain_of_order(texts, {d: True for d in texts}, 4)
    assert {len(c) for c in after} == {1, 2, 3}
    for held in after:
        assert sum(p(held, w) for w in [*seen, "unseen"]) == pytest.approx(1)


def test_orders_without_training_text_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a b"), (None, None), (1, "a b")], "doc_id long, text string")
    scores, _ = backoff.score_by_order(df, F.lit(False))
    assert sorted((r.n_tokens, r.n_known, r.score, r.base_score) for r in scores.collect()) == [(1, 0, 0, 0), (3, 0, 0, 0), (3, 0, 0, 0)]
    assert backoff.score_by_order(df.limit(0), F.lit(True))[0].count() == 0
    with pytest.raises(ValueError, match="at least"):
        backoff.score_by_order(df, F.lit(True), 0)


def test_longer_contexts_predict_held_out_texts_better(spark):
    from starloom.llm.quality import held_out

    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    totals = []
    for order in (1, 2, 3):
        scores, _ = backoff.score_by_order(df, ~held_out(F.col("doc_id"), 5, 1), order)
        totals.append(scores.filter("NOT train").agg(F.sum("score")).first()[0])
    assert totals[0] < totals[1], totals
    assert totals[2] > totals[0], totals
