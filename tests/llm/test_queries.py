"""The registered queries on the whole test tables, against brute force or held-out labels."""

import hashlib
import os
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from starloom.llm.licenses import BASE_PHRASES
from starloom.llm.queries import REGISTRY
import brute

SF_DIR = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.01")


def table(name, *columns):
    rows = pq.read_table(f"{SF_DIR}/{name}.parquet", columns=list(columns))
    return list(zip(*(rows[c].to_pylist() for c in columns), strict=True))


def rows(spark, name):
    return [tuple(r) for r in REGISTRY[name](spark, SF_DIR).collect()]


def test_op1(spark):
    wanted = Counter(
        (d, n, hit, len(items), hashlib.sha256(",".join(items).encode()).hexdigest(), hit > 0)
        for d, n, hit, items in brute.contaminated(table("documents", "doc_id", "text"), table("benchmark", "item_id", "text"))
    )
    assert Counter(rows(spark, "op1_decontamination")) == wanted


def test_op2(spark):
    vectors = table("embeddings", "vec_id", "embedding")
    wanted = brute.nearest(vectors, [r for r in vectors if r[0] % 20 == 0], 20)
    found = defaultdict(list)
    for q, rank, v, score in sorted(rows(spark, "op2_nearest")):
        found[q].append((v, score))
        assert rank == len(found[q])
    assert set(found) == set(wanted)
    hits = sum(len({v for v, _ in found[q]} & {v for v, _ in wanted[q]}) for q in wanted)
    assert hits >= 0.95 * sum(map(len, wanted.values()))
    exact = {i: np.array(v, float) for i, v in vectors}
    for q, pairs in found.items():
        assert pairs == sorted(pairs, key=lambda p: (-p[1], p[0])) and q not in dict(pairs)
        for v, score in pairs:
            assert score == pytest.approx(exact[q] @ exact[v], abs=1e-12)


def test_op3(spark):
    documents = table("documents", "doc_id", "source", "text")
    sizes = Counter()
    for _, source, text in documents:
        sizes[source] += len(brute.SOLID.findall(text or ""))
    targets = brute.targets(sizes)
    source = {d: s for d, s, _ in documents}
    taken = Counter()
    found = rows(spark, "op3_mixing")
    assert Counter(r[0] for r in found) == Counter(d for d, _, _ in documents)
    for doc, size, source_size, target, words in found:
        s = source[doc]
        assert source_size == sizes[s] and target == pytest.approx(targets[s]) and 0 <= words <= 2 * size
        taken[s] += words
    assert {s: int(targets[s] + 1e-6) for s in sizes} == dict(taken)
    assert sorted(found) == sorted(rows(spark, "op3_mixing"))


def test_op5(spark):
    assert Counter(rows(spark, "op5_warc")) == Counter(brute.archived(table("pages", "page_id", "html")))


@pytest.mark.parametrize(
    ("name", "label", "parts", "part", "least", "good"),
    [("op6_quality", "quality", 5, 0, 0.3, 0.9), ("op7_toxicity", "toxic", 3, 1, 0.7, 0.85)],
)
def test_classifiers(spark, name, label, parts, part, least, good):
    labels = dict(table("labels", "doc_id", label))
    found = rows(spark, name)
    assert Counter(r[0] for r in found) == Counter(d for (d,) in table("documents", "doc_id"))
    for doc, held, score, predicted in found:
        assert held == brute.in_part(doc, parts, part) and 0 <= score <= 1 and predicted == (score >= least)
    judged = [(s, labels[d]) for d, held, s, _ in found if held and d in labels]
    assert brute.auc(*zip(*judged, strict=True)) >= good


def test_op8(spark):
    wanted = brute.jaccard_components(table("documents", "doc_id", "text"))
    assert Counter(rows(spark, "op8_jaccard")) == Counter(wanted)


def test_op9(spark):
    wanted = Counter((d, *brute.base_licenses(t, BASE_PHRASES)) for d, t in table("documents", "doc_id", "text"))
    found = rows(spark, "op9_licenses")
    assert Counter(r[:6] for r in found) == wanted
    assert all(set(r[5].split(",")) <= set(r[6].split(",")) | {""} and 0 <= r[7] <= 1 for r in found)


def test_op10(spark):
    documents = {d: t for d, t in table("documents", "doc_id", "text")}
    load, slots, shards_of = Counter(), defaultdict(list), defaultdict(set)
    found = rows(spark, "op10_sharding")
    assert Counter(r[0] for r in found) == Counter(list(documents))
    for doc, size, crc, law, shard, slot, grown in found:
        data = (documents[doc] or "").encode()
        assert (size, crc, law, grown) == (len(data) + 16, brute.zlib.crc32(data), "bytes", None)
        load[shard] += size
        slots[shard].append(slot)
        shards_of[documents[doc]].add(shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(load) == set(range(40))
    assert max(load.values()) - min(load.values()) < 0.1 * np.mean(list(load.values()))
    assert sum(len(s) > 1 for s in shards_of.values()) <= 0.1 * sum(n > 1 for n in Counter(documents.values()).values())
