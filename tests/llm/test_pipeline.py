"""The pipeline's stages, each on what its predecessor kept, against plain versions."""

from collections import Counter

import pytest

import brute
import corpus_pipeline
from starloom.llm.common import stored
from starloom.llm.quality import classify_quality

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def results(spark):
    docs = stored(spark.read.parquet(f"{SF_DIR}/documents.parquet"), "pipeline-input")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), "pipeline-test")
        out.append((name, docs))
    return out


def texts(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns_and_order(results):
    columns = results[0][1].columns
    assert [name for name, _ in results[1:]] == ["quality", "near duplicates", "decontamination", "mixing", "sharding"]
    assert all(df.columns == columns for _, df in results[:-1])


def test_quality_keeps_the_good(spark, results):
    before, after = results[0][1], {d for d, _ in texts(results[1][1])}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    ids = [d for d, _ in texts(before)]
    good = [d for d in ids if labels.get(d) == 1]
    bad = [d for d in ids if labels.get(d) == 0]
    assert sum(d in after for d in good) >= 0.97 * len(good)
    assert sum(d in after for d in bad) <= 0.4 * len(bad)
    predicted = classify_quality(before, spark.read.parquet(f"{SF_DIR}/labels.parquet")).filter("predicted = 1")
    assert after == {r.doc_id for r in predicted.select("doc_id").collect()}


def test_one_document_of_each_component_stays(results):
    components = brute.jaccard_components(texts(results[1][1]))
    wanted = Counter(d for d, _, top in components if d == top)
    assert Counter(d for d, _ in texts(results[2][1])) == wanted
    assert len(wanted) < len(components)


def test_contaminated_documents_go(spark, results):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    clean = Counter(d for d, _, hit, _ in brute.contaminated(texts(results[2][1]), items) if not hit)
    assert Counter(d for d, _ in texts(results[3][1])) == clean
    assert sum(clean.values()) < results[2][1].count()


def test_sources_come_near_their_targets(results):
    rows, mixed = results[3][1].collect(), results[4][1].collect()
    size = lambda r: len(brute.SOLID.findall(r.text or ""))
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in rows:
        sizes[r.source] += size(r)
        largest[r.source] = max(largest[r.source], size(r))
    for r in mixed:
        taken[r.source] += size(r)
    targets = brute.targets(sizes)
    assert all(-1 <= taken[s] - targets[s] <= largest[s] for s in sizes)
    assert max(Counter(r.doc_id for r in mixed).values()) <= 2


def test_shards_are_even_and_hold_every_row(results):
    mixed, rows = results[4][1], results[5][1].collect()
    assert Counter(r.doc_id for r in rows) == Counter(d for d, _ in texts(mixed))
    load = Counter()
    for r in rows:
        load[r.shard] += r.size
    assert set(load) == set(range(40)) and max(load.values()) < 1.25 * min(load.values())


def test_run(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and corpus_pipeline.ORACLE_SQL is None


OWN = {
    "score": 99.0, "Predicted": 7, "held_out": -1, "N_WORDS": -2, "n_hit": -3, "item_ids": "mine", "spans": -4, "row": 5,
    "text_hash": 6, "first": "x", "turns": 8, "user_column_4": 9, "_key": 10, "size": 11, "class": 12,
}
PASSAGE = "the clean words of an ordinary page about tea and boats that nobody else has ever written"


@pytest.fixture(scope="module")
def odd_documents(spark):
    """Nulls, empty texts, ties, equal rows, rows that differ in lang alone, unlike texts under one id; own columns."""
    rows = [
        (1, PASSAGE, "en", "a"), (1, PASSAGE, "de", "a"), (1, PASSAGE, "de", "a"), (2, None, None, None), (3, "", "en", "b"),
        (None, "a text without an id that stays as it is", "en", "a"), (4, "one text of number four on rivers and hills", "en", "b"),
        (4, "quite another page under the same number on metal and glass", "en", "b"), (5, " \n", "en", None),
        (6, "words " * 30_000, "en", "a"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    from pyspark.sql import functions as F

    return df.withColumns({k: F.lit(v) for k, v in OWN.items()}).repartition(3)


@pytest.fixture(scope="module")
def odd_tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("odd")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = [(1, "one text of number four on rivers and hills"), (2, None), (3, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def whole(df):
    return Counter(tuple(r) for r in df.collect())


def test_filters_leave_own_columns_alone(spark, odd_documents, odd_tables):
    before = whole(odd_documents)
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, odd_documents, odd_tables)
        assert out.schema.simpleString() == odd_documents.schema.simpleString(), name
        after = whole(out)
        assert set(after) <= set(before), name
        assert stage(spark, odd_documents.limit(0), odd_tables).count() == 0, name


def test_near_duplicates_keep_unlike_texts_under_one_id(spark, odd_documents, odd_tables):
    kept = Counter((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, odd_documents, odd_tables).collect())
    assert kept == Counter({(r.doc_id, r.text): 1 for r in odd_documents.collect()})


def test_decontamination_takes_the_passage_alone(spark, odd_documents, odd_tables):
    kept = whole(corpus_pipeline.decontamination(spark, odd_documents, odd_tables))
    gone = whole(odd_documents) - kept
    assert [r[1] for r in gone.elements()] == ["one text of number four on rivers and hills"]


def test_mixing_keeps_rows_that_differ_in_any_column(spark, odd_documents, odd_tables):
    out = corpus_pipeline.mixing(spark, odd_documents, odd_tables)
    assert out.schema.simpleString() == odd_documents.schema.simpleString()
    before, after = whole(odd_documents), whole(out)
    assert set(after) <= set(before)
    mixed = corpus_pipeline.mix_documents(odd_documents, row=corpus_pipeline.row_hash(odd_documents)).collect()
    turns = Counter()
    for r in mixed:
        if r.taken:
            turns[r.doc_id, r.row_hash] += -(-r.taken // r.size)
    assert sum(after.values()) == sum(turns.values()) and all(n <= 2 * before[row] for row, n in after.items())
    small = odd_documents.filter("doc_id = 1")
    taken = Counter(r.lang for r in corpus_pipeline.mixing(spark, small, odd_tables).collect())
    assert set(taken) == {"en", "de"}, "a row that differs in lang is lost"


def test_sharding_takes_odd_rows(spark, odd_documents, odd_tables):
    out = corpus_pipeline.sharding(spark, odd_documents, odd_tables)
    assert Counter(r.doc_id for r in out.collect()) == Counter(r.doc_id for r in odd_documents.collect())
