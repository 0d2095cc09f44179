"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from starloom.llm import decontaminate, hnsw, jaccard, licenses, mixing, quality, sharding, toxicity, warc
from starloom.llm.components import connected_components

LONG = " ".join(f"w{i}" for i in range(30_000))
#: Columns that the operators use inside, under names that a user may have too.
CLASH = "key string, shard int, token long, class long, score double, n int, link string, _hash int, window string"
TEXTS = [
    (1, "a b c d e f g h i j k l"),
    (2, "a b c d e f g h i j k l"),
    (3, None),
    (4, ""),
    (5, " \n "),
    (None, "a b c d e f g h i j k l"),
    (6, "a b c d e f g h i j k l"),
    (6, "a b c d e f g h i j k l"),
    (7, "x"),
    (8, "X"),
    (9, LONG),
    (10, LONG + " extra"),
    (11, "Ünïcode wörds ärë ÜNÏCODE kept apart by case here and there"),
]


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(d, t, "en", None if d in (1, 7) else f"s{(d or 0) % 3}") for d, t in TEXTS]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    extra = [F.lit(None).cast(field.split()[1]).alias(field.split()[0]) for field in CLASH.split(", ")]
    return df.select("*", *extra).repartition(3)


def test_decontamination(spark, documents):
    items = [(1, "c d e f g h i j k l m"), (1, "x"), (2, None), (3, ""), (4, "b c d e f g h i j k"), (None, "w5 w6"), (5, "kept")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(documents, benchmark)
    got = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids)) for r in found.collect())
    named = [(i, t) for i, t in items if i is not None]
    without = [(d, n, hit, items) for d, n, hit, items in brute.contaminated(TEXTS, named)]
    assert {k[0]: k[1:] for k in got if k[0] not in (9, 10)} == {w[0]: w[1:] for w in without if w[0] not in (9, 10)}
    assert [k[2] for k in got if k[0] in (9, 10)] == [2, 2]  # the item without an id still hits
    assert sum(got.values()) == len(TEXTS) and set(documents.columns) <= set(found.columns)
    empty = decontaminate.contamination(documents, benchmark.limit(0)).agg(F.sum("n_hit")).first()[0]
    assert empty == 0 and decontaminate.contamination(documents.limit(0), benchmark).count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "red x blue"), (2, "red blue"), (3, "red x x x x blue"), (4, "blue red")], "doc_id long, text string")
    windows, _ = decontaminate.benchmark_windows(spark.createDataFrame([(1, "red blue")], "item_id long, text string"), 10)
    probes = decontaminate.rarest_terms(docs, windows, 2)
    index = decontaminate.postings(docs)
    assert index.count() == 13
    near = {r.doc_id for r in decontaminate.proximity_matches(index, probes, 2).collect()}
    assert near == {1, 2, 4} and {r.doc_id for r in decontaminate.phrase_candidates(index, probes).collect()} == {2}


def near_windows_of(text, benchmark, width, slack):
    """The windows near any start of the text, by brute force, and the items that hold them."""
    w, windows, items = brute.alnum_words(text), set(), set()
    for item, passage in benchmark:
        p = brute.alnum_words(passage)
        for i in range(max(1, len(p) - width + 1) if p else 0):
            window = tuple(p[i : i + width])
            k = min(slack, len(window) // 5)
            for s in range(-2 * width, len(w) + 2 * width):
                there = sum(x in w[max(0, s + j - k) : max(0, s + j + k + 1)] for j, x in enumerate(window))
                if there >= len(window) - k:
                    windows.add(window)
                    items.add(str(item))
                    break
    return len(windows), sorted(items)


def test_near_passages(spark):
    rng = np.random.default_rng(11)
    vocabulary = [f"v{i}" for i in range(60)]
    benchmark = [(i, " ".join(rng.choice(vocabulary, n))) for i, n in enumerate([30, 25, 12, 10, 7, 5, 3, 1])]
    rows = [(900, ""), (901, None), (902, "v1 v2")]
    for i in range(150):
        text = list(rng.choice(vocabulary, rng.integers(0, 40)))
        passage = benchmark[i % 6][1].split()
        for at in range(len(passage) - 1, int(rng.integers(2, 7)), -int(rng.integers(3, 9))):
            passage[at : at + 1] = [["x", passage[at]], [], ["changed"]][i % 3]
        at = int(rng.integers(len(text) + 1))
        rows.append((i, " ".join(text[:at] + passage + text[at:])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(benchmark, "item_id long, text string")
    found = decontaminate.contamination(docs, items, slack=2)
    got = {r.doc_id: r for r in found.collect()}
    plain = {r.doc_id: r for r in decontaminate.contamination(docs, items).collect()}
    wanted = {d: near_windows_of(t, benchmark, 10, 2) for d, t in rows}
    assert {d: (r.n_near, r.near_ids) for d, r in got.items()} == wanted
    assert sum(not r.item_ids and r.near_ids != [] for r in got.values()) > 0 and len(got) == len(rows)
    assert all((r.n_hit, r.item_ids) == (plain[d].n_hit, plain[d].item_ids) for d, r in got.items())


def test_candidates_carry_no_items(spark, monkeypatch):
    tables = {}

    def keep(df, label):
        tables[label] = stored(df, label)
        return tables[label]

    stored = decontaminate.stored
    monkeypatch.setattr(decontaminate, "stored", keep)
    shared = "one two three four five six seven eight nine ten"
    items = spark.range(300).select(F.col("id").alias("item_id"), F.lit(shared).alias("text"))
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.concat(F.lit(shared + " "), F.col("id")).alias("text"))
    found = decontaminate.contamination(docs, items).collect()
    assert all(r.n_hit == 10 and len(r.item_ids) == 300 for r in found) and len(found) == 50
    assert "item" not in tables["test-hits"].schema.simpleString() and tables["test-hits"].count() == 50


def test_near_passages_are_in_a_query(spark):
    from starloom.llm.queries import REGISTRY

    found = REGISTRY["op1_proximity"](spark, "/root/testdata/sf0.01")
    same = REGISTRY["op1_decontamination"](spark, "/root/testdata/sf0.01")
    assert Counter(found.drop("n_near", "near_ids").collect()) == Counter(same.collect())
    assert found.filter("contaminated and n_near = 0").count() == 0 and found.filter("n_near > 0").count() > 0


def test_jaccard(spark, documents):
    found = jaccard.jaccard_components(documents)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in found.collect())
    named = [(d, t) for d, t in TEXTS if d is not None]
    assert got == Counter(brute.jaccard_components(named)) + Counter([(None, 8, None)])
    kept = jaccard.keep_first(documents, found)
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 3, 4, 5, None, 7, 9, 11])
    assert kept.columns == documents.columns
    assert jaccard.jaccard_components(documents.limit(0)).count() == 0


def test_jaccard_near_copies(spark):
    rng = np.random.default_rng(3)
    words = np.array([f"v{i}" for i in range(400)])
    rows, n = [], 0
    passage = " ".join(rng.choice(words, 40))
    for _ in range(25):
        base = list(rng.choice(words, rng.integers(8, 120)))
        for _ in range(rng.integers(1, 9)):
            text = list(base)
            for _ in range(rng.integers(0, 4)):
                text[rng.integers(len(text))] = str(rng.choice(words))
            rows.append((n, " ".join(text) + (f" {passage}" if n % 3 == 0 else "")))
            n += 1
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(df).collect())
    assert got == Counter(brute.jaccard_components(rows))


def test_prefix_tokens_are_looked_at_in_slices(spark):
    texts = [(i, " ".join(f"w{(i * 31 + j) % 997}" for j in range(200))) for i in range(60)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    _, sketch = jaccard.signatures(df)
    levels = spark.sparkContext.broadcast(jaccard._levels(sketch))
    whole = Counter(jaccard.prefix_tokens(df, levels).collect())
    slices = [Counter(jaccard.prefix_tokens(df, levels, part=k, parts=jaccard.SLICES).collect()) for k in range(jaccard.SLICES)]
    assert sum(slices, Counter()) == whole
    assert jaccard.SLICES > 1 and max(s.total() for s in slices) < 0.6 * whole.total(), "a slice holds most rows"
    shared = [Counter(jaccard.shared_tokens(df, sketch, parts=n).collect()) for n in (1, jaccard.SLICES)]
    assert shared[0] == shared[1] and shared[0]


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (7, 7), (102, 101), (200, 200)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {100: 100, 101: 100, 102: 100}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_mixing(spark, documents):
    mixed = mixing.mix_documents(documents)
    rows = mixed.collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += r.size
    targets = brute.targets(sizes)
    taken = Counter()
    for r in rows:
        assert r.target == pytest.approx(targets[r.source]) and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - targets[s]) <= 1 for s in sizes) and len(rows) == len(TEXTS)
    rows = [r for r in mixing.mix_documents(documents, row=mixing.row_hash(documents)).collect()]
    applied = mixing.apply_mix(documents, mixing.mix_documents(documents, row=mixing.row_hash(documents)))
    assert applied.columns == documents.columns
    copies = Counter(r.doc_id for r in applied.collect())
    assert copies == Counter({d: n for d, n in Counter(
        {d: sum(-(-r.taken // r.size) for r in rows if r.doc_id == d and r.taken) for d in {r.doc_id for r in rows}}
    ).items() if n})
    assert mixing.mix_documents(documents.limit(0)).count() == 0
    assert mixing.mix_documents(documents.filter("doc_id in (3, 4)")).agg(F.sum("taken")).first()[0] == 0


def test_sharding(spark, documents):
    rows = sharding.shard_documents(documents, shards=4).collect()
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((d, len((t or "").encode()) + 16) for d, t in TEXTS)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(4))
    assert len({r.shard for r in rows if r.doc_id in (1, 2, 6)}) == 1
    assert sharding.shard_documents(documents.limit(0)).count() == 0


def test_sharding_splits_a_huge_group(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.expr("if(id % 3 = 0, 'same text', concat('own ', id))").alias("text"))
    load = Counter()
    for r in sharding.shard_documents(df, shards=10).collect():
        load[r.shard] += r.size
    assert max(load.values()) - min(load.values()) < 0.02 * np.mean(list(load.values()))


def test_sharding_gathers_every_group(spark):
    # A third of the rows in one text, the others in groups of 2 to 60 (30 % of them) or alone.
    texts = ["hot " * 10] * 4000 + [f"group {g} " * 4 for g in range(120) for _ in range(2 + g % 59)]
    texts += [f"own text number {i} of its kind" for i in range(12_000 - len(texts))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    load, shards_of = Counter(), defaultdict(set)
    for r in sharding.shard_documents(df, shards=20).collect():
        load[r.shard] += r.size
        shards_of[texts[r.doc_id]].add(r.shard)
    quota = sum(load.values()) / 20
    assert max(load.values()) - min(load.values()) < 0.05 * quota
    hot = shards_of.pop(texts[0])
    assert len(hot) <= 4000 * (len(texts[0]) + 16) / quota + 1.5
    assert all(len(s) == 1 for s in shards_of.values())


def test_sharding_by_a_link_table(spark, monkeypatch):
    # Rings of 8 documents with chords, an edge from each ring to the next; unlinked documents beside.
    edges = [(r * 8 + i, r * 8 + (i + step) % 8) for r in range(24) for i in range(8) for step in (1, 2, 3)]
    edges += [(r * 8, (r + 1) % 24 * 8 + 1) for r in range(24)]
    links = [(doc, str(n)) for n, edge in enumerate(edges) for doc in edge] + [(None, "7"), (3, None), (999, "1")]
    df = spark.range(400).select(F.col("id").alias("doc_id"), F.format_string("text %05d", "id").alias("text"))
    seen, whole = [], sharding.propagate

    def spy(nodes, members, shards, quota):
        found, cuts = whole(nodes, members, shards, quota)
        at = {r.row: r.shard for r in found.collect()}
        ends = defaultdict(list)
        for r in members.collect():
            ends[r.hub].append(at[r.row])
        seen.extend([cuts, sum(a != b for a, b in ends.values())])
        return found, cuts

    monkeypatch.setattr(sharding, "propagate", spy)
    found = sharding.shard_documents(df, shards=4, links=spark.createDataFrame(links, "doc_id long, link string")).collect()
    shard = {r.doc_id: r.shard for r in found}
    cuts, last = seen
    assert len(found) == len(shard) == 400 and set(Counter(shard.values()).values()) == {100}
    assert all(a > b for a, b in zip(cuts, cuts[1:])) and cuts[-1] == last
    # By hash three quarters of the edges are cut.
    assert sum(shard[a] != shard[b] for a, b in edges) < 0.35 * len(edges)


def test_classifiers(spark, documents):
    labels = spark.createDataFrame(
        [(i, i % 2, i % 2) for i in (1, 2, 3, 4, 6, 7, 8, 9, 10)] + [(None, 1, 1), (11, None, None)], "doc_id long, quality int, toxic int"
    )
    for classify, label in ((quality.classify_quality, "quality"), (toxicity.classify_toxicity, "toxic")):
        for known in (labels, labels.limit(0), labels.withColumn(label, F.lit(1))):
            found = classify(documents, known)
            rows = found.collect()
            assert Counter(r.doc_id for r in rows) == Counter(d for d, _ in TEXTS)
            assert all(0 <= r.score <= 1 for r in rows) and set(documents.columns) <= set(found.columns)
        assert classify(documents.limit(0), labels).count() == 0


def test_word_sums_reach_the_driver_as_one_table(spark, monkeypatch):
    rows = [(i, f"good words {i} stand here".encode() if i % 2 else f"#{i} xx {i} !!".encode(), i % 2) for i in range(64)]
    sample = spark.createDataFrame(rows, "doc_id long, text binary, label int")
    collect, seen = type(sample).collect, []

    def spy(df):
        found = collect(df)
        seen.extend(len(r.sums) for r in found if "sums" in r)
        return found

    fitted = []
    for tasks in (1, 8):
        with monkeypatch.context() as patch:
            patch.setattr(quality, "labelled_sample", lambda *a: sample.repartition(tasks))
            patch.setattr(type(sample), "collect", spy)
            fitted.append(quality.fit_quality(sample, sample))
    size = 4 * fitted[0].shape.words * fitted[0].shape.dims
    assert seen == [size, size], "the driver gets a table of each task"
    assert (fitted[0].vectors == fitted[1].vectors).all() and fitted[0].vectors.any()


def test_word_ids_do_not_depend_on_pieces(monkeypatch):
    shape = quality.Shape()
    text = b"a a a b !! c c " * 50
    whole = np.concatenate(list(quality.word_ids(text, shape)))
    monkeypatch.setattr(quality, "PIECE", 64)
    assert (np.concatenate(list(quality.word_ids(text, shape))) == whole).all()


def test_swaps_lower_false_positives(spark):
    rng = np.random.default_rng(5)
    filler = [f"word{i}" for i in range(200)]
    rows = []
    for i in range(1500):
        toxic = i % 3 == 0
        words = list(rng.choice(filler, 12))
        if rng.random() < (0.9 if toxic else 0.05):
            words.append("muslims")
        if toxic and rng.random() < 0.8:
            words.append("idiot")
        rows.append((i, " ".join(words), int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    neutral = toxicity.text_features(b"many muslims word3 word7")
    scores = []
    for penalty in (0.0, 50.0):
        model = toxicity.fit_toxicity(df, df, swap_penalty=penalty)
        scores.append((model.score(neutral), model.score(toxicity.text_features(b"you idiot word3"))))
    (plain, _), (fair, insult) = scores
    assert fair < 0.5 * plain and insult > 0.8


def test_archives(spark):
    big = "<p>" + "payload " * 40_000
    pages = [(1, "http://a/x y", big), (2, None, big), (3, "u\r\nInjected: 1", None), (4, "u", ""), (5, "u", "small"), (6, "u", "small"),
             (None, "u", big), (7, "ü", "é" * 60), (7, "ü", "é" * 60), (8, "v", "é" * 60)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("payload", F.lit("clash")).repartition(4)
    index = warc.archive_pages(df)
    records = warc.read_bundles(index).collect()
    got = Counter((r.record_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in records)
    assert got == Counter(brute.archived([(p, h) for p, _, h in pages]))
    assert all(r.uri is None or not any(c in r.uri for c in "\r\n ") for r in records)
    one = warc.fetch_records(index.filter("record_id in (5, 8)")).collect()
    assert {(r.record_id, r.payload and r.payload.decode()) for r in one} == {(5, "small"), (8, None)}
    assert {r.record_id: r.payload for r in records}[1].decode() == big
    assert warc.read_bundles(warc.archive_pages(df.limit(0))).count() == 0


def test_seek_table(spark):
    page = spark.range(300).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.expr("repeat(md5(string(id)), 100)").alias("html"))
    index = warc.write_bundles(warc.page_records(page), warc.scratch_path(spark, "warc"), frame_bytes=20_000, bundle_bytes=100_000)
    assert index.select("bundle", "frame").distinct().count() > 20 and index.select("bundle").distinct().count() > 1
    some = warc.fetch_records(index.filter("record_id % 7 = 0")).collect()
    assert {r.record_id for r in some} == set(range(0, 300, 7))


def test_licenses(spark, documents):
    assert licenses.to_postfix("MIT OR (Apache-2.0 AND GPL-2.0 WITH Classpath)") == ["mit", "apache-2.0", "gpl-2.0", "classpath", "with", "and", "or"]
    assert [licenses.to_postfix(x) for x in ("", "AND", "MIT OR", "(MIT", "MIT)", "MIT Apache")] == [None] * 6
    permits = lambda x: licenses.is_permissive(licenses.to_postfix(x))
    assert permits("MIT OR GPL-3.0") and not permits("MIT AND GPL-3.0") and permits("(GPL-3.0 OR MIT) AND ISC")
    texts = ["The MIT License. mit-license MIT\nLICENSE", "SPDX-License-Identifier: MIT OR GPL-3.0\n(c)", "submit license mit licensed",
             "GNU Lesser General Public License", "// SPDX-License-Identifier: (MIT AND", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in licenses.scan_licenses(df).collect()}
    for i, text in enumerate(texts):
        r = rows[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.base_licenses(text, licenses.BASE_PHRASES)
    assert rows[0].n_base == 3 and rows[3].labels == "gpl,lgpl"
    assert (rows[1].labels, rows[1].permissive, rows[1].score) == ("gpl-3.0,mit", True, 1.0)
    found = licenses.scan_licenses(documents)
    assert found.count() == len(TEXTS) and licenses.scan_licenses(documents.limit(0)).count() == 0


def test_long_license_expressions(spark):
    names = [f"LicenseRef-{i}" for i in range(200)]
    nested = "(" * 300 + "MIT" + ")" * 300
    texts = [
        "SPDX-License-Identifier: " + " OR ".join(names),
        "SPDX-License-Identifier: " + "MIT AND " * 199 + "GPL-3.0 is the licence",
        f"SPDX-License-Identifier: {nested} AND (",
        "SPDX-License-Identifier: MIT OR SPDX-License-Identifier: ISC",
        "SPDX-License-Identifier:x11 or " * 20_000,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = [r for r in licenses.scan_licenses(df).orderBy("doc_id").collect()]
    assert rows[0].labels == ",".join(sorted(x.lower() for x in names))
    assert (rows[1].labels, rows[1].permissive) == ("gpl-3.0,mit", False)
    assert (rows[2].labels, rows[2].permissive) == ("mit", True)
    assert (rows[3].labels, rows[3].expressions) == ("isc,mit", ["MIT", "ISC"])
    assert rows[4].expressions == ["x11"] * 20_000


def test_words_that_name_no_licence_end_an_expression():
    read = lambda x: (licenses.leading_expression(x) or [None])[0]
    assert read("on top of every file") is None
    assert read("MIT OR whatever you like") == "MIT"
    assert read("GPL-2.0+ WITH Classpath-exception-2.0 AND LicenseRef-x") == "GPL-2.0+ WITH Classpath-exception-2.0 AND LicenseRef-x"
    assert read("GPL-2.0 WITH luck") == "GPL-2.0" and read("MIT WITH (Classpath-exception-2.0)") == "MIT"
    assert read("DocumentRef-a:LicenseRef-b") == "DocumentRef-a:LicenseRef-b"


def test_leading_expression_is_the_longest_well_formed_start():
    rng = np.random.default_rng(7)
    for _ in range(3000):
        kinds = ["MIT", "GPL-2.0+", "AND", "or", "WITH", "(", ")", "Classpath-exception-2.0", "the"]
        pieces = list(rng.choice(kinds, rng.integers(0, 9), p=[0.2, 0.1, 0.15, 0.15, 0.1, 0.1, 0.1, 0.07, 0.03]))

        def sound(part):
            behind = [a == "WITH" for a in ["", *part[:-1]]]
            named = all(w == (x == "Classpath-exception-2.0") for x, w in zip(part, behind) if x not in kinds[2:7])
            return named and "the" not in part and not any(w and x == "(" for x, w in zip(part, behind))

        ends = [n for n in range(len(pieces), 0, -1) if sound(pieces[:n]) and licenses.to_postfix(" ".join(pieces[:n])) is not None]
        found = licenses.leading_expression(" ".join(pieces))
        assert (found and found[0]) == (" ".join(pieces[: ends[0]]) if ends else None)


def test_nearest(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(i, same) for i in range(40)] + [(40, None), (41, [0.0, 0.0, 0.0]), (42, [float("nan"), 1.0, 1.0]), (43, [None, 1.0, 1.0]),
            (44, [float("inf"), 1.0, 1.0]), (None, same), (45, [2.0, 1.0]), (46, [-1.0, 5.0, 0.5]), (46, [-1.0, 5.0, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = defaultdict(list)
    for r in hnsw.nearest_neighbours(df, df, k=5).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    valid = [(i, v) for i, v in rows if i is not None and i not in range(40, 46)][:-1]
    wanted = brute.nearest(valid, valid, 5)
    assert {q: [v for v, _ in x] for q, x in found.items()} == {q: [v for v, _ in x] for q, x in wanted.items()}
    assert hnsw.nearest_neighbours(df.limit(0), df, k=5).count() == 0
    assert hnsw.nearest_neighbours(df, df.limit(0), k=5).count() == 0


def test_graph_recall():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 24)).astype(np.float32)
    params = hnsw.Params()
    graph = hnsw.Graph(x, params, hnsw.draw_levels(np.arange(3000), params))
    graph.build()
    again = hnsw.restore(x, graph.levels, [graph.flat(i) for i in range(len(x))], params)
    q = x[:100]
    found, _ = again.search(q, 0, again.descend(q, 0, again.top, again.entry), 96)
    best = np.argsort(-(q @ x.T), axis=1)[:, :20]
    assert np.mean([len(set(f[:20]) & set(b)) / 20 for f, b in zip(found, best, strict=True)]) > 0.9


@pytest.mark.parametrize("longest", [1.0, 10.0, 1e6, 1e150])
def test_recall_does_not_depend_on_the_lengths_of_vectors(spark, longest):
    """Over at least four shards: vectors of one length, of lengths up to ``longest``, and with one far longer."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    some = longest ** rng.uniform(size=(4000, 1))
    few = np.where(np.arange(4000)[:, None] == 17, longest, 1.0)
    for lengths in (some, few):
        y = x * lengths
        rows = [(i, v.tolist()) for i, v in enumerate(y)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        clashing = df.withColumns({"Dim": F.lit(1), "SHARD": F.lit("x"), "v": F.lit(0), "q": F.lit(0), "band": F.lit(2)})
        params = hnsw.Params(shard_rows=900, block_rows=64)
        index = hnsw.build_index(clashing, 21, params)
        assert index.select("band", "shard").distinct().count() >= 4
        queries = hnsw.valid_vectors(clashing.filter("vec_id % 20 = 0"))
        found = defaultdict(dict)
        for r in hnsw.search_index(index, queries, 20, params).collect():
            found[r.query_id][r.vec_id] = r.score
        wanted = brute.nearest(rows, rows[::20], 20)
        hits = sum(len(set(found[q]) & {v for v, _ in near}) for q, near in wanted.items())
        assert hits >= 0.95 * 20 * len(wanted) and set(found) == set(wanted)
        for q, near in found.items():
            assert len(near) == 20
            for v, score in near.items():
                assert score == pytest.approx(y[q] @ y[v], rel=1e-9, abs=1e-9 * float(lengths[q, 0] * lengths[v, 0]))


def test_slices_of_texts_split_like_whole_ones():
    import pyarrow as pa

    from starloom.llm.common import split_texts

    texts = [t for i in range(400) for t in (f"Ünï {i}  cià\t", None, "", "x é à\n" * (i % 7))]
    whole = pa.array(texts)
    for at, n in ((0, 1600), (400, 700), (1201, 300)):
        words, counts = split_texts(whole.slice(at, n))
        words, rows = words.to_pylist(), []
        for count in counts:
            rows.append([w for w in words[:count] if w])
            words = words[count:]
        assert rows == [brute.solid_words(t) for t in texts[at : at + n]]


def test_bundles_are_read_in_many_tasks(spark):
    """The bundles are dealt out anew, and adaptive execution leaves their number of tasks alone."""
    rows = [(i, f"http://h/{i}", f"page {i} " * 50) for i in range(64)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(16)
    index = warc.archive_pages(pages)
    assert index.select("bundle").distinct().count() == 16
    task = F.spark_partition_id()
    for read in (warc.read_bundles(index, payload=False), warc.fetch_records(index)):
        assert read.select(task.alias("task")).distinct().count() >= 4 and read.count() == 64
