"""Benchmark decontamination by a positional inverted index: exact phrases and near ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import NOT_ALNUM, ascii_lower, discard, free_names, light, n_words, stored, words


def text_words(text: Column) -> Column:
    """Lower-case words of letters, digits and non-ASCII characters, in order."""
    return words(ascii_lower(text), NOT_ALNUM)


def benchmark_windows(benchmark: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """The distinct windows (window, words, length) and which items hold them (window, item_id).

    An item's windows are its runs of ``width`` words; a shorter item is one window. An item
    without words has none.
    """
    item = benchmark.select("item_id", text_words(F.col("text")).alias("w"))
    n = F.size("w")
    starts = F.when(n >= width, F.sequence(F.lit(1), F.greatest(n - width + 1, F.lit(1)))).otherwise(
        F.array(F.lit(1))
    )
    runs = item.filter(n > 0).select(
        "item_id", F.explode(F.transform(starts, lambda s: F.slice("w", s, width))).alias("words")
    )
    # Words hold no blanks, so the joined words name the window.
    runs = runs.withColumn("window", F.md5(F.concat_ws(" ", "words").cast("binary")))
    windows = runs.groupBy("window").agg(F.first("words").alias("words")).withColumn("length", F.size("words"))
    return windows, runs.select("window", "item_id").distinct()


def _tokens(documents: DataFrame, *positions: str) -> DataFrame:
    """A row for each word of each document, named by its id and the text's hash."""
    out = F.posexplode if positions else F.explode
    names = (*positions, "term")
    return documents.select("doc_id", F.xxhash64("text").alias("text_hash"), out(text_words(F.col("text"))).alias(*names))


def rarest_terms(documents: DataFrame, windows: DataFrame, probes: int) -> DataFrame:
    """The ``probes`` rarest terms of each window: window, length, term, shift, probe (from 0), n_probes.

    Rarity is the term's count over all documents; ``shift`` its place in the window.
    """
    places = windows.select("window", "length", F.posexplode("words").alias("shift", "term"))
    terms = stored(places.select("term").distinct(), "test-terms")
    tokens = _tokens(documents).select("term").join(light(terms), "term")
    counts = tokens.groupBy("term").agg(F.count("*").alias("n"))
    ranked = places.join(counts, "term", "left").withColumn(
        "probe",
        F.row_number().over(Window.partitionBy("window").orderBy(F.coalesce("n", F.lit(0)), "term", "shift")) - 1,
    )
    return ranked.filter(F.col("probe") < probes).select(
        "window", "length", "term", "shift", "probe", F.least("length", F.lit(probes)).alias("n_probes")
    )


def pair_probes(probes: DataFrame, windows: DataFrame) -> DataFrame:
    """The probes as pairs of neighbours: adds ``pair``, a hash of the term and the word behind it in the window.

    A term at its window's end goes by the pair before it; a window of one word has no pair (null).
    """
    words_of = windows.select(F.col("window").alias("of"), "words")
    found = probes.join(words_of, F.col("window") == F.col("of")).withColumn(
        "shift", F.least("shift", F.greatest(F.col("length") - 2, F.lit(0)))
    )
    term, after = F.get("words", F.col("shift")), F.get("words", F.col("shift") + 1)
    pair = F.when(F.col("length") > 1, F.xxhash64(term, after))
    return found.select("window", "length", term.alias("term"), "shift", "probe", "n_probes", pair.alias("pair"))


def postings(documents: DataFrame, probes: DataFrame | None = None) -> DataFrame:
    """The positional index: term, doc_id, text_hash, pos. Of all terms, or of the postings that ``probes`` open.

    A probe opens its term's postings that have the pair's second word behind them, so a frequent
    term's list holds little else than places that a search needs.
    """
    tokens = _tokens(documents, "pos").select("term", "doc_id", "text_hash", "pos")
    if probes is None:
        return tokens
    alone = probes.filter("pair is null").select("term").distinct()

    def with_next(w: Column) -> Column:
        return F.transform(w, lambda x, i: F.struct(x.alias("term"), F.xxhash64(x, F.get(w, i + 1)).alias("pair")))

    # The words as a variable of the lambda are split once.
    pairs = F.transform(F.array(text_words(F.col("text"))), with_next)[0]
    listed = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(pairs).alias("pos", "t"))
    listed = listed.select("t.term", "doc_id", "text_hash", "pos", "t.pair")
    opened = listed.join(light(probes.filter("pair is not null").select("pair").distinct()), "pair")
    opened = opened.select("term", "doc_id", "text_hash", "pos", "pair")
    if alone.isEmpty():
        return opened
    single = tokens.join(light(alone), "term").withColumn("pair", F.lit(None).cast("long"))
    return opened.unionByName(single.select(opened.columns))


def shifted(index: DataFrame, probes: DataFrame) -> DataFrame:
    """Postings of the probe terms, moved back to where their windows would start."""
    if "pair" in index.columns:
        opened = F.col("index.pair").eqNullSafe(F.col("probes.pair")) & (F.col("index.term") == F.col("probes.term"))
        lists = index.alias("index").join(light(probes).alias("probes"), opened).select("index.*", *[
            f"probes.{c}" for c in ("window", "length", "shift", "probe", "n_probes")
        ])
    else:
        lists = index.join(light(probes), "term")
    return lists.select(
        "doc_id", "text_hash", "window", "length", "probe", "n_probes", (F.col("pos") - F.col("shift")).alias("start")
    )


def phrase_candidates(index: DataFrame, probes: DataFrame) -> DataFrame:
    """Where all probe terms of a window stand at their places: doc_id, text_hash, window, start, length."""
    bit = F.expr("shiftleft(1L, probe)")
    met = (
        shifted(index, probes)
        .filter("start >= 0")
        .groupBy("doc_id", "text_hash", "window", "start", "length")
        .agg(F.bit_or(bit).alias("met"), F.first("n_probes").alias("n_probes"))
    )
    return met.filter("met = shiftleft(1L, n_probes) - 1").select("doc_id", "text_hash", "window", "start", "length")


def proximity_matches(index: DataFrame, probes: DataFrame, slack: int) -> DataFrame:
    """Where all probe terms of a window stand within ``slack`` words of their places.

    Rows are doc_id, text_hash, window, start: the least start of the matching postings. Starts
    are dealt to overlapping stretches of ``2 * slack`` words, so two within ``slack`` of each
    other meet in one, and a stretch holds a bounded number of rows.
    """
    step = max(1, slack)
    stretch = F.floor(F.col("start") / step)
    near = shifted(index, probes).withColumn("stretch", F.explode(F.array(stretch, stretch - 1)))
    by = ["doc_id", "text_hash", "window", "stretch"]
    first = Window.partitionBy(*by).orderBy("start").rangeBetween(0, slack)
    bits = F.expr("shiftleft(1L, probe)")
    met = near.withColumn("met", F.bit_or(bits).over(first))
    found = met.filter("met = shiftleft(1L, n_probes) - 1")
    return found.groupBy("doc_id", "text_hash", "window", "stretch").agg(F.min("start").alias("start")).drop(
        "stretch"
    ).distinct()


def slack_of(length: Column, slack: int) -> Column:
    """What a near match of a window allows: a word in five, ``slack`` at most."""
    return F.least(F.lit(slack), F.floor(length / 5)).cast("int")


def near_candidates(documents: DataFrame, rarest: DataFrame, width: int, slack: int) -> DataFrame:
    """Where a near match may be: doc_id, text_hash, window, and the range lo to hi of its start.

    A match lacks ``k = slack_of(length)`` words at most, so of the k + 2 rarest two are there (a
    window of one word has that one twice), each within k words of its place. Every two of them are
    a key; a document's words meet the keys with the words around them, so that nothing but pairs of
    a window leaves the task. Words are named by 64-bit hashes here, which can only add candidates.
    """
    k = slack_of(F.col("length"), slack)
    probes = rarest.filter(F.col("probe") < k + 2).select("window", "length", F.xxhash64("term").alias("term"), "shift", k.alias("k"))
    other = probes.select("window", F.col("term").alias("term2"), F.col("shift").alias("shift2"))
    pairs = stored(
        probes.join(other, "window")
        .filter("shift < shift2 or length = 1")
        .select(F.xxhash64("term", "term2").alias("pair"), "term", "window", "shift", "shift2", "k"),
        "test-pairs",
    )
    hashes = F.transform(text_words(F.col("text")), lambda w: F.xxhash64(w))
    tokens = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), hashes.alias("w")).select(
        "*", F.posexplode("w").alias("pos", "term")
    )
    opened = tokens.join(light(pairs.select("term").distinct()), "term", "left_semi")
    first = F.greatest(F.col("pos") + 1 - 2 * slack, F.lit(0))
    around = opened.select(
        "doc_id", "text_hash", "pos", "term", first.alias("first"),
        F.posexplode(F.slice("w", first + 1, F.col("pos") + width + 2 * slack - first)).alias("at", "term2"),
    )
    met = around.withColumn("pair", F.xxhash64("term", "term2")).join(light(pairs.drop("term")), "pair")
    here, there = F.col("pos") - F.col("shift"), F.col("first") + F.col("at") - F.col("shift2")
    return (
        met.filter(F.abs(here - there) <= 2 * F.col("k"))
        .select(
            "doc_id",
            "text_hash",
            "window",
            (F.greatest(here, there) - F.col("k")).alias("lo"),
            (F.least(here, there) + F.col("k")).alias("hi"),
        )
        .distinct()
    )


def near_windows(documents: DataFrame, candidates: DataFrame, windows: DataFrame, slack: int) -> DataFrame:
    """The distinct doc_id, text_hash, window of near matches, verified on all words of the window.

    With ``k = slack_of(length)``, a window is near a start if all its words but k stand within k
    words of their places: a passage with k words put in, dropped or changed in any ten still is.
    """
    list_, key, text = "candidates", "found_id", "found_hash"
    per_document = candidates.join(light(windows), "window").groupBy(
        F.col("doc_id").alias(key), F.col("text_hash").alias(text)
    ).agg(F.collect_list(F.struct("window", "lo", "hi", "words", "length", slack_of(F.col("length"), slack).alias("k"))).alias(list_))
    texts = texts_of(documents, stored(candidates.select("doc_id", "text_hash").distinct(), "test-near-keys"))
    found = texts.join(per_document, F.col("doc_id").eqNullSafe(F.col(key)) & (F.col("text_hash") == F.col(text)))

    def is_near(w: Column, c: Column) -> Column:
        k, step = c["k"], 2 * c["k"] + 1

        def stands(start: Column, shift: Column) -> Column:
            first = start + shift - k
            near = F.slice(w, F.greatest(first, F.lit(0)) + 1, F.greatest(F.least(first, F.lit(0)) + step, F.lit(0)))
            return F.array_contains(near, F.element_at(c["words"], shift + 1))

        starts = F.sequence(c["lo"], c["hi"])
        shifts = F.sequence(F.lit(0), c["length"] - 1)
        return F.exists(starts, lambda start: F.size(F.filter(shifts, lambda j: stands(start, j))) >= c["length"] - k)

    # The words as a variable of the lambda are split once, not for each candidate.
    near = F.transform(F.array(text_words(F.col("text"))), lambda w: F.filter(list_, lambda c: is_near(w, c)))[0]
    return found.select("doc_id", "text_hash", F.explode(near["window"]).alias("window")).distinct()


def texts_of(documents: DataFrame, keys: DataFrame) -> DataFrame:
    """doc_id, text_hash and text of the documents in ``keys`` (doc_id, text_hash): each key's text once.

    The keys go to the documents while they are light; beyond that they meet in a shuffle.
    """
    named = keys.select(F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_hash") == F.col("found_hash"))
    rows = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.join(light(named), same, "left_semi").dropDuplicates(["doc_id", "text_hash"])


def exact_hits(documents: DataFrame, starts: DataFrame) -> DataFrame:
    """Candidates that hold word by word: doc_id, text_hash, found (window, start, length), a row per document.

    A window is named by the digest of its words, so a candidate needs its place and length alone.
    Of the texts only those with candidates move.
    """
    key, text = "found_id", "found_hash"
    per_document = starts.groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("window", "start", "length")).alias("candidates")
    )
    texts = texts_of(documents, stored(starts.select("doc_id", "text_hash").distinct(), "test-keys"))
    per_document = per_document.withColumnsRenamed({"doc_id": key, "text_hash": text})
    found = texts.join(per_document, F.col("doc_id").eqNullSafe(F.col(key)) & (F.col("text_hash") == F.col(text)))
    named = lambda w, c: F.md5(F.concat_ws(" ", F.slice(w, c["start"] + 1, c["length"])).cast("binary"))
    # The words as a variable of the lambda are split once, not for each candidate.
    exact = F.transform(
        F.array(text_words(F.col("text"))),
        lambda w: F.filter("candidates", lambda c: named(w, c) == c["window"]),
    )[0]
    return found.select("doc_id", "text_hash", exact.alias("found")).filter(F.size("found") > 0)


def holding_items(pairs: DataFrame, holders: DataFrame, out: str) -> DataFrame:
    """The items that hold the windows of each document, as sorted strings: doc_id, text_hash, ``out``, n_windows."""
    item = F.col("item_id").cast("string")
    return pairs.join(light(holders), "window").groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_set(item)).alias(out), F.count_distinct("window").alias("n_windows")
    )


def covered_words(spans: Column) -> Column:
    """How many words the spans (start, length) cover, each word once; ``spans`` is sorted."""

    def add(s: Column, x: Column) -> Column:
        end = (x["start"] + x["length"]).cast("long")
        fresh = F.greatest(F.lit(0), end - F.greatest(s["upto"], x["start"]))
        return F.struct(F.greatest(s["upto"], end).alias("upto"), (s["n"] + fresh).cast("long").alias("n"))

    state = F.aggregate(
        spans,
        F.struct(F.lit(0).cast("long").alias("upto"), F.lit(0).cast("long").alias("n")),
        add,
    )
    return state["n"]


def contamination(
    documents: DataFrame, benchmark: DataFrame, width: int = 10, probes: int = 2, slack: int = 0
) -> DataFrame:
    """Every row of ``documents`` with the benchmark windows found in it.

    Adds n_words, n_hit (words inside an occurrence of a window), item_ids (items with occurring
    windows, as sorted strings) and spans (start, length of the occurrences). The index holds the
    postings of the windows' rarest terms, the only ones a search opens, as far as the window's next
    word stands behind them; their offset-adjusted lists are intersected, and what is left is
    compared with the document word by word.

    With ``slack``, adds also n_near (distinct windows found exactly or nearly, see ``near_windows``)
    and near_ids (items that hold them, as sorted strings); the other columns stay as they are.

    Defined cases: a null or empty text has no words; a null item text no windows; a null or
    repeated doc_id, equal rows and extra columns stay as they are, but for own columns of the added
    names in any case, which are replaced; items repeated under one id
    count once; without benchmark or documents nothing is hit.
    """
    windows, holders = benchmark_windows(benchmark, width)
    windows, holders = stored(windows, "test-windows"), stored(holders, "test-items")
    rarest = stored(rarest_terms(documents, windows, max(probes, slack + 2) if slack else probes), "test-probes")
    first = rarest.filter(F.col("probe") < probes).withColumn("n_probes", F.least("n_probes", F.lit(probes)))
    first = stored(pair_probes(first, windows), "test-pairs")
    index = stored(postings(documents, first), "test-postings")
    starts = stored(phrase_candidates(index, first), "test-candidates")
    discard(documents.sparkSession, index)
    added = ["n_words", "n_hit", "item_ids", "spans"] + ["n_near", "near_ids"] * bool(slack)
    kept = [c for c in documents.columns if c.lower() not in added]
    own, key, text = free_names(documents, "own_hash", "found_id", "found_hash")
    hits = stored(exact_hits(documents, starts), "test-hits")
    pairs = hits.select("doc_id", "text_hash", F.explode("found.window").alias("window")).distinct()
    spans = F.array_sort(F.transform("found", lambda c: F.struct(c["start"].alias("start"), c["length"].alias("length"))))
    covered = hits.select("doc_id", "text_hash", covered_words(spans).alias("n_hit"), F.array_distinct(spans).alias("spans"))
    # Stored, so that Spark knows the bytes and broadcasts by these.
    found = stored(
        covered.withColumnRenamed("doc_id", "hit_id").join(
            holding_items(pairs, holders, "item_ids").drop("n_windows").withColumnRenamed("text_hash", "items_hash"),
            F.col("hit_id").eqNullSafe(F.col("doc_id")) & (F.col("text_hash") == F.col("items_hash")),
            "left",
        ).select(F.col("hit_id").alias(key), F.col("text_hash").alias(text), "n_hit", "item_ids", "spans"),
        "test-found",
    )
    # The words are counted before the join, which then needs no text unless the caller does.
    sized = documents.select(*kept, F.xxhash64("text").alias(own), n_words(F.col("text"), NOT_ALNUM).alias("n_words"))
    exactly = sized.join(found, F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(own) == F.col(text)), "left").select(
        *kept,
        own,
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.coalesce("spans", F.array().cast(found.schema["spans"].dataType)).alias("spans"),
    )
    if not slack:
        return exactly.drop(own)
    close = stored(near_candidates(documents, rarest, width, slack), "test-near")
    pairs = stored(near_windows(documents, close, windows, slack), "test-near-windows")
    discard(documents.sparkSession, close)
    # Stored, so that Spark knows the bytes and broadcasts by these.
    near = stored(holding_items(pairs, holders, "near_ids"), "test-near-items").select(
        F.col("doc_id").alias(key), F.col("text_hash").alias(text), "n_windows", "near_ids"
    )
    joined = exactly.join(near, F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(own) == F.col(text)), "left")
    return joined.select(
        *kept,
        *added[:4],
        F.coalesce("n_windows", F.lit(0)).cast("long").alias("n_near"),
        F.coalesce("near_ids", F.array().cast("array<string>")).alias("near_ids"),
    )
