"""Mix sources to target weights: random keys, distributed prefix sums, exact cuts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, free_names, global_rank, n_words, random_key, running_totals, small, stored

#: Sources up to this many are broadcast; more are joined by shuffle.
SMALL_SOURCES = 100_000


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``target``.

    ``sizes`` holds ``source`` and ``size``. Sources in order of code points, null last, weigh
    ``weights`` in turn. ``share`` times all words go to the sources by weight; a target stops at
    ``most`` times its source's size, and what is left over is shared again among the others.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = global_rank(by_source, "_place", F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_place") % len(weights) + 1).cast("int"))
    sources = stored(
        ranked.select("source", "source_size", weight.alias("_w"), (F.col("source_size") * most).alias("_most")),
        "sources",
    )
    total, weighed = sources.agg(
        F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("_w"), F.lit(0))
    ).first()
    budget, level, full = total * share, 0.0, -1
    # The water level of the shares rises until no further source is full; only sums come here.
    while True:
        is_full = F.col("_most") < F.col("_w") * F.lit(level)
        n, held, out = sources.filter(is_full).agg(F.count("*"), F.sum("_most"), F.sum("_w")).first()
        if n == full or weighed == (out or 0):
            break
        full = n
        level = (budget - (held or 0)) / (weighed - (out or 0))
    target = F.least(F.col("_most").cast("double"), F.col("_w") * F.lit(float(level)))
    return sources.select("source", "source_size", target.alias("target"))


def mix_documents(
    documents: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2,
    seed: str = "mix",
    size: Column | None = None,
    row: Column | None = None,
) -> DataFrame:
    """How often the mix takes each document: doc_id, source, size, source_size, target, taken.

    ``row`` tells rows apart that are equal in id, source and text; it joins the key and comes back
    as row_hash.

    Every document gets an evenly spread key from the seed, its id and text. In its source, the
    documents in order of key are laid end to end, again and again, and cut after the whole words
    of the source's target. So ``taken`` is the size once for each whole epoch, plus the part
    before the cut; a source takes its target, rounded down, to the word.

    Defined cases: a null or empty text has size 0 and takes 0; a null source is a source of its
    own, last in order; a null or repeated doc_id is an ordinary row; equal rows share a key, and
    which of them meets the cut is open, but the taken words are not. An empty table gives an
    empty table. Other columns are ignored. ``size`` replaces the number of words.
    """
    sized = stored(
        documents.select(
            "doc_id",
            "source",
            (n_words(F.col("text"), BLANKS) if size is None else size).alias("size"),
            random_key(seed, F.col("doc_id"), F.md5(F.col("text").cast("binary")), *([] if row is None else [row])).alias("_key"),
            F.xxhash64("text").alias("_text"),
            (F.lit(0).cast("long") if row is None else row).alias("_row"),
        ),
        "mix-sizes",
    )
    targets = stored(source_targets(sized, weights, share, most), "mix-targets")
    placed = running_totals(sized, "source", "_key", "size", "_before")
    same = placed["source"].eqNullSafe(targets["source"])
    joined = placed.join(small(targets, SMALL_SOURCES), same, "inner").drop(targets["source"])
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - epochs * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_before")))
    return joined.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (epochs * F.col("size") + part).cast("long").alias("taken"),
        F.col("_text").alias("text_hash"),
        F.col("_row").alias("row_hash"),
    )


def row_hash(documents: DataFrame) -> Column:
    """A hash of all columns but the text; columns go by name, so nulls keep their places."""
    names = [c for c in documents.columns if c != "text"]
    return F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in names])))


def apply_mix(documents: DataFrame, mixed: DataFrame) -> DataFrame:
    """The documents of the mix: a row for each time that a document is taken, in part or whole.

    ``mixed`` must have been made with ``row=row_hash(documents)``, so rows that differ in any column
    keep turns of their own. Rows equal in all columns were mixed as separate rows; their turns are
    added up and dealt to the row once, so that the rows of the mix stay right.
    """
    by = ["doc_id", "source", "text_hash", "row_hash"]
    turns = mixed.filter("taken > 0").select(*by, F.ceil(F.col("taken") / F.col("size")).alias("_turns"))
    turns = turns.groupBy(*by).agg(F.sum("_turns").alias("_turns"))
    columns = documents.columns
    own, whole, n, turn = free_names(documents, "own_hash", "whole_hash", "turns", "turn")
    rows = documents.withColumns({own: F.xxhash64("text"), whole: row_hash(documents)})
    rows = rows.dropDuplicates(["doc_id", "source", own, whole])
    match = (
        rows["doc_id"].eqNullSafe(turns["doc_id"])
        & rows["source"].eqNullSafe(turns["source"])
        & (rows[own] == turns["text_hash"])
        & (rows[whole] == turns["row_hash"])
    )
    taken = rows.join(turns, match).select(*[rows[c] for c in columns], turns["_turns"].alias(n))
    return taken.withColumn(turn, F.explode(F.sequence(F.lit(1), n))).select(*columns)
