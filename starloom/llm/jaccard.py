"""N-gram Jaccard join by a token-group matrix, exact, down to connected components.

1. Every text becomes the set of its distinct 5-word shingles; equal sets are one class.
2. A set's prefix is its first tokens in a common order, rare ones first: sets that reach the
   similarity share a token of their prefixes. Prefix tokens of one class alone are dropped.
3. Similar classes are partitioned into groups: in every token's list, all are compared with one
   of them; verified links make the groups.
4. The token-group matrix holds each group's union of prefix tokens. A class and a group not its
   own qualify if the matrix leaves room for the overlap that the similarity needs, by lengths and
   places in the order; only qualifying groups are opened, and their members compared.
5. Links between groups join them. Pairs within a group need no comparison.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, free_names, light, release, small, split_texts, stored
from .components import connected_components

#: Words of a shingle; similarity in hundredths.
WORDS, PERCENT = 5, 75
#: Buckets (as a power of two) of the frequency sketch, which is of this size for any input.
SKETCH_BITS = 20
#: Sets in a batch that hold a token before the sketch counts it.
REPEATS = 3
#: Keys up to this many are broadcast; more are joined by shuffle.
SMALL_ROWS = 300_000
#: Salts over which rows of one class are dealt when classes are joined to documents.
SALTS = 16
#: Slices of the tokens, looked at one after the other: so much less disk do their rows take at a time.
SLICES = 2
#: Rows of a batch sent back to Spark.
CHUNK = 1 << 18

#: Odd multipliers, one for each place of a shingle.
_ODD = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64
)


def _mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: pa.Array, width: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a shorter text's words are one shingle."""
    flat, lengths = split_texts(texts)
    coded = flat.dictionary_encode()
    names = coded.dictionary.to_numpy(zero_copy_only=False)
    by_code = pd.util.hash_array(names, categorize=False) if len(names) else np.array([], np.uint64)
    codes = coded.indices.to_numpy(zero_copy_only=False)
    blank = pc.index(coded.dictionary, pa.scalar("", coded.dictionary.type)).as_py()
    out, at = [], 0
    for n in lengths:
        own = codes[at : at + n]
        at += n
        h = by_code[own[own != blank] if blank >= 0 else own]
        if len(h) == 0:
            out.append(np.array([], np.uint64))
        elif len(h) < width:
            short = np.array([len(h)], np.uint64)
            for i in range(len(h)):
                short = _mixed(short * _ODD[0] + h[i : i + 1])
            out.append(short)
        else:
            total = np.zeros(len(h) - width + 1, np.uint64)
            for i in range(width):
                total = _mixed(total + h[i : len(h) - width + 1 + i] * _ODD[i % 5])
            out.append(np.unique(total))
    return out


def sets_in(texts: pa.Array, rows: int = 1024) -> Iterator[np.ndarray]:
    """The sets of all texts, made for some rows at a time to keep memory low."""
    for at in range(0, len(texts), rows):
        yield from shingle_sets(texts.slice(at, rows))


def _digest(tokens: np.ndarray) -> bytes:
    return hashlib.md5(tokens.tobytes()).digest()


def _class_of(tokens: np.ndarray) -> int:
    """A 64-bit name of the set."""
    return int.from_bytes(_digest(tokens)[:8], "little", signed=True)


def signatures(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per row doc_id, text_hash, n_shingles and class (null for an empty set); and the sketch.

    The sketch counts, by hash bucket, the tokens that several sets of a batch share.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(sets_in(batch.column(2)))
            names = [_class_of(s) if len(s) else None for s in sets]
            distinct = {name: s for name, s in zip(names, sets, strict=True) if name is not None}
            buckets, counts = np.array([], np.uint64), np.array([], np.int64)
            if distinct:
                tokens, seen = np.unique(np.concatenate(list(distinct.values())), return_counts=True)
                often = seen >= REPEATS
                buckets, counts = tokens[often] >> np.uint64(64 - SKETCH_BITS), seen[often]
            rows = batch.num_rows
            none = lambda kind, n: pa.nulls(n, kind)
            yield pa.record_batch(
                [
                    pa.concat_arrays([batch.column(0), none(pa.int64(), len(buckets))]),
                    pa.concat_arrays([batch.column(1), none(pa.int64(), len(buckets))]),
                    pa.concat_arrays([pa.array([len(s) for s in sets], pa.int64()), none(pa.int64(), len(buckets))]),
                    pa.concat_arrays([pa.array(names, pa.int64()), none(pa.int64(), len(buckets))]),
                    pa.concat_arrays([none(pa.int32(), rows), pa.array(buckets.astype(np.int32))]),
                    pa.concat_arrays([none(pa.int64(), rows), pa.array(counts)]),
                ],
                ["doc_id", "text_hash", "n_shingles", "class", "bucket", "seen"],
            )

    schema = "doc_id long, text_hash long, n_shingles long, class long, bucket int, seen long"
    rows = stored(_hashed(documents).mapInArrow(read, schema), "shingle-signatures")
    return rows.filter("bucket is null").select("doc_id", "text_hash", "n_shingles", "class"), rows.filter(
        "bucket is not null"
    ).groupBy("bucket").agg(F.sum("seen").alias("seen"))


def _hashed(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


def _levels(sketch: DataFrame) -> np.ndarray:
    """The sketch as logarithms, one byte a bucket: its size is fixed, whatever the input."""
    out = np.zeros(1 << SKETCH_BITS, np.uint8)
    rows = sketch.toArrow()
    out[rows.column("bucket").to_numpy()] = np.log2(rows.column("seen").to_numpy() + 1).astype(np.uint8)
    return out


def needed(n: int, percent: int = PERCENT) -> int:
    """The least overlap of a set of ``n`` with one that reaches the similarity."""
    return -(-percent * n // 100)


def prefix_tokens(
    documents: DataFrame, levels: Broadcast, percent: int = PERCENT, part: int = 0, parts: int = 1
) -> DataFrame:
    """Prefixes of all classes: token, class, at (the set's size and the token's place in the order).

    A token goes by the 48 upper bits of its hash: a name that two share adds candidates, no links.
    Of the names only those of slice ``part`` of ``parts`` are given; ``levels`` is the sketch.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()  # classes of this task
        for batch in batches:
            held, size = [], 0
            for tokens in sets_in(batch.column(2)):
                if not len(tokens) or (name := _class_of(tokens)) in done:
                    continue
                done.add(name)
                n = len(tokens)
                length = n - needed(n, percent) + 1
                level = levels.value[(tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                # Tokens are sorted by hash, so a stable sort by level gives (level, hash).
                prefix = tokens[np.argsort(level, kind="stable")[:length]]
                places = np.flatnonzero((prefix >> np.uint64(16)) % np.uint64(parts) == part)
                held.append((prefix[places], places, name, n))
                size += len(places)
                if size >= CHUNK:
                    yield _prefix_batch(held)
                    held, size = [], 0
            if held:
                yield _prefix_batch(held)

    rows = _hashed(documents).filter("doc_id is not null").mapInArrow(read, "token long, class long, at long")
    return rows


def _prefix_batch(held: list[tuple[np.ndarray, np.ndarray, int, int]]) -> pa.RecordBatch:
    lengths = [len(p) for p, _, _, _ in held]
    sizes = np.repeat(np.array([n for _, _, _, n in held], np.int64), lengths)
    return pa.record_batch(
        [
            pa.array((np.concatenate([p for p, _, _, _ in held]) >> np.uint64(16)).view(np.int64)),
            pa.array(np.repeat(np.array([c for _, _, c, _ in held], np.int64), lengths)),
            pa.array((sizes << 32) + np.concatenate([at.astype(np.int64) for _, at, _, _ in held])),
        ],
        ["token", "class", "at"],
    )


def shared_rows(prefixes: DataFrame) -> DataFrame:
    """Rows (token, class, n, place) of the prefix tokens that stand in several classes.

    Tokens that stand in the same classes get one name.
    """
    by_token = Window.partitionBy("token")
    name = F.xxhash64("class")
    listed = prefixes.withColumns(
        {
            "least": F.min("class").over(by_token),
            "most": F.max("class").over(by_token),
            "xor": F.bit_xor(name).over(by_token),
            "sum": F.sum(name.bitwiseAND(F.lit(0xFFFFFFFF))).over(by_token),
        }
    )
    return listed.filter("least != most").select(
        F.xxhash64("least", "most", "xor", "sum").alias("token"),
        "class",
        F.shiftright("at", 32).cast("int").alias("n"),
        F.col("at").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("place"),
    )


def shared_tokens(documents: DataFrame, sketch: DataFrame, percent: int = PERCENT, parts: int = SLICES) -> DataFrame:
    """Prefix tokens that stand in several classes, those in the same classes taken together.

    Rows are token (a name for all tokens that stand in the same classes, such as the shingles of
    one passage), class, n, place (of the first of the tokens), weight (their number, at least) and
    leader: the class with the token at the foremost place. Rare tokens stand in front, so a text
    from which others were made by small changes has its tokens in front of theirs, and leads them.
    Tokens that wrongly share a name add candidates, no links.

    Most prefix tokens stand in one class alone, and their rows are the bulk of what is shuffled. So
    the tokens are looked at in ``parts`` slices: the shuffle files of one go before the next begins.
    Texts are read once per slice.
    """
    spark = documents.sparkSession
    levels = spark.sparkContext.broadcast(_levels(sketch))
    slices = []
    for part in range(parts):
        slices.append(stored(shared_rows(prefix_tokens(documents, levels, percent, part, parts)), "shingle-slice"))
        release(spark)
    rows = reduce(DataFrame.unionByName, slices).groupBy("token", "class", "n").agg(
        F.min("place").alias("place"), F.count("*").alias("weight")
    )
    foremost = F.min(F.struct("place", "class")).over(Window.partitionBy("token"))
    shared = stored(rows.withColumn("leader", foremost["class"]), "shingle-shared")
    discard(spark, *slices)
    return shared


def can_follow(n: Column, place_a: Column, m: Column, place_b: Column, percent: int = PERCENT) -> Column:
    """Whether sets may link whose first shared token is this one.

    Tokens before the first shared one are in one set alone, so the overlap is at most what is
    left from here on in either. A pair that links passes at its first shared token, and that lies
    in both prefixes.
    """
    return F.least(n - place_a, m - place_b) * (100 + percent) >= (n + m) * percent


def may_link(pairs: DataFrame, rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) that may link by all prefix tokens they share, looked up in ``rows``.

    A shared token bounds the overlap by what can lie before, at and after it. All shared prefix
    tokens together bound it by their number and the longer rest behind a prefix.
    """
    side = lambda name, size: rows.select(
        F.col("class").alias(name),
        "token",
        F.col("n").alias(size),
        F.col("place").alias(f"place_{name}"),
        F.col("weight").alias(f"weight_{name}"),
    )
    shared = pairs.join(side("a", "n"), "a").join(side("b", "m"), ["b", "token"])
    n, m = F.col("n"), F.col("m")
    around = F.least("place_a", "place_b") + F.least(n - F.col("place_a"), m - F.col("place_b"))
    met = shared.groupBy("a", "b", "n", "m").agg(
        F.sum(F.least("weight_a", "weight_b")).alias("met"), F.min(around).alias("around")
    )
    behind = F.ceil(F.greatest(n, m) * percent / 100) - 1
    most = F.least("around", F.col("met") + behind)
    return met.filter(most * (100 + percent) >= (n + m) * percent).select("a", "b")


def sets_of(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """The shingles of the classes in ``wanted`` (class, doc_id, text_hash of a row): class, tokens.

    Rows equal in id and text give their class once a task.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = {_class_of(s): s for s in shingle_sets(batch.column(2).slice(at, 256))}
                some = {name: s for name, s in some.items() if name not in done}
                done.update(some)
                offsets = np.cumsum([0, *map(len, some.values())], dtype=np.int32)
                tokens = np.concatenate([*some.values(), np.array([], np.uint64)])
                yield pa.record_batch(
                    [pa.array(list(some), pa.int64()), pa.ListArray.from_arrays(offsets, tokens.view(np.int64))],
                    ["class", "tokens"],
                )

    keys = small(wanted.select("doc_id", "text_hash").distinct(), SMALL_ROWS)
    chosen = _hashed(documents).join(keys, ["doc_id", "text_hash"], "left_semi")
    return chosen.mapInArrow(read, "class long, tokens array<long>")


def verified(pairs: DataFrame, documents: DataFrame, classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of classes whose sets reach the similarity, compared in full."""
    spark = documents.sparkSession
    nodes = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct()
    sets = stored(sets_of(documents, classes.join(nodes, "class", "left_semi")), "shingle-sets")

    def side(name: str) -> DataFrame:
        of_side = small(pairs.select(F.col(name).alias("class")).distinct(), SMALL_ROWS)
        chosen = sets.join(of_side, "class", "left_semi")
        return chosen.select(F.col("class").alias(name), F.col("tokens").alias(f"tokens_{name}"))

    # Pairs that are few go to the sets; else the sets are shuffled to the pairs.
    both = side("a").join(small(pairs, SMALL_ROWS), "a").join(side("b"), "b")
    common = F.size(F.array_intersect("tokens_a", "tokens_b"))
    union = F.size("tokens_a") + F.size("tokens_b") - common
    links = stored(both.filter(common * 100 >= union * percent).select("a", "b").distinct(), "shingle-links")
    discard(spark, sets)
    release(spark)
    return links


def group_candidates(shared: DataFrame, groups: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs of classes (a, b) from different groups that the token-group matrix can't rule out."""
    matrix_rows = shared.join(groups, shared["class"] == groups["node"], "left").select(
        "token", "class", "n", "place", "weight", F.coalesce("component", "class").alias("group")
    )
    by_token = Window.partitionBy("token")
    # Tokens of one group's union alone can't tell of another group.
    several = matrix_rows.withColumns(
        {"least": F.min("group").over(by_token), "most": F.max("group").over(by_token)}
    ).filter("least != most")
    rows = stored(several.select("token", "class", "n", "place", "weight", "group"), "shingle-matrix")
    left = F.col("n") - F.col("place")
    unions = rows.groupBy("token", "group").agg(
        F.min("n").alias("shortest"), F.max("n").alias("longest"), F.max(left).alias("most_left")
    )
    q, u = rows.alias("q"), unions.alias("u")
    fits = (
        (F.col("u.longest") * 100 >= F.col("q.n") * percent)
        & (F.col("q.n") * 100 >= F.col("u.shortest") * percent)
        # The bound of ``can_follow`` for the member that would allow the largest overlap.
        & (
            F.least(F.col("q.n") - F.col("q.place"), F.col("u.most_left")) * (100 + percent)
            >= (F.col("q.n") + F.col("u.shortest")) * percent
        )
    )
    # A pair is looked at from its lesser group.
    opened = q.join(u, (F.col("q.token") == F.col("u.token")) & (F.col("q.group") < F.col("u.group")) & fits).select(
        "q.token", "q.class", "q.n", "q.place", F.col("u.group").alias("group")
    )
    members = rows.select(
        "token", F.col("class").alias("b"), F.col("n").alias("m"), F.col("place").alias("place_b"), "group"
    ).alias("s")
    o = opened.alias("o")
    same = (F.col("o.token") == F.col("s.token")) & (F.col("o.group") == F.col("s.group"))
    bound = can_follow(F.col("o.n"), F.col("o.place"), F.col("s.m"), F.col("s.place_b"), percent)
    pairs = o.join(members, same & bound).select(F.col("o.class").alias("a"), "s.b").distinct()
    pairs = stored(pairs, "shingle-opened")
    found = stored(may_link(pairs, rows, percent), "shingle-rest")
    discard(shared.sparkSession, pairs, rows)
    return found


def jaccard_components(documents: DataFrame, percent: int = PERCENT, by_id: bool = True) -> DataFrame:
    """Every row's near-duplicate component: doc_id, text_hash, n_shingles, component_id, first.

    Two documents link if 100 times the shared shingles are ``percent`` times the union's or more.
    component_id is the least doc_id that links lead to, the document's own included. No link is
    lost: prefixes, bounds and groups only leave out pairs that can't link or are joined already.

    Defined cases: null, empty and blank texts have no shingles and link with nothing; equal sets
    always link; rows of one doc_id are one node for linking, whatever their texts, unless ``by_id`` is
    false, when rows link by their texts alone and components may share a component_id; ``first``
    marks the rows of each component's least doc_id and, of its texts, the least hash; a null doc_id
    has a null component; an empty table gives an empty table; other columns are ignored.
    """
    spark = documents.sparkSession
    signed, sketch = signatures(documents)
    named = signed.filter("class is not null and doc_id is not null")
    classes = stored(
        named.groupBy("class").agg(F.min(F.struct("doc_id", "text_hash")).alias("row")).select("class", "row.*"),
        "shingle-classes",
    )
    shared = shared_tokens(documents, sketch, percent)
    release(spark)
    leaders = shared.filter(F.col("class") == F.col("leader")).select(
        F.col("class").alias("b"), F.col("n").alias("m"), F.col("place").alias("place_b"), "token"
    )
    first = (
        shared.filter(F.col("class") != F.col("leader"))
        .select(F.col("class").alias("a"), "n", "place", F.col("leader").alias("b"), "token")
        .join(leaders, ["token", "b"])
        .filter(can_follow(F.col("n"), F.col("place"), F.col("m"), F.col("place_b"), percent))
        .select("a", "b")
        .distinct()
    )
    starred = stored(first, "shingle-starred")
    first = stored(may_link(starred, shared, percent), "shingle-first")
    links = verified(first, documents, classes, percent)
    groups = connected_components(links)
    rest = group_candidates(shared, groups, percent)
    more = verified(rest, documents, classes, percent)
    discard(spark, starred, first, rest, shared, groups)
    linked = links.unionByName(more)
    if by_id:  # rows of one doc_id tie their classes together
        several = named.groupBy("doc_id").agg(F.min("class").alias("a"), F.max("class").alias("b")).filter("a != b")
        linked = linked.unionByName(named.join(several.select("doc_id", "a"), "doc_id").select("a", F.col("class").alias("b")))
    joined = connected_components(linked)
    tops = classes.join(joined, classes["class"] == joined["node"], "left").select(
        "class", "doc_id", "text_hash", F.coalesce("component", "class").alias("component")
    )
    least = tops.groupBy("component").agg(F.min(F.struct("doc_id", "text_hash")).alias("top"))
    of_class = tops.join(least, "component").select(
        "class", F.col("top.doc_id").alias("component_id"), F.col("top.text_hash").alias("top_hash")
    )
    # Most rows are their own component; classes that aren't are few and are copied over salts.
    copies = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    by_class = stored(of_class, "shingle-components")
    discard(spark, links, more, joined, classes)
    by_class = by_class.withColumn("_salt", copies)
    salted = signed.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(SALTS)).cast("int"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    first = (F.col("doc_id") == F.col("component_id")) & (F.col("text_hash") == F.col("top_hash"))
    return salted.join(by_class, ["class", "_salt"], "left").select(
        "doc_id",
        "text_hash",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(first, F.lit(False)).alias("first"),
    )


def keep_first(documents: DataFrame, components: DataFrame) -> DataFrame:
    """One row of each component of texts, that marked ``first``; ``components`` must link by texts (not ``by_id``).

    Rows without shingles or doc_id have no component and all stay. Of rows equal in id and text one
    stays, whichever; unlike texts under one id are apart.
    """
    loose = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    first = components.filter(~loose & F.col("first")).groupBy("doc_id", "text_hash").agg(F.count("*").alias("rows"))
    first = stored(first, "shingle-kept")
    kept = stored(components.filter(loose).select("doc_id", "text_hash").distinct(), "shingle-loose")
    own, key, text = free_names(documents, "own_hash", "kept_id", "kept_hash")
    hashed = documents.withColumn(own, F.xxhash64("text"))

    def among(keys: DataFrame) -> DataFrame:
        named = keys.select(F.col("doc_id").alias(key), F.col("text_hash").alias(text))
        same = F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(own) == F.col(text))
        return hashed.join(light(named), same, "left_semi")

    chosen = among(first)
    if not first.filter("rows > 1").isEmpty():  # some row is there several times
        chosen = chosen.dropDuplicates(["doc_id", own])
    return chosen.unionByName(among(kept)).drop(own)
