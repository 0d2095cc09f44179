"""Katz back-off language model of order two, counted and evaluated in packed chunks.

Texts are cut into chunks of whole documents, with words as numbers. Three exchanges follow, each
from chunks to buckets and back, with packed arrays as rows:

- words: a bucket adds up the training counts of its words, numbers them, and answers each chunk;
- pairs: a bucket adds up the training counts of its word pairs and answers each chunk with the
  counts of its pairs and, per context, how many successors were seen 1 to K times and how much
  unigram probability all seen successors hold together;
- scores: a chunk has all it needs and evaluates every token: the discounted pair if it was seen,
  else the context's back-off weight times the word's own probability.

Word counts and pair counts stay behind as tables partitioned by bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_slices, discard, release, split_texts, stored

#: Counts up to K are discounted; larger ones are taken as reliable.
K = 5
#: Tokens of a chunk, and words or pairs of a bucket, on average.
CHUNK_TOKENS = 1_000_000
#: Bytes of text that are split into tokens at a time.
SLICE_BYTES = 1 << 20
#: The number of the mark before a text's first token; words are numbered from 1.
START = 0
#: A word's name is its hash; the end of a text has this one.
END = np.uint64(1)


def pack(a: np.ndarray) -> bytes:
    """An array of whole numbers, bytes of equal weight together, compressed."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, kind: type) -> np.ndarray:
    """The array that ``pack`` was given."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).reshape(-1)


# --- Good-Turing discounts and probabilities -------------------------------------------------


def discounts(seen: list[int]) -> np.ndarray:
    """d[r] for r from 0 to K, from how many items were seen 1 to K + 1 times (``seen[r - 1]``).

    Katz's renormalised Good-Turing ratios. A ratio outside (0, 1), as small tables give, is
    replaced by that of an absolute discount from the items seen once and twice.
    """
    n = [0, *seen]
    d = np.ones(K + 1)
    if n[1] == 0:
        return d
    least = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else 0.5
    spared = (K + 1) * n[K + 1] / n[1]
    for r in range(1, K + 1):
        ratio = -1.0
        if n[r] and spared < 1:
            ratio = ((r + 1) * n[r + 1] / (n[r] * r) - spared) / (1 - spared)
        d[r] = ratio if 0 < ratio < 1 else 1 - min(least, 0.99) / r
    return d


@dataclass(frozen=True)
class Unigrams:
    """The lower model: N training tokens, V training types, and how many were seen 1 to K + 1 times."""

    n: int
    v: int
    seen: tuple[int, ...]

    @property
    def d(self) -> np.ndarray:
        return discounts(list(self.seen))

    @property
    def unknown(self) -> float:
        """The probability of all unseen words together."""
        if self.n == 0:
            return 1.0
        d = self.d
        spared = sum((1 - d[r]) * r * self.seen[r - 1] for r in range(1, K + 1))
        return spared / self.n if spared > 0 else 1.0 / (self.n + 1)

    def probability(self, counts: np.ndarray) -> np.ndarray:
        """Of words with these training counts; unseen words share one probability."""
        if self.n == 0:
            return np.ones(len(counts))
        d = np.where(counts <= K, self.d[np.minimum(counts, K)], 1.0)
        spared = sum((1 - self.d[r]) * r * self.seen[r - 1] for r in range(1, K + 1))
        known = d * counts / (self.n if spared > 0 else self.n + 1)
        return np.where(counts > 0, known, self.unknown)


def backoff(of_context: np.ndarray, few: np.ndarray, lower: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per context the divisor of its pairs and its back-off weight.

    ``few[:, r - 1]`` successors were seen r times, all seen ones hold ``lower`` of the unigram
    probability. What the discounts spare is spread over the rest, so that a context's
    probabilities add up to one; a context that spares nothing sets one count aside.
    """
    spared = (few * ((1 - d[1:]) * np.arange(1, K + 1))).sum(1)
    none = spared <= 1e-12
    divisor = of_context + none
    left = np.where(none, 1.0, spared) / np.maximum(divisor, 1)
    weight = left / np.maximum(1 - lower, 1e-300)
    return divisor, np.where(of_context > 0, weight, 1.0)


# --- chunks ------------------------------------------------------------------------------------

_CHUNKS = (
    "chunk long, n_docs int, doc_ids array<long>, lengths binary, train binary, codes binary, names binary, seen binary"
)


def chunk_texts(documents: DataFrame, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """Chunks of whole texts: documents hold doc_id, train and text; a chunk is one row.

    A chunk holds ``chunk_tokens`` tokens at most, or one text that is longer.

    A token is a run without ASCII white space, A-Z in lower case; each text ends with one more
    token. ``names`` are the hashes of the chunk's words in order, ``seen`` their training counts,
    ``codes`` the texts as places in ``names``.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        size = 0
        for part in bounded_slices(batches, "text", SLICE_BYTES):
            ids, train = part.column(0).to_pylist(), part.column(1).to_pylist()
            lengths, tokens = _tokens(part.column(2).cast(pa.string()))
            ends = np.cumsum(lengths, dtype=np.int64)
            row = 0
            while row < len(ids):
                # As many texts as the chunk has room for; a longer text is a chunk of its own.
                done = int(ends[row - 1]) if row else 0
                stop = int(np.searchsorted(ends, done + chunk_tokens - size, side="right"))
                if stop > row or not held:
                    stop = max(stop, row + 1)
                    own = tokens[done : ends[stop - 1]]
                    held.append((ids[row:stop], train[row:stop], lengths[row:stop], own))
                    size, row = size + len(own), stop
                if row < len(ids) or size >= chunk_tokens:
                    yield _chunk(number, held)
                    number, held, size = number + 1, [], 0
        if held:
            yield _chunk(number, held)

    return documents.select(F.col("doc_id").cast("long"), "train", F.col("text").cast("binary")).mapInArrow(read, _CHUNKS)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per text, and all tokens as hashes, each text's end included."""
    flat, counts = split_texts(texts)
    coded = flat.dictionary_encode()
    names = coded.dictionary.to_numpy(zero_copy_only=False)
    hashes = pd.util.hash_array(names, categorize=False) if len(names) else np.array([], np.uint64)
    hashes = np.maximum(hashes, np.uint64(2))
    hashes[names == ""] = 0  # what stands before leading and after trailing blanks
    tokens = hashes[coded.indices.to_numpy(zero_copy_only=False)]
    row = np.repeat(np.arange(len(texts)), counts)
    row, tokens = row[tokens != 0], tokens[tokens != 0]
    lengths = np.bincount(row, minlength=len(texts)) + 1
    out = np.full(int(lengths.sum()), END, np.uint64)
    is_end = np.zeros(len(out), bool)
    is_end[np.cumsum(lengths) - 1] = True
    out[~is_end] = tokens
    return lengths.astype(np.int32), out


def _chunk(number: int, held: list[tuple]) -> pa.RecordBatch:
    doc_ids = [d for h in held for d in h[0]]
    train = np.array([t for h in held for t in h[1]], bool)
    lengths = np.concatenate([h[2] for h in held])
    tokens = np.concatenate([h[3] for h in held])
    names, codes = np.unique(tokens, return_inverse=True)
    codes = codes.astype(np.uint32)
    seen = np.bincount(codes[np.repeat(train, lengths)], minlength=len(names)).astype(np.uint32)
    binary = [pack(lengths), pack(train.astype(np.uint8)), pack(codes), pack(names), pack(seen)]
    return pa.record_batch(
        [pa.array([number]), pa.array([len(doc_ids)], pa.int32()), pa.array([doc_ids], pa.list_(pa.int64())),
         *(pa.array([b], pa.binary()) for b in binary)],
        ["chunk", "n_docs", "doc_ids", "lengths", "train", "codes", "names", "seen"],
    )


# --- words ---------------------------------------------------------------------------------------

_WORDS = (
    "bucket int, chunk long, names binary, counts binary, numbers binary, "
    "n_tokens long, n_types long, n_names long, seen array<long>"
)


def bucket_of(names: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each hash, by its high bits."""
    return ((names >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def _count_of_counts(counts: np.ndarray) -> list[int]:
    return [int(x) for x in np.bincount(counts[counts <= K + 1], minlength=K + 2)[1 : K + 2]]


def count_words(chunks: DataFrame, buckets: int) -> DataFrame:
    """Training counts of all words. Rows of chunk -1 are the table of a bucket: its words and counts.

    The other rows answer a chunk: for its words of the bucket, in the chunk's order, the counts
    and numbers (places in the bucket's table).
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, names, seen in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                names, seen = unpack(names, np.uint64), unpack(seen, np.uint32)
                parts = list(_slices(bucket_of(names, buckets)))
                yield pa.record_batch(
                    [pa.array([b for b, _ in parts], pa.int32()), pa.array([chunk] * len(parts), pa.int64()),
                     pa.array([pack(names[own]) for _, own in parts], pa.binary()),
                     pa.array([pack(seen[own]) for _, own in parts], pa.binary())],
                    ["bucket", "chunk", "names", "seen"],
                )

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        lists = [unpack(x, np.uint64) for x in rows["names"]]
        names, at = np.unique(np.concatenate(lists), return_inverse=True)
        seen = np.concatenate([unpack(x, np.uint32) for x in rows["seen"]])
        counts = np.bincount(at, seen, len(names)).astype(np.int64)
        out, start = [], 0
        bucket = int(rows["bucket"].iat[0])
        for chunk, own in zip(rows["chunk"], lists, strict=True):
            mine = at[start : start + len(own)]
            start += len(own)
            out.append((bucket, chunk, None, pack(counts[mine]), pack(mine.astype(np.int64)), None, None, None, None))
        known = counts[counts > 0]
        table = (bucket, -1, pack(names), pack(counts), None, int(known.sum()), len(known), len(names), _count_of_counts(known))
        return pd.DataFrame([*out, table], columns=[c.split()[0] for c in _WORDS.split(", ")])

    asked = chunks.select("chunk", "names", "seen").mapInArrow(ask, "bucket int, chunk long, names binary, seen binary")
    return asked.groupBy("bucket").applyInPandas(add, _WORDS)


def _slices(own: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The runs of an array of buckets in order: bucket, places."""
    edges = [int(at) for at in _runs(own)] if len(own) else []
    for a, b in zip(edges, [*edges[1:], len(own)]):
        yield int(own[a]), slice(a, b)


# --- pairs ---------------------------------------------------------------------------------------

_PAIRS = (
    "bucket int, chunk long, contexts binary, runs binary, words binary, counts binary, few binary, lower binary, "
    "n_pairs long, seen array<long>, shared array<struct<context:long,few:array<long>,lower:double>>"
)


@dataclass(frozen=True)
class Layout:
    """How words and pairs are dealt: buckets, where each bucket's word numbers begin, the unigrams."""

    buckets: int
    first: np.ndarray
    unigrams: Unigrams
    n_texts: int

    @property
    def frequent(self) -> int:
        """Contexts seen more often are dealt over several buckets, by their successor."""
        return max(1, self.unigrams.n // self.buckets)

    def deal(self, context: np.ndarray, of_context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The bucket of each pair."""
        salts = of_context // self.frequent + 1
        key = context.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        key += (word % salts).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return bucket_of(key ^ (key >> np.uint64(32)), self.buckets)


class _Chunk:
    """A chunk with its words' counts and numbers, and its distinct pairs in the order of exchange."""

    def __init__(self, row: dict, layout: Layout):
        self.lengths, self.train = unpack(row["lengths"], np.int32), unpack(row["train"], np.uint8).astype(bool)
        codes = unpack(row["codes"], np.uint32).astype(np.int64)
        # The chunk's words are in order of buckets. Place 0 stands for the mark before a text.
        answers = sorted(row["words"], key=lambda a: a["bucket"])
        self.counts = np.concatenate([[layout.n_texts], *(unpack(a["counts"], np.int64) for a in answers)])
        numbers = np.concatenate(
            [[START], *(unpack(a["numbers"], np.int64) + layout.first[a["bucket"]] + 1 for a in answers)]
        )
        n_places = len(numbers)
        self.word = codes + 1
        before = np.concatenate([[0], self.word[:-1]])
        before[np.concatenate([[0], np.cumsum(self.lengths)[:-1]])] = 0
        self.before = before
        # A context never seen in training has no pairs to ask for.
        asks = self.counts[before] > 0
        keys, pair = np.unique(before[asks] * n_places + self.word[asks], return_inverse=True)
        context, word = np.divmod(keys, n_places)
        own = layout.deal(numbers[context], self.counts[context], numbers[word])
        order = np.lexsort((numbers[word], numbers[context], own))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.pair = np.full(len(self.word), -1, np.int64)
        self.pair[asks] = place[pair]
        self.bucket, self.pair_context, self.pair_word = own[order], context[order], word[order]
        self.contexts, self.words = numbers[self.pair_context], numbers[self.pair_word]
        trained = self.pair[asks & np.repeat(self.train, self.lengths)]
        self.seen = np.bincount(trained, minlength=len(order)).astype(np.uint32)


def _runs(a: np.ndarray) -> np.ndarray:
    """Where each run of one value begins."""
    return np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))


def count_pairs(chunks: DataFrame, layout: Layout) -> DataFrame:
    """Training counts of all pairs, from chunks with their ``words`` answers.

    Rows of chunk -1 are a bucket's table: contexts, runs of successors, and counts. The other rows
    answer a chunk: counts of its pairs of the bucket, and per context ``few`` and ``lower`` (see
    ``backoff``). Contexts dealt over several buckets are in ``shared``, to be added up.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                chunk, out = _Chunk(row, layout), []
                for bucket, own in _slices(chunk.bucket):
                    contexts = chunk.contexts[own]
                    starts = _runs(contexts)
                    steps = np.diff(chunk.words[own], prepend=0)
                    steps[starts] = chunk.words[own][starts]
                    out.append(
                        (bucket, row["chunk"], pack(np.diff(contexts[starts], prepend=0)),
                         pack(np.diff(np.append(starts, len(contexts))).astype(np.uint32)), pack(steps),
                         pack(chunk.seen[own]), pack(chunk.counts[chunk.pair_context[own][starts]]),
                         pack(chunk.counts[chunk.pair_word[own]]))
                    )
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names
                )

    names = ["bucket", "chunk", "contexts", "runs", "words", "seen", "of_context", "of_word"]
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 6]

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        bucket = int(rows["bucket"].iat[0])
        runs = [unpack(x, np.uint32).astype(np.int64) for x in rows["runs"]]
        heads = [np.cumsum(unpack(x, np.int64)) for x in rows["contexts"]]
        context = np.concatenate([np.repeat(h, r) for h, r in zip(heads, runs, strict=True)])
        of_context = np.concatenate(
            [np.repeat(unpack(x, np.int64), r) for x, r in zip(rows["of_context"], runs, strict=True)]
        )
        words = []
        for steps, run in zip(rows["words"], runs, strict=True):
            total = np.cumsum(unpack(steps, np.int64))
            first = np.cumsum(run) - run
            # A run's first step is the number itself, so what came before is taken off.
            before = np.where(first > 0, total[np.maximum(first - 1, 0)], 0)
            words.append(total - np.repeat(before, run))
        word = np.concatenate(words)
        seen = np.concatenate([unpack(x, np.uint32) for x in rows["seen"]]).astype(np.int64)
        of_word = np.concatenate([unpack(x, np.int64) for x in rows["of_word"]])
        order = np.lexsort((word, context))
        new = np.concatenate([[True], (np.diff(context[order]) != 0) | (np.diff(word[order]) != 0)])
        at = np.empty(len(order), np.int64)
        at[order] = np.cumsum(new) - 1
        one = order[new]  # a row for each distinct pair
        counts = np.bincount(at, seen, len(one)).astype(np.int64)
        own, group = np.unique(context[one], return_inverse=True)
        few = np.stack([np.bincount(group[counts == r], minlength=len(own)) for r in range(1, K + 1)], 1).astype(np.uint32)
        probability = layout.unigrams.probability(of_word[one])
        lower = np.bincount(group, np.where(counts > 0, probability, 0.0), len(own))
        many = np.zeros(len(own), bool)
        many[group] = of_context[one] >= layout.frequent
        out, start = [], 0
        for chunk, head, run in zip(rows["chunk"], heads, runs, strict=True):
            n = int(run.sum())
            place = np.searchsorted(own, head)
            out.append((bucket, chunk, None, None, None, pack(counts[at[start : start + n]].astype(np.uint32)),
                        pack(few[place].reshape(-1)), pack(lower[place]), None, None, None))
            start += n
        shared = [
            {"context": int(own[i]), "few": [int(x) for x in few[i]], "lower": float(lower[i])}
            for i in np.flatnonzero(many)
        ]
        kept = counts > 0
        starts = _runs(context[one][kept]) if kept.any() else np.array([], np.int64)
        lengths = np.diff(np.append(starts, kept.sum())).astype(np.uint32)
        table = (bucket, -1, pack(context[one][kept][starts]), pack(lengths), pack(word[one][kept]), pack(counts[kept].astype(np.uint32)), None, None, int(kept.sum()),
                 _count_of_counts(counts[kept]), shared)
        return pd.DataFrame([*out, table], columns=[c.split()[0] for c in _PAIRS.split(", ")])

    schema = (
        "bucket int, chunk long, contexts binary, runs binary, words binary, "
        "seen binary, of_context binary, of_word binary"
    )
    return chunks.mapInArrow(ask, schema).groupBy("bucket").applyInPandas(add, _PAIRS)


# --- scores --------------------------------------------------------------------------------------

_SCORES = "doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double"


def evaluate(chunks: DataFrame, layout: Layout, d: np.ndarray, shared: list[tuple[int, list[int], float]]) -> DataFrame:
    """Scores of all texts, from chunks with their ``words`` and ``pairs`` answers.

    ``shared`` holds context, few and lower of the contexts dealt over several buckets, in order.
    """
    unigrams = layout.unigrams
    frequent = np.array([s[0] for s in shared], np.int64)
    few_of = np.array([s[1] for s in shared], np.int64).reshape(-1, K)
    lower_of = np.array([s[2] for s in shared], float)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                chunk = _Chunk(row, layout)
                answers = {a["bucket"]: a for a in row["pairs"] or ()}
                counts = np.zeros(len(chunk.bucket), np.int64)
                of_place = np.zeros((len(chunk.counts), K + 1))  # few and lower of each context
                for bucket, own in _slices(chunk.bucket):
                    answer = answers[bucket]
                    counts[own] = unpack(answer["counts"], np.uint32)
                    at = chunk.pair_context[own][_runs(chunk.contexts[own])]
                    of_place[at, :K] = unpack(answer["few"], np.uint32).reshape(-1, K)
                    of_place[at, K] = unpack(answer["lower"], np.float64)
                # Contexts dealt over buckets: the sums over all of them.
                numbers = np.full(len(chunk.counts), -1, np.int64)
                numbers[chunk.pair_context] = chunk.contexts
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, numbers), len(frequent) - 1)
                    hit = frequent[at] == numbers
                    of_place[hit, :K], of_place[hit, K] = few_of[at[hit]], lower_of[at[hit]]
                divisor, weight = backoff(chunk.counts, of_place[:, :K], of_place[:, K], d)
                c = np.append(counts, 0)[chunk.pair]  # the last place stands for pairs not asked for
                ratio = np.where(c <= K, d[np.minimum(c, K)], 1.0)
                alone = unigrams.probability(chunk.counts)
                p = np.where(
                    c > 0, ratio * c / np.maximum(divisor[chunk.before], 1), weight[chunk.before] * alone[chunk.word]
                )
                base = (chunk.counts + 0.5) / (unigrams.n + 0.5 * (unigrams.v + 1))
                starts = np.concatenate([[0], np.cumsum(chunk.lengths)[:-1]]).astype(np.int64)
                total = lambda x: np.add.reduceat(x, starts) if len(starts) else x
                yield pa.record_batch(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(chunk.train),
                     pa.array(chunk.lengths.astype(np.int64)),
                     pa.array(total((chunk.counts[chunk.word] > 0).astype(np.int64))),
                     pa.array(total(np.log10(base[chunk.word]))), pa.array(total(np.log10(p)))],
                    ["doc_id", "train", "n_tokens", "n_known", "base_score", "score"],
                )

    return chunks.mapInArrow(score, _SCORES)


@dataclass(frozen=True)
class KatzModel:
    """The stored tables (bucket rows of words and pairs) and what is needed to read them."""

    words: DataFrame
    pairs: DataFrame
    layout: Layout
    d: np.ndarray


def score_texts(documents: DataFrame, train: Column, chunk_tokens: int = CHUNK_TOKENS) -> tuple[DataFrame, KatzModel]:
    """Learn from the rows with ``train`` and score all: doc_id, train, n_tokens, n_known, base_score, score, train_tokens.

    Scores are sums of log10 probabilities over a text's tokens and its end. The base model is an
    add-half unigram. Defined cases: a null or empty text is its end alone; a null ``train`` counts
    as false; null and repeated doc_ids are ordinary rows; without training texts all probability
    is the unseen words', and scores are 0; an empty table gives an empty table.
    """
    spark = documents.sparkSession
    rows = documents.select("doc_id", F.coalesce(train, F.lit(False)).alias("train"), "text")
    chunks = stored(chunk_texts(rows, chunk_tokens), "katz-chunks")
    n_texts = rows.filter("train").count()
    buckets = max(1, chunks.count())
    words = stored(count_words(chunks, buckets), "katz-words")
    tables = words.filter("chunk = -1").select("bucket", "n_tokens", "n_types", "n_names", "seen").toArrow().to_pylist()
    names = np.zeros(buckets, np.int64)
    for t in tables:
        names[t["bucket"]] = t["n_names"]
    seen = [sum(t["seen"][r] for t in tables) for r in range(K + 1)]
    unigrams = Unigrams(sum(t["n_tokens"] for t in tables), sum(t["n_types"] for t in tables), tuple(seen))
    layout = Layout(buckets, np.cumsum(names) - names, unigrams, n_texts)
    release(spark)
    answers = words.filter("chunk >= 0").groupBy("chunk").agg(
        F.collect_list(F.struct("bucket", "counts", "numbers")).alias("words")
    )
    bare = stored(chunks.select("chunk", "doc_ids", "lengths", "train", "codes"), "katz-texts")
    discard(spark, chunks)
    named = bare.join(answers, "chunk")
    pairs = stored(count_pairs(named, layout), "katz-pairs")
    tables = pairs.filter("chunk = -1").agg(*[F.sum(F.col("seen")[r]) for r in range(K + 1)]).first()
    d = discounts([x or 0 for x in tables])
    several = pairs.filter("chunk = -1").select(F.explode("shared").alias("s")).groupBy("s.context").agg(
        F.array(*[F.sum(F.col("s.few")[r]) for r in range(K)]).alias("few"), F.sum("s.lower").alias("lower")
    )
    # A frequent context holds a bucket's share of all tokens or more, so there are at most as many as buckets.
    shared = sorted((r["context"], list(r["few"]), r["lower"]) for r in several.collect())
    release(spark)
    replies = pairs.filter("chunk >= 0").groupBy("chunk").agg(
        F.collect_list(F.struct("bucket", "counts", "few", "lower")).alias("pairs")
    )
    scores = evaluate(named.join(replies, "chunk", "left"), layout, d, shared)
    model = KatzModel(words.filter("chunk = -1"), pairs.filter("chunk = -1"), layout, d)
    return scores.withColumn("train_tokens", F.lit(unigrams.n).cast("long")), model
