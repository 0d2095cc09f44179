"""Periodic runs of words in texts: suffix automaton, and a link-cut tree's access over its suffix links.

Appending word ``i`` recolours with ``i`` the path from the state of that prefix to the root. The
path falls into segments of one earlier colour: the strings of a segment ended last at ``e``, the
longest of them has ``m`` words. If ``i - e`` is not above ``m``, the two places touch or overlap,
so a stretch of period ``i - e`` and length ``i - e + m`` ends at ``i``, which no word to the left
extends. Its later ends extend it to the right; the last one seen closes the run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, bounded_slices, words

#: The least length of a run, and the words that any run of that length and two periods repeats at
#: the distance of its period: ``max(LEAST - q, q)`` is never below it.
LEAST = 12
GRAM = LEAST // 2


class SuffixAutomaton:
    """The states of a sequence of numbers: ``length`` of the longest string, suffix ``link``, and each prefix's state.

    State 0 stands for nothing, state 1 is the root.
    """

    def __init__(self, sequence: list[int]):
        self.length, self.link, self.prefix = [0, 0], [0, 0], []
        step: list[dict[int, int]] = [{}, {}]
        length, link = self.length, self.link
        last = 1
        for word in sequence:
            state = len(length)
            length.append(length[last] + 1)
            link.append(1)
            step.append({})
            at = last
            while at and word not in step[at]:
                step[at][word] = state
                at = link[at]
            if at:
                onto = step[at][word]
                if length[onto] == length[at] + 1:
                    link[state] = onto
                else:
                    clone = len(length)
                    length.append(length[at] + 1)
                    link.append(link[onto])
                    step.append(step[onto].copy())
                    while at and step[at].get(word) == onto:
                        step[at][word] = clone
                        at = link[at]
                    link[onto] = link[state] = clone
            last = state
            self.prefix.append(state)


class LinkCutTree:
    """A rooted tree kept as preferred paths, each a splay tree by depth with one colour.

    ``up`` is the parent in the splay tree or, at its root, the node above the path (0: none); the
    path's colour stands at its splay tree's root.
    """

    def __init__(self, parents: list[int]):
        self.up = list(parents)
        self.left, self.right = [0] * len(parents), [0] * len(parents)
        self.colour = [-1] * len(parents)

    def splay(self, x: int) -> None:
        """Make ``x`` the root of its splay tree, with the path's colour."""
        up, left, right = self.up, self.left, self.right
        p = up[x]
        while p:
            on_left = left[p] == x
            if not on_left and right[p] != x:
                return
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                # Two steps: the middle one first if both lie on one side.
                self._rotate(p if (left[g] == p) == on_left else x)
                self.colour[x] = self.colour[g]  # the root's in the end
            else:
                self.colour[x] = self.colour[p]
            self._rotate(x)
            p = up[x]

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        p = up[x]
        g = up[p]
        if left[p] == x:
            inner = left[p] = right[x]
            right[x] = p
        else:
            inner = right[p] = left[x]
            left[x] = p
        if inner:
            up[inner] = p
        up[p] = x
        up[x] = g
        if g:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    def access(self, x: int, colour: int) -> list[tuple[int, int]]:
        """Recolour the path from ``x`` to the root.

        Its segments so far come back as (deepest node, colour), the deepest first; -1 is no colour.
        """
        segments = []
        below = 0
        while x:
            self.splay(x)
            so_far = self.colour[x]
            segments.append((x, so_far))
            if deeper := self.right[x]:
                self.colour[deeper] = so_far  # stays as a path of its own
            self.right[x] = below
            below, x = x, self.up[x]
        self.colour[below] = colour
        return segments


def runs_of(sequence: list[int]) -> dict[tuple[int, int], int]:
    """All stretches of two periods or more that no neighbour extends: {(start, least period): last place}."""
    states = SuffixAutomaton(sequence)
    paths, length = LinkCutTree(states.link), states.length
    out: dict[tuple[int, int], int] = {}
    for i, state in enumerate(states.prefix):
        for node, seen in paths.access(state, i):
            if seen >= 0 and (period := i - seen) <= length[node]:
                out[i - period - length[node] + 1, period] = i
    return out


def _repeated(codes: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Which places lie in a stretch of GRAM words that its part holds twice or more; a few others may too."""
    n = len(codes) - GRAM + 1
    grams = part[:n].astype(np.uint64)
    for k in range(GRAM):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + n].astype(np.uint64)
    ordered = np.sort(grams)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    out = np.zeros(len(codes), bool)
    if len(twice):
        begins = np.flatnonzero(np.isin(grams, twice) & (part[:n] == part[GRAM - 1 :]))
        edge = np.bincount(begins, minlength=len(codes) + 1) - np.bincount(begins + GRAM, minlength=len(codes) + 1)
        out = np.cumsum(edge)[:-1] > 0
    return out


def stretches(codes: np.ndarray) -> list[tuple[int, int]]:
    """Stretches (start, end) outside which no run lies.

    A run repeats GRAM words or more at the distance of its period, so all its words stand in a
    GRAM-word stretch that comes twice; looked at once more inside the stretches that are found,
    what repeats only elsewhere goes.
    """
    part = np.zeros(len(codes), np.int64)
    for _ in range(2):
        inside = _repeated(codes, part)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], inside.astype(np.int8), [0]])))
        if not len(edges):
            return []
        marks = np.zeros(len(codes) + 1, np.int64)
        marks[edges] = 1
        part = np.cumsum(marks)[:-1]
    return [(int(a), int(b)) for a, b in edges.reshape(-1, 2) if b - a >= LEAST]


def runs_of_words(text_words: list[bytes]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of ``max(LEAST, 2 * period)`` words or more, by start, then period."""
    if len(text_words) < LEAST:
        return []
    number: dict[bytes, int] = {}
    codes = np.array([number.setdefault(w, len(number)) for w in text_words], np.int64)
    found = []
    for start, end in stretches(codes):
        for (at, period), last in runs_of(codes[start:end].tolist()).items():
            if (length := last - at + 1) >= max(LEAST, 2 * period):
                found.append((start + at, length, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(text_words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words but for those of a run behind its first period."""
    if not runs:
        return text_words
    change = np.zeros(len(text_words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.cumsum(change)[:-1] == 0
    return [text_words[i] for i in np.flatnonzero(kept)]


SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"


def periodic_runs(documents: DataFrame) -> DataFrame:
    """The periodic runs of every document's words, one row each: doc_id, n_words, runs, collapsed.

    Words stand between ASCII white space and are numbered from 0. A run is a stretch of words with
    least period q (words q apart are equal), of ``max(12, 2q)`` words or more, that no neighbour
    extends. ``runs`` are in order of start, then period; ``collapsed`` is the UTF-8 text of the
    words, joined by one blank, that no run holds behind its first q words.

    Defined cases: a null, empty or blank text has no words, no runs and an empty ``collapsed``;
    words are compared byte by byte; overlapping runs are all given, and one word may be dropped by
    several; null and repeated doc_ids are ordinary rows; other columns are ignored; an empty table
    gives an empty table. Whole texts are read, one at a time, with some 100 bytes per word and 500
    per word of the longest stretch of repeats.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in bounded_slices(batches, "text"):
            counts, found, kept = [], [], []
            for text in batch.column(1):
                text_words = (text.as_py() or b"").split()  # bytes split at ASCII white space alone
                runs = runs_of_words(text_words)
                counts.append(len(text_words))
                found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                kept.append(b" ".join(collapse(text_words, runs)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(found, kind), pa.array(kept, pa.binary())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(find, SCHEMA)


def longest(runs: Column) -> Column:
    """Of an array of runs the longest (of equals the first, then that of the least period); null without runs."""
    order = lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))
    best = F.array_max(F.transform(runs, order))
    run = F.struct((-best["s"]).alias("start"), best["l"].alias("length"), (-best["p"]).alias("period"))
    return F.when(F.size(runs) > 0, run)


def with_periodic_tails(documents: DataFrame) -> DataFrame:
    """doc_id and text; of one document in ten, drawn by the crc32 of its id, the text's end repeats one stretch.

    With h the crc32, g = h // 10 and n words, every word from a = g % n on becomes word
    ``a + (i - a) % p`` for p = 1 + (n - a) // (3 + g % 8). Words are then joined by one blank.
    Documents without words or id stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = documents.select(
        "doc_id", "text", F.when(h % 10 == 0, words(F.col("text"), BLANKS)).alias("w"), F.floor(h / 10).alias("g")
    )
    n = F.size("w").cast("long")
    rows = rows.select("*", F.when(n > 0, F.col("g") % n).alias("a"), n.alias("n"))
    rows = rows.select("*", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).alias("p"))
    # Places of an array count from 0 here, as in the rule.
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    again = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get("w", place(i).cast("int")))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.concat_ws(" ", again)).otherwise(F.col("text")).alias("text"))
