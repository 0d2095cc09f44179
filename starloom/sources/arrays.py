"""Large JSON arrays read by many tasks.

A file with one array is split by bytes as text is, with ``}`` as the line end, so that a task gets
whole pieces however the array is laid out. Whether a piece begins inside a quoted text, and how deep,
depends on all that stands before it. A first pass therefore sums up each split of a file that may have
several: what it makes of either quote state, and how the depth changes. Run over the splits of a
file these sums give each split's beginning. A second pass cuts the records; one that lies across
splits comes as fragments, which are put together by the split it begins in.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from starloom.functions import col

QUOTE, BACKSLASH, COMMA, OPEN = 34, 92, 44, ord("[")
#: How each byte changes the depth, and which bytes matter at all.
STEP = np.zeros(256, np.int64)
STEP[[ord("["), ord("{")]], STEP[[ord("]"), ord("}")]] = 1, -1
MATTERS = STEP != 0
MATTERS[COMMA] = True
BLANKS = b" \t\r\n"
BOM = b"\xef\xbb\xbf"
#: Deeper than any text.
NEVER = 1 << 40


def marks(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Brackets and commas: places, bytes, whether an odd number of quotes stands before; and the number of quotes."""
    b = np.frombuffer(data, np.uint8)
    quotes = np.flatnonzero(b == QUOTE)
    slashes = np.flatnonzero(b == BACKSLASH)
    if len(quotes) and len(slashes):
        # An odd run of backslashes escapes what follows it.
        first = np.flatnonzero(np.diff(slashes, prepend=-2) != 1)
        lengths = np.diff(np.append(first, len(slashes)))
        escaped = slashes[first] + lengths
        quotes = np.setdiff1d(quotes, escaped[lengths % 2 == 1], assume_unique=True)
    at = np.flatnonzero(MATTERS[b])
    return at, b[at], (np.searchsorted(quotes, at) & 1).astype(bool), len(quotes)


# --- first pass: sums of splits ------------------------------------------------------------------

#: Of a split: its quotes' parity and, for a beginning outside (0) and inside (1) a quoted text, the
#: change of depth, the least depth at a comma, the least and the greatest depth.
SUMS = "file long, start long, odd boolean, " + ", ".join(
    f"{name}{state} long" for state in (0, 1) for name in ("change", "comma", "least", "most")
)


def _summed(data: bytes) -> tuple[bool, list[tuple[int, int, int, int]]]:
    _, kinds, odd, quotes = marks(data)
    sums = []
    for state in (False, True):
        outside = kinds[odd == state]
        depth = np.cumsum(STEP[outside])
        commas = depth[outside == COMMA]
        sums.append(
            (
                int(depth[-1]) if len(depth) else 0,
                int(commas.min(initial=NEVER)),
                int(depth.min(initial=0)),
                int(depth.max(initial=0)),
            )
        )
    return bool(quotes % 2), sums


def _then(one: tuple, other: tuple) -> tuple:
    """The sums of one stretch with another behind it."""
    odd, sums = one
    after = [other[1][state ^ odd] for state in (0, 1)]
    return odd ^ other[0], [
        (a[0] + b[0], min(a[1], a[0] + b[1]), min(a[2], a[0] + b[2]), max(a[3], a[0] + b[3]))
        for a, b in zip(sums, after, strict=True)
    ]


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes, pa.RecordBatch]]:
    """File, split and bytes of each run of pieces of one split, with its first row."""
    for batch in batches:
        files, starts = (batch.column(k).to_numpy() for k in (0, 1))
        edges = (np.flatnonzero((np.diff(files) != 0) | (np.diff(starts) != 0)) + 1).tolist()
        for a, b in zip([0, *edges], [*edges, len(files)]):
            if a < b:
                run = pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), batch.column(2).slice(a, b - a))
                yield int(files[a]), int(starts[a]), pc.binary_join(run, b"}")[0].as_py(), batch.slice(a, 1)


def split_sums(pieces: DataFrame) -> DataFrame:
    """A row for each split: see ``SUMS``."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task may hold splits of several files, one behind the other.
        totals: dict[tuple[int, int], tuple] = {}
        for file, start, data, _ in _by_split(batches):
            if (file, start) in totals:
                totals[file, start] = _then(totals[file, start], _summed(b"}" + data))
            else:
                totals[file, start] = _summed(b"}" + data if start else data)
        rows = [(*key, odd, *sums[0], *sums[1]) for key, (odd, sums) in totals.items()]
        names = [f.split()[0] for f in SUMS.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.bool_(), *[pa.int64()] * 8]
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return pieces.mapInArrow(add, SUMS)


BEGINNINGS = "file long, start long, inside boolean, depth long, opened long"


def beginnings(sums: DataFrame) -> DataFrame:
    """What each split of a file begins with; ``opened`` is the split in which the record at hand began."""
    names = [f.split()[0] for f in SUMS.split(", ")]
    # A file's splits, as many as the driver lists of it, meet in one row.
    files = sums.groupBy("file").agg(F.sort_array(F.collect_list(F.struct(*names[1:]))).alias("splits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for file, splits in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                inside, depth, opened = False, 0, 0
                for s in splits:
                    rows.append((file, s["start"], inside, depth, opened))
                    change, comma, least, most = (s[f"{n}{int(inside)}"] for n in ("change", "comma", "least", "most"))
                    if depth + comma <= 1 or depth + least <= 0 < depth or depth == 0 < most:
                        opened = s["start"]
                    inside, depth = inside ^ s["odd"], depth + change
            kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                [f.split()[0] for f in BEGINNINGS.split(", ")],
            )

    return files.mapInArrow(run, BEGINNINGS)


# --- second pass: records --------------------------------------------------------------------------


@dataclass
class Cutter:
    """Cuts the records of one split out of its bytes, handed over in order."""

    file: int
    start: int
    inside: bool
    depth: int
    opened: int
    #: Whether only the fragments at the split's ends are wanted.
    ends_only: bool = False
    held: list[bytes] = field(default_factory=list)
    objects: int = 0
    #: Whether the record at hand began in this split, whether it is the first of its array.
    own: bool = False
    first: bool = False
    #: Whether an array has ended here.
    closed: bool = False
    #: (opened, text, number of objects on its top level, whether its end is here)
    fragments: list[tuple[int, bytes, int, bool]] = field(default_factory=list)

    def refuse(self, text: bytes) -> None:
        found = text.strip(BLANKS)[:100].decode("utf-8", "replace")
        raise ValueError(f"not one JSON array per file (read JSON lines without multiline): {found!r}")

    def outside(self, text: bytes) -> None:
        if self.start == 0 and self.depth == 0 and text.startswith(BOM):
            text = text[len(BOM) :]
        if text.strip(BLANKS):
            self.refuse(text)

    def feed(self, data: bytes) -> list[tuple[bytes, int]]:
        """The records that end in ``data`` and began in this split: text, number of top-level objects."""
        at, kinds, odd, quotes = marks(data)
        real = odd == self.inside
        at, kinds = at[real], kinds[real]
        steps = STEP[kinds]
        depth = self.depth + np.cumsum(steps)
        cut = np.flatnonzero(((kinds == COMMA) & (depth == 1)) | ((steps > 0) & (depth == 1)) | (depth <= 0))
        objects = np.cumsum((steps > 0) & (depth == 2))
        records: list[tuple[bytes, int]] = []
        behind = counted = 0
        cuts = cut.tolist()
        for i in cuts[:1] + cuts[1:][-1:] if self.ends_only else cuts:
            text, n = data[behind : at[i]], int(objects[i]) - counted
            behind, counted = int(at[i]) + 1, int(objects[i])
            if steps[i] > 0:
                self.outside(b"".join(self.held) + text)
                if kinds[i] != OPEN or self.closed:
                    self.refuse(data[at[i] :])
                self.own = self.first = True
            elif kinds[i] == COMMA or depth[i] == 0 and steps[i] < 0:
                text, n = b"".join(self.held) + text, self.objects + n
                if not self.own:
                    self.fragments.append((self.opened, text, n, True))
                elif not (self.first and kinds[i] != COMMA and not text.strip(BLANKS)):
                    records.append((text, n))
                self.own, self.first, self.closed = True, False, kinds[i] != COMMA
            else:
                self.refuse(data[at[i] :])
            self.held, self.objects = [], 0
        self.held.append(data[behind:])
        if len(depth):
            self.objects += int(objects[-1]) - counted
            self.depth = int(depth[-1])
        self.inside ^= bool(quotes % 2)
        return records

    def finish(self) -> list[tuple[int, bytes, int, bool]]:
        """The fragments of records that lie across splits, that at the split's end among them."""
        rest = b"".join(self.held)
        if self.depth <= 0:
            self.outside(rest)
        else:
            self.fragments.append((self.start if self.own else self.opened, rest, self.objects, False))
        return self.fragments


CUT = "file long, start long, opened long, place long, text binary, objects long, ended boolean"


def cut_records(pieces: DataFrame, fragments: bool) -> DataFrame:
    """Of pieces with their split's beginning the records inside splits, or the fragments at the splits' ends."""
    more = pieces.schema.fields[7:]
    schema = T.StructType([*T._parse_datatype_string(CUT).fields, *more])
    names = [f.name for f in schema.fields]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter: Cutter | None = None
        of: pa.RecordBatch | None = None

        def rows(found: list[tuple]) -> pa.RecordBatch:
            opened, texts, objects, ended = zip(*found, strict=True) if found else [()] * 4
            n = len(found)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([cutter.file] * n, pa.int64()),
                    pa.array([cutter.start] * n, pa.int64()),
                    pa.array(opened, pa.int64()),
                    pa.array(range(n), pa.int64()),
                    pa.array(texts, pa.binary()),
                    pa.array(objects, pa.int64()),
                    pa.array(ended, pa.bool_()),
                    *(c.take(pa.array([0] * n, pa.int64())) for c in of.columns[7:]),
                ],
                names,
            )

        for file, start, data, row in _by_split(batches):
            if cutter is None or (cutter.file, cutter.start) != (file, start):
                if cutter is not None and (found := cutter.finish()) and (fragments or alone):
                    yield rows(found)
                inside, depth, opened, alone = (row.column(k)[0].as_py() for k in (3, 4, 5, 6))
                cutter, of = Cutter(file, start, inside, depth, opened, fragments), row
                data = b"}" + data if start else data
            else:
                data = b"}" + data
            if (found := cutter.feed(data)) and not fragments:
                yield rows([(None, text, n, True) for text, n in found])
        if cutter is not None and (found := cutter.finish()) and (fragments or alone):
            yield rows(found)

    return pieces.mapInArrow(cut, schema)


def _pieces(text: DataFrame, *more: str) -> DataFrame:
    """The pieces with their split; a file goes by a number made of its path and size."""
    return text.select(
        F.xxhash64("_metadata.file_path", "_metadata.file_size").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("piece"),
        *[col(c) for c in more],
    )


def array_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The elements of files that hold one JSON array each: text, is_object, and the path's partition columns.

    ``is_object`` is false for what isn't exactly one object. UTF-8 alone is read. A file that holds
    anything but one array raises when it is read; a cut off one has a last element that isn't an object.
    """
    text = spark.read.option("lineSep", "}").text(path)
    parts = [c for c in text.columns if c != "value"]
    conf = spark._jsparkSession.sessionState().conf()
    least = min(conf.filesOpenCostInBytes(), conf.filesMaxPartitionBytes())
    # Smaller files are one split each and begin as all files do; Spark leaves them out by their size.
    large = text.filter(F.col("_metadata.file_size") > least)
    begun = beginnings(split_sums(_pieces(large)))

    def cut(files: DataFrame, fragments: bool) -> DataFrame:
        # One short row for each split, of which the driver holds a list anyway.
        pieces = _pieces(files, *parts).join(F.broadcast(begun), ["file", "start"], "left")
        beginning = [
            F.coalesce("inside", F.lit(False)).alias("inside"),
            F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
            F.coalesce("opened", F.lit(0)).cast("long").alias("opened"),
            F.col("inside").isNull().alias("alone"),
        ]
        return cut_records(pieces.select("file", "start", "piece", *beginning, *[col(c) for c in parts]), fragments)

    # Of a file that was left out of the first pass the whole text is here, its end too.
    whole = cut(text, False).select("text", "objects", "ended", *[col(c) for c in parts])
    fragment = F.struct("start", "place", F.col("text").cast("string").alias("text"))
    joined = (
        cut(large, True)
        .groupBy("file", "opened", *[col(c) for c in parts])
        .agg(
            F.sort_array(F.collect_list(fragment)).alias("fragments"),
            F.sum("objects").alias("objects"),
            F.max("ended").alias("ended"),
        )
        .select(
            F.array_join("fragments.text", "").cast("binary").alias("text"), "objects", "ended", *[col(c) for c in parts]
        )
    )
    element = F.col("text").cast("string")
    bare = F.btrim(element, F.lit(" \t\r\n"))
    is_object = F.col("ended") & (F.col("objects") == 1) & bare.startswith("{") & bare.endswith("}")
    return whole.unionByName(joined).select(bare.alias("text"), is_object.alias("is_object"), *[col(c) for c in parts])


def parse_records(records: DataFrame, schema: T.StructType, corrupt: str | None) -> DataFrame:
    """The records' columns; one that isn't an object or doesn't fit the schema raises, or keeps its text in ``corrupt``."""
    parts = [col(c) for c in records.columns if c not in ("text", "is_object")]
    if corrupt is None:
        wrong = F.raise_error(F.concat(F.lit("Malformed record in a JSON array: "), F.left("text", F.lit(200))))
        parsed = F.from_json(F.when(F.col("is_object"), F.col("text")).otherwise(wrong.cast("string")), schema, {"mode": "FAILFAST"})
        return records.select(parsed.alias("r"), *parts).select("r.*", *parts)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    parsed = F.from_json(F.when(F.col("is_object"), F.col("text")), schema, options)
    rows = records.select(parsed.alias("r"), "text", *parts)

    def value(f: T.StructField) -> Column:
        found = F.col("r")[f.name]
        return (F.when(F.col("r").isNull(), F.col("text")).otherwise(found) if f.name == corrupt else found).alias(f.name)

    return rows.select(*[value(f) for f in schema.fields], *parts)
