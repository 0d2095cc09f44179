"""Secret scans: patterns that tell by themselves, and credentials linked from parts that tell only together.

A task finds the parts of each text. Identifiers are then joined with the secrets and endpoints
that begin near them: an interval join over places, dealt by row, block and range of places. Weak
parts count only where a complementary part stands by.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_slices, stored

#: Kinds of parts, in the order of reports. The first three tell by themselves, the others are weak.
KINDS = ("assign", "access", "hex", "key", "login", "endpoint")
STRONG = 3
#: What a kind adds to a credential.
IDENTIFIERS = ("access", "login")
SECRETS = ("assign", "hex", "key")

#: The patterns of the strong kinds. The secret's least length counts afterwards, as a
#: match that is too short still uses up its characters; the other runs are as long as they can be.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ASSIGN_LEAST = 8
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
#: Weak kinds: 40 base64 characters of all three sorts; a name given to an account; addresses.
_KEY = re.compile(r"(?<![A-Za-z0-9+/=_.-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])")
_SORTS = tuple(re.compile(p) for p in ("[0-9]", "[A-Z]", "[a-z]"))
_LOGIN = re.compile(
    r"""(?<![A-Za-z0-9])(?:user(?:_?name)?|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?"""
    r"""[A-Za-z0-9+/_.@-]{3,}""",
    re.I | re.A,
)
_ENDPOINT = re.compile(
    r"""[a-z][a-z0-9+]{1,15}://[^\x00-\x20"'<>]+|(?<![A-Za-z0-9.-])(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}:[0-9]{2,5}"""
)
#: An empty line ends a block.
_BLOCK_END = re.compile(r"\n[\x20\t\r]*\n")


def strong_parts(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the parts that tell by themselves, by start, then kind."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= _ASSIGN_LEAST]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def weak_parts(text: str, strong: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the parts that need company; none overlaps a strong one."""
    found = [(m.start(), 3, m.end()) for m in _KEY.finditer(text) if all(s.search(m[0]) for s in _SORTS)]
    found += [(m.start(), 4, m.end()) for m in _LOGIN.finditer(text)]
    if "://" in text or ":" in text and "." in text:
        found += [(m.start(), 5, m.end()) for m in _ENDPOINT.finditer(text)]
    if not found or not strong:
        return sorted(found)
    starts = np.array([s for s, _, _ in strong])
    furthest = np.maximum.accumulate([e for _, _, e in strong])
    # Of the strong parts that begin before the weak one ends, the furthest reaching ends before it begins.
    before = np.searchsorted(starts, [e for _, _, e in found], side="left")
    return sorted(p for p, k in zip(found, before, strict=True) if k == 0 or furthest[k - 1] <= p[0])


_PARTS = "array<struct<kind:int,start:long,end:long,block:long>>"
_PART = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("block", pa.int64())])
SCAN = f"doc_id long, row long, strong {_PARTS}, weak {_PARTS}"


def scan_parts(documents: DataFrame) -> DataFrame:
    """The parts of every text, one row each; ``row`` numbers the rows. Places are code points, ends exclusive."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in bounded_slices(batches, "text"):
            strong_of, weak_of = [], []
            for data in batch.column(1):
                text = (data.as_py() or b"").decode("utf-8", "replace")
                strong = strong_parts(text)
                weak = weak_parts(text, strong)
                ends = [m.end() for m in _BLOCK_END.finditer(text)] if weak else []
                for parts, out in ((strong, strong_of), (weak, weak_of)):
                    blocks = np.searchsorted(ends, [s for s, _, _ in parts], side="right")
                    out.append(
                        [
                            {"kind": k, "start": s, "end": e, "block": int(b)}
                            for (s, k, e), b in zip(parts, blocks, strict=True)
                        ]
                    )
            numbers = np.arange(row, row + batch.num_rows)
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(numbers), *(pa.array(x, pa.list_(_PART)) for x in (strong_of, weak_of))],
                ["doc_id", "row", "strong", "weak"],
            )

    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return rows.mapInArrow(scan, SCAN)


def _in_kinds(kinds: tuple[str, ...]) -> Column:
    return F.col("kind").isin([KINDS.index(k) for k in kinds])


def link_parts(parts: DataFrame, reach: int) -> DataFrame:
    """Identifiers with what stands by: row, identifier, secrets, endpoints (arrays, nearest first).

    ``parts`` holds row, kind, start, end and block. Another part stands by an identifier if it is in
    the same block and begins at most ``reach`` places before the identifier's start or behind its
    end. Both sides are dealt by row, block and range of ``reach`` places, an identifier to each
    range that it reaches, so a pair meets once, and a task never gets more of a text than a range.
    """
    low, high = F.col("start") - reach, F.col("end") + reach
    anchors = parts.filter(_in_kinds(IDENTIFIERS)).select(
        "row",
        "block",
        F.struct("kind", "start", "end").alias("identifier"),
        low.alias("low"),
        high.alias("high"),
        F.explode(F.sequence(F.floor(low / reach), F.floor(high / reach))).alias("range"),
    )
    others = parts.filter(~_in_kinds(IDENTIFIERS)).select(
        "row", "block", F.floor(F.col("start") / reach).alias("range"), "kind", "start", "end"
    )
    near = anchors.join(others, ["row", "block", "range"]).filter("start between low and high")
    gap = F.greatest(
        F.lit(0), F.col("start") - F.col("identifier.end"), F.col("identifier.start") - F.col("end")
    )
    other = F.struct(gap.alias("gap"), "start", "end", "kind")
    near = near.groupBy("row", "identifier").agg(
        F.sort_array(F.collect_list(F.when(_in_kinds(SECRETS), other))).alias("secrets"),
        F.sort_array(F.collect_list(F.when(~_in_kinds(SECRETS), other))).alias("endpoints"),
    )
    return near.filter(F.size("secrets") > 0)


def _spans(parts: Column) -> Column:
    """kind:start:end of all parts, by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    # A part may be named by several identifiers; structs sort by their fields in order.
    ordered = F.array_sort(F.array_distinct(F.transform(parts, lambda p: F.struct(p["start"], p["kind"], p["end"]))))
    name = lambda p: F.concat_ws(":", F.get(names, p["kind"]), p["start"], p["end"])
    return F.array_join(F.transform(ordered, name), ",")


def scan_credentials(documents: DataFrame, reach: int = 200) -> DataFrame:
    """Secrets of every document, one row each: doc_id, n_assign, n_access, n_hex, base_spans, spans, credentials.

    ``base_spans`` lists the strong parts, ``spans`` also the weak ones that are linked: an account
    name with a secret within ``reach`` characters in the same block of lines, a 40-character key
    with an account name or access identifier, an address with an identifier that has a secret.
    ``credentials`` tells, per identifier with a secret, the nearest secret and address (null: none).
    Places are code points from 0, ends exclusive; a list entry is kind:start:end.

    Defined cases: a null text is empty; an empty text has no spans; null and repeated doc_ids and
    equal rows are ordinary rows; of equally near parts the one that begins first counts; weak parts
    that overlap a strong one are not looked at; other columns are ignored; an empty table gives an
    empty table. Whole texts are read. The scan is stored once (no texts in it); rows without weak
    parts are not shuffled.
    """
    scanned = stored(scan_parts(documents), "credential-parts")
    alone = scanned.filter(F.size("weak") == 0)
    doubtful = scanned.filter(F.size("weak") > 0)
    parts = doubtful.select("row", F.inline(F.concat("strong", "weak")))
    short = lambda p: F.struct(p["kind"].alias("kind"), p["start"].alias("start"), p["end"].alias("end"))
    linked = link_parts(parts, reach).select(
        "row",
        F.concat(
            F.array("identifier"), F.transform(F.concat("secrets", "endpoints"), short)
        ).alias("named"),
        F.struct(
            "identifier",
            short(F.get("secrets", F.lit(0))).alias("secret"),
            F.when(F.size("endpoints") > 0, short(F.get("endpoints", F.lit(0)))).alias("endpoint"),
        ).alias("credential"),
    )
    linked = linked.groupBy("row").agg(
        F.flatten(F.collect_list("named")).alias("named"), F.sort_array(F.collect_list("credential")).alias("credentials")
    )
    kinds = {f.name: f.dataType for f in linked.schema.fields}
    none = {name: F.array().cast(kinds[name]) for name in ("named", "credentials")}
    joined = doubtful.join(linked, "row", "left").withColumns({c: F.coalesce(c, none[c]) for c in none})
    rows = alone.withColumns(none).unionByName(joined)
    bare = F.transform("strong", short)
    count = lambda kind: F.size(F.filter("strong", lambda p: p["kind"] == KINDS.index(kind))).cast("long")
    return rows.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS[:STRONG]],
        _spans(bare).alias("base_spans"),
        _spans(F.concat(bare, "named")).alias("spans"),
        "credentials",
    )
