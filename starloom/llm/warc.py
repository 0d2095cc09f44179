"""Seekable Zstandard bundles of WARC records.

A bundle is a row of independent Zstandard frames, each holding whole records, and a seek table in
a skippable frame at its end. The index maps a record to its bundle, its frame, and its offset in
the decompressed frame, so that one record costs one frame.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import scratch_path

from .common import stored

#: Fixed values of the seekable format: skippable frame, footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
#: Salts over which records of one payload are dealt.
SALTS = 16
#: Payload groups up to this many are broadcast; more are joined by shuffle.
SMALL_GROUPS = 200_000
#: Fixed value: profile of a record that repeats an earlier payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "record_id long, bundle string, frame int, frame_start long, frame_bytes long, offset long, bytes long"
RECORDS = (
    "record_id long, uri string, payload binary, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long"
)
_INDEX_ARROW = pa.schema(
    [("record_id", pa.int64()), ("bundle", pa.string()), ("frame", pa.int32()), ("frame_start", pa.int64()),
     ("frame_bytes", pa.int64()), ("offset", pa.int64()), ("bytes", pa.int64())]
)
_RECORDS_ARROW = pa.schema(
    [("record_id", pa.int64()), ("uri", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
     ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
)


def header_value(text: str) -> str:
    """Text as a header's value: control characters and blanks percent-encoded."""
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in text)


def _urn(record_id: int | None) -> str:
    return f"<urn:page:{'none' if record_id is None else record_id}>"


def _from_urn(urn: str) -> int | None:
    name = urn[len("<urn:page:") : -1]
    return None if name == "none" else int(name)


def build_record(record: dict, date: str) -> bytes:
    """A WARC/1.1 record; the block is an HTTP response, without its body for a revisit."""
    payload = record["payload"] or b""
    revisit = record["record_type"] == "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {record['record_type']}",
        f"WARC-Record-ID: {_urn(record['record_id'])}",
        f"WARC-Date: {date}",
    ]
    if record["uri"] is not None:
        head.append(f"WARC-Target-URI: {header_value(record['uri'])}")
    head.append(f"WARC-Payload-Digest: sha256:{record['payload_digest']}")
    if revisit:
        head += [f"WARC-Refers-To: {_urn(record['refers_to'])}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def parse_record(data: memoryview | bytes, at: int) -> tuple[dict, int]:
    """The record that starts at ``at``, its payload's digest computed anew, and where it ends."""
    data = bytes(data) if isinstance(data, memoryview) else data
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no record at {at}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    start = end + 4
    stop = start + int(fields["Content-Length"])
    body = data.index(b"\r\n\r\n", start, stop) + 4
    http = dict(x.split(": ", 1) for x in data[start : body - 4].decode().split("\r\n")[1:])
    revisit = fields["WARC-Type"] == "revisit"
    payload = None if revisit else data[body:stop]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if payload is not None and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"record {fields['WARC-Record-ID']}: the payload doesn't match its digest")
    return {
        "record_id": _from_urn(fields["WARC-Record-ID"]),
        "uri": fields.get("WARC-Target-URI"),
        "payload": payload,
        "payload_bytes": int(http["Content-Length"]) if revisit else len(payload),
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": _from_urn(fields["WARC-Refers-To"]) if revisit else None,
    }, stop + 4


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The closing skippable frame: compressed and decompressed bytes of every frame, and the footer."""
    entries = b"".join(struct.pack("<II", *frame) for frame in frames)
    body = entries + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(file: BinaryIO, size: int) -> list[tuple[int, int, int]]:
    """Start, compressed and decompressed bytes of every frame, from the end of a bundle."""
    file.seek(size - 9)
    n, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("the bundle has no seek table")
    file.seek(size - 9 - 8 * n)
    raw, start, out = file.read(8 * n), 0, []
    for i in range(n):
        packed, unpacked = struct.unpack_from("<II", raw, 8 * i)
        out.append((start, packed, unpacked))
        start += packed
    return out


class _Bundles:
    """Writes a task's records into bundles. Names hold the attempt, so a second try harms nothing."""

    def __init__(self, root: str, frame_bytes: int, bundle_bytes: int, level: int):
        self.fs, self.folder = pafs.FileSystem.from_uri(root)
        self.root, self.frame_bytes, self.bundle_bytes = root.rstrip("/"), frame_bytes, bundle_bytes
        context = TaskContext.get()
        self.name = f"{context.partitionId():06d}-{context.taskAttemptId()}" if context else "000000-0"
        self.pack = zstandard.ZstdCompressor(level=level).compress
        self.n, self.out, self.rows = 0, None, []
        self.buffer, self.held = bytearray(), []

    def add(self, record_id: int | None, record: bytes) -> None:
        if self.buffer and len(self.buffer) + len(record) > self.frame_bytes:
            self._frame()
        self.held.append((record_id, len(self.buffer), len(record)))
        self.buffer += record

    def _frame(self) -> None:
        if self.out is None:
            self.path = f"{self.name}-{self.n:04d}.warc.zst"
            self.fs.create_dir(self.folder, recursive=True)
            self.out, self.at, self.frames = self._open(), 0, []
        packed = self.pack(bytes(self.buffer))
        self.out.write(packed)
        bundle = f"{self.root}/{self.path}"
        for record_id, offset, n in self.held:
            self.rows.append((record_id, bundle, len(self.frames), self.at, len(packed), offset, n))
        self.frames.append((len(packed), len(self.buffer)))
        self.at += len(packed)
        self.buffer, self.held = bytearray(), []
        if self.at >= self.bundle_bytes:
            self._end()

    def _open(self) -> pa.NativeFile:
        # The name's ending must not make the file system compress once more.
        return self.fs.open_output_stream(f"{self.folder}/{self.path}", compression=None)

    def _end(self) -> None:
        self.out.write(seek_table(self.frames))
        self.out.close()
        self.out, self.n = None, self.n + 1

    def close(self) -> None:
        if self.buffer:
            self._frame()
        if self.out is not None:
            self._end()

    def take(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = list(zip(*rows, strict=True)) or [[]] * len(_INDEX_ARROW)
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _INDEX_ARROW, strict=True)], _INDEX_ARROW)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as workers need it."""
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    return named.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(named).toString()


def write_bundles(
    records: DataFrame, path: str, frame_bytes: int = 1 << 18, bundle_bytes: int = 1 << 26, level: int = 3,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write records (the columns of RECORDS) to bundles in the folder ``path``; returns the index.

    Every task writes its own bundles through the folder's file system; only those named in the
    index count. A record longer than ``frame_bytes`` has a frame of its own.
    """
    root = qualified(records.sparkSession, path)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundles = _Bundles(root, frame_bytes, bundle_bytes, level)
        for batch in batches:
            for i in range(batch.num_rows):
                record = {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}
                bundles.add(record["record_id"], build_record(record, date))
            yield bundles.take()
        bundles.close()
        yield bundles.take()

    names = [f.split()[0] for f in RECORDS.split(", ")]
    return stored(records.select(*names).mapInArrow(write, INDEX), "warc-index")


def _frames(bundle: str, frames: list[int] | None) -> Iterator[tuple[int, bytes]]:
    fs, path = pafs.FileSystem.from_uri(bundle)
    unpack = zstandard.ZstdDecompressor()
    with fs.open_input_file(path) as file:
        table = read_seek_table(file, file.size())
        for k in range(len(table)) if frames is None else frames:
            start, packed, unpacked = table[k]
            file.seek(start)
            yield k, unpack.decompress(file.read(packed), max_output_size=unpacked)


def _as_batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, _RECORDS_ARROW)


def read_bundles(index: DataFrame, payload: bool = True) -> DataFrame:
    """All records of the bundles that the index names, with the columns of RECORDS.

    A bundle is read frame by frame, by its own seek table. Without ``payload`` the payloads are
    checked against their digests and left out of the result.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bundle in batch.column(0).to_pylist():
                for _, data in _frames(bundle, None):
                    at, rows = 0, []
                    while at < len(data):
                        record, at = parse_record(data, at)
                        rows.append(record if payload else record | {"payload": None})
                    yield _as_batch(rows)

    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # By another key than that of the grouping, as Spark would drop this step as redundant otherwise.
    dealt = index.select("bundle").distinct().repartition(parts, F.xxhash64("bundle"))
    return dealt.mapInArrow(read, RECORDS)


def fetch_records(index: DataFrame) -> DataFrame:
    """The records of an index's rows alone: one frame is read for the rows that lie in it."""
    wanted = index.groupBy("bundle", "frame").agg(F.collect_list("offset").alias("offsets"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for _, data in _frames(row["bundle"], [row["frame"]]):
                    yield _as_batch([parse_record(data, at)[0] for at in row["offsets"]])

    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return wanted.repartition(parts, F.xxhash64("bundle", "frame")).mapInArrow(fetch, RECORDS)


def page_records(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """Pages as records (the columns of RECORDS), equal payloads kept once.

    Of pages with equal payloads of ``least_bytes`` or more, that with the smallest page_id is a
    response and the others revisit it; smaller payloads are always responses. Defined cases: a
    null html is an empty payload; rows that repeat the smallest page_id are responses too; a null
    page_id is never the smallest unless all are null; a null url is left out.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    record_id = F.col("page_id").cast("long").alias("record_id")
    rows = pages.select(record_id, F.col("url").alias("uri"), payload.alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn(
        "payload_digest", F.sha2("payload", 256)
    )
    groups = rows.filter(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest").agg(
        F.min("record_id").alias("first_id"), F.count("*").alias("n")
    )
    shared = stored(groups.filter("n > 1").select("payload_digest", "first_id"), "warc-groups")
    if shared.limit(SMALL_GROUPS + 1).count() <= SMALL_GROUPS:
        joined = rows.join(F.broadcast(shared), "payload_digest", "left")
    else:  # copies of one payload are dealt over salts
        copies = shared.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64("record_id", "uri"), F.lit(SALTS)).cast("int")
        joined = rows.withColumn("_salt", salt).join(copies, ["payload_digest", "_salt"], "left")
    later = F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("record_id"))
    revisit = (F.col("payload_bytes") >= least_bytes) & later
    return joined.select(
        "record_id",
        "uri",
        "payload",
        "payload_bytes",
        "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def archive_pages(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write pages to bundles and return the index; ``path`` is a new folder of shared scratch unless given."""
    return write_bundles(page_records(pages), path or scratch_path(pages.sparkSession, "warc"))
