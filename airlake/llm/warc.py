"""WARC archives as seekable Zstandard bundles.

A task writes its records into bundles under a shared folder. Records are
grouped into frames that are compressed independently; a bundle ends with a
skippable frame that holds the sizes of all frames (the seek table of the
public seekable format), so one record is read by decompressing one frame. The
index maps record ids to bundle, frame, and offset inside the frame.

Bundle names are new in every task attempt and only the index, which Spark
commits, says which bundles count: bundles of lost attempts are never read.
A bundle enters the index only after it is closed.

Payloads of at least ``MIN_REVISIT_BYTES`` that are equal are stored once: the
record with the largest page_id is the response, the others revisit it.

Defined results: null html is an empty payload; a null page_id is written as
"null" and is response only in a group without any page_id; rows of one group
that repeat the largest page_id are all responses; a null url gives no target
URI. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlake.llm.common import materialize, shared_path, slices

MIN_REVISIT_BYTES = 1000
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 64 << 20
# fixed values of the formats
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WARC_DATE = "1970-01-01T00:00:00Z"
# end of fixed values
INDEX = "page_id bigint, bundle string, frame int, offset bigint, length bigint"


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page_id(record_id: str) -> int | None:
    name = record_id.removeprefix("<urn:page:").removesuffix(">")
    return None if name == "null" else int(name)


def warc_record(page_id, url: str | None, payload: bytes, sha1: str, refers_to, revisit: bool) -> bytes:
    """One record: an HTTP response, or its headers alone if it is a revisit."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in url))
    head += [f"WARC-Date: {WARC_DATE}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head += [f"WARC-Refers-To: {_record_id(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    else:
        block += payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(data: bytes, at: int = 0) -> tuple[dict[str, str], int]:
    """Header fields of the block at ``at``, and where it ends."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")[1:]
    return dict(line.split(": ", 1) for line in lines), end + 4


def parse_record(data: bytes) -> dict:
    """page_id, payload (None for a revisit), payload_bytes, payload_digest,
    record_type and refers_to of one record."""
    head, at = _headers(data)
    block = data[at : at + int(head["Content-Length"])]
    http, body = _headers(block)
    digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    out = {"page_id": _page_id(head["WARC-Record-ID"]), "record_type": head["WARC-Type"], "payload_digest": digest}
    if head["WARC-Type"] == "revisit":
        return out | {"payload": None, "payload_bytes": int(http["Content-Length"]), "refers_to": _page_id(head["WARC-Refers-To"])}
    payload = block[body:]
    if hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload of {head['WARC-Record-ID']} does not match its digest")
    return out | {"payload": payload, "payload_bytes": len(payload), "refers_to": None}


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """Skippable frame with (compressed, decompressed) sizes and the footer."""
    body = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


@dataclass
class Bundle:
    """A bundle being written: frames go out as they fill."""

    path: str
    out: pa.NativeFile
    packer: zstandard.ZstdCompressor
    frames: list[tuple[int, int]] = field(default_factory=list)
    index: list[tuple] = field(default_factory=list)
    records: list[bytes] = field(default_factory=list)
    filled: int = 0
    written: int = 0

    def add(self, page_id, record: bytes) -> None:
        self.index.append((page_id, self.path, len(self.frames), self.filled, len(record)))
        self.records.append(record)
        self.filled += len(record)
        if self.filled >= FRAME_BYTES:
            self.flush()

    def flush(self) -> None:
        if self.records:
            packed = self.packer.compress(b"".join(self.records))
            self.out.write(packed)
            self.frames.append((len(packed), self.filled))
            self.written += len(packed)
            self.records, self.filled = [], 0

    def close(self) -> list[tuple]:
        self.flush()
        self.out.write(seek_table(self.frames))
        self.out.close()
        return self.index


def _file_system(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


class BundleReader:
    """Random access to the records of a bundle through its seek table."""

    def __init__(self, uri: str):
        system, path = _file_system(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        count, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE_MAGIC or flags:
            raise ValueError(f"{uri} has no seek table")
        table = self.file.read_at(8 * count, size - 9 - 8 * count)
        self.sizes = list(struct.iter_unpack("<II", table))
        self.starts = [0]
        for packed, _ in self.sizes:
            self.starts.append(self.starts[-1] + packed)

    def frame(self, number: int) -> bytes:
        packed, plain = self.sizes[number]
        data = self.file.read_at(packed, self.starts[number])
        return zstandard.ZstdDecompressor().decompress(data, max_output_size=plain)

    def record(self, frame: int, offset: int, length: int) -> dict:
        return parse_record(self.frame(frame)[offset : offset + length])

    def records(self) -> Iterator[dict]:
        for number in range(len(self.sizes)):
            data, at = self.frame(number), 0
            while at < len(data):
                head, block = _headers(data, at)
                stop = block + int(head["Content-Length"]) + 4
                yield parse_record(data[at:stop])
                at = stop


def mark_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, sha1, ``keep`` (the response's page_id where equal
    payloads exist, else null). Only digests and ids are aggregated; a group of
    equal payloads needs no task of its own."""
    facts = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("key", F.when(F.length("payload") >= MIN_REVISIT_BYTES, F.sha2("payload", 256)))
    groups = (
        facts.where("key is not null")
        .groupBy("key")
        .agg(F.max("page_id").alias("keep"), F.count("*").alias("n"))
        .where("n > 1 and keep is not null")
        .select("key", "keep")
    )
    # written first, so that the join's inputs are plain shuffles, which Spark
    # can split where one payload has very many rows
    groups = materialize(groups, "warc-groups")
    # a key of its own for each short payload: one null key would be one partition
    short = F.concat(F.lit("short "), F.xxhash64("page_id", "url").cast("string"))
    facts = facts.withColumn("key", F.coalesce("key", short))
    return facts.join(groups, "key", "left").select("page_id", "url", "payload", F.sha1("payload").alias("sha1"), "keep")


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) into bundles in
    ``folder``, a place that all executors share; returns the index."""

    def run(batches):
        system, base = _file_system(folder)
        system.create_dir(base, recursive=True)
        packer, bundle = zstandard.ZstdCompressor(level=3, write_checksum=True), None
        for part in slices(batches):
            for row in part.to_pylist():
                if bundle is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    bundle = Bundle(f"{folder}/{name}", system.open_output_stream(f"{base}/{name}", compression=None), packer)
                keep = row["keep"]
                revisit = keep is not None and row["page_id"] != keep
                bundle.add(row["page_id"], warc_record(row["page_id"], row["url"], row["payload"], row["sha1"], keep, revisit))
                if bundle.written >= BUNDLE_BYTES:
                    yield _index_batch(bundle.close())
                    bundle = None
        if bundle is not None:
            yield _index_batch(bundle.close())

    return materialize(mark_revisits(pages).mapInArrow(run, INDEX), "warc-index")


def _index_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64())
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)],
        names=["page_id", "bundle", "frame", "offset", "length"],
    )


def read_archives(index: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of the index's bundles, a bundle at a time: page_id,
    payload_bytes, payload_digest, record_type, refers_to, and payload."""
    bundles = index.select("bundle").distinct()
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}
    kinds |= {"payload": pa.binary()} if payloads else {}

    def run(batches):
        for batch in batches:
            for uri in batch.column("bundle").to_pylist():
                rows = []
                for record in BundleReader(uri).records():
                    rows.append(record)
                    if len(rows) == 256:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)

    def _batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in kinds.items()], names=list(kinds))

    fields = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    return bundles.repartition(max(1, bundles.count()), "bundle").mapInArrow(run, fields + ", payload binary" * payloads)


def read_record(spark: SparkSession, index: DataFrame, page_id: int) -> list[dict]:
    """The records of one page, each by one seek and one frame."""
    found = index.where(F.col("page_id") == page_id).collect()
    return [BundleReader(r["bundle"]).record(r["frame"], r["offset"], r["length"]) for r in found]


def archive_digest(pages: DataFrame) -> DataFrame:
    """Write all pages as WARC bundles, read the bundles back, and return
    page_id, payload_bytes, payload_digest, record_type, refers_to."""
    index = write_archives(pages, shared_path(pages.sparkSession, "warc"))
    return read_archives(index, payloads=False)


ARCHIVE_DIGEST_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, octet_length(encode(coalesce(html, ''))) AS n FROM pages
), m AS (
  SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY payload) ELSE page_id END AS keep FROM p
)
SELECT page_id, n::BIGINT AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN keep = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN keep = page_id THEN NULL ELSE keep END AS refers_to
FROM m
"""
