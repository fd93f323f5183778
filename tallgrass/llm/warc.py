"""Seekable Zstandard bundles of WARC records.

A bundle is a row of independent frames, each holding a group of records, and a last skippable frame with the seek
table of the public seekable format: compressed and plain size of every frame, then count, flags and magic number.
The index table maps each record to bundle, frame and offset within the frame's plain bytes.

Bundles are written by tasks into the shared folder under a name of their own per attempt; the index, which Spark
commits, names only those of attempts that succeeded, so a lost executor leaves an orphan file and nothing else.

Defined cases: null html is an empty payload; null page ids are kept; of equal payloads of at least ``least_bytes``
all rows with the largest page id are responses (repeated rows), and every row is if none has an id; null url is
written as an empty target; an empty table gives no bundle and an empty index; only page_id, url and html are read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from io import BytesIO

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.llm.joins import small
from tallgrass.plans.durable import passing, stash

# Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

#: Plain bytes and records after which a frame is closed.
FRAME_BYTES = 1 << 20
FRAME_RECORDS = 256

INDEX_SCHEMA = "page_id long, bundle string, frame int, at long, length long"
RECORD_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target string"
_DATE = "2024-01-01T00:00:00Z"


def place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


class BundleWriter:
    """Groups records into frames and ends the file with the seek table."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES, frame_records: int = FRAME_RECORDS):
        self.out, self.frame_bytes, self.frame_records = out, frame_bytes, frame_records
        self.packer, self.sizes = zstandard.ZstdCompressor(level=3), []
        self.plain, self.held = BytesIO(), 0

    def next(self) -> tuple[int, int]:
        """Frame and offset of the record that is added next."""
        return len(self.sizes), self.plain.tell()

    def add(self, record: bytes) -> tuple[int, int]:
        """Frame and offset of ``record``."""
        where = self.next()
        self.plain.write(record)
        self.held += 1
        if self.plain.tell() >= self.frame_bytes or self.held >= self.frame_records:
            self.end_frame()
        return where

    def end_frame(self) -> None:
        if self.held:
            plain = self.plain.getvalue()
            packed = self.packer.compress(plain)
            self.out.write(packed)
            self.sizes.append((len(packed), len(plain)))
            self.plain, self.held = BytesIO(), 0

    def close(self) -> None:
        self.end_frame()
        table = b"".join(struct.pack("<II", *x) for x in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)


def seek_table(source) -> list[tuple[int, int, int]]:
    """Offset, compressed and plain size of each frame, from the file's end."""
    size = source.size()
    source.seek(size - 9)
    count, flags, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table at the end of the file")
    entry = 12 if flags & 0x80 else 8
    source.seek(size - 9 - count * entry)
    raw, at, frames = source.read(count * entry), 0, []
    for k in range(count):
        packed, plain = struct.unpack_from("<II", raw, k * entry)
        frames.append((at, packed, plain))
        at += packed
    return frames


def read_frame(source, frames: list[tuple[int, int, int]], frame: int) -> bytes:
    at, packed, plain = frames[frame]
    source.seek(at)
    return zstandard.ZstdDecompressor().decompress(source.read(packed), max_output_size=plain)


def _target(url: str | None) -> str:
    return (url or "").replace("\r", "%0D").replace("\n", "%0A")


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to, revisit: bool, its_url: str | None = None, place: str = "") -> bytes:
    """One WARC/1.1 record; a revisit holds headers only, and the payload's digest and length as fields.

    ``place`` (bundle, frame and offset) makes the record's id, so that rows that share a page id have ids of their own.
    """
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{place}:{page_id}')}>"),
        ("WARC-Date", _DATE),
        ("WARC-Target-URI", _target(url)),
        ("WARC-Payload-Digest", f"sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}"),
        ("X-Page-ID", "" if page_id is None else page_id),
        ("X-Payload-Length", len(payload)),
    ]
    if revisit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To-Target-URI", _target(its_url)),
            ("WARC-Refers-To-Date", _DATE),
            ("X-Refers-To-Page-ID", refers_to),
        ]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse(plain: bytes, at: int = 0) -> Iterator[tuple[dict[str, str], bytes, int]]:
    """Fields, payload and offset of the records of ``plain`` from ``at`` on."""
    while at < len(plain):
        body = plain.index(b"\r\n\r\n", at) + 4
        lines = plain[at : body - 4].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError("a record must begin with its version")
        fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        end = body + int(fields["Content-Length"])
        block = plain[body:end]
        yield fields, block[block.index(b"\r\n\r\n") + 4 :], at
        at = end + 4


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = place(folder)
        out = writer = None
        name = f"{uuid.uuid4().hex}.warc.zst"
        try:
            for batch in batches:
                rows = []
                for page_id, url, html, digest, refers_to, its_url in zip(*(c.to_pylist() for c in batch.columns)):
                    if writer is None:
                        store.create_dir(top, recursive=True)
                        out = store.open_output_stream(f"{top}/{name}", compression=None)
                        writer = BundleWriter(out)
                    place_of = "{}/{}/{}".format(name, *writer.next())
                    raw = record(page_id, url, (html or "").encode(), digest, refers_to, refers_to is not None, its_url, place_of)
                    rows.append((page_id, name, *writer.add(raw), len(raw)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*rows) if rows else [[]] * 5, (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()))],
                    names=["page_id", "bundle", "frame", "at", "length"],
                )
            if writer is not None:
                writer.close()
        finally:
            if out is not None:
                out.close()

    return run


def write_bundles(pages: DataFrame, folder: str, least_bytes: int = 1000) -> DataFrame:
    """Write every row of ``pages`` into bundles below ``folder``; returns the index (a row per record)."""
    with passing(pages.sparkSession) as keep:
        html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
        read = pages.select("page_id", "url", "html").withColumns({"digest": F.sha1(html), "check": F.sha2(html, 256), "n": F.octet_length(html)})
        kept = (
            read.where(F.col("n") >= least_bytes)
            .groupBy("digest", "check")
            .agg(F.max("page_id").alias("kept_id"), F.max_by("url", "page_id").alias("kept_url"), F.count(F.lit(1)).alias("rows"))
            .where("rows > 1")
            .select(F.col("digest").alias("kept_digest"), F.col("check").alias("kept_check"), "kept_id", "kept_url")
        )
        # Sent to all unless there are very many of them, payloads stay where they are, whatever share of pages has one.
        kept = small(stash(kept, "warc-kept"), rows_of=8)
        refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("kept_id")), F.col("kept_id"))
        rows = read.join(kept, (F.col("digest") == F.col("kept_digest")) & (F.col("check") == F.col("kept_check")), "left").select(
            "page_id", "url", "html", "digest", refers_to.alias("refers_to"), "kept_url"
        )
        index = stash(rows.mapInArrow(_write(folder), INDEX_SCHEMA), "warc-index")
        keep(index)
    return index


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = place(folder)
        name = source = None
        for batch in batches:
            for bundle, frame in zip(*(c.to_pylist() for c in batch.columns)):
                if bundle != name:
                    if source is not None:
                        source.close()
                    name, source = bundle, store.open_input_file(f"{top}/{bundle}")
                    frames = seek_table(source)
                rows = []
                for fields, payload, _ in parse(read_frame(source, frames, frame)):
                    stored = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    digest, n = stored, int(fields["X-Payload-Length"])
                    if fields["WARC-Type"] == "response":
                        digest, n = hashlib.sha1(payload).hexdigest(), len(payload)
                        if digest != stored:
                            raise ValueError(f"{bundle}, frame {frame}: a payload does not have its digest")
                    number = lambda k: int(fields[k]) if fields.get(k) else None
                    rows.append((number("X-Page-ID"), n, digest, fields["WARC-Type"], number("X-Refers-To-Page-ID"), fields["WARC-Target-URI"]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()))],
                    names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target"],
                )
        if source is not None:
            source.close()

    return run


def read_bundles(spark: SparkSession, folder: str, index: DataFrame) -> DataFrame:
    """Every record of the bundles that ``index`` names, read frame by frame through the seek tables."""
    plain = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(spark.sparkContext.defaultParallelism, plain // (64 << 20) + 1)
    frames = index.select("bundle", "frame").distinct().repartition(tasks, "bundle", F.floor(F.col("frame") / 16)).sortWithinPartitions("bundle", "frame")
    return frames.mapInArrow(_read(folder), RECORD_SCHEMA)


def fetch(folder: str, bundle: str, frame: int, at: int) -> tuple[dict[str, str], bytes]:
    """The one record at an index entry; reads the seek table and one frame."""
    store, top = place(folder)
    with store.open_input_file(f"{top}/{bundle}") as source:
        fields, payload, _ = next(parse(read_frame(source, seek_table(source), frame), at))
    return fields, payload
