"""WARC records in seekable Zstandard bundles.

A bundle is a row of independent Zstandard frames, each with a group of records, and a seek table in a skippable frame
at its end (the published seekable format). The index maps a record to its bundle, frame and offset in the frame.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.llm.common import batches_of, rows_of
from tidemark.session import new_folder, staged

# Fixed values of the formats.
SKIPPABLE, SEEK_MAGIC = 0x184D2A5E, 0x8F92EAB1
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FRAME_BYTES = 1 << 20  # a frame is closed when its records reach this
BUNDLE_BYTES = 256 << 20  # a bundle is closed when its frames reach this
SPLIT_FRAMES = 16  # frames in a row that are read together
LEVEL = 3


class Place(NamedTuple):
    frame: int
    offset: int
    size: int


def digest_of(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page: int | None) -> str:
    return f"urn:page:{'null' if page is None else page}"


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record. A revisit has the HTTP head of its page, so its payload's size stays known, but no payload."""
    target = "".join(c if " " < c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    head = [
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{record_id(page)}>",
        "WARC-Date: 1970-01-01T00:00:00Z",  # the table has no dates
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{record_id(refers_to)}>"]
    else:
        block += payload
    head.append(f"Content-Length: {len(block)}")
    return b"\r\n".join([VERSION, *(h.encode() for h in head), b"", block]) + b"\r\n\r\n"


def parsed(frame: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record that begins at ``at``."""
    stop = frame.index(b"\r\n\r\n", at)
    first, *lines = frame[at:stop].split(b"\r\n")
    if first != VERSION:
        raise ValueError("no record begins here")
    headers = dict(line.decode().split(": ", 1) for line in lines)
    begin, size = stop + 4, int(headers["Content-Length"])
    return headers, frame[begin : begin + size], begin + size + 4


class Bundle:
    """A bundle being written to a binary stream."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES):
        self.out, self.frames, self.held, self.written, self.frame_bytes = out, [], bytearray(), 0, frame_bytes
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)

    def add(self, raw: bytes) -> Place:
        place = Place(len(self.frames), len(self.held), len(raw))
        self.held += raw
        if len(self.held) >= self.frame_bytes:
            self._flush()
        return place

    def _flush(self) -> None:
        packed = self.packer.compress(bytes(self.held))
        self.out.write(packed)
        self.frames.append((len(packed), len(self.held)))
        self.written += len(packed)
        self.held.clear()

    def close(self) -> None:
        if self.held:
            self._flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


def seek_table(source) -> list[tuple[int, int, int]]:
    """``(position, packed bytes, bytes)`` of each frame of an open bundle."""
    end = source.size()
    source.seek(end - 9)
    count, _, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEK_MAGIC:
        raise ValueError("the file has no seek table")
    source.seek(end - 9 - 8 * count)
    raw, found, at = source.read(8 * count), [], 0
    for packed, size in struct.iter_unpack("<II", raw):
        found.append((at, packed, size))
        at += packed
    return found


def frame_of(source, entry: tuple[int, int, int]) -> bytes:
    source.seek(entry[0])
    return zstandard.ZstdDecompressor().decompress(source.read(entry[1]), max_output_size=entry[2])


def read_record(spark: SparkSession, index: DataFrame, page: int) -> bytes | None:
    """One page's record by its index entry: one seek, one frame."""
    entry = index.where(F.col("page_id") == page).head()
    if entry is None:
        return None
    files, path = pafs.FileSystem.from_uri(entry["bundle"])
    with files.open_input_file(path) as source:
        frame = frame_of(source, seek_table(source)[entry["frame"]])
    return frame[entry["offset"] : entry["offset"] + entry["size"]]


def with_originals(pages: DataFrame, least: int = 0) -> DataFrame:
    """Adds ``_original``: of pages with equal payloads of at least ``least`` bytes, the largest id.

    Only digests that occur more than once are joined back; one page's digest may be that of very many, which the
    adaptive join splits. Null where the payload occurs once or is smaller.
    """
    digest = F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary"))
    rows = pages.withColumn("_digest", digest)
    size = F.coalesce(F.octet_length("html"), F.lit(0))
    shared = rows.where(size >= least).groupBy("_digest").agg(F.max("page_id").alias("_original"), F.count(F.lit(1)).alias("_n"))
    return rows.join(staged(shared.where("_n > 1").drop("_n"), "digests"), "_digest", "left").drop("_digest")


def write_bundles(pages: DataFrame, folder: str, least: int = 0, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Writes a record per row of ``pages`` (page_id, url, html) and returns the index.

    The index is ``page_id, bundle, frame, offset, size``. Of records with equal payloads of at least ``least`` bytes
    the one with the largest id is a response and the others revisit it; rows that repeat that id are all responses,
    as are payloads whose rows have null ids alone. A null html is an empty payload. Other columns are not written.

    A task writes its own bundles, under names of its own, and the index lists those of finished tasks only: what a
    lost executor has left is never read. An empty table writes nothing.
    """
    rows = with_originals(pages.select("page_id", "url", "html"), least)
    revisit = F.col("_original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_original"))
    rows = rows.select("page_id", "url", "html", "_original", revisit.alias("revisit"))
    id_type = rows.schema["page_id"].dataType
    schema = T.StructType([T.StructField("page_id", id_type), T.StructField("bundle", T.StringType())])
    schema = schema.add("frame", "long").add("offset", "long").add("size", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        bundle, name = None, ""
        fields = [pa.field("bundle", pa.string()), *(pa.field(n, pa.int64()) for n in ("frame", "offset", "size"))]
        for batch in batches:
            placed = []
            for page, url, html, original, again in rows_of([batch], "page_id", "url", "html", "_original", "revisit"):
                if bundle is None:
                    name = f"part-{uuid.uuid4().hex}.warc.zst"
                    bundle = Bundle(files.open_output_stream(f"{root}/{name}", compression=None), frame_bytes)
                place = bundle.add(record(page, url, (html or "").encode(), original, again))
                placed.append((page, f"{folder}/{name}", *place))
                if bundle.written >= BUNDLE_BYTES:
                    bundle.close()
                    bundle = None
            yield from batches_of(iter(placed), pa.schema([batch.schema.field("page_id"), *fields]))
        if bundle is not None:
            bundle.close()

    files, root = pafs.FileSystem.from_uri(folder)
    files.create_dir(root, recursive=True)
    return staged(rows.mapInArrow(run, schema), "warc-index")


def read_bundles(index: DataFrame, split_frames: int = SPLIT_FRAMES) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to``, read from the bundles of the index.

    The bundles are read in splits of ``split_frames`` frames, found by the seek table, which are dealt to tasks in turn; so a
    single large bundle is shared too. A response's digest is taken from its payload and must be the one that its header
    states. Rows that repeat an id come back each. An empty index gives no rows.
    """
    id_type = index.schema["page_id"].dataType
    last = index.groupBy("bundle").agg(F.max("frame").alias("last"))
    first = F.explode(F.sequence(F.lit(0).cast("bigint"), "last", F.lit(split_frames).cast("bigint")))
    splits = staged(last.select("bundle", first.alias("first")), "splits")
    # Dealt in turn and by a number, as adaptive execution would join so few rows in one task.
    tasks = min(splits.count(), int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    splits = splits.repartition(max(tasks, 1))
    schema = T.StructType([T.StructField("page_id", T.StringType())]).add("payload_bytes", "long")
    schema = schema.add("payload_digest", "string").add("record_type", "string").add("refers_to", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = pa.schema([pa.field(f.name, pa.int64() if f.name == "payload_bytes" else pa.string()) for f in schema])

        def records():
            for uri, first in rows_of(batches, "bundle", "first"):
                files, path = pafs.FileSystem.from_uri(uri)
                with files.open_input_file(path) as source:
                    for entry in seek_table(source)[first : first + split_frames]:
                        frame, at = frame_of(source, entry), 0
                        while at < len(frame):
                            headers, block, at = parsed(frame, at)
                            yield _facts(headers, block)

        yield from batches_of(records(), fields)

    found = splits.mapInArrow(run, schema)
    return found.select(
        F.col("page_id").try_cast(id_type).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").try_cast(id_type).alias("refers_to")
    )


def _facts(headers: dict[str, str], block: bytes) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if headers["WARC-Type"] == "response" and (len(payload) != size or digest_of(payload) != digest):
        raise ValueError(f"{headers['WARC-Record-ID']} does not hold its payload")
    refers = headers.get("WARC-Refers-To", "")
    return headers["WARC-Record-ID"][10:-1], size, digest, headers["WARC-Type"], refers[10:-1] or None


def archive_folder(spark: SparkSession) -> str:
    """A new folder for bundles in the shared folder, as a URI."""
    folder = new_folder(spark, "warc")
    return folder if "://" in folder else f"file://{folder.removeprefix('file:')}"
