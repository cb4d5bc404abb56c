"""WARC archives in seekable Zstandard bundles.

A bundle is a row of independent Zstandard frames, each holding whole records, closed by a
seek table in a skippable frame (the public seekable format: per frame its compressed and
plain length, then a footer).  The index maps every record id to (bundle, frame, offset in
the plain frame, length), so one record costs one ranged read and one small decompression.

Each task streams its rows into bundles in the shared folder, bundle after bundle, frame
after frame; what it holds is one frame.  File names carry a random part, and only the
index of successful tasks is kept, so what a lost or repeated attempt wrote is never read.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_url, scratch, stored

FRAME_BYTES = 256 * 1024         # a frame is closed once it holds so many plain bytes
BUNDLE_BYTES = 64 * 1024 * 1024  # a bundle is closed once it has so many compressed bytes
REVISIT_BYTES = 1000             # smaller payloads are always written out
BATCH_BYTES = 8 * 1024 * 1024    # of records handed back to Spark at once

# Fixed values of the seekable format and of WARC 1.1.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
WARC_VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "record_id string, page_id long, bundle string, frame int, at long, offset long, length long"
RECORD = ("record_id string, page_id long, record_type string, payload_bytes long, "
          "payload_digest string, refers_to long, url string, payload binary")


# --- records ------------------------------------------------------------------------

def _clean(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record_bytes(record_id, page_id, url, kind, digest, n_bytes, refers_to, payload) -> bytes:
    """One WARC record.  Fields that are null are left out."""
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"),
            ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("X-Payload-Length", str(n_bytes))]
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    if url is not None:
        head.append(("WARC-Target-URI", _clean(url)))
    if kind == "revisit":
        head.append(("WARC-Profile", REVISIT_PROFILE))
        head.append(("X-Refers-To-Page", str(refers_to)))
    head.append(("Content-Length", str(len(payload))))
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in head)
    return b"".join((WARC_VERSION, b"\r\n", lines, b"\r\n", payload, b"\r\n\r\n"))


def parse_record(frame: bytes, start: int = 0) -> tuple[dict, int]:
    """The record at `start` of a plain frame, and where the next one starts."""
    end = frame.index(b"\r\n\r\n", start)
    head = frame[start:end].decode().split("\r\n")
    if head[0].encode() != WARC_VERSION:
        raise ValueError(f"no WARC record at byte {start}")
    fields = dict(line.split(": ", 1) for line in head[1:])
    body = end + 4
    size = int(fields["Content-Length"])
    number = lambda k: int(fields[k]) if k in fields else None
    return {
        "record_id": fields["WARC-Record-ID"][1:-1], "page_id": number("X-Page-ID"),
        "record_type": fields["WARC-Type"], "payload_bytes": number("X-Payload-Length"),
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "refers_to": number("X-Refers-To-Page"), "url": fields.get("WARC-Target-URI"),
        "payload": frame[body:body + size] if fields["WARC-Type"] == "response" else None,
    }, body + size + 4


# --- bundles ------------------------------------------------------------------------

class BundleWriter:
    """Frames, then the seek table; holds one plain frame."""

    def __init__(self, sink):
        self.sink, self.frames, self.written = sink, [], 0
        self.pack = zstandard.ZstdCompressor(level=3)
        self.plain, self.filled = [], 0

    def add(self, record: bytes) -> tuple[int, int, int]:
        """Where the record lies: (frame, frame's first byte in the bundle, offset)."""
        if self.filled and self.filled + len(record) > FRAME_BYTES:
            self.close_frame()
        place = len(self.frames), self.written, self.filled
        self.plain.append(record)
        self.filled += len(record)
        return place

    def close_frame(self) -> None:
        if self.filled:
            data = self.pack.compress(b"".join(self.plain))
            self.sink.write(data)
            self.frames.append((len(data), self.filled))
            self.written += len(data)
            self.plain, self.filled = [], 0

    def close(self) -> None:
        self.close_frame()
        table = b"".join(struct.pack("<II", *sizes) for sizes in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC)
        self.sink.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table) + len(footer)) + table + footer)
        self.sink.close()


def seek_table(source) -> list[tuple[int, int, int]]:
    """(first byte, compressed length, plain length) per frame, from the bundle's end."""
    size = source.size()
    source.seek(size - 9)
    n, _, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("the bundle has no seek table")
    source.seek(size - 9 - 8 * n)
    sizes = struct.iter_unpack("<II", source.read(8 * n))
    out, at = [], 0
    for packed, plain in sizes:
        out.append((at, packed, plain))
        at += packed
    return out


def read_frame(source, at: int, packed: int, plain: int) -> bytes:
    source.seek(at)
    return zstandard.ZstdDecompressor().decompress(source.read(packed), max_output_size=plain)


# --- jobs ---------------------------------------------------------------------------

def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 payload_col: str = "html") -> DataFrame:
    """Rows with their payload's digest and the page they revisit, if any.

    Equal payloads are found by SHA-256, summed per task before the shuffle; the rows of a
    hot payload are then looked up in a join that adaptive execution splits.  SHA-1, for
    which collisions are published, is the records' digest only.
    """
    payload = F.coalesce(F.col(f"`{payload_col}`"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
                        payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("n_bytes", F.octet_length("payload").cast("long"))
    # null for smaller ones: they meet nothing
    rows = rows.withColumn("same", F.when(F.col("n_bytes") >= REVISIT_BYTES, F.sha2("payload", 256)))
    heads = (rows.filter("same is not null").groupBy(F.col("same").alias("_same"))
             .agg(F.max("page_id").alias("head"), F.count("*").alias("n")).filter("n > 1").select("_same", "head"))
    rows = rows.join(heads, F.col("same") == F.col("_same"), "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("head")), F.col("head"))
    return rows.select("page_id", "url", "digest", "n_bytes", refers.alias("refers_to"),
                       F.when(refers.isNull(), F.col("payload")).otherwise(F.lit(b"")).alias("payload"))


def write_bundles(planned: DataFrame, folder: str) -> DataFrame:
    """Writes the bundles and returns the stored index (INDEX)."""
    url = arrow_url(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(url)
        fs.create_dir(root, recursive=True)
        writer = path = None
        index: list[tuple] = []

        def flush():
            names = [f.split()[0] for f in INDEX.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*index), types)], names)

        types = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches:
            columns = [batch.column(i) for i in range(batch.num_columns)]
            for i in range(batch.num_rows):
                page, target, digest, n_bytes, refers, payload = (c[i].as_py() for c in columns)
                if writer is None:
                    path = f"{root}/{uuid.uuid4().hex}.warc.zst"
                    writer = BundleWriter(fs.open_output_stream(path, compression=None))
                record_id = f"urn:uuid:{uuid.uuid4()}"
                kind = "response" if refers is None else "revisit"
                data = record_bytes(record_id, page, target, kind, digest, n_bytes, refers, payload)
                frame, at, offset = writer.add(data)
                index.append((record_id, page, path.rsplit("/", 1)[1], frame, at, offset, len(data)))
                if writer.written >= BUNDLE_BYTES:
                    writer.close()
                    writer = None
            if len(index) >= 20_000:
                yield flush()
                index = []
        if writer is not None:
            writer.close()
        if index:
            yield flush()

    return stored(planned.mapInArrow(write, INDEX))


def _batches(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())])
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 200 + len(row["payload"] or b"")
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def read_bundles(spark: SparkSession, folder: str, index: DataFrame) -> DataFrame:
    """Every record of the bundles that the index names, bundle by bundle through the seek tables."""
    url = arrow_url(folder)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(url)

        def rows():
            for batch in batches:
                for name in batch.column(0).to_pylist():
                    with fs.open_input_file(f"{root}/{name}") as source:
                        for at, packed, plain in seek_table(source):
                            frame, start = read_frame(source, at, packed, plain), 0
                            if len(frame) != plain:
                                raise ValueError(f"{name}: frame at {at} has {len(frame)} bytes, not {plain}")
                            while start < len(frame):
                                row, start = parse_record(frame, start)
                                yield row
        yield from _batches(rows())

    bundles = index.select("bundle").distinct()
    return bundles.repartition(spark.sparkContext.defaultParallelism, "bundle").mapInArrow(read, RECORD)


def read_records(wanted: DataFrame, folder: str) -> DataFrame:
    """The records of some index rows, by ranged reads of their frames alone."""
    url = arrow_url(folder)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(url)

        def rows():
            for batch in batches:
                for row in batch.to_pylist():
                    with fs.open_input_file(f"{root}/{row['bundle']}") as source:
                        source.seek(row["at"])
                        reader = zstandard.ZstdDecompressor().stream_reader(source, closefd=False)
                        reader.read(row["offset"])
                        yield parse_record(reader.read(row["length"]))[0]
        yield from _batches(rows())

    return wanted.select("bundle", "at", "offset", "length").mapInArrow(read, RECORD)


def archive(pages: DataFrame, folder: str | None = None, **columns) -> tuple[DataFrame, str]:
    """Writes every page as a record; returns (index, folder).

    A null or empty payload is an empty response; a null url or id leaves its field out.
    Of equal payloads of at least REVISIT_BYTES the row with the largest id is the
    response, the others (null ids too) revisit it; if all ids are null, or rows repeat the
    largest id, those rows are responses.  Payloads beyond FRAME_BYTES get a frame of their
    own.  An empty table gives an empty index and no bundle.
    """
    folder = folder or scratch(pages.sparkSession)
    return write_bundles(plan_records(pages, **columns), folder), folder


def archived_pages(pages: DataFrame) -> DataFrame:
    """Writes the archives and reads them back: page_id, payload_bytes, payload_digest,
    record_type, refers_to.  A response's length and digest are taken from the payload read."""
    index, folder = archive(pages)
    back = read_bundles(pages.sparkSession, folder, index)
    read = F.col("record_type") == "response"
    return back.select(
        "page_id", F.when(read, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(read, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", "refers_to")
