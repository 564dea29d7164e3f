"""Web archives as seekable Zstandard bundles.

Each task writes archives of its own: WARC records are grouped into independent Zstandard frames, a seek table follows as a
skippable frame at the end, and an index row per record says in which frame it stands and where in the frame's text. One record is
read by one footer, one frame and a slice; whole archives are read frame by frame, in any number of tasks.

An archive belongs to the run only if the index names it. The index is written by Spark, so a task that is lost and run again leaves
at most a file that nothing names.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from hashlib import sha256
from urllib.parse import quote

import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casefeatures.sources.files import scratch_path, written

#: Payloads of fewer bytes are always stored whole.
LEAST_REVISIT = 100
#: Uncompressed bytes from which a frame ends, compressed bytes from which an archive ends. One record is never divided.
FRAME_BYTES, ARCHIVE_BYTES = 1 << 20, 256 << 20
BROADCAST_ROWS = 500_000
DATE = "2000-01-01T00:00:00Z"
# The seekable format's frame, footer and layout.
SKIPPABLE, SEEKABLE, CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
INDEX = "path string, frame int, at long, length long, page_id long, record_type string"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def classified(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """``page_id``, ``url``, ``payload`` (null html: empty), ``digest``, ``n_bytes``, ``record_type``, ``refers_to``.

    Of equal payloads of at least ``least`` bytes the row with the smallest page_id is the response. Rows that repeat that page_id are
    responses too; a null page_id is larger than any, and a group with no other is all responses.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "n_bytes": F.octet_length("payload").cast("long")})
    groups = rows.where(F.col("n_bytes") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    groups = written(groups.where("n > 1 AND first IS NOT NULL").select("digest", "first"), scratch_path(pages.sparkSession, "repeats"))
    few = groups.count() <= BROADCAST_ROWS
    joined = rows.join(F.broadcast(groups) if few else groups, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(
        "page_id", "url", "payload", "digest", "n_bytes", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("first")).alias("refers_to")
    )


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, n_bytes: int, kind: str, refers: int | None) -> bytes:
    """One WARC record. A revisit has the digest and the length of the payload it does not repeat."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$&'()*+,/:;=?@[]~%"))
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Payload-Length: {n_bytes}", "Content-Type: application/http; msgtype=response"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:x-page:{refers}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _id(value: str) -> int | None:
    digits = value.removeprefix("<urn:x-page:").removesuffix(">")
    return int(digits) if digits else None


def parsed(frame: bytes, at: int = 0) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, headers and payload of each record of a frame from ``at`` on."""
    while at < len(frame):
        end = frame.index(b"\r\n\r\n", at)
        lines = frame[at:end].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no record at {at}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        start, n = end + 4, int(head["Content-Length"])
        block = frame[start : start + n]
        yield at, head, block[block.index(b"\r\n\r\n") + 4 :]
        at = start + n + 4


def seek_table(frames: list[tuple[int, int, int]]) -> bytes:
    """The skippable frame for (compressed bytes, bytes, checksum) of each frame."""
    body = b"".join(struct.pack("<III", *f) for f in frames) + struct.pack("<IBI", len(frames), CHECKSUMS, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def frames_of(source: pa.NativeFile) -> list[tuple[int, int, int, int]]:
    """(offset, compressed bytes, bytes, checksum) of each frame, from an archive's footer."""
    size = source.size()
    source.seek(size - 9)
    n, flags, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEKABLE or flags != CHECKSUMS:
        raise ValueError("no seek table")
    source.seek(size - 9 - 12 * n)
    out, offset = [], 0
    for packed, plain, check in struct.iter_unpack("<III", source.read(12 * n)):
        out.append((offset, packed, plain, check))
        offset += packed
    return out


def read_frame(source: pa.NativeFile, offset: int, packed: int, size: int, check: int) -> bytes:
    source.seek(offset)
    plain = zstandard.ZstdDecompressor().decompress(source.read(packed), max_output_size=size)
    if xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != check:
        raise ValueError("a frame's checksum differs")
    return plain


def write_archives(pages: DataFrame, folder: str, least: int = LEAST_REVISIT) -> DataFrame:
    """Write all pages to archives in ``folder`` (a path or URI that all tasks reach); the index, a row per record.

    An empty table writes no archive.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, base = fs.FileSystem.from_uri(folder)
        where.create_dir(base)
        packer = zstandard.ZstdCompressor(level=3)
        sink, name, table, size, held, plain = None, "", [], 0, [], 0

        def flush() -> pa.RecordBatch:
            nonlocal sink, name, table, size, held, plain
            if sink is None:
                name, table, size = f"{base}/{uuid.uuid4().hex}.warc.zst", [], 0
                sink = where.open_output_stream(name, compression=None)  # the frames are compressed already
            text = b"".join(x for x, _, _ in held)
            packed = packer.compress(text)
            sink.write(packed)
            at, rows = 0, []
            for x, page, kind in held:
                rows.append({"path": name, "frame": len(table), "at": at, "length": len(x), "page_id": page, "record_type": kind})
                at += len(x)
            table.append((len(packed), len(text), xxhash.xxh64_intdigest(text) & 0xFFFFFFFF))
            size, held, plain = size + len(packed), [], 0
            if size >= ARCHIVE_BYTES:
                close()
            return pa.RecordBatch.from_pylist(rows, _INDEX)

        def close() -> None:
            nonlocal sink
            sink.write(seek_table(table))
            sink.close()
            sink = None

        for batch in batches:
            for i in range(batch.num_rows):
                row = [c[i].as_py() for c in batch.columns]
                x = record(*row)
                held.append((x, row[0], row[5]))
                plain += len(x)
                if plain >= FRAME_BYTES:
                    yield flush()
        if held:
            yield flush()
        if sink is not None:
            close()

    return classified(pages, least).mapInArrow(work, INDEX)


_INDEX = pa.schema([("path", pa.string()), ("frame", pa.int32()), ("at", pa.int64()), ("length", pa.int64()), ("page_id", pa.int64()), ("record_type", pa.string())])
_RECORD = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())])


def _row(head: dict[str, str], payload: bytes) -> dict:
    """What a record says; of a response, what its stored payload says."""
    kind, refers = head["WARC-Type"], head.get("WARC-Refers-To")
    digest, n = head["WARC-Payload-Digest"].removeprefix("sha256:"), int(head["WARC-Payload-Length"])
    if kind == "response":
        if (sha256(payload).hexdigest(), len(payload)) != (digest, n):
            raise ValueError(f"payload of {head['WARC-Record-ID']} differs")
    return {"page_id": _id(head["WARC-Record-ID"]), "payload_bytes": n, "payload_digest": digest, "record_type": kind, "refers_to": _id(refers) if refers else None, "url": head.get("WARC-Target-URI")}


def read_archives(spark: SparkSession, paths: DataFrame, folder: str) -> DataFrame:
    """All records of the archives in column ``path``: the footers give the frames, which are dealt out evenly and read."""

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with where.open_input_file(path) as source:
                    rows = [(path, *f) for f in frames_of(source)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], ["path", "offset", "packed", "plain", "checksum"])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, offset, packed, size, check in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with where.open_input_file(path) as source:
                    plain = read_frame(source, offset, packed, size, check)
                yield pa.RecordBatch.from_pylist([_row(head, payload) for _, head, payload in parsed(plain)], _RECORD)

    frames = paths.select("path").mapInArrow(footers, "path string, offset long, packed long, plain long, checksum long")
    frames = written(frames, scratch_path(spark, "frames"))
    parts = max(1, min(frames.count() // 4, 100_000), spark.sparkContext.defaultParallelism)
    return frames.repartition(parts).mapInArrow(records, RECORD)


def fetch(index: DataFrame, folder: str) -> DataFrame:
    """``page_id`` and ``payload`` (binary; null for revisits) of the records of some index rows, each by its frame and offset."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            rows = []
            for path, frame, at in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                with where.open_input_file(path) as source:
                    _, head, payload = next(parsed(read_frame(source, *frames_of(source)[frame]), at))
                rows.append({"page_id": _id(head["WARC-Record-ID"]), "payload": payload if head["WARC-Type"] == "response" else None})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("page_id", pa.int64()), ("payload", pa.binary())]))

    return index.select("path", "frame", "at").mapInArrow(work, "page_id long, payload binary")


def round_trip(pages: DataFrame, folder: str) -> DataFrame:
    """Write all pages to archives and read them back: ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``, ``url``.

    Every input row gives one row; an empty table gives none. Columns but page_id, url and html are not read.
    """
    spark = pages.sparkSession
    index = written(write_archives(pages, folder), scratch_path(spark, "index"))
    return read_archives(spark, index.select("path").distinct(), folder)
