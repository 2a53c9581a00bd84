"""WARC records in ZIP-packaged archives: written by tasks, read back by byte ranges."""

from __future__ import annotations

import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bellwire.session import scratch_path, small_side, stored

# Smaller payloads are never written as revisits.
LEAST_REVISIT = 1000
# Payload bytes after which a task begins a new archive.
ARCHIVE_BYTES = 128 << 20
# Bytes of records that one task reads, and neighbouring bytes that stay together.
READ_BYTES, PART_BYTES = 64 << 20, 1 << 20
DATE = "1970-01-01T00:00:00Z"

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"

# Fixed values of the ZIP format.
END, END64, LOCATOR64 = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
ENTRY, LOCAL = b"PK\x01\x02", b"PK\x03\x04"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


def filesystem(uri: str):
    """A file system for any store that Arrow knows, and the path in it."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


# --- reading ----------------------------------------------------------------


def _zip64(extra: bytes, fields: list[int]) -> list[int]:
    """``fields`` with those that are full replaced from the ZIP64 extra field, in its order."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            values = iter(struct.unpack_from(f"<{size // 8}Q", extra, at + 4))
            return [next(values) if f == FULL32 else f for f in fields]
        at += 4 + size
    return fields


def central_directory(file) -> dict[str, tuple[int, int]]:
    """Stored members of a ZIP file by name: where their local header stands, and their size.

    ``file`` is read from its end and at its directory only. Archives with ZIP64 records are
    followed; a compressed or encrypted member raises.
    """
    file.seek(0, io.SEEK_END)
    length = file.tell()
    tail_at = max(0, length - 65_557)
    file.seek(tail_at)
    tail = file.read(length - tail_at)
    end = tail.rfind(END)
    if end < 0:
        raise ValueError("not a ZIP archive")
    count, size, start = struct.unpack_from("<HII", tail, end + 10)
    if FULL16 in (count,) or FULL32 in (size, start):
        locator = tail[end - 20 : end]
        if locator[:4] != LOCATOR64:
            raise ValueError("the ZIP64 locator is missing")
        file.seek(struct.unpack_from("<Q", locator, 8)[0])
        record = file.read(56)
        if record[:4] != END64:
            raise ValueError("the ZIP64 end record is missing")
        count, size, start = struct.unpack_from("<QQQ", record, 32)
    file.seek(start)
    directory = file.read(size)
    members, at = {}, 0
    for _ in range(count):
        if directory[at : at + 4] != ENTRY:
            raise ValueError("a damaged ZIP directory")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", directory, at + 20)
        header = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46 : at + 46 + n_name].decode()
        extra = directory[at + 46 + n_name : at + 46 + n_name + n_extra]
        plain, packed, header = _zip64(extra, [plain, packed, header])
        if method or flags & 1 or plain != packed:
            raise ValueError(f"member {name} isn't stored")
        members[name] = (header, plain)
        at += 46 + n_name + n_extra + n_comment
    return members


def member_start(file, header: int) -> int:
    """Where a member's bytes begin, after its local header."""
    file.seek(header)
    local = file.read(30)
    if local[:4] != LOCAL:
        raise ValueError("a damaged local header")
    return header + 30 + sum(struct.unpack_from("<HH", local, 26))


def parse_record(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of one gzip member."""
    plain = zlib.decompress(raw, 31)
    head, _, rest = plain.partition(b"\r\n\r\n")
    headers = _fields(head)
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return headers, _fields(http), payload


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in head.decode().split("\r\n")[1:])
    return {p[0]: p[1].strip(" \t") for p in pairs if len(p) == 2}


def index_lines(file, start: int, size: int, step: int = 1 << 20) -> Iterator[dict]:
    """The index's entries, read block by block."""
    rest, at = b"", start
    while at < start + size:
        file.seek(at)
        block = file.read(min(step, start + size - at))
        at += len(block)
        *lines, rest = (rest + block).split(b"\n")
        yield from map(json.loads, filter(None, lines))


def read_archives(spark: SparkSession, archives: DataFrame) -> DataFrame:
    """All records of the archives (column ``archive``): one row per record, revisits too.

    First the indexes are read, then the records by their byte ranges, spread over tasks: a large
    archive is read by many of them, and nothing is extracted. ``payload`` is null for
    revisits; ``payload_bytes`` and ``payload_digest`` are checked against the bytes of responses.
    """

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch["archive"].to_pylist():
                system, path = filesystem(archive)
                with system.open_input_file(path) as file:
                    members = central_directory(file)
                    data = member_start(file, members[DATA][0])
                    header, size = members[INDEX]
                    rows: list[tuple] = []
                    for x in index_lines(file, member_start(file, header), size):
                        rows.append((archive, data + x["offset"], x["length"]))
                        if len(rows) == 10_000:
                            yield _ranges(rows)
                            rows = []
                    yield _ranges(rows)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, file = None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = []
                for x in batch.slice(at, 256).to_pylist():
                    if opened != x["archive"]:
                        system, path = filesystem(x["archive"])
                        opened, file = x["archive"], system.open_input_file(path)
                    file.seek(x["at"])
                    rows.append(_row(*parse_record(file.read(x["length"]))))
                yield pa.RecordBatch.from_pylist(rows, RECORD)

    ranges = stored(archives.select("archive").mapInArrow(entries, "archive string, at long, length long"), "warc-ranges")
    # The rows are short and the bytes they stand for are not, so tasks are counted by bytes.
    size = ranges.agg(F.sum("length")).first()[0] or 0
    tasks = int(max(spark.sparkContext.defaultParallelism, -(-size // READ_BYTES)))
    spread = ranges.repartition(tasks, "archive", F.floor(F.col("at") / PART_BYTES)).sortWithinPartitions("archive", "at")
    return spread.mapInArrow(
        records,
        "page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
        "record_type string, refers_to long",
    )


RECORD = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ]
)


def _ranges(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [("archive", pa.string()), ("at", pa.int64()), ("length", pa.int64())]
    return pa.RecordBatch.from_pylist([dict(zip(("archive", "at", "length"), r)) for r in rows], pa.schema(kinds))


def _row(headers: dict, http: dict, payload: bytes) -> dict:
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(http["Content-Length"])
    revisit = headers["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    return {
        "page_id": _page(headers.get("WARC-Record-ID")),
        "url": headers.get("WARC-Target-URI"),
        "payload": None if revisit else payload,
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": headers["WARC-Type"],
        "refers_to": _page(headers.get("WARC-Refers-To")),
    }


def _page(record_id: str | None) -> int | None:
    text = (record_id or "<urn:page:>").removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


# --- writing ----------------------------------------------------------------


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member of its own. A revisit keeps the HTTP head, without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {url.translate({10: '%0A', 13: '%0D'})}")
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{refers_to}>",
        ]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


class ArchiveWriter:
    """A ZIP file with a stored member of records and a stored index of them, written in one pass."""

    def __init__(self, path: str):
        self.path = path
        system, inner = filesystem(path)
        system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        self.out = system.open_output_stream(inner)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.index: list[str] = []
        self.size = 0

    def add(self, record: bytes, entry: dict) -> None:
        self.data.write(record)
        self.index.append(json.dumps(entry | {"offset": self.size, "length": len(record)}))
        self.size += len(record)

    def close(self) -> None:
        self.data.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "".join(x + "\n" for x in self.index))
        self.zip.close()
        self.out.close()


def write_archives(pages: DataFrame, folder: str, least: int = LEAST_REVISIT, limit: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes one record per row (``page_id, url, html``) below ``folder``; returns the archives.

    Of rows with equal payloads of ``least`` bytes or more, that with the largest id is written
    whole and the others as revisits of it. Every attempt of a task writes files of its own and
    reports them; only reports of finished attempts are stored, so a repeated task leaves no
    double records. ``folder`` must be shared by all machines.
    """
    full = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")
    ).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    long_ = F.octet_length("html") >= least
    # One row per payload that occurs more than once; page texts don't move for it.
    again = (
        full.where(long_)
        .groupBy("digest")
        .agg(F.count("*").alias("_n"), F.max("page_id").alias("_first"))
        .where("_n > 1 AND _first IS NOT NULL")
        .select(F.col("digest").alias("_digest"), "_first")
    )
    joined = full.join(small_side(again), F.col("digest") == F.col("_digest"), "left")
    revisit = F.col("_first").isNotNull() & long_ & ~F.col("page_id").eqNullSafe(F.col("_first"))
    rows = joined.select("page_id", "url", "html", "digest", F.when(revisit, F.col("_first")).alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt, archive, out, payloads = uuid.uuid4().hex, None, [], 0
        for batch in batches:
            for page_id, url, html, digest, refers_to in zip(*(batch[c] for c in batch.schema.names)):
                if archive is None:
                    archive = ArchiveWriter(f"{folder}/{attempt}-{len(out):05d}.wacz")
                payload = html.as_buffer().to_pybytes()
                target = refers_to.as_py()
                record = make_record(page_id.as_py(), url.as_py(), payload, digest.as_py(), target, target is not None)
                archive.add(record, {"page": page_id.as_py(), "url": url.as_py()})
                payloads += len(payload)
                if payloads >= limit:
                    archive.close()
                    out.append(archive.path)
                    archive, payloads = None, 0
        if archive is not None:
            archive.close()
            out.append(archive.path)
        yield pa.record_batch([pa.array(out, pa.string())], names=["archive"])

    return stored(rows.mapInArrow(write, "archive string"), "warc-list")


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages written to archives in the shared folder and read back: one row per record.

    A null html is an empty payload, a null url writes no target, a null id stays null (and never
    is revisited). Of rows that repeat the largest id with equal payloads, each is a response.
    """
    folder = scratch_path(pages.sparkSession, "warc")
    return read_archives(pages.sparkSession, write_archives(pages, folder))


def digest(records: DataFrame) -> DataFrame:
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
