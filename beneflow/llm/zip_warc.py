"""WARC records in ZIP packages: written by tasks, read back by byte ranges without extraction.

A package is a ZIP file with stored (uncompressed) members: ``archive/data.warc.gz``, in which every record
is a gzip member of its own, and ``indexes/index.cdxj``, a line with place and length for each record. The
reader finds the directory from the file's end (ZIP64 included), reads the members' places from it, and
then only the index and the ranges of records, neighbouring ones together. A package without an index is
read through from its first record.

Packages are written below a folder that all executors share, under a name with the task's attempt in it.
Which of them count is said by the manifest, a table Spark commits; files of lost or repeated attempts are
never read. Folders are opened with ``pyarrow.fs``, so local paths and object stores it knows can be used.

Payloads that occur more than once are stored once, in a ``response`` record under the smallest page id;
the others are ``revisit`` records, with the length and digest of the full payload. Pages are compared by
SHA-1 and length.

Defined results: a null html is an empty payload. A null page id comes after all others, so it is a
response only if no page with an id has its payload. Rows that repeat a page's id and payload are all what
the first of them is. A null url is named after the page.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beneflow.llm.frames import Steps, record_batch, stored
from beneflow.session import shared_folder

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PACKAGE_BYTES = 32 << 20
READ_BYTES = 1 << 20
DATE = "2026-01-01T00:00:00Z"
MOST_READERS = 20_000

# Fixed values of the ZIP format: signatures, sizes of fixed parts, marks for a value kept elsewhere.
END, END64, LOCATOR, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
END_SIZE, END64_SIZE, LOCATOR_SIZE, ENTRY_SIZE, LOCAL_SIZE = 22, 56, 20, 46, 30
MOST_COMMENT = 0xFFFF
IN_EXTRA, ZIP64_EXTRA = 0xFFFFFFFF, 1


# --- records --------------------------------------------------------------------------------


def record_name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """A response, or a revisit if ``refers_to`` is given, with its HTTP head."""
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else record_name(page_id)[1:-1]
    body = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_name(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
    ]
    if refers_to is None:
        body += payload
    else:
        head += [
            f"WARC-Refers-To: {record_name(refers_to)}",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _head(raw: bytes, at: int) -> tuple[dict[str, str], int]:
    """Named fields from ``at`` on, and where what follows them begins."""
    end = raw.index(b"\r\n\r\n", at)
    lines = raw[at:end].decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}, end + 4


@dataclass
class Record:
    page_id: int | None
    record_type: str
    payload_bytes: int
    payload_digest: str
    refers_to: int | None
    payload: bytes | None


def parse_record(raw: bytes) -> Record:
    fields, start = _head(raw, 0)
    block = raw[start : start + int(fields["content-length"])]
    http, body = _head(block, 0)
    kind, length = fields["warc-type"], int(http["content-length"])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    payload = None
    if kind == "response":
        payload = block[body:]
        if len(payload) != length or base32_sha1(payload) != digest:
            raise ValueError(f"record {fields['warc-record-id']} does not hold what its head says")
    return Record(
        page_of(fields["warc-record-id"]), kind, length, digest, page_of(fields.get("warc-refers-to")), payload
    )


# --- the package reader ---------------------------------------------------------------------


@dataclass
class Member:
    name: str
    method: int
    encrypted: bool
    size: int
    stored_size: int
    header: int  # place of its local header


def _range(file, start: int, length: int) -> bytes:
    file.seek(start)
    data = file.read(length)
    if len(data) != length:
        raise ValueError("the package is cut short")
    return data


def directory(file, size: int) -> list[Member]:
    """Members by the central directory at the end of the file, of either format."""
    tail_at = max(0, size - END_SIZE - MOST_COMMENT)
    tail = _range(file, tail_at, size - tail_at)
    at = tail.rfind(END)
    # The signature can also stand in the comment: the right one is followed by just its comment.
    while at >= 0 and (len(tail) - at < END_SIZE or at + END_SIZE + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("not a ZIP package")
    entries, length, start = struct.unpack_from("<HII", tail, at + 10)
    end = tail_at + at
    if end >= LOCATOR_SIZE and (locator := _range(file, end - LOCATOR_SIZE, LOCATOR_SIZE)).startswith(LOCATOR):
        (end,) = struct.unpack_from("<Q", locator, 8)
        record = _range(file, end, END64_SIZE)
        if not record.startswith(END64):
            raise ValueError("no ZIP64 directory where its locator points")
        entries, length, start = struct.unpack_from("<QQQ", record, 32)
    raw, at, out = _range(file, start, length), 0, []
    for _ in range(entries):
        if raw[at : at + 4] != ENTRY:
            raise ValueError("the package's directory is damaged")
        flags, method = struct.unpack_from("<HH", raw, at + 8)
        small, full, name_length, extra_length, comment_length = struct.unpack_from("<IIHHH", raw, at + 20)
        (header,) = struct.unpack_from("<I", raw, at + 42)
        name_at = at + ENTRY_SIZE
        name = raw[name_at : name_at + name_length].decode("utf-8" if flags & 0x800 else "cp437")
        extra = raw[name_at + name_length : name_at + name_length + extra_length]
        full, small, header = _from_extra(extra, [full, small, header])
        out.append(Member(name, method, bool(flags & 1), full, small, header))
        at = name_at + name_length + extra_length + comment_length
    return out


def _from_extra(extra: bytes, values: list[int]) -> list[int]:
    """Values too large for the entry stand in the ZIP64 field, in this order."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == ZIP64_EXTRA:
            place = at + 4
            for i, value in enumerate(values):
                if value == IN_EXTRA:
                    (values[i],) = struct.unpack_from("<Q", extra, place)
                    place += 8
        at += 4 + length
    return values


def data_start(file, member: Member) -> int:
    """Where a stored member's bytes begin; the local header's own name and extra field count."""
    if member.method != zipfile.ZIP_STORED or member.encrypted:
        raise ValueError(f"{member.name} is not stored as it is")
    header = _range(file, member.header, LOCAL_SIZE)
    if not header.startswith(LOCAL):
        raise ValueError(f"no member {member.name} where the directory points")
    return member.header + LOCAL_SIZE + sum(struct.unpack_from("<HH", header, 26))


def _lines(file, start: int, size: int) -> Iterator[bytes]:
    rest = b""
    for at in range(0, size, READ_BYTES):
        *lines, rest = (rest + _range(file, start + at, min(READ_BYTES, size - at))).split(b"\n")
        yield from lines
    if rest:
        yield rest


def indexed_records(file, data_at: int, index_at: int, index_size: int) -> Iterator[bytes]:
    """Records at the ranges the index names; neighbouring ranges are read at once."""
    waiting: list[tuple[int, int]] = []

    def read() -> Iterator[bytes]:
        first, (last, length) = waiting[0][0], waiting[-1]
        data = _range(file, data_at + first, last + length - first)
        for offset, length in waiting:
            yield gzip.decompress(data[offset - first : offset - first + length])

    for line in _lines(file, index_at, index_size):
        entry = json.loads(line)
        place, length = entry["offset"], entry["length"]
        if waiting and (place != sum(waiting[-1]) or place + length - waiting[0][0] > READ_BYTES):
            yield from read()
            waiting.clear()
        waiting.append((place, length))
    if waiting:
        yield from read()


def scanned_records(file, start: int, size: int) -> Iterator[bytes]:
    """All gzip members one after another, without an index."""
    inflate, record, at, rest = zlib.decompressobj(31), [], 0, b""
    while at < size or rest:
        if not rest:
            rest = _range(file, start + at, min(READ_BYTES, size - at))
            at += len(rest)
        record.append(inflate.decompress(rest))
        rest = inflate.unused_data
        if inflate.eof:
            yield b"".join(record)
            inflate, record = zlib.decompressobj(31), []


def package_records(file, size: int) -> Iterator[Record]:
    members = {m.name: m for m in directory(file, size)}
    index = members.get(INDEX)
    for name, member in members.items():
        if not name.startswith("archive/"):
            continue
        start = data_start(file, member)
        if index is not None and name == DATA:
            raw = indexed_records(file, start, data_start(file, index), index.size)
        else:
            raw = scanned_records(file, start, member.size)
        yield from map(parse_record, raw)


# --- writing and reading with Spark -----------------------------------------------------------


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", uri))


class Package:
    """A package being written: records straight to the file, the index when it is closed."""

    def __init__(self, store: fs.FileSystem, path: str):
        self.file = store.open_output_stream(path)
        self.package = zipfile.ZipFile(self.file, "w", zipfile.ZIP_STORED)
        self.data = self.package.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.size, self.lines = 0, []

    def add(self, page_id: int | None, record: bytes) -> None:
        member = gzip.compress(record, 6, mtime=0)
        self.data.write(member)
        self.lines.append(json.dumps({"id": record_name(page_id), "offset": self.size, "length": len(member)}))
        self.size += len(member)

    def close(self) -> int:
        self.data.close()
        self.package.writestr(zipfile.ZipInfo(INDEX), "\n".join(self.lines))
        self.package.close()
        self.file.close()
        return len(self.lines)


def with_first_pages(
    pages: DataFrame, page_id: str, url: str, html: str, min_bytes: int, steps: Steps
) -> DataFrame:
    """(page_id, url, payload, refers_to): pages whose payload another page stores refer to that page."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"), F.col(url).alias("url"), payload.alias("payload"),
        F.sha1(payload).alias("sha1"),
    )
    # Narrow, so that the two joins by digest and page never carry payloads but once.
    digests = steps.keep(rows.select("page_id", "sha1", F.octet_length("payload").alias("bytes")), "digests")
    firsts = steps.keep(
        digests.where(F.col("bytes") >= min_bytes).groupBy("sha1", "bytes").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where(F.col("n") > 1).drop("n"), "first-pages",
    )
    later = F.col("page_id").isNull() | (F.col("page_id") > F.col("first"))
    refers = steps.keep(
        digests.join(firsts, ["sha1", "bytes"]).where(F.col("first").isNotNull() & later)
        .select(F.col("page_id").alias("id"), F.col("sha1").alias("digest"), F.col("first").alias("refers_to")).distinct(),
        "revisits",
    )
    same = F.col("page_id").eqNullSafe(F.col("id")) & (F.col("sha1") == F.col("digest"))
    return rows.join(refers, same, "left").select("page_id", "url", "payload", "refers_to")


def write_packages(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_bytes: int = 0,
    package_bytes: int = PACKAGE_BYTES,
) -> DataFrame:
    """Writes every page into packages below ``folder``; the manifest (path, records).

    Payloads shorter than ``min_bytes`` are never revisited.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_folder(folder)
        store.create_dir(root, recursive=True)
        context = TaskContext.get()
        open_one, number = None, 0

        def done() -> pa.RecordBatch:
            return record_batch(path=[path], records=[open_one.close()])

        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "refers_to")), strict=True):
                own, target, payload, refers_to = (x.as_py() for x in row)
                if open_one is None:
                    name = f"pages-{context.partitionId():06d}-{context.taskAttemptId()}-{number}.wacz"
                    path, number = f"{folder}/{name}", number + 1
                    open_one = Package(store, f"{root}/{name}")
                open_one.add(own, make_record(own, target, payload, refers_to))
                if open_one.size >= package_bytes:
                    yield done()
                    open_one = None
        if open_one is not None:
            yield done()

    steps = Steps(pages.sparkSession, "zip-warc")
    rows = with_first_pages(pages, page_id, url, html, min_bytes, steps)
    manifest = stored(rows.mapInArrow(run, "path string, records bigint"), "manifest")
    steps.drop()
    return manifest


READ_SCHEMA = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def read_packages(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """One row for each record of the packages at ``path``; with ``payloads`` also the stored payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, inner = open_folder(path)
                with store.open_input_file(inner) as file:
                    waiting, held = [], 0
                    for record in package_records(file, file.size()):
                        waiting.append(record)
                        held += 100 + (len(record.payload or b"") if payloads else 0)
                        if not payloads:
                            record.payload = None
                        if held >= 4 * READ_BYTES:
                            yield rows(waiting)
                            waiting, held = [], 0
                    if waiting:
                        yield rows(waiting)

    def rows(records: list[Record]) -> pa.RecordBatch:
        columns = {
            "page_id": pa.array([r.page_id for r in records], pa.int64()),
            "payload_bytes": pa.array([r.payload_bytes for r in records], pa.int64()),
            "payload_digest": pa.array([r.payload_digest for r in records], pa.string()),
            "record_type": pa.array([r.record_type for r in records], pa.string()),
            "refers_to": pa.array([r.refers_to for r in records], pa.int64()),
        }
        if payloads:
            columns["payload"] = pa.array([r.payload for r in records], pa.binary())
        return record_batch(**columns)

    readers = min(max(manifest.count(), 1), MOST_READERS)
    schema = READ_SCHEMA + (", payload binary" if payloads else "")
    return manifest.select("path").repartition(readers).mapInArrow(run, schema)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Pages written to packages in the shared folder and read back."""
    folder = shared_folder(pages.sparkSession, "packages")
    return read_packages(write_packages(pages, folder, **options))
