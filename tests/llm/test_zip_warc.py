import gzip
import io
import zipfile

import pytest

from beneflow.llm import zip_warc as Z
from beneflow.session import shared_folder

SCHEMA = "page_id bigint, url string, html string, payload string, sha1 int"
ROWS = [
    (5, "http://a/ b\r\nX: y", "same é", "x", 1), (2, None, "same é", None, None), (9, "http://c", "same é", None, None),
    (None, "http://n", "same é", None, None), (1, "http://e", None, None, None), (3, "http://e", "", None, None),
    (7, "http://f", "own\r\n\r\nWARC/1.1\r\n", None, None), (2, None, "same é", None, None),
    (8, "http://g", "x" * 3_000_000, None, None), (None, None, "only without an id", None, None),
    (2, "http://h", "another page under id 2", None, None),
]


def expected(rows, min_bytes=0):
    out = []
    for page_id, _, html, *_ in rows:
        payload = (html or "").encode()
        ids = [r[0] for r in rows if (r[2] or "").encode() == payload and r[0] is not None]
        first = min(ids, default=None)
        revisit = len(payload) >= min_bytes and first is not None and (page_id is None or page_id > first)
        out.append((page_id, len(payload), Z.base32_sha1(payload), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize(("min_bytes", "package_bytes"), [(0, 32 << 20), (4, 200)])
def test_round_trip(spark, min_bytes, package_bytes):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    folder = shared_folder(spark, "packages-test")
    manifest = Z.write_packages(df, folder, min_bytes=min_bytes, package_bytes=package_bytes)
    rows = Z.read_packages(manifest, payloads=True).collect()
    assert sorted((tuple(r)[:5] for r in rows), key=str) == expected(ROWS, min_bytes)
    texts = {Z.base32_sha1((r[2] or "").encode()): (r[2] or "").encode() for r in ROWS}
    assert all((r.payload is None) == (r.record_type == "revisit") for r in rows)
    assert all(bytes(r.payload) == texts[r.payload_digest] for r in rows if r.payload is not None)
    # Any other reader of these formats agrees.
    paths = [r.path for r in manifest.collect()]
    assert len(paths) > 3 if package_bytes == 200 else len(paths) <= 3
    with zipfile.ZipFile(paths[0]) as package:
        assert package.testzip() is None
        assert {i.compress_type for i in package.infolist()} == {zipfile.ZIP_STORED}
        assert gzip.decompress(package.read(Z.DATA)).startswith(b"WARC/1.1\r\n")


def test_empty_table(spark):
    assert Z.round_trip(spark.createDataFrame([], SCHEMA)).collect() == []


class Far(io.BytesIO):
    """A file whose first 5 GiB are a hole, without holding them."""

    shift = 5 << 30

    def __init__(self, data):
        super().__init__(data)
        self.reads = []

    def seek(self, at, whence=0):
        self.at = at
        return super().seek(max(at - self.shift, 0), whence)

    def read(self, n=-1):
        assert self.at >= self.shift or n == 0
        self.reads.append(n)
        return super().read(n)


def package(records, index=True, comment=b""):
    file = io.BytesIO()
    with zipfile.ZipFile(file, "w", zipfile.ZIP_STORED) as out:
        out.comment = comment
        out.writestr("notes.txt", "x" * 100, zipfile.ZIP_DEFLATED)
        at, lines, data = 0, [], b""
        for r in records:
            member = gzip.compress(r)
            lines.append('{"offset": %d, "length": %d}' % (at, len(member)))
            data, at = data + member, at + len(member)
        with out.open(zipfile.ZipInfo(Z.DATA), "w", force_zip64=True) as member:
            member.write(data)
        if index:
            out.writestr(Z.INDEX, "\n".join(lines) + "\n")
    return file.getvalue()


RECORDS = [Z.make_record(i, f"http://{i}", b"x" * i * 300_000, None if i % 3 else 1) for i in range(8)]


@pytest.mark.parametrize("index", [True, False])
@pytest.mark.parametrize("comment", [b"", b"a comment with PK\x05\x06 and more than twenty-two bytes in it"])
def test_reader(index, comment):
    raw = package(RECORDS, index, comment)
    found = list(Z.package_records(io.BytesIO(raw), len(raw)))
    assert [(r.page_id, r.payload_bytes, r.record_type) for r in found] == [
        (i, i * 300_000, "response" if i % 3 else "revisit") for i in range(8)
    ]


def test_zip64_directory_beyond_4_gib():
    """The same package moved by 5 GiB: every place in the directory is kept in ZIP64 fields."""
    import struct

    raw = package(RECORDS)
    members = Z.directory(io.BytesIO(raw), len(raw))
    start = struct.unpack_from("<I", raw, len(raw) - 6)[0]
    entries = b""
    for m in members:
        name = m.name.encode()
        extra = struct.pack("<HHQQQ", 1, 24, m.size, m.stored_size, m.header + Far.shift)
        entries += struct.pack("<4s6H3I5H2I", Z.ENTRY, 45, 45, 0, m.method, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name),
                               len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    at = Far.shift + start
    end64 = struct.pack("<4sQHHIIQQQQ", Z.END64, 44, 45, 45, 0, 0, len(members), len(members), len(entries), at)
    locator = struct.pack("<4sIQI", Z.LOCATOR, 0, at + len(entries), 1)
    end = struct.pack("<4s4H2IH", Z.END, 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    far = Far(raw[:start] + entries + end64 + locator + end)
    size = Far.shift + len(far.getvalue())
    Z.MOST_COMMENT, most = 0, Z.MOST_COMMENT
    try:
        found = list(Z.package_records(far, size))
    finally:
        Z.MOST_COMMENT = most
    assert [r.page_id for r in found] == list(range(8))
    # Only ranges were read, and none of the member that is not an archive.
    assert sum(far.reads) < len(raw) + 2000


@pytest.mark.parametrize("raw", [b"", b"not a package", package(RECORDS)[:-30]])
def test_damaged(raw):
    with pytest.raises(ValueError):
        list(Z.package_records(io.BytesIO(raw), len(raw)))


def test_compressed_member_is_refused():
    file = io.BytesIO()
    with zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as out:
        out.writestr(Z.DATA, b"x" * 1000)
    with pytest.raises(ValueError, match="not stored"):
        list(Z.package_records(file, len(file.getvalue())))
