"""WARC packages: round trips, ZIP64 directories, foreign packages, and rows of attempts that do not count."""

import gzip
import hashlib
import io
import json
import zipfile

import pytest

from tillstar.llm import warc_packages as W
from tillstar.llm.common import shared_path

LONG = "ä" * 600  # 1,200 bytes
PAGES = [(1, "http://a/", LONG), (2, "http://b/\r\nx: y", LONG), (3, None, LONG), (4, "http://c/", "short"), (5, "http://d/", "short"),
         (6, "http://e/", None), (7, "http://e/", ""), (8, "http://f/", "x" * 999), (9, "http://f/", "x" * 999), (10, "http://g/", "x" * 1000),
         (11, "http://g/", "x" * 1000), (None, "http://h/", LONG), (None, "http://h/", "only without ids " * 90), (None, None, "only without ids " * 90),
         (12, "http://i/", "y" * 2000), (12, "http://i/", "y" * 2000), (13, "http://j/", "\r\n\r\nWARC/1.1\r\n\x00" * 200)]


def want(pages):
    out = []
    for page_id, _, html in pages:
        raw = (html or "").encode()
        last = max((i for i, _, h in pages if h == html and i is not None), default=None) if len(raw) >= 1000 else None
        revisit = last is not None and page_id != last
        out.append((page_id, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", last if revisit else None))
    return sorted(out, key=str)


def frame(spark, pages=PAGES):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    return df.withColumns({c: F.lit("x") for c in ("digest", "same", "salt", "response", "refers_to", "package", "bytes")})


def read(spark, manifest):
    rows = W.read_packages(spark, manifest, with_payload=True).collect()
    return rows, sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows), key=str)


@pytest.mark.parametrize("package_bytes", [1, 3000, 64 << 20])
def test_round_trip(spark, package_bytes):
    manifest = W.write_packages(frame(spark), shared_path(spark, "warc-test"), package_bytes=package_bytes)
    rows, found = read(spark, manifest)
    assert found == want(PAGES)
    payloads = {r["page_id"]: r["payload"] for r in rows if r["record_type"] == "response" and r["page_id"] is not None}
    assert payloads == {i: bytearray((h or "").encode()) for i, _, h in PAGES if i in payloads}
    assert manifest.count() == (len(PAGES) if package_bytes == 1 else manifest.count()) and sum(r["records"] for r in manifest.collect()) == len(PAGES)
    assert {r["url"] for r in rows} == {None if u is None else u.replace("\r\n", "%0D%0A") for _, u, _ in PAGES}


def test_empty_table(spark):
    manifest = W.write_packages(frame(spark, PAGES[:1]).where("false"), shared_path(spark, "warc-test"))
    assert read(spark, manifest) == ([], [])


def test_files_outside_the_manifest_are_not_read(spark):
    path = shared_path(spark, "warc-test")
    manifest = W.write_packages(frame(spark), path)
    folder = path.removeprefix("file:") + "/packages"
    with open(f"{folder}/pages-000000-lost.zip", "wb") as f:  # what a task that died leaves
        f.write(b"PK half a package")
    assert read(spark, manifest)[1] == want(PAGES)


def test_packages_are_plain_zip_and_gzip_files(spark):
    manifest = W.write_packages(frame(spark), shared_path(spark, "warc-test"))
    for row in manifest.collect():
        with zipfile.ZipFile(row["package"].removeprefix("file:")) as z:
            assert z.testzip() is None and {i.compress_type for i in z.infolist()} == {zipfile.ZIP_STORED}
            raw = gzip.decompress(z.read(W.ARCHIVE))
            assert raw.count(b"WARC-Type: re") == row["records"]
            about = json.loads(z.read(W.ABOUT))["resources"]
            assert [r["hash"] for r in about] == [f"sha256:{hashlib.sha256(z.read(r['path'])).hexdigest()}" for r in about]


class Ranges:
    """read_at over bytes, keeping what was asked for."""

    def __init__(self, raw):
        self.raw, self.asked = raw, []

    def read_at(self, n, at):
        self.asked.append((at, n))
        return self.raw[at:at + n]


def test_zip64_directories(monkeypatch):
    many = io.BytesIO()
    with zipfile.ZipFile(many, "w") as z:
        for k in range(66_000):  # more than the older count holds
            z.writestr(zipfile.ZipInfo(f"m{k}"), b"")
        z.writestr(zipfile.ZipInfo("archive/last"), b"here")
    raw = many.getvalue()
    file = Ranges(raw)
    members = W.read_directory(file, len(raw))
    assert len(members) == 66_001
    at = W.data_start(file, members[-1])
    assert raw[at:at + members[-1].size] == b"here"

    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)  # sizes and places go to the extra field
    wide = io.BytesIO()
    with zipfile.ZipFile(wide, "w") as z:
        z.writestr(zipfile.ZipInfo("a"), b"x" * 300)
        z.writestr(zipfile.ZipInfo("archive/b"), b"y" * 301)
        z.comment = b"a comment with PK\x05\x06 in it"
    raw = wide.getvalue()
    members = W.read_directory(Ranges(raw), len(raw))
    assert [(m.name, m.size) for m in members] == [("a", 300), ("archive/b", 301)]
    at = W.data_start(Ranges(raw), members[1])
    assert raw[at:at + 301] == b"y" * 301


def test_only_the_ends_and_the_named_ranges_are_read():
    big = io.BytesIO()
    with zipfile.ZipFile(big, "w") as z:
        z.writestr(zipfile.ZipInfo("archive/data.warc.gz"), b"z" * 5_000_000)
        z.writestr(zipfile.ZipInfo("indexes/index.cdxj"), b'com,a)/ 2024 {"filename": "data.warc.gz", "offset": "1000", "length": "50"}\n')
    file = Ranges(big.getvalue())
    members = W.read_directory(file, len(file.raw))
    (start, length), = W.indexed_records(file, members)
    assert file.raw[start:start + length] == b"z" * 50 and sum(n for _, n in file.asked) < 100_000
    assert W.data_start(file, members[0]) + 1000 == start


def test_damaged_and_packed_packages_are_errors():
    with pytest.raises(ValueError):
        W.read_directory(Ranges(b"no zip file at all"), 18)
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/data.warc.gz", b"z" * 1000)
    members = W.read_directory(Ranges(packed.getvalue()), len(packed.getvalue()))
    with pytest.raises(ValueError):
        W.data_start(Ranges(packed.getvalue()), members[0])
    record = W.page_record(1, "http://a/", b"payload", hashlib.sha1(b"another").hexdigest(), None, "2024-01-01T00:00:00Z")
    with pytest.raises(ValueError):
        W.page_row(W.parse_record(record))


def test_blocks_hold_neighbours_only():
    assert list(W.blocks([(0, 5), (5, 5), (20, 5), (25, 100), (125, 1)], 12)) == [(0, [5, 5]), (20, [5]), (25, [100]), (125, [1])]
    assert list(W.blocks([], 12)) == []


def test_digests_in_both_notations():
    digest = hashlib.sha1(b"x").hexdigest()
    assert W.bare_digest(W.labelled_digest(digest)) == digest == W.bare_digest(f"sha1:{digest.upper()}")
