"""Operator 13: WARC records in ZIP packages, read back by ranges.

``write_packages`` writes each row as a WARC record (a gzip member of its own) into packages: ZIP files whose members
are stored, not deflated, so that bytes inside them can be read where they lie:

    archive/data.warc.gz     the records
    indexes/index.cdxj       one line a record: its place and length in the archive member, and what it is
    datapackage.json         sizes and digests of the two

Of rows with equal payloads of at least ``least_bytes`` the one with the largest id is a ``response`` record, and the
others are ``revisit`` records, which hold the headers and the digest but no payload; smaller ones are all responses.
A row without an id ranks below all others. Rows that share the largest id are responses all; payloads that only rows
without an id have, too. Null texts are empty payloads.

``read_packages`` never extracts a package. It reads the end of the file for the end-of-directory record (and the ZIP64
one, where a count or an offset passes the older fields), parses the central directory, takes from the local header where a
stored member's bytes begin, reads the index, and deals blocks of neighbouring records to tasks, which read just
those bytes. Every payload is checked against its digest. Packages of other writers work as well, if their archive
members are stored and an index names offsets and lengths.

Recovery: a task writes to a file name of its own attempt, and the written manifest (Parquet, under Spark's
commit protocol) names the files of the attempts that count; other files are never read. Files are opened through Arrow's file
systems, by the path's scheme, so any shared folder will do.

An empty table gives an empty manifest and no record. Other columns of the input are left alone; rows out have their own.
"""

from __future__ import annotations

import base64
import datetime as dt
import gzip
import hashlib
import io
import json
import math
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import release, ship, slices

ARCHIVE, INDEX, ABOUT = "archive/data.warc.gz", "indexes/index.cdxj", "datapackage.json"
LEAST_BYTES = 1000
PACKAGE_BYTES = 64 << 20
BLOCK_BYTES = 4 << 20  # records read at once
TASK_BYTES = 16 << 20  # of packages, for each reading task
SALTS = 16
MANIFEST = "package string, bytes long, records long"
BLOCKS = "package string, start long, lengths array<long>"
RECORDS = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, "
           "package string, start long, length long")

# --- fixed values: the formats' signatures, sizes and names ---
END, END64, LOCATOR, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
END_FIELDS = struct.Struct("<4s4H2LH")
LOCATOR_FIELDS = struct.Struct("<4sLQL")
END64_FIELDS = struct.Struct("<4sQ2H2L4Q")
ENTRY_FIELDS = struct.Struct("<4s6H3L5H2L")
LOCAL_FIELDS = struct.Struct("<4s5H3L2H")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# --- end of fixed values ---


def open_for_reading(path: str):
    system, inner = file_system(path)
    return system.open_input_file(inner)


def file_system(path: str):
    """Arrow's file system for a path's scheme, and the path within it."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


# ---- WARC records ----

def _header(name: str, value: object) -> str:
    return f"{name}: {str(value).translate({i: f'%{i:02X}' for i in (*range(32), 127)})}\r\n"


def warc_record(fields: dict[str, object], block: bytes) -> bytes:
    """A record of version 1.1 as a gzip member; fields that are None are left out."""
    head = "WARC/1.1\r\n" + "".join(_header(k, v) for k, v in fields.items() if v is not None)
    raw = b"".join((head.encode(), f"Content-Length: {len(block)}\r\n\r\n".encode(), block, b"\r\n\r\n"))
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def labelled_digest(hexadecimal: str) -> str:
    """A SHA-1 the way WARC headers write it: base 32, with its algorithm."""
    return "sha1:" + base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def bare_digest(labelled: str) -> str:
    """The lower-case hexadecimal digits of a labelled SHA-1 (in base 32 or base 16)."""
    value = labelled.partition(":")[2]
    return value.lower() if len(value) == 40 else base64.b32decode(value.upper()).hex()


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    fields = {
        "WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": date,
        "WARC-Target-URI": url, "Content-Type": "application/http;msgtype=response", "WARC-Payload-Digest": labelled_digest(digest),
        "Page-ID": page_id, "WARC-Profile": REVISIT_PROFILE if revisit else None, "Refers-To-Page-ID": refers_to}
    return warc_record(fields, http if revisit else http + payload)


class Record(NamedTuple):
    fields: dict[str, str]  # names in lower case
    block: bytes

    def http(self) -> tuple[dict[str, str], bytes]:
        """The headers and the body of an HTTP message."""
        head, _, body = self.block.partition(b"\r\n\r\n")
        return _fields(head.decode("utf-8", "replace").split("\r\n")[1:]), body


def _fields(lines: list[str]) -> dict[str, str]:
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines if line)}


def parse_record(raw: bytes) -> Record:
    """One record, packed with gzip or not."""
    if raw[:2] == b"\x1f\x8b":
        unpacker = zlib.decompressobj(31)
        raw = unpacker.decompress(raw) + unpacker.flush()
    head, found, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not found or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = _fields(lines[1:])
    length = int(fields["content-length"])
    if len(rest) < length:
        raise ValueError("a WARC record is cut short")
    return Record(fields, rest[:length])


def page_row(record: Record) -> tuple:
    """page_id, url, record_type, payload_bytes, payload_digest and refers_to of a response or a revisit."""
    fields, kind = record.fields, record.fields["warc-type"]
    headers, body = record.http()
    digest = bare_digest(fields["warc-payload-digest"])
    if kind == "response":
        size = len(body)
        if hashlib.sha1(body).hexdigest() != digest:
            raise ValueError(f"the payload of {fields.get('warc-record-id')} does not have its digest")
    else:  # a revisit keeps the headers of what it stands for
        size = int(headers["content-length"])
    number = lambda name: int(fields[name]) if name in fields else None
    return number("page-id"), fields.get("warc-target-uri"), kind, size, digest, number("refers-to-page-id")


# ---- writing ----

class Package:
    """A package being written to a stream; records go straight through, only index lines are held."""

    def __init__(self, stream, date: str):
        self.stream, self.date = stream, date
        self.zip = zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.archive = self.zip.open(self._info(ARCHIVE), "w", force_zip64=True)
        self.at, self.records, self.lines, self.digest = 0, 0, [], hashlib.sha256()
        self._put(warc_record({"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": date,
                               "Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n"))

    @staticmethod
    def _info(name: str) -> zipfile.ZipInfo:
        return zipfile.ZipInfo(name)  # stored, with a fixed time

    def _put(self, raw: bytes) -> int:
        start = self.at
        self.archive.write(raw)
        self.digest.update(raw)
        self.at += len(raw)
        return start

    def add(self, page_id, url, payload: bytes, digest: str, refers_to) -> None:
        raw = page_record(page_id, url, payload, digest, refers_to, self.date)
        start = self._put(raw)
        about = {"url": url, "digest": labelled_digest(digest), "mime": "warc/revisit" if refers_to is not None else "text/html",
                 "status": "200", "offset": start, "length": len(raw), "filename": ARCHIVE, "page": page_id}
        self.lines.append(f"{json.dumps(url or '')} {self.date.translate({ord(c): None for c in '-:TZ'})} {json.dumps(about)}\n")
        self.records += 1

    def close(self) -> None:
        self.archive.close()
        index = "".join(self.lines).encode()
        self.zip.writestr(self._info(INDEX), index)
        resources = [{"path": ARCHIVE, "bytes": self.at, "hash": f"sha256:{self.digest.hexdigest()}"},
                     {"path": INDEX, "bytes": len(index), "hash": f"sha256:{hashlib.sha256(index).hexdigest()}"}]
        self.zip.writestr(self._info(ABOUT), json.dumps({"profile": "data-package", "resources": resources}))
        self.zip.close()


def referring(df: DataFrame, id_col: str, url_col: str, html_col: str, least_bytes: int) -> DataFrame:
    """Rows with page_id, url, html, digest and refers_to (null for a response). Copies of one payload are spread over
    ``SALTS`` keys, to which only the payloads that occur more than once are copied."""
    html = F.coalesce(F.col(html_col), F.lit("")).cast("string")
    rows = df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumns({"digest": F.sha1(F.col("html").cast("binary")), "same": F.sha2(F.col("html").cast("binary"), 256)})
    copies = (rows.where(F.octet_length("html") >= least_bytes).groupBy("same").agg(F.max("page_id").alias("response"), F.count("*").alias("k"))
              .where("k > 1 and response is not null").select("same", "response"))
    copies = copies.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    found = salted.join(copies, ["same", "salt"], "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("response")), F.col("response"))
    return found.select("page_id", "url", "html", "digest", refers.alias("refers_to"))


def write_packages(df: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   least_bytes: int = LEAST_BYTES, package_bytes: int = PACKAGE_BYTES, date: str | None = None) -> DataFrame:
    """Write the packages into the folder ``path`` and return the stored manifest: package (its full path), bytes, records."""
    spark = ship(df.sparkSession)
    date = date or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        system, folder = file_system(f"{path}/packages")
        package = stream = name = None

        def finished() -> pa.RecordBatch:
            package.close()
            size = stream.tell()
            stream.close()
            return pa.RecordBatch.from_pydict({"package": [f"{path}/packages/{name}"], "bytes": pa.array([size], pa.int64()),
                                               "records": pa.array([package.records], pa.int64())})

        for batch in batches:
            for some in slices(batch):
                for page_id, url, html, digest, refers_to in zip(*(c.to_pylist() for c in some.columns)):
                    if package is None:
                        system.create_dir(folder, recursive=True)
                        name = f"pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.zip"
                        stream = system.open_output_stream(f"{folder}/{name}")
                        package = Package(stream, date)
                    package.add(page_id, url, html.encode(), digest, refers_to)
                    if package.at >= package_bytes:
                        yield finished()
                        package = None
        if package is not None:
            yield finished()

    referring(df, id_col, url_col, html_col, least_bytes).mapInArrow(write, MANIFEST).write.parquet(f"{path}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


# ---- reading ----

class Member(NamedTuple):
    name: str
    method: int
    packed: int
    size: int
    header: int  # where its local header stands
    flags: int


def read_directory(file, size: int) -> list[Member]:
    """The members of a ZIP file, from its end and its central directory alone."""
    tail_at = max(0, size - END_FIELDS.size - 0xFFFF)
    tail = file.read_at(size - tail_at, tail_at)
    at = tail.rfind(END)
    while at >= 0 and at + END_FIELDS.size + int.from_bytes(tail[at + 20:at + 22], "little") != len(tail):
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("no end of a ZIP directory")
    _, disk, first_disk, _, count, length, start, _ = END_FIELDS.unpack_from(tail, at)
    if 0xFFFF in (disk, first_disk, count) or 0xFFFFFFFF in (length, start):
        where = tail_at + at - LOCATOR_FIELDS.size
        mark, _, end64, disks = LOCATOR_FIELDS.unpack(file.read_at(LOCATOR_FIELDS.size, where)) if where >= 0 else (b"", 0, 0, 0)
        if mark == LOCATOR:
            fields = END64_FIELDS.unpack(file.read_at(END64_FIELDS.size, end64))
            if fields[0] != END64:
                raise ValueError("no ZIP64 end of directory where its locator points")
            disk, first_disk, count, length, start = fields[4], fields[5], fields[7], fields[8], fields[9]
    if disk or first_disk:
        raise ValueError("a ZIP file in several parts")
    raw, members, at = file.read_at(length, start), [], 0
    for _ in range(count):
        (mark, _, _, flags, method, _, _, _, packed, whole, name_length, extra_length, comment_length, _, _, _, header
         ) = ENTRY_FIELDS.unpack_from(raw, at)
        if mark != ENTRY:
            raise ValueError("a ZIP directory entry is damaged")
        at += ENTRY_FIELDS.size
        name, extra = raw[at:at + name_length], raw[at + name_length:at + name_length + extra_length]
        whole, packed, header = wide_fields(extra, whole, packed, header)
        members.append(Member(name.decode("utf-8" if flags & 0x800 else "cp437"), method, packed, whole, header, flags))
        at += name_length + extra_length + comment_length
    return members


def wide_fields(extra: bytes, *fields: int) -> list[int]:
    """Size, packed size and place of an entry; those that did not fit in 32 bits from its ZIP64 extra field."""
    out, at = list(fields), 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<2H", extra, at)
        if kind == 1:
            wide = at + 4
            for k, value in enumerate(out):
                if value == 0xFFFFFFFF:
                    out[k] = struct.unpack_from("<Q", extra, wide)[0]
                    wide += 8
        at += 4 + length
    return out


def data_start(file, member: Member) -> int:
    """Where the bytes of a stored member begin."""
    if member.method != 0 or member.flags & 1:
        raise ValueError(f"{member.name} is packed or encrypted, so no range of it can be read")
    fields = LOCAL_FIELDS.unpack(file.read_at(LOCAL_FIELDS.size, member.header))
    if fields[0] != LOCAL:
        raise ValueError(f"no local header of {member.name}")
    return member.header + LOCAL_FIELDS.size + fields[9] + fields[10]


def indexed_records(file, members: list[Member]) -> list[tuple[int, int]]:
    """Start in the file and length of every record that the package's indexes name, in their order in the file."""
    by_name = {m.name: m for m in members}
    starts: dict[str, int] = {}
    found = []
    for member in members:
        if not member.name.startswith("indexes/") or not member.name.endswith((".cdxj", ".cdx.gz")):
            continue
        raw = file.read_at(member.size, data_start(file, member))
        for line in (gzip.decompress(raw) if member.name.endswith(".gz") else raw).decode().splitlines():
            if "{" not in line:
                continue
            about = json.loads(line[line.rindex(" {") + 1:])
            name = about["filename"] if about["filename"] in by_name else f"archive/{about['filename']}"
            if name not in starts:
                starts[name] = data_start(file, by_name[name])
            offset, length = int(about["offset"]), int(about["length"])
            if offset + length > by_name[name].size:
                raise ValueError(f"the index names bytes behind the end of {name}")
            found.append((starts[name] + offset, length))
    return sorted(found)


def blocks(records: list[tuple[int, int]], most: int) -> Iterator[tuple[int, list[int]]]:
    """Neighbouring records together, up to ``most`` bytes (one record may be longer): start and lengths."""
    start, end, lengths = 0, -1, []
    for at, length in records:
        if lengths and (at != end or end + length - start > most):
            yield start, lengths
            lengths = []
        if not lengths:
            start = at
        lengths.append(length)
        end = at + length
    if lengths:
        yield start, lengths


def read_packages(spark: SparkSession, manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row per record of the packages that ``manifest`` names: what it says of its page, and where it lies; with
    its ``payload`` if asked for (null for a revisit)."""
    ship(spark)
    schema = RECORDS + (", payload binary" if with_payload else "")
    bytes_ = manifest.agg(F.sum("bytes")).first()[0] or 0  # one number
    tasks = max(1, math.ceil(bytes_ / TASK_BYTES))

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for package in batch.column(0).to_pylist():
                with open_for_reading(package) as file:
                    found = list(blocks(indexed_records(file, read_directory(file, file.size())), BLOCK_BYTES))
                for k in range(0, len(found), 256):
                    starts, lengths = zip(*found[k:k + 256])
                    yield pa.RecordBatch.from_arrays([pa.array([package] * len(starts)), pa.array(starts, pa.int64()),
                                                      pa.array(lengths, pa.list_(pa.int64()))], ["package", "start", "lengths"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        names = [c.split()[0] for c in schema.split(", ")]
        types = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]] for c in schema.split(", ")]
        for batch in batches:
            for package, start, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                with open_for_reading(package) as file:
                    raw = io.BytesIO(file.read_at(sum(lengths), start))
                rows = []
                for length in lengths:
                    record = parse_record(raw.read(length))
                    row = page_row(record) + (package, start, length)
                    if with_payload:
                        row += (record.http()[1] if row[2] == "response" else None,)
                    rows.append(row)
                    start += length
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    places = manifest.select("package").repartition(tasks, "package").mapInArrow(locate, BLOCKS)
    return places.repartition(tasks, "package", "start").mapInArrow(read, schema)
