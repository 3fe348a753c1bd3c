"""Multi-line CSV read in byte ranges (A1): one large file by many tasks.

A line end inside quotes does not end a record, so where a range's first record starts depends on whether the range begins inside
quotes, and that on all bytes before it. Two passes settle it without reading a file in order:

1. Every range counts its quote characters. Whether a range begins inside quotes is the parity of the counts before it: a
   running sum over the ranges of a file, one small row a range.
2. With its parity known, every range finds the records that begin in it (the last one may end behind it) and emits
   their text; the CSV expression of Spark parses each with the reader's own options.

A doubled quote keeps the parity, so escaped quotes are no exception. A quote that neither opens nor closes a field would
flip it; such a record is an error here (``csv.read_raw_csv`` reads such files, one task a file). Encodings must keep
ASCII bytes for themselves (Windows-1252, Latin-1, UTF-8). Each file's first record is its header and is left out; names come from
the first file, as in the reader. Blank lines are skipped. Files are opened through Arrow's file systems by the path's scheme.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, ship_package
from .csv import READ_OPTIONS, read_raw_csv

RANGE_BYTES = 32 << 20
BLOCK_BYTES = 1 << 20  # read at once
BATCH_BYTES = 4 << 20  # of records, sent at once
ASCII_BASED = {"windows-1252", "cp1252", "iso-8859-1", "latin-1", "utf-8"}
WELL_FORMED = re.compile(r'(?:"(?:[^"]|"")*+"|[^",]*+)(?:,(?:"(?:[^"]|"")*+"|[^",]*+))*+')


def open_file(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    system, inner = (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def lines_from(file, start: int, size: int) -> Iterator[tuple[int, bytes]]:
    """The lines from a byte on, as far as they are asked for: where each begins, and its bytes without the line end."""
    at, rest = start, b""
    while start < size:
        block = file.read_at(min(BLOCK_BYTES, size - start), start)
        start += len(block)
        *whole, rest = (rest + block).split(b"\n")
        for line in whole:
            yield at, line
            at += len(line) + 1
    if rest:
        yield at, rest


def records_in(file, size: int, start: int, end: int, inside: bool) -> Iterator[tuple[int, bytes]]:
    """The records that begin in [start, end): where, and their bytes. ``inside``: whether the byte at ``start`` is in quotes."""
    at_record = start == 0 or not inside and file.read_at(1, start - 1) == b"\n"
    record: list[bytes] = []
    first = start
    for at, line in lines_from(file, start, size):
        if at_record and not record:
            if at >= end:
                return
            first = at
        inside ^= line.count(b'"') & 1
        if at_record:
            record.append(line)
            if not inside:
                yield first, b"\n".join(record)
                record = []
        else:
            at_record = not inside
    if record:
        yield first, b"\n".join(record)


def file_ranges(spark: SparkSession, path: str, range_bytes: int) -> DataFrame:
    """path, length and start of every range; files are listed, not read."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    return files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))).alias("start"))


def with_parity(ranges: DataFrame, range_bytes: int) -> DataFrame:
    """``inside``: whether a range begins inside quotes, from the quotes of all ranges before it in its file."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            quotes = []
            for path, length, start in zip(*(c.to_pylist() for c in batch.columns)):
                end, n = min(start + range_bytes, length), 0
                with open_file(path) as file:
                    for at in range(start, end, BLOCK_BYTES):
                        n += file.read_at(min(BLOCK_BYTES, end - at), at).count(b'"')
                quotes.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(quotes, pa.int64())], ["path", "length", "start", "quotes"])

    counted = cut_lineage(ranges.mapInArrow(count, "path string, length long, start long, quotes long"))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select("path", "length", "start", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside"))


def read_records(spark: SparkSession, path: str, encoding: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The text of every record but the files' first ones: path, at (its first byte) and record."""
    ship_package(spark)
    ranges = cut_lineage(file_ranges(spark, path, range_bytes))
    tasks = max(1, ranges.count())
    spread = ranges.repartition(tasks, "path", "start")
    decode = codecs.lookup(encoding).decode

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(path: str, ats: list[int], texts: list[str]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([path] * len(ats)), pa.array(ats, pa.int64()), pa.array(texts, pa.string())], ["path", "at", "record"])

        for batch in batches:
            for path, length, start, inside in zip(*(c.to_pylist() for c in batch.columns)):
                ats, texts, held = [], [], 0
                with open_file(path) as file:
                    # As in the reader, a file whose first line ends in CRLF has these for line ends, in fields too.
                    crlf = next(lines_from(file, 0, length))[1].endswith(b"\r")
                    for at, raw in records_in(file, length, start, min(start + range_bytes, length), inside):
                        if crlf:
                            raw = raw.removesuffix(b"\r").replace(b"\r\n", b"\n")
                        text = decode(raw, "replace")[0]
                        if at == 0 or not text:
                            continue
                        if '"' in text and not WELL_FORMED.fullmatch(text):
                            raise ValueError(f"{path}: the record at byte {at} has a quote that neither opens nor closes a field")
                        ats.append(at)
                        texts.append(text)
                        held += len(raw)
                        if held >= BATCH_BYTES:
                            yield batch_of(path, ats, texts)
                            ats, texts, held = [], [], 0
                if ats:
                    yield batch_of(path, ats, texts)

    known = with_parity(spread, range_bytes).repartition(tasks, "path", "start")
    return known.mapInArrow(cut, "path string, at long, record string")


def read_raw_csv_ranges(spark: SparkSession, path: str, encoding: str = "windows-1252", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """A1: what ``read_raw_csv`` reads (header row, all text, permissive), with a task for each range instead of each file."""
    if encoding.lower().replace("_", "-") not in ASCII_BASED:
        raise ValueError(f"{encoding} files cannot be cut at bytes")
    names = read_raw_csv(spark, path, encoding).columns
    schema = ", ".join(f"`{n.replace('`', '``')}` STRING" for n in names)
    options = {k: str(v) for k, v in READ_OPTIONS.items() if k in ("quote", "escape", "mode")} | {"multiLine": "true"}
    parsed = read_records(spark, path, encoding, range_bytes).select(F.from_csv("record", schema, options).alias("row"))
    return parsed.select("row.*")
