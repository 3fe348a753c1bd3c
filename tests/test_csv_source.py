"""A1: multi-line quoted fields, doubled quotes and Windows-1252 bytes."""

import os

import random

import pytest

from tillstar.sources.csv import read_raw_csv
from tillstar.sources.csv_ranges import read_raw_csv_ranges


def test_csv_multiline_cp1252(spark, tmpdir_path):
    header = '"Row ID","Order ID","Product Name","Sales"\r\n'
    row = '1,O-1,"two\r\nlines ""q""","$1,234.50"\r\n'
    row2 = '2,O-2,"Caf\xe9 \x80"," 7 "\r\n'
    path = os.path.join(tmpdir_path, "raw.csv")
    with open(path, "wb") as fh:
        fh.write(header.encode("ascii") + row.encode("ascii") + row2.encode("latin-1"))
    df = read_raw_csv(spark, path)
    rows = df.orderBy("Row ID").collect()
    assert len(rows) == 2
    assert rows[0]["Product Name"] == 'two\nlines "q"'  # one field; CRLF read as a line break
    assert rows[1]["Product Name"] == "Café €"
    assert sorted(map(str, read_raw_csv_ranges(spark, path, range_bytes=7).collect())) == sorted(map(str, df.collect()))


def messy(seed, rows, end):
    some = random.Random(seed)
    parts = ["a", "Caf\xe9", " pad ", "", "x,y", 'say ""hi""', f"two{end}lines", "\n", '""', "z" * 50]
    lines = ["k,a,b"]
    for k in range(rows):
        fields = []
        for _ in range(some.randint(1, 3)):
            text = "".join(some.choice(parts) for _ in range(some.randint(0, 4)))
            fields.append(f'"{text}"' if some.random() < 0.7 or any(c in text for c in ',"\n\r') else text)
        lines.append(f"{k}," + ",".join(fields))
        if some.random() < 0.05:
            lines.append("")
    return (end.join(lines) + (end if seed % 2 else "")).encode("cp1252")


@pytest.mark.parametrize("seed, end, size", [(1, "\n", 64), (2, "\r\n", 1), (3, "\n", 5000), (4, "\r\n", 333)])
def test_ranges_equal_the_multi_line_reader(spark, tmpdir_path, seed, end, size):
    """Quoted line breaks, doubled quotes, blank lines, short rows and ranges that begin anywhere; two files."""
    for k in range(2):
        with open(os.path.join(tmpdir_path, f"{k}.csv"), "wb") as fh:
            fh.write(messy(seed + 10 * k, 25 if size == 1 else 150, end))
    want, got = read_raw_csv(spark, tmpdir_path), read_raw_csv_ranges(spark, tmpdir_path, range_bytes=size)
    assert got.columns == want.columns == ["k", "a", "b"]
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 40


def test_one_file_is_read_by_many_tasks(spark, tmpdir_path):
    from pyspark.sql import functions as F

    path = os.path.join(tmpdir_path, "big.csv")
    with open(path, "wb") as fh:
        fh.write(messy(5, 20_000, "\n"))
    got = read_raw_csv_ranges(spark, path, range_bytes=64 << 10)
    tasks = got.select(F.spark_partition_id().alias("t")).distinct().count()
    assert tasks > 5 and got.count() == read_raw_csv(spark, path).count()


def test_files_that_cannot_be_cut_are_errors(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "bare.csv")
    with open(path, "wb") as fh:
        fh.write(b'k,a\n1,5" pipe\n2,6" pipe\n')
    with pytest.raises(Exception, match="neither opens nor closes"):
        read_raw_csv_ranges(spark, path).collect()
    with pytest.raises(ValueError, match="cannot be cut"):
        read_raw_csv_ranges(spark, path, encoding="utf-16")
