"""Raw delimited file readers (A1, A2).

Everything is read as text (no inference) and bound by *header name* afterwards, so a file
with missing or reordered columns still lands in the staging layout (B2, B3). Quoted
fields may span lines and escape quotes by doubling them. Windows-1252 input is decoded by
the reader itself (no transcoded copy on the driver); Spark 4 only accepts that charset
with ``spark.sql.legacy.javaCharsets`` enabled, which ``session.BASE_CONF`` sets.

Spark's reader cannot split multi-line CSV inside a file; ``csv_ranges`` reads large files in byte ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# --- fixed values: how the raw export is written ---
READ_OPTIONS = {"header": True, "inferSchema": False, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
# --- end of fixed values ---


def read_raw_csv(spark: SparkSession, path: str, encoding: str = "windows-1252",
                 multi_line: bool = True) -> DataFrame:
    """A1: header row, all text, permissive (malformed rows become NULL fields)."""
    if encoding.lower().replace("_", "-") in ("windows-1252", "cp1252"):
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    return spark.read.options(**READ_OPTIONS, multiLine=multi_line, encoding=encoding).csv(path)


def read_profile_csv(spark: SparkSession, path: str) -> DataFrame:
    """A2: the profiling read (Latin-1); dates are parsed by the profiler, not the reader."""
    return read_raw_csv(spark, path, encoding="ISO-8859-1")
