"""Operator 8: document fingerprints by a homomorphic multiset hash.

A text is the multiset of its paragraphs, and a fingerprint the sum, modulo a power of two, of wide vectors
hashed from them. So order does not matter, equal multisets have equal fingerprints, a paragraph is
inserted or deleted by adding or subtracting its vector, and the fingerprint of joined texts is the
sum of theirs. A vector has four lanes of 32 uniform bits, modulo 2**32, for equality, and 64 lanes of
+1 or -1, modulo 2**16, for likeness: the squared length of such a lane vector estimates the number
of paragraphs in which two texts differ (the sum of squared multiplicity differences), so

    likeness = 1 - |a - b|^2 / (|a|^2 + |b|^2), held to 0 to 1, and 1 for equal fingerprints.

Its error falls with the number of lanes; the difference of two texts is exact up to 2**15 paragraphs.

Paragraphs are what line breaks and sentence ends cut; blanks around them do not count, and empty ones
are left out. Null and empty texts have the fingerprint of no paragraph, all zeros; two of these have
likeness 1, one of them and another text 0. All is done with built-in column functions; a paragraph's
256 bits are its SHA-256.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_bytes

UNIFORM, SIGNS = 4, 64
PARAGRAPH_END = r"\n|(?<=[.!?;|])[ \t]+"
MASK = 0xFFFFFFFF
#: Lanes kept in one 64-bit sum: each has 32 bits, so no text short of 2**32 paragraphs carries over.
PACK = 0x0000000100000001


def word32(hexadecimal: Column, k: int) -> Column:
    """The k-th 32 bits of a hexadecimal digest as a long."""
    return F.conv(F.substring(hexadecimal, 8 * k + 1, 8), 16, 10).cast("long")


def wrapped(value: Column) -> Column:
    """A lane value modulo 2**16, as a signed number."""
    return F.pmod(value + 32768, F.lit(65536)) - 32768


def paragraph_rows(df: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """One row for each paragraph: the keys, six 32-bit words of its digest, and n = 1. A text without
    paragraphs has one row with n = 0."""
    parts = F.split(F.coalesce(F.col(text_col), F.lit("")), PARAGRAPH_END)
    rows = df.select(*keys, F.explode(parts).alias("p")).select(*keys, F.btrim("p").alias("p"))
    rows = rows.select(*keys, (F.col("p") != "").cast("long").alias("n"), F.sha2(F.col("p").cast("binary"), 256).alias("h"))
    words = [F.when(F.col("n") == 1, word32(F.col("h"), k)).otherwise(F.lit(0)).alias(f"w{k}") for k in range(UNIFORM + 2)]
    return rows.select(*keys, "n", *words)


#: The columns of a text's sums: paragraphs, uniform lanes, and counts of set bits (two to a number).
SUMS = ["n", *(f"u{k}" for k in range(UNIFORM)), *(f"s{j}" for j in range(SIGNS // 2))]


def lane_sums(df: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """Per distinct ``keys`` (which tell texts apart): ``SUMS``. One row of partial sums leaves each task for a text."""
    bits = F.shiftleft(F.col(f"w{UNIFORM}"), 32).bitwiseOR(F.col(f"w{UNIFORM + 1}"))
    rows = paragraph_rows(df, keys, text_col).withColumn("bits", bits)
    ones = [F.sum(F.shiftrightunsigned("bits", j).bitwiseAND(F.lit(PACK))).alias(f"s{j}") for j in range(SIGNS // 2)]
    return rows.groupBy(*keys).agg(F.sum("n").alias("n"), *(F.sum(f"w{k}").alias(f"u{k}") for k in range(UNIFORM)), *ones)


def lanes(prefix: str = "") -> Column:
    """A struct of uniform and signs, the lanes, from sums in columns of this prefix."""
    packed, n = F.array(*(F.col(f"{prefix}s{j}") for j in range(SIGNS // 2))), F.col(f"{prefix}n")
    counts = F.concat(F.transform(packed, lambda s: s.bitwiseAND(F.lit(MASK))), F.transform(packed, lambda s: F.shiftrightunsigned(s, 32)))
    return F.struct(F.array(*(F.pmod(F.col(f"{prefix}u{k}"), F.lit(1 << 32)) for k in range(UNIFORM))).alias("uniform"),
                    F.transform(counts, lambda c: wrapped(2 * c - n).cast("int")).alias("signs"))


def add_fingerprints(df: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """Per distinct ``keys``: ``uniform``, ``signs`` (the lanes) and ``fingerprint``, their hexadecimal text."""
    found = lane_sums(df, keys, text_col).select(*keys, lanes().alias("lanes")).select(*keys, "lanes.*")
    return found.withColumn("fingerprint", fingerprint_text(F.col("uniform"), F.col("signs")))


def fingerprint_text(uniform: Column, signs: Column) -> Column:
    """Lanes as hexadecimal text: the wide uniform ones, then the likeness lanes."""
    wide = F.transform(uniform, lambda u: F.lpad(F.lower(F.hex(u)), 8, "0"))
    narrow = F.transform(signs, lambda v: F.lpad(F.lower(F.hex(F.pmod(v, F.lit(65536)))), 4, "0"))
    return F.array_join(F.concat(wide, narrow), "")


def combined(a: Column, b: Column, sign: int = 1) -> Column:
    """Lanes (structs of uniform and signs) of both multisets together, or (``sign`` -1) of the first
    without the second."""
    return F.struct(
        F.zip_with(a["uniform"], b["uniform"], lambda p, q: F.pmod(p + sign * q, F.lit(1 << 32))).alias("uniform"),
        F.zip_with(a["signs"], b["signs"], lambda p, q: wrapped(p + sign * q).cast("int")).alias("signs"))


def likeness(a: Column, b: Column) -> Column:
    """Likeness from 0 to 1 of two structs of uniform and signs."""
    square = lambda x: F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v.cast("double") * v.cast("double"))
    apart = square(F.zip_with(a["signs"], b["signs"], lambda p, q: wrapped(p - q)))  # differences wrap like lanes
    size = square(a["signs"]) + square(b["signs"])
    same = (a["uniform"] == b["uniform"]) & (a["signs"] == b["signs"])
    return (F.when(same, 1.0).when(size == 0, 0.0)
            .otherwise(F.greatest(F.lit(0.0), 1 - apart / F.greatest(size, F.lit(1.0)))))


def bounds_below(key: Column, cuts: list[int]) -> Column:
    """How many of the ascending bounds are smaller than the key, by bisection; 0 for a null key."""
    if not cuts:
        return F.lit(0)
    bounds = F.lit(cuts).cast("array<long>")

    def halved(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        below = (state["low"] < state["high"]) & (F.get(bounds, middle) < key)
        return F.struct(F.when(below, middle + 1).otherwise(state["low"]).alias("low"),
                        F.when(below | (state["low"] >= state["high"]), state["high"]).otherwise(middle).alias("high"))

    start = F.struct(F.lit(0).alias("low"), F.lit(len(cuts)).alias("high"))
    steps = F.array_repeat(F.lit(0), len(cuts).bit_length())
    return F.when(key.isNull(), 0).otherwise(F.aggregate(steps, start, halved)["low"])


def with_next(df: DataFrame, key: str = "doc_id", text_col: str = "text", bucket_bytes: int = 32 << 20) -> DataFrame:
    """Each row with the text of the next row in ascending ``key`` (after the last: the first): columns
    ``key``, ``text``, ``next_key``, ``next_text``, and ``place`` and ``next_place``, numbers of the row and of the next. Rows without
    a key come first; rows of one key are ordered by text. Keys are meant to be unique: all rows of one key meet in one task.

    Rows are dealt into buckets by key range (bounds from one quantile pass over the keys), a bucket to a partition, and a copy of
    each bucket's first key goes to the bucket before it, so no window spans more than a bucket."""
    rows = df.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = max(1, math.ceil(text_bytes(rows) / bucket_bytes))
    cuts = sorted(set(rows.agg(F.percentile_approx("key", [k / n for k in range(1, n)], 20 * n)).first()[0] or [])) if n > 1 else []
    bucket = bounds_below(F.col("key"), cuts).cast("int")
    dealt = rows.withColumn("bucket", bucket)
    firsts = dealt.groupBy("bucket").agg(F.min(F.struct(F.col("key").isNotNull(), F.col("key"))).getField("key").alias("first"))
    order = Window.orderBy("bucket")  # a row per bucket
    ends = F.min("bucket").over(Window.partitionBy()), F.max("bucket").over(Window.partitionBy())
    borders = firsts.select("first", F.col("bucket").alias("from"), F.coalesce(F.lag("bucket").over(order), ends[1]).alias("to"),
                            (F.col("bucket") == ends[0]).alias("wraps"))
    # The copies: rows of the first key of each bucket, for the bucket before (the last one, for the first).
    copies = (rows.join(F.broadcast(borders), F.col("key").eqNullSafe(F.col("first")))  # a row per bucket
              .select("key", "text", F.col("to").alias("bucket"), F.when(F.col("wraps"), 2).otherwise(1).alias("copy"), "from"))
    inside = Window.partitionBy("bucket").orderBy("copy", F.col("key").asc_nulls_first(), "text")
    both = dealt.select("key", "text", "bucket", F.lit(0).alias("copy"), F.lit(None).cast("int").alias("from")).unionByName(copies)
    both = both.repartitionById(len(cuts) + 1, F.col("bucket"))
    first_place = lambda b: F.shiftleft(b.cast("long"), 32) + 1
    place = first_place(F.col("bucket")) - 1 + F.row_number().over(inside)
    following = F.coalesce(first_place(F.lead("from").over(inside)), place + 1)  # a copy is the first row of its bucket
    return (both.select("key", "text", "copy", place.alias("place"), following.alias("next_place"), F.lead("key").over(inside).alias("next_key"),
                        F.lead("text").over(inside).alias("next_text"))
            .where("copy = 0").select("key", "text", "next_key", "next_text", "place", "next_place"))
