"""Exact distinct counts that merge (E2, E7, E19): bitmaps over dense ids.

Surrogate ids are dense, so a set of them is a row of bits: ``build`` gives, per group and block of 32,768 ids, one bitmap
(built by map-side partial aggregation). Bitmaps of finer groups give those of coarser ones by OR, so every level of a drill
path comes from one pass over the rows, and a stored state can be merged with that of new rows. A block takes 4 KB whatever it
holds: groups of few ids spread over the whole range are better counted directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def build(df: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """keys, block, bits: the ids (from 1 up, NULL left out) of each group."""
    rows = df.where(F.col(id_col).isNotNull())
    return (rows.select(*keys, F.bitmap_bucket_number(id_col).alias("block"), F.bitmap_bit_position(id_col).alias("at"))
            .groupBy(*keys, "block").agg(F.bitmap_construct_agg("at").alias("bits")))


def merge(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """Bitmaps of coarser groups, or of several states of the same groups."""
    return bitmaps.groupBy(*keys, "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def counts(bitmaps: DataFrame, keys: list[str], name: str) -> DataFrame:
    """keys and the number of distinct ids. Without keys: one row, 0 for no ids."""
    return bitmaps.groupBy(*keys).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias(name))
