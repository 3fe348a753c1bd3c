"""Lookups on keys of which a few hold very many rows.

``hot_keys`` finds them with a frequent-items sketch: one aggregate over the key columns, whose result is a few keys for each
column. A key (or NULL) is hot if it has more rows than an even share of a shuffle partition; so there are at most as many
hot keys as partitions. ``lookup`` splits only the rows of hot keys: each gets one of the key's salts, and the key's row
of the mapping is repeated for each salt. The number of salts follows the key's share, so that all repeated rows together are a
few for each partition. Rows without a key match nothing and are only spread. No row is dropped or sampled; where no key is hot
the join is the plain one.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import growing

SALTS_PER_PARTITION = 4  # a hot key's salt holds about a quarter of an even share
MOST_TRACKED = 1_000_000  # items the sketch function can track


@dataclass(frozen=True)
class Hot:
    """A column's hot keys with the number of salts of each, and of NULL."""

    keys: tuple[tuple[object, int], ...] = ()
    null_salts: int = 1

    def __bool__(self) -> bool:
        return bool(self.keys) or self.null_salts > 1


def hot_keys(df: DataFrame, columns: list[str]) -> dict[str, Hot]:
    """The hot keys of each column: one scan of these columns, at most a shuffle partition's number of keys to the driver.

    The sketch's counts err by less than an eighth of the threshold, so a key in need of splitting is not missed;
    a key just below the threshold may be split too, which changes no result."""
    parts = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    tracked = min(MOST_TRACKED, 1 << math.ceil(math.log2(parts * 16)))
    rows = df.agg(F.count(F.lit(1)).alias("n"), *(F.expr(f"approx_top_k(`{c}`, {parts + 1}, {tracked})").alias(f"t{i}")
                                                  for i, c in enumerate(columns))).first()
    out = {}
    for i, c in enumerate(columns):
        keys, null_salts = [], 1
        for item in rows[f"t{i}"] or ():
            if item["count"] * parts <= rows["n"]:
                continue
            salts = math.ceil(item["count"] * parts * SALTS_PER_PARTITION / rows["n"])
            if item["item"] is None:
                null_salts = salts
            else:
                keys.append((item["item"], salts))
        out[c] = Hot(tuple(keys), null_salts)
    return out


def _salts(df: DataFrame, key: str, hot: Hot) -> DataFrame:
    """Add ``__salts``, the number of salts of the row's key: 1 unless it is hot."""
    if not hot.keys:
        return df.withColumn("__salts", F.lit(1))
    schema = f"__hot {df.schema[key].dataType.simpleString()}, __salts int"
    table = df.sparkSession.createDataFrame(list(hot.keys), schema)
    # At most one row for each shuffle partition.
    joined = df.join(F.broadcast(table), F.col(key) == F.col("__hot"), "left").drop("__hot")
    return joined.withColumn("__salts", F.coalesce("__salts", F.lit(1)))


def _deal(df: DataFrame, salts: Column) -> Column:
    """A salt below ``salts`` from the row's own values, so that a task run again deals alike."""
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    return F.when(salts > 1, F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in plain)), salts).cast("int")).otherwise(0)


def lookup(df: DataFrame, mapping: DataFrame, key: str, hot: Hot, grows: bool = False) -> DataFrame:
    """``df`` left-joined with ``mapping`` on ``key``, its hot keys split. Equal rows share a salt, as their values deal them;
    the callers' rows carry an id. The columns are those of the plain join. ``grows``: ``mapping`` grows with the data and is
    never broadcast."""
    side = growing if grows else lambda rows: rows
    if not hot:
        return df.join(side(mapping), key, "left")
    salts = F.when(F.col(key).isNull(), F.lit(hot.null_salts)).otherwise(F.col("__salts"))
    left = _salts(df, key, hot)
    left = left.withColumn("__salt", _deal(df, salts)).drop("__salts")
    right = _salts(mapping, key, hot)
    right = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1))).drop("__salts")
    return left.join(side(right), [key, "__salt"], "left").drop("__salt")
