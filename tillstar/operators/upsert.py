"""Set-based dimension upserts and idempotent fact replacement (K1-K6).

A dimension snapshot is ``existing`` full-outer-joined to ``incoming`` on the natural key
(one shuffle of each side on the key; NULL-safe where key parts may be NULL). Per column,
the update rule is one of

* ``overwrite``: the incoming value wins whenever the key arrived, even if it is NULL;
* ``coalesce``: the incoming value wins unless it is NULL;
* ``keep``: existing value is kept (insert-only columns).

Rows only in ``incoming`` are new and get ids from ``keys.assign_ids``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .keys import assign_ids


def _key_condition(e: DataFrame, i: DataFrame, keys: list[str], null_safe: bool):
    parts = [(e[f"_e_{k}"].eqNullSafe(i[k]) if null_safe else e[f"_e_{k}"] == i[k]) for k in keys]
    return reduce(lambda a, b: a & b, parts)


def upsert(existing: DataFrame | None, incoming: DataFrame, keys: list[str], id_col: str,
           rules: dict[str, str], null_safe: bool = False, start: int | None = None, stored: bool = False) -> DataFrame:
    """Return the new dimension snapshot: ``id_col`` + ``keys`` + rule columns.

    ``incoming`` must hold one row per key (staging already guarantees it). ``start`` is the id after which new ones
    follow (default: the largest in ``existing``). ``stored``: ``incoming`` only reads rows that ``cut_lineage`` wrote.
    """
    cols = list(rules)
    if existing is None:
        return assign_ids(None, incoming.select(*keys, *cols), keys, id_col, start, stored=stored).select(id_col, *keys, *cols)

    e = existing.select(
        id_col, *[F.col(k).alias(f"_e_{k}") for k in keys], *[F.col(c).alias(f"_e_{c}") for c in cols]
    ).withColumn("_e_here", F.lit(True))
    i = incoming.select(*keys, *cols).withColumn("_i_here", F.lit(True))
    # Materialised once: both the updated and the new rows are cut from it.
    j = cut_lineage(e.join(i, _key_condition(e, i, keys, null_safe), "full_outer"))

    def rule(c: str):
        kind = rules[c]
        if kind == "overwrite":
            return F.when(F.col("_i_here"), F.col(c)).otherwise(F.col(f"_e_{c}"))
        if kind == "coalesce":
            return F.coalesce(F.col(c), F.col(f"_e_{c}"))
        if kind == "keep":
            return F.col(f"_e_{c}")
        raise ValueError(f"unknown rule {kind!r}")

    updated = j.filter(F.col("_e_here")).select(
        id_col, *[F.col(f"_e_{k}").alias(k) for k in keys], *[rule(c).alias(c) for c in cols]
    )
    fresh = j.filter(F.col("_e_here").isNull()).select(*keys, *cols)
    fresh = assign_ids(existing, fresh, keys, id_col, start, stored=True).select(id_col, *keys, *cols)
    return updated.unionByName(fresh)


def insert_new(existing: DataFrame | None, incoming: DataFrame, keys: list[str], id_col: str,
               null_safe: bool = True, start: int | None = None) -> DataFrame:
    """K2: insert-only dimension (every column is part of the key)."""
    inc = incoming.select(*keys).dropDuplicates()
    if existing is None:
        return assign_ids(None, inc, keys, id_col, start).select(id_col, *keys)
    e = existing.select(*[F.col(k).alias(f"_e_{k}") for k in keys])
    fresh = inc.join(e, _key_condition(e, inc, keys, null_safe), "left_anti")
    return existing.select(id_col, *keys).unionByName(
        assign_ids(existing, fresh, keys, id_col, start).select(id_col, *keys))


def replace_by_key(existing: DataFrame | None, new_rows: DataFrame, key: str) -> DataFrame:
    """K6: drop every existing row whose ``key`` occurs in ``new_rows``, then add
    ``new_rows`` (re-running a batch gives the same table; a re-sent order with fewer
    lines loses the old ones)."""
    if existing is None:
        return new_rows
    affected = new_rows.select(key).distinct()
    return existing.join(affected, key, "left_anti").unionByName(new_rows)
