"""Join helpers.

Broadcasting is only asked for where a side's size is proven: the output of a ``limit``.
Everything else is left to the planner's size threshold, and AQE turns a sort-merge join into a broadcast join at runtime
only if the shuffled side turns out small (``spark.sql.adaptive.autoBroadcastJoinThreshold``). The planner measures a stored
table by the bytes of its files; sides that grow with the data are kept from its guess (``growing``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def growing(side: DataFrame) -> DataFrame:
    """A join side that grows with the data, so that it is never broadcast. Keys and ids that lie sorted in a stored table take
    a fiftieth of the bytes under zstd that they take as rows in the driver, so the size of its files says too little."""
    return side.hint("merge")


def null_safe_condition(left: DataFrame, right: DataFrame, cols: list[str],
                        right_cols: list[str] | None = None) -> Column:
    """Conjunction of ``left.c <=> right.c``; stays an equi-join (hash or sort-merge)."""
    right_cols = right_cols or cols
    parts = [left[a].eqNullSafe(right[b]) for a, b in zip(cols, right_cols)]
    return reduce(lambda a, b: a & b, parts)


def lookup(df: DataFrame, mapping: DataFrame, keys: list[str], null_safe: bool = False,
           how: str = "left") -> DataFrame:
    """Natural key -> surrogate id lookup.

    ``mapping`` holds ``keys`` plus the id column(s). With ``null_safe`` a NULL key part
    matches a NULL key part (the four-column location key); the join is still an equi-join.
    """
    if not null_safe:
        return df.join(mapping, on=keys, how=how)
    m = mapping.select(*[F.col(k).alias(f"__m_{k}") for k in keys],
                       *[c for c in mapping.columns if c not in keys])
    cond = null_safe_condition(df, m, keys, [f"__m_{k}" for k in keys])
    return df.join(m, cond, how).drop(*[f"__m_{k}" for k in keys])
