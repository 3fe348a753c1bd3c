"""Stable surrogate keys (K7).

Known keys keep their id; new keys get ``max(existing id) + rank`` where the rank follows
the sort order of the natural key (NULL parts first). The rank is computed without a
single-partition window: new keys are range-partitioned and sorted within partitions, each
row gets its position inside its partition, and per-partition row counts (one small row
per partition, so a proven size bound) give each partition its starting offset.

Positions come from ``monotonically_increasing_id``, which is only meaningful for one
evaluation of the plan, so the numbered keys are checkpointed to the shared checkpoint
folder before they are used twice (counts and ids). That also keeps ids stable if an
executor is lost later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_ROW_BITS = 33  # monotonically_increasing_id = partition index << 33 | row position


def max_id(existing: DataFrame | None, id_col: str) -> int:
    """Largest id in use (one scalar to the driver)."""
    if existing is None:
        return 0
    value = existing.agg(F.max(id_col)).first()[0]
    return int(value or 0)


def number_rows(df: DataFrame, order_cols: list[str], id_col: str, start: int = 0,
                num_partitions: int | None = None, stored: bool = False) -> DataFrame:
    """Add ``id_col`` = start + 1 .. start + n following ``order_cols`` (ascending, NULLs
    first), dense and gap-free. ``stored``: ``df`` only reads rows that ``cut_lineage`` wrote."""
    spark = df.sparkSession
    n_parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort_cols = [F.col(c).asc_nulls_first() for c in order_cols]
    # Range partitioning runs its input twice (a sampling pass for the bounds, then the
    # shuffle); reading a materialised input keeps the upstream joins to one run.
    rows = df if stored else cut_lineage(df)
    numbered = cut_lineage(
        rows.repartitionByRange(n_parts, *sort_cols)
        .sortWithinPartitions(*sort_cols)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    counts = numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).alias("_off"),
    ).fillna(0, ["_off"])
    local = F.col("_pos") - F.shiftleft(F.col("_pid").cast("long"), _ROW_BITS)
    return (
        numbered.join(F.broadcast(offsets), "_pid")
        .withColumn(id_col, F.lit(start).cast("long") + F.col("_off") + local + 1)
        .drop("_pid", "_pos", "_off")
    )


def assign_ids(existing: DataFrame | None, new_rows: DataFrame, key_cols: list[str],
               id_col: str, start: int | None = None, stored: bool = False) -> DataFrame:
    """Ids for rows whose key is not in ``existing`` (callers pass only new keys), after the largest id there or after
    ``start``, the table's high-water mark where ``existing`` is only a part of it."""
    return number_rows(new_rows, key_cols, id_col, start=max_id(existing, id_col) if start is None else start, stored=stored)
