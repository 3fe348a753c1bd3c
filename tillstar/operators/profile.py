"""Column profile of a raw text table.

The table is unpivoted to ``(column_name, value)`` pairs and aggregated per column in one
job: missing count, distinct count, longest text, numeric min / max / mean after stripping
currency characters, and the most digits written after the decimal point. Exact distinct
counts shuffle the distinct pairs (skew-safe: the pairs, not the 21 columns, are the
keys); ``exact=False`` switches to HyperLogLog sketches for very wide or very large inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean

# --- fixed values: text a CSV reader treats as missing by default ---
MISSING_MARKERS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                   "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                   "nan", "null"]
# --- end of fixed values ---

DECIMAL_DIGITS = r"\.(\d+)$"


def _present(c: str):
    x = F.col(f"`{c}`").cast("string")
    missing = x.isNull() | x.isin(MISSING_MARKERS)
    return missing, F.when(~missing, x)


def profile_columns(df: DataFrame, text_cols: list[str], numeric_cols: list[str],
                    exact: bool = True) -> DataFrame:
    cols = df.columns
    # 1) Everything but distinct counts: one aggregate over the table as it is (partial
    #    aggregation per task, one row out), then stacked to one row per column.
    aggs = []
    for i, c in enumerate(cols):
        missing, present = _present(c)
        aggs.append(F.sum(F.when(missing, 1).otherwise(0)).cast("long").alias(f"n{i}"))
        aggs.append((F.max(F.char_length(present)) if c in text_cols else F.lit(None)).cast("long").alias(f"l{i}"))
        if c in numeric_cols:
            stripped = clean.strip_currency(present)
            num = stripped.try_cast(clean.WIDE)
            scale = F.when(num.isNotNull(), F.char_length(F.regexp_extract(stripped, DECIMAL_DIGITS, 1)))
            aggs += [F.min(num).cast("double").alias(f"a{i}"), F.max(num).cast("double").alias(f"b{i}"),
                     F.round(F.avg(num), 6).cast("double").alias(f"m{i}"), F.max(scale).cast("long").alias(f"s{i}")]
        else:
            aggs += [F.lit(None).cast("double").alias(f"a{i}"), F.lit(None).cast("double").alias(f"b{i}"),
                     F.lit(None).cast("double").alias(f"m{i}"), F.lit(None).cast("long").alias(f"s{i}")]
    stack_args = [x for i, c in enumerate(cols)
                  for x in (F.lit(c), F.col(f"n{i}"), F.col(f"l{i}"), F.col(f"a{i}"), F.col(f"b{i}"),
                            F.col(f"m{i}"), F.col(f"s{i}"))]
    stats = df.agg(*aggs).select(F.stack(F.lit(len(cols)), *stack_args).alias(
        "column_name", "nulls", "maxlen", "min_value", "max_value", "mean_value", "max_scale"))
    # 2) Distinct counts: (column, value) pairs, deduplicated by a shuffle on the pair, so
    #    no single column's values have to meet in one task.
    long = df.select([_present(c)[1].alias(c) for c in cols]).unpivot([], cols, "column_name", "value")
    distinct = F.count_distinct("value") if exact else F.approx_count_distinct("value")
    counts = long.filter(F.col("value").isNotNull()).groupBy("column_name").agg(distinct.cast("long").alias("distinct_count"))
    return stats.join(F.broadcast(counts), "column_name", "left").select(
        "column_name", "nulls", F.coalesce("distinct_count", F.lit(0)).alias("distinct_count"),
        "maxlen", "min_value", "max_value", "mean_value", "max_scale")


# Columns profiled as text and as numbers (staging names of the raw file).
PROFILE_TEXT = ["order_key", "customer_key", "customer_name", "product_key", "product_name",
                "category", "sub_category", "region", "city", "state", "postal_code"]
PROFILE_NUMERIC = ["sales", "profit", "discount", "quantity"]
