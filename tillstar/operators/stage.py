"""Raw text -> raw staging -> five typed staging tables.

``extract`` types the raw file once (lenient number reading, percent discounts, 4-place
money, row fingerprint, load stamp); numbers stay wide, so no value is lost before the load
decides on it. ``stage`` re-reads that table the way a second job would (text
columns trimmed, guarded number reading of numbers in text) and splits it into location, product,
customer, order and sales-line frames.

One row per key is picked by an aggregate, not a window: the smallest struct that opens with ``row_id`` keeps
the row with the smallest ``row_id`` and runs with map-side partial aggregation, so a key
holding a third of all rows never lands in one task as a sorted window partition would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

from .. import schemas
from ..functions import clean

LOCATION_COLS = ["city", "state", "postal_code", "region"]
MEASURES = ("sales", "quantity", "discount", "profit")


def extract(raw_text: DataFrame) -> DataFrame:
    """Raw CSV frame (header names, all text) -> raw staging table (RAW_STAGING)."""
    df = clean.ensure_columns(clean.rename_headers(clean.trim_all(raw_text)))
    sales = clean.money(F.col("sales"))
    profit = clean.money(F.col("profit"))
    discount = clean.money(F.col("discount"))
    quantity = F.col("quantity").try_cast(clean.WIDE)
    typed = df.select(
        *[F.col(c) for c in clean.RAW_COLUMNS if c not in MEASURES],
        F.round(sales, 4).alias("sales"),
        clean.to_quantity(quantity).alias("quantity"),
        clean.norm_discount(discount).alias("discount"),
        F.round(profit, 4).alias("profit"),
        clean.row_hash().alias("row_hash"),
        F.current_timestamp().alias("loaded_at"),
    )
    return clean.conform(typed, schemas.RAW_STAGING)


def cleaned(raw_staging: DataFrame) -> DataFrame:
    """The shared cleaned frame the five staging tables are cut from. A measure that is an exact number already is read as it
    is: its text is a plain number, which reads back as the same one."""
    exact = [c for c in MEASURES if c in raw_staging.columns and isinstance(raw_staging.schema[c].dataType, (DecimalType, IntegralType))]
    columns = [F.col(c).try_cast(clean.WIDE).alias(c) if c in exact else F.trim(F.col(f"`{c}`").cast("string")).alias(c)
               for c in raw_staging.columns]
    df = clean.ensure_columns(raw_staging.select(columns), clean.RAW_COLUMNS + ["row_hash"])

    def number(c: str, strip: bool = True):
        return F.col(c) if c in exact else clean.guarded_number(F.col(c), strip)

    return df.select(
        *[F.col(c) for c in clean.RAW_COLUMNS if c not in (*MEASURES, "order_date", "ship_date")],
        F.round(number("sales"), 4).try_cast(clean.WIDE).alias("sales"),
        F.round(number("profit"), 4).try_cast(clean.WIDE).alias("profit"),
        clean.norm_discount(number("discount")).try_cast(clean.WIDE).alias("discount"),
        clean.to_quantity(number("quantity", strip=False)).alias("quantity"),
        clean.parse_date(F.col("order_date")).alias("order_date"),
        clean.parse_date(F.col("ship_date")).alias("ship_date"),
    )


def first_per_key(df: DataFrame, key: str, cols: list[str], order_col: str = "row_id") -> DataFrame:
    """E5: one row per ``key``, the one with the smallest ``order_col``; ties (the same row
    id twice) are broken by the picked values themselves, so the survivor is deterministic.

    Several values travel once, in the struct whose smallest is taken; a single one is a plain ``min_by``."""
    values = [F.col(c) for c in cols]
    ranked = F.struct(F.col(order_col), *values)
    picked = F.min(ranked) if len(cols) > 1 else F.min_by(F.struct(*values), ranked)
    return df.groupBy(key).agg(picked.alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in cols])


def stage(raw_staging: DataFrame) -> dict[str, DataFrame]:
    """Split the raw staging table into the five typed staging frames."""
    c = cleaned(raw_staging)
    return {
        "stg_dim_location": c.select(*LOCATION_COLS).dropDuplicates(),
        "stg_dim_product": first_per_key(c, "product_key", ["product_name", "category", "sub_category"]),
        "stg_dim_customer": first_per_key(c, "customer_key", ["customer_name", "segment", *LOCATION_COLS]),
        "stg_orders": first_per_key(c, "order_key", ["order_date", "ship_date", "ship_mode", *LOCATION_COLS]),
        "stg_sales_lines": c.select("row_id", "order_key", "product_key", "customer_key",
                                    "quantity", "sales", "discount", "profit"),
    }
