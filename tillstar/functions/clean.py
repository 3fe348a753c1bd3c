"""Cleaning and typing of raw text columns.

All functions return built-in column expressions (no Python UDFs), so they stay inside
whole-stage code generation. ANSI mode stays on; every text-to-value step uses ``try_*``
so bad input becomes NULL instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

# --- fixed values: header names, staging names and patterns of the raw order-line file ---
HEADER_TO_STAGING = {
    "Row ID": "row_id", "Order ID": "order_key", "Order Date": "order_date",
    "Ship Date": "ship_date", "Ship Mode": "ship_mode", "Customer ID": "customer_key",
    "Customer Name": "customer_name", "Segment": "segment", "Country": "country",
    "City": "city", "State": "state", "Postal Code": "postal_code", "Region": "region",
    "Product ID": "product_key", "Category": "category", "Sub-Category": "sub_category",
    "Product Name": "product_name", "Sales": "sales", "Quantity": "quantity",
    "Discount": "discount", "Profit": "profit",
}
RAW_COLUMNS = [
    "row_id", "order_key", "order_date", "ship_date", "ship_mode", "customer_key",
    "customer_name", "segment", "country", "city", "state", "postal_code", "region",
    "product_key", "category", "sub_category", "product_name", "sales", "quantity",
    "discount", "profit",
]
CURRENCY_CHARS = r"[$,]"
PLAIN_NUMBER = r"^[+-]?\d+(\.\d+)?$"
DATE_FORMATS = ("M/d/yyyy", "yyyy-MM-dd")
HASH_SEPARATOR = "|"
# --- end of fixed values ---

WIDE = DecimalType(38, 10)
MONEY = DecimalType(12, 4)
RATE = DecimalType(3, 2)


def trim_all(df: DataFrame) -> DataFrame:
    """B1: every column as trimmed text, in one projection."""
    return df.select([F.trim(F.col(f"`{c}`").cast("string")).alias(c) for c in df.columns])


def rename_headers(df: DataFrame, mapping: dict[str, str] = HEADER_TO_STAGING) -> DataFrame:
    """B2: rename source headers to staging names; absent headers are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def ensure_columns(df: DataFrame, names: list[str] = RAW_COLUMNS) -> DataFrame:
    """Add every missing expected column as a NULL string."""
    missing = [n for n in names if n not in df.columns]
    if not missing:
        return df
    return df.withColumns({n: F.lit(None).cast("string") for n in missing})


def strip_currency(c: Column) -> Column:
    """Without ``$`` and ``,``; only text that holds one goes through the pattern."""
    return F.when(c.contains("$") | c.contains(","), F.regexp_replace(c, CURRENCY_CHARS, "")).otherwise(c)


def money(c: Column) -> Column:
    """Strip ``$`` and ``,`` and read a number; anything unreadable is NULL.

    Accepts what a numeric cast accepts (``1e3``, ``.5``)."""
    return strip_currency(c).try_cast(WIDE)


def guarded_number(c: Column, strip: bool = True) -> Column:
    """Read a number only if the text is plain digits with an optional sign and
    fraction; ``1e3``, ``.5`` and ``5.`` become NULL."""
    t = strip_currency(c) if strip else c
    return F.when(t.rlike(PLAIN_NUMBER), t.try_cast(WIDE))


def norm_discount(c: Column) -> Column:
    """A value above 1 is a percentage; result rounded (half-up) to 2 places."""
    return F.round(F.when(c > 1, c / 100).otherwise(c), 2)


def norm_discount_clamped(c: Column) -> Column:
    """As B7, then clamped to 0..1; NULL stays NULL (the guard keeps ``greatest``/
    ``least`` from turning NULL into a bound)."""
    v = F.when(c > 1, c / 100).otherwise(c)
    return F.when(c.isNotNull(), F.round(F.greatest(F.lit(0), F.least(F.lit(1), v)), 2))


def round_money(c: Column, digits: int = 4, target: DecimalType = MONEY) -> Column:
    """Round half-up and store as decimal(12,4); out-of-range is NULL."""
    return F.round(c, digits).try_cast(target)


def parse_date(c: Column, formats=DATE_FORMATS) -> Column:
    """First format that parses wins, else NULL (``try_to_date`` never raises). A format is only tried on text that has its
    separator: no other text parses, and each failed try costs an exception."""
    return F.coalesce(*[F.when(c.contains(_separator(f)), F.try_to_date(c, f)) for f in formats])


def _separator(date_format: str) -> str:
    """The first character of a date format that stands for itself."""
    return next(ch for ch in date_format if not ch.isalpha())


def to_quantity(n: Column) -> Column:
    """Number -> integer, truncating toward zero; NULL stays NULL."""
    return n.try_cast(DecimalType(18, 4)).try_cast("long").try_cast("int")


def row_hash(cols: list[str] = RAW_COLUMNS) -> Column:
    """SHA-256 hex over the columns in fixed order, NULL as empty text."""
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]), 256)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project to the schema's column order and types (``try_cast``: bad is NULL)."""
    return df.select([F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def unit_price(sales: Column, quantity: Column) -> Column:
    """Sales / integer quantity rounded to 4 places; NULL if either is NULL or the
    quantity is 0."""
    q = quantity.try_cast("int")
    return F.round(F.try_divide(sales, F.nullif(q, F.lit(0))), 4).try_cast(MONEY)


def fill_discount(c: Column) -> Column:
    """Missing discount -> 0.00."""
    return F.coalesce(c, F.lit(0).cast(RATE))


def present(c: Column, kind: str) -> Column:
    """Presentation casts: ``money2`` (round 2), ``float``, ``date``."""
    if kind == "money2":
        return F.round(c, 2)
    if kind == "float":
        return c.cast("double")
    if kind == "date":
        return c.cast("date")
    raise ValueError(kind)
