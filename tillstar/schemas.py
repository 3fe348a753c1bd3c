"""Table definitions (A8): raw staging, five typed staging tables and the star.

Spark does not enforce the declared constraints; ``operators/quality.py`` checks them
(K8-K12) from the ``CONSTRAINTS`` listed here.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType, DateType, DecimalType, IntegerType, LongType, ShortType, StringType,
    StructField, StructType, TimestampType,
)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


S = StringType()
MONEY = DecimalType(12, 4)
RATE = DecimalType(3, 2)
WIDE = DecimalType(38, 10)  # raw and staged numbers are not narrowed; the load is

RAW_STAGING = _s(
    ("row_id", S), ("order_key", S), ("order_date", S), ("ship_date", S), ("ship_mode", S),
    ("customer_key", S), ("customer_name", S), ("segment", S), ("country", S), ("city", S),
    ("state", S), ("postal_code", S), ("region", S), ("product_key", S), ("category", S),
    ("sub_category", S), ("product_name", S), ("sales", WIDE), ("quantity", IntegerType()),
    ("discount", WIDE), ("profit", WIDE), ("row_hash", S), ("loaded_at", TimestampType()),
)

STG_DIM_LOCATION = _s(("city", S), ("state", S), ("postal_code", S), ("region", S))
STG_DIM_PRODUCT = _s(("product_key", S), ("product_name", S), ("category", S), ("sub_category", S))
STG_DIM_CUSTOMER = _s(("customer_key", S), ("customer_name", S), ("segment", S),
                      ("city", S), ("state", S), ("postal_code", S), ("region", S))
STG_ORDERS = _s(("order_key", S), ("order_date", DateType()), ("ship_date", DateType()),
                ("ship_mode", S), ("city", S), ("state", S), ("postal_code", S), ("region", S))
STG_SALES_LINES = _s(("row_id", S), ("order_key", S), ("product_key", S), ("customer_key", S),
                     ("quantity", IntegerType()), ("sales", WIDE), ("discount", WIDE),
                     ("profit", WIDE))

DIM_DATE = _s(("date_id", LongType()), ("full_date", DateType()), ("year", ShortType()),
              ("quarter", ShortType()), ("month", ShortType()), ("day", ShortType()),
              ("day_of_week", ShortType()), ("is_weekend", BooleanType()),
              ("is_holiday", BooleanType()))
DIM_LOCATION = _s(("location_id", LongType()), ("city", S), ("state", S),
                  ("postal_code", S), ("region", S))
DIM_CUSTOMER = _s(("customer_id", LongType()), ("customer_key", S), ("customer_name", S),
                  ("segment", S), ("location_id", LongType()))
DIM_PRODUCT = _s(("product_id", LongType()), ("product_key", S), ("product_name", S),
                 ("category", S), ("sub_category", S))
DIM_ORDER = _s(("order_id", LongType()), ("order_key", S), ("order_date_id", LongType()),
               ("ship_date_id", LongType()), ("ship_mode", S), ("location_id", LongType()),
               ("order_year", ShortType()), ("order_month", ShortType()))
FACT_SALES = _s(("sales_id", LongType()), ("order_id", LongType()), ("product_id", LongType()),
                ("customer_id", LongType()), ("location_id", LongType()),
                ("quantity", ShortType()), ("sales", MONEY), ("unit_price", MONEY),
                ("discount", RATE), ("profit", MONEY), ("created_at", TimestampType()))

STAR = {
    "dim_date": DIM_DATE, "dim_location": DIM_LOCATION, "dim_customer": DIM_CUSTOMER,
    "dim_product": DIM_PRODUCT, "dim_order": DIM_ORDER, "fact_sales": FACT_SALES,
}
STAGING = {
    "stg_raw_lines": RAW_STAGING, "stg_dim_location": STG_DIM_LOCATION,
    "stg_dim_product": STG_DIM_PRODUCT, "stg_dim_customer": STG_DIM_CUSTOMER,
    "stg_orders": STG_ORDERS, "stg_sales_lines": STG_SALES_LINES,
}

# Declared constraints of the star (K8-K12). Keys: table -> rule lists.
CONSTRAINTS = {
    "dim_date": {
        "not_null": ["date_id", "full_date", "year", "quarter", "month", "day", "day_of_week",
                     "is_weekend", "is_holiday"],
        "unique": [["date_id"], ["full_date"]],
        "range": {"year": (1900, 2100), "quarter": (1, 4), "month": (1, 12), "day": (1, 31),
                  "day_of_week": (0, 6)},
    },
    "dim_location": {
        "not_null": ["location_id"],
        "unique": [["location_id"], ["city", "state", "postal_code", "region"]],
        "length": {"city": 50, "state": 50, "postal_code": 20, "region": 20},
    },
    "dim_customer": {
        "not_null": ["customer_id", "customer_key", "customer_name", "segment"],
        "unique": [["customer_id"], ["customer_key"]],
        "fk": [("location_id", "dim_location", "location_id")],
        "length": {"customer_key": 12, "customer_name": 100, "segment": 30},
    },
    "dim_product": {
        "not_null": ["product_id", "product_key", "product_name", "category"],
        "unique": [["product_id"], ["product_key"]],
        "length": {"product_key": 20, "category": 30, "sub_category": 40},
    },
    "dim_order": {
        "not_null": ["order_id", "order_key", "order_date_id", "ship_date_id", "ship_mode"],
        "unique": [["order_id"], ["order_key"]],
        "fk": [("order_date_id", "dim_date", "date_id"), ("ship_date_id", "dim_date", "date_id"),
               ("location_id", "dim_location", "location_id")],
        "length": {"order_key": 20, "ship_mode": 40},
    },
    "fact_sales": {
        "not_null": ["sales_id", "order_id", "product_id", "customer_id", "location_id",
                     "quantity", "sales", "unit_price", "discount"],
        "unique": [["sales_id"]],
        "fk": [("order_id", "dim_order", "order_id"), ("product_id", "dim_product", "product_id"),
               ("customer_id", "dim_customer", "customer_id"),
               ("location_id", "dim_location", "location_id")],
        "range": {"quantity": (1, None), "sales": (0, None), "discount": (0, 1)},
        "numeric": {"sales": (12, 4), "unit_price": (12, 4), "discount": (3, 2), "profit": (12, 4)},
    },
}

# Checks of staged rows, before the load rejects or types anything.
STAGED_CHECKS = {
    "stg_sales_lines": {
        "not_null": ["order_key", "product_key", "customer_key", "quantity", "sales", "discount"],
        "unique": [["order_key"], ["row_id"]],
        "range": {"quantity": (1, None), "sales": (0, None), "profit": (0, None)},
        "numeric": {"sales": (8, 4), "discount": (3, 2)},
    },
    "stg_orders": {"not_null": ["order_key", "order_date", "ship_date", "ship_mode"], "length": {"order_key": 4, "ship_mode": 10}},
    "stg_dim_location": {"not_null": ["city", "postal_code"]},
    "stg_dim_product": {"not_null": ["product_key"], "length": {"product_name": 20}},
}
