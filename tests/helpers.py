"""Small raw-text fixtures in the CSV header layout."""

from __future__ import annotations

import os

from pyspark.sql.types import StringType, StructField, StructType

from tillstar.functions.clean import HEADER_TO_STAGING

SF_SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

HEADERS = list(HEADER_TO_STAGING)
SCHEMA = StructType([StructField(h, StringType(), True) for h in HEADERS])

BASE = {
    "Row ID": "1", "Order ID": "O-1", "Order Date": "1/2/2018", "Ship Date": "1/5/2018",
    "Ship Mode": "Standard", "Customer ID": "C-1", "Customer Name": "Ann", "Segment": "Consumer",
    "Country": "US", "City": "Austin", "State": "Texas", "Postal Code": "73301", "Region": "Central",
    "Product ID": "P-1", "Category": "Office", "Sub-Category": "Paper", "Product Name": "Pad",
    "Sales": "10.00", "Quantity": "2", "Discount": "0.1", "Profit": "1.00",
}


def raw_rows(spark, *overrides: dict):
    rows = []
    for i, o in enumerate(overrides, start=1):
        r = dict(BASE)
        r["Row ID"] = f"{i:04d}"
        r.update(o)
        rows.append(tuple(r[h] for h in HEADERS))
    return spark.createDataFrame(rows, SCHEMA)
