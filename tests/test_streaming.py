"""Streaming ingestion: files dropped into a folder are loaded batch by batch, and a
restarted query only loads files it has not committed yet."""

import csv
import os

from helpers import BASE, HEADERS
from tillstar.plans.warehouse import read_snapshot
from tillstar.streaming.ingest import start_ingest


def write_csv(path, rows, headers=HEADERS):
    with open(path, "w", encoding="cp1252", newline="") as fh:
        w = csv.writer(fh, quoting=csv.QUOTE_MINIMAL)
        w.writerow(headers)
        for i, o in enumerate(rows):
            r = dict(BASE)
            r.update(o)
            w.writerow([r[h] for h in headers])


def test_columns_are_bound_by_header(spark, tmpdir_path):
    """Files of one batch with reversed and with missing columns."""
    src, wh, ck = (os.path.join(tmpdir_path, x) for x in ("in", "wh", "ck"))
    os.makedirs(src)
    write_csv(os.path.join(src, "a.csv"), [{"Row ID": "1", "Order ID": "O-1", "Product ID": "P-1"}], HEADERS[::-1])
    write_csv(os.path.join(src, "b.csv"), [{"Row ID": "2", "Order ID": "O-2", "Product ID": "P-2"}],
              [h for h in HEADERS if h != "Country"])
    start_ingest(spark, src, wh, ck, max_files_per_trigger=5).awaitTermination()
    snap = read_snapshot(spark, wh)
    assert sorted(r.product_key for r in snap.tables["dim_product"].collect()) == ["P-1", "P-2"]
    assert snap.tables["fact_sales"].count() == 2


def test_available_now_ingest(spark, tmpdir_path):
    src, wh, ck = (os.path.join(tmpdir_path, x) for x in ("in", "wh", "ck"))
    os.makedirs(src)
    write_csv(os.path.join(src, "drop1.csv"), [
        {"Row ID": "1", "Order ID": "O-1", "Product ID": "P-1", "Product Name": "Café €"},
        {"Row ID": "2", "Order ID": "O-1", "Product ID": "P-2"},
        {"Row ID": "3", "Order ID": "O-2", "Product ID": "P-1", "Customer ID": "C-2"},
    ])
    start_ingest(spark, src, wh, ck).awaitTermination()
    snap = read_snapshot(spark, wh)
    assert snap.tables["fact_sales"].count() == 3
    assert snap.tables["dim_product"].filter("product_key = 'P-1'").first().product_name == "Café €"

    # second drop re-sends order O-1 with one line and adds O-3
    write_csv(os.path.join(src, "drop2.csv"), [
        {"Row ID": "4", "Order ID": "O-1", "Product ID": "P-2", "Sales": "99"},
        {"Row ID": "5", "Order ID": "O-3", "Product ID": "P-3"},
    ])
    start_ingest(spark, src, wh, ck).awaitTermination()
    snap = read_snapshot(spark, wh)
    orders = {r.order_key: r.order_id for r in snap.tables["dim_order"].collect()}
    fact = snap.tables["fact_sales"]
    assert fact.count() == 3  # O-1 now one line, O-2 one line, O-3 one line
    assert fact.filter(fact.order_id == orders["O-1"]).first().sales == 99
    assert sorted(orders) == ["O-1", "O-2", "O-3"]
