"""Command line: load a raw export onto a warehouse folder, then report from stored tables."""

import os

from test_streaming import write_csv
from tillstar.__main__ import main


def test_load_then_report(spark, tmpdir_path, capsys):
    csv_path = os.path.join(tmpdir_path, "export.csv")
    wh = os.path.join(tmpdir_path, "wh")
    write_csv(csv_path, [
        {"Row ID": "1", "Order ID": "O-1", "Product ID": "P-1", "Region": "East", "Sales": "$1,000.00"},
        {"Row ID": "2", "Order ID": "O-2", "Product ID": "P-2", "Region": "West", "Customer ID": "C-2",
         "Sales": "250"},
    ])
    assert main(["load", csv_path, wh]) == 0
    assert "fact_sales: 2 rows" in capsys.readouterr().out
    assert main(["report", "sales_by_region", wh]) == 0
    out = capsys.readouterr().out
    assert "East" in out and "West" in out and "1000.0" in out
    assert main(["profile", csv_path]) == 0
    assert "customer_name" in capsys.readouterr().out
