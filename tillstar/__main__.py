"""Command line: ``python -m tillstar <command> ...``

* ``load CSV_PATH WAREHOUSE_ROOT`` — read a raw order-line export (Windows-1252, multi-line
  quoted fields) and load it onto the warehouse tables under WAREHOUSE_ROOT (created if empty).
* ``report NAME WAREHOUSE_ROOT [--rows N]`` — one of the five sales reports over the stored
  warehouse tables (sales_by_region, monthly_trend, top_customers, top_products, by_ship_mode).
* ``profile CSV_PATH`` — column profile of a raw export.
* ``query NAME SOURCE_DIR [--rows N]`` — any registered query over a folder of source tables.

Reads ``spark.checkpoint.dir`` from the session (set it to shared storage on a cluster).
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tillstar")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("load")
    p.add_argument("csv_path")
    p.add_argument("warehouse_root")
    p = sub.add_parser("report")
    p.add_argument("name")
    p.add_argument("warehouse_root")
    p.add_argument("--rows", type=int, default=50)
    p = sub.add_parser("profile")
    p.add_argument("csv_path")
    p = sub.add_parser("query")
    p.add_argument("name")
    p.add_argument("source_dir")
    p.add_argument("--rows", type=int, default=50)
    args = ap.parse_args(argv)

    from .session import get_spark

    spark = get_spark()
    if args.cmd == "load":
        from .plans.warehouse import run_etl
        from .sources.csv_ranges import read_raw_csv_ranges

        snap = run_etl(read_raw_csv_ranges(spark, args.csv_path), args.warehouse_root)
        for name, df in snap.tables.items():
            print(f"{name}: {df.count()} rows")
        snap.fact_rejects.groupBy("reject_reason").count().show(truncate=False)
        snap.order_rejects.groupBy().count().withColumnRenamed("count", "orders_rejected").show()
    elif args.cmd == "report":
        from .plans.star_reports import REPORTS
        from .plans.warehouse import read_snapshot

        snap = read_snapshot(spark, args.warehouse_root)
        if snap is None:
            print(f"no warehouse tables under {args.warehouse_root}", file=sys.stderr)
            return 1
        REPORTS[args.name](snap.tables).show(args.rows, truncate=False)
    elif args.cmd == "profile":
        from .functions import clean
        from .operators.profile import PROFILE_NUMERIC, PROFILE_TEXT, profile_columns
        from .sources.csv import read_profile_csv

        raw = clean.ensure_columns(clean.rename_headers(read_profile_csv(spark, args.csv_path)))
        profile_columns(raw, PROFILE_TEXT, PROFILE_NUMERIC).show(50, truncate=False)
    elif args.cmd == "query":
        from .registry import all_queries

        all_queries()[args.name](spark, args.source_dir).show(args.rows, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
