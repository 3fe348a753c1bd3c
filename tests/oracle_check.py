"""Compare registered Spark queries with their DuckDB oracle SQL.

Mirrors the driver's gate: row count, column names, and an order-insensitive comparison of
values (columns sorted by name, floats rounded to 6 decimals). Usable from pytest and as a
script: ``python tests/oracle_check.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

VIEWS = ("region nation customer supplier part orders lineitem events documents embeddings "
         "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for v in VIEWS:
        path = f"{sf_dir}/{v}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, name: str, sf_dir: str, fn, sql: str) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "spark_sec": round(t1 - t0, 2)}
    out["cols_match"] = sorted(s_cols) == sorted(d_cols)
    if not out["cols_match"]:
        out["spark_cols"], out["oracle_cols"] = sorted(s_cols), sorted(d_cols)
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    out["values_match"] = a == b
    if not out["values_match"]:
        sa, sb = set(a), set(b)
        diff_a = [r for r in a if r not in sb][:3]
        diff_b = [r for r in b if r not in sa][:3]
        out["spark_only"], out["oracle_only"] = diff_a, diff_b
    out["ok"] = out["cols_match"] and out["values_match"] and len(s_rows) == len(d_rows)
    return out


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from tillstar.session import get_spark

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = get_spark()
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            n = qs[name](spark, sf_dir).count()
            print(f"-- {name}: rows-only ({n} rows)")
            continue
        try:
            r = compare(spark, con, name, sf_dir, qs[name], sqls[name])
        except Exception as exc:  # report and continue with the next query
            bad += 1
            print(f"!! {name}: {type(exc).__name__}: {str(exc)[:400]}")
            continue
        flag = "ok" if r["ok"] else "MISMATCH"
        bad += 0 if r["ok"] else 1
        print(f"{flag:8s} {name}: {r}" if not r["ok"] else
              f"{flag:8s} {name}: rows={r['spark_rows']} {r['spark_sec']}s")
    print(f"{bad} failing of {len(names or qs)}")


if __name__ == "__main__":
    main(sys.argv[1:])
