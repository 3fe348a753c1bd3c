"""Oracle SQL (DuckDB dialect) for every registered query.

Each statement runs on the source tables registered as views and must return the same
columns, names and values as the Spark query of the same name. The star mapping is repeated
here in SQL (see ``plans/star.py``) so the two sides are independent implementations.
"""

from __future__ import annotations

STAR_CTES = """
geo AS (
  SELECT n.n_nationkey AS nationkey, n.n_name AS city, n.n_name AS state,
         CASE WHEN n.n_nationkey % 5 = 0 THEN NULL ELSE CAST(n.n_nationkey AS VARCHAR) END AS postal_code,
         r.r_name AS region
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
cust AS (
  SELECT c.c_custkey, CAST(c.c_custkey AS VARCHAR) AS customer_key, c.c_name AS customer_name,
         c.c_mktsegment AS segment, g.city, g.state, g.postal_code, g.region
  FROM customer c JOIN geo g ON c.c_nationkey = g.nationkey),
ord AS (
  SELECT o_orderkey, o_custkey, CAST(o_orderkey AS VARCHAR) AS order_key,
         CAST(o_custkey AS VARCHAR) AS customer_key, CAST(o_orderdate AS DATE) AS order_date,
         o_orderpriority AS ship_mode,
         CAST(year(o_orderdate) AS BIGINT) AS order_year, CAST(month(o_orderdate) AS BIGINT) AS order_month
  FROM orders),
prod AS (
  SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS product_key, p_name AS product_name,
         p_type AS category, p_brand AS sub_category, CAST(p_retailprice AS DECIMAL(12,2)) AS retail_price
  FROM part),
line AS (
  SELECT l_orderkey, l_partkey, CAST(l_quantity AS INTEGER) AS quantity,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(3,2))) AS DECIMAL(12,4)) AS sales,
         CAST(l_discount AS DECIMAL(3,2)) AS discount, CAST(l_shipdate AS DATE) AS ship_date
  FROM lineitem),
fact AS (
  SELECT l.*, CAST(l.sales - CAST(l.quantity AS DECIMAL(5,0)) * p.retail_price AS DECIMAL(12,4)) AS profit
  FROM line l JOIN prod p ON l.l_partkey = p.p_partkey)
"""


def with_star(body: str) -> str:
    return "WITH " + STAR_CTES.strip() + ",\n" + body.strip()


def _sales_by_region(limit: str = "") -> str:
    return with_star(f"""
q AS (
  SELECT c.region, COUNT(DISTINCT f.l_orderkey) AS orders, SUM(f.quantity) AS total_qty,
         SUM(f.sales) AS s, SUM(f.profit) AS p
  FROM fact f JOIN ord o ON f.l_orderkey = o.o_orderkey JOIN cust c ON o.o_custkey = c.c_custkey
  GROUP BY c.region)
SELECT region, orders, CAST(total_qty AS BIGINT) AS total_qty,
       CAST(ROUND(s, 2) AS DOUBLE) AS total_sales, CAST(ROUND(p, 2) AS DOUBLE) AS total_profit,
       CAST(ROUND(100 * p / NULLIF(s, 0), 2) AS DOUBLE) AS profit_margin_pct
FROM q ORDER BY total_sales DESC NULLS FIRST, region {limit}""")


def _monthly_trend(rnd: bool = False, limit: str = "") -> str:
    s = "ROUND(SUM(f.sales), 2)" if rnd else "SUM(f.sales)"
    p = "ROUND(SUM(f.profit), 2)" if rnd else "SUM(f.profit)"
    return with_star(f"""
q AS (
  SELECT o.order_year, o.order_month, CAST({s} AS DOUBLE) AS month_sales,
         CAST({p} AS DOUBLE) AS month_profit, COUNT(DISTINCT o.o_orderkey) AS orders_count
  FROM fact f JOIN ord o ON f.l_orderkey = o.o_orderkey
  GROUP BY o.order_year, o.order_month)
SELECT * FROM q ORDER BY order_year, order_month {limit}""")


def _top_customers(rnd: bool = False) -> str:
    s = "ROUND(SUM(f.sales), 2)" if rnd else "SUM(f.sales)"
    p = "ROUND(SUM(f.profit), 2)" if rnd else "SUM(f.profit)"
    return with_star(f"""
q AS (
  SELECT c.customer_key, c.customer_name, COUNT(DISTINCT o.o_orderkey) AS orders_count,
         SUM(f.sales) AS raw_s, CAST({s} AS DOUBLE) AS total_sales, CAST({p} AS DOUBLE) AS total_profit
  FROM fact f JOIN ord o ON f.l_orderkey = o.o_orderkey JOIN cust c ON o.o_custkey = c.c_custkey
  GROUP BY c.customer_key, c.customer_name)
SELECT customer_key, customer_name, orders_count, total_sales, total_profit
FROM q ORDER BY raw_s DESC, customer_key LIMIT 10""")


def _top_products(rnd: bool = False) -> str:
    s = "ROUND(SUM(f.sales), 2)" if rnd else "SUM(f.sales)"
    p = "ROUND(SUM(f.profit), 2)" if rnd else "SUM(f.profit)"
    return with_star(f"""
q AS (
  SELECT p.product_key, p.product_name, p.category, p.sub_category,
         CAST({s} AS DOUBLE) AS total_sales, SUM(f.profit) AS raw_p, CAST({p} AS DOUBLE) AS total_profit,
         CAST(SUM(f.quantity) AS BIGINT) AS total_qty
  FROM fact f JOIN prod p ON f.l_partkey = p.p_partkey
  GROUP BY p.product_key, p.product_name, p.category, p.sub_category)
SELECT product_key, product_name, category, sub_category, total_sales, total_profit, total_qty
FROM q ORDER BY raw_p DESC, product_key LIMIT 10""")


REPORTS = {
    "sales_by_region": _sales_by_region(),
    "monthly_trend": _monthly_trend(),
    "top_customers": _top_customers(),
    "top_products": _top_products(),
    "by_ship_mode": with_star("""
q AS (
  SELECT o.ship_mode, CAST(SUM(f.sales) AS DOUBLE) AS total_sales, CAST(SUM(f.profit) AS DOUBLE) AS total_profit,
         CAST(ROUND(SUM(f.discount) / COUNT(*), 6) AS DOUBLE) AS avg_discount,
         COUNT(DISTINCT o.o_orderkey) AS orders_count
  FROM fact f JOIN ord o ON f.l_orderkey = o.o_orderkey
  GROUP BY o.ship_mode)
SELECT * FROM q ORDER BY total_sales DESC"""),
    "chat_sales_by_region": _sales_by_region("LIMIT 50"),
    "chat_monthly_trend": _monthly_trend(True, "LIMIT 200"),
    "chat_top_customers": _top_customers(True),
    "chat_top_products": _top_products(True),
}

_W = r"[^\p{L}\p{N}_]"


def _words(words: list[str]) -> str:
    return f"regexp_matches(lower(text), '(^|{_W})({'|'.join(words)})({_W}|$)')"


def _route_sql() -> str:
    from .functions.intent import INTENT_RULES

    cases = "\n".join(
        f"    WHEN {_words(a)} AND {_words(b)} THEN '{name}'" for name, a, b in INTENT_RULES
    )
    return f"""
SELECT intent, COUNT(*) AS n FROM (
  SELECT CASE
{cases}
    ELSE NULL END AS intent
  FROM conversations) t
GROUP BY intent"""


def _rendered_sql() -> str:
    from .functions.intent import INTENT_RULES
    from .parameters import QUESTIONS

    cases = "\n".join(f"    WHEN {_words(a)} AND {_words(b)} THEN '{name}'" for name, a, b in INTENT_RULES)
    asked = ", ".join("'" + q.replace("'", "''") + "'" for q in QUESTIONS)
    return f"""
SELECT question, CASE
{cases}
    ELSE NULL END AS intent, COUNT(*) AS n FROM (
  SELECT question, question || ' ' || coalesce(text, '') AS text FROM (
    SELECT [{asked}][1 + (((conv_id * 7 + turn) % {len(QUESTIONS)} + {len(QUESTIONS)}) % {len(QUESTIONS)})] AS question, text FROM conversations) q) t
GROUP BY 1, 2"""


ROUTER = {"route_questions": _route_sql(), "route_rendered": _rendered_sql()}


def all_sql() -> dict[str, str]:
    from .oracle_dash import dash_sql, forecast_source_sql, forecast_sql, profile_sql, ridge_sql
    from .oracle_etl import etl_sql, roles_sql

    out: dict[str, str] = {}
    for part in (REPORTS, ROUTER, etl_sql(), roles_sql(), dash_sql()):
        out.update(part)
    out["profile_columns"] = out["profile_stored"] = profile_sql()
    out["forecast_features"] = forecast_sql()
    out["forecast_source"] = forecast_source_sql()
    out.update(ridge_sql())
    out["csv_ranges"] = out["row_hash"]
    out["sql_source"] = """
SELECT l.l_partkey AS product_id, 'P-' || p.p_partkey AS product_ref, p.p_type AS category, CAST(o.o_orderdate AS DATE) AS order_date,
       CAST(l.l_quantity AS DOUBLE) AS quantity
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey LEFT JOIN part p ON l.l_partkey = p.p_partkey"""
    amounts = [f"'\"{c}\":' || CAST(CAST({c} AS DECIMAL(20, 2)) AS VARCHAR)" for c in ("total_sales", "total_profit", "profit_margin_pct")]
    out["report_json"] = f"""
WITH r AS (SELECT * FROM ({_sales_by_region("LIMIT 50")}) ORDER BY total_sales DESC NULLS FIRST, region LIMIT 8)
SELECT '[' || string_agg('{{"region":"' || region || '","orders":' || orders || ',"total_qty":' || total_qty || ',' || {" || ',' || ".join(amounts)} || '}}', ','
       ORDER BY total_sales DESC NULLS FIRST, region) || ']' AS json FROM r"""
    return out
