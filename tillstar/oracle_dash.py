"""Oracle SQL (DuckDB) for the dashboard sheets and calculations."""

from __future__ import annotations

from .oracle import with_star

# Parameters used by the registered dashboard queries (see registry).
from .parameters import CATEGORIES, F_CUTS, M_SCALE, REGIONS, SEGMENTS, YEARS


def _in(vals):
    return "(" + ", ".join(f"'{v}'" for v in vals) + ")"


OSALES = """
os AS (SELECT l_orderkey, SUM(sales) AS sales, SUM(profit) AS profit FROM fact GROUP BY l_orderkey),
v AS (SELECT os.*, o.*, c.region, c.segment, c.city, c.state, c.customer_name
      FROM os JOIN ord o ON os.l_orderkey = o.o_orderkey JOIN cust c ON o.o_custkey = c.c_custkey),
y AS (SELECT order_year AS year, CAST(SUM(sales) AS DOUBLE) AS sales FROM v GROUP BY order_year),
m AS (SELECT order_year AS year, order_month AS month, CAST(SUM(sales) AS DOUBLE) AS sales FROM v
      GROUP BY order_year, order_month)"""


def _r6(x):
    return f"CAST(ROUND({x}, 6) AS DOUBLE)"


def dash_sql() -> dict[str, str]:
    lo, hi = YEARS
    rfm_lod = f"""
lod AS (SELECT customer_key, max(order_date) AS last_order, COUNT(*) AS frequency, SUM(sales) AS monetary
        FROM v GROUP BY customer_key),
asofd AS (SELECT max(order_date) AS d FROM v),
sc AS (
  SELECT customer_key, last_order, CAST(asofd.d - last_order AS BIGINT) AS recency, frequency,
         CAST(monetary AS DOUBLE) AS monetary_d, monetary
  FROM lod, asofd),
rfm AS (
  SELECT customer_key, last_order, recency, frequency, monetary_d AS monetary,
    CAST(CASE WHEN recency <= 30 THEN 5 WHEN recency <= 60 THEN 4 WHEN recency <= 120 THEN 3
              WHEN recency <= 365 THEN 2 ELSE 1 END AS BIGINT) AS r_score,
    CAST(CASE {' '.join(f'WHEN frequency >= {bound} THEN {score}' for score, bound in F_CUTS)} ELSE 1 END AS BIGINT) AS f_score,
    CAST(CASE WHEN monetary >= {10000 * M_SCALE} THEN 5 WHEN monetary >= {5000 * M_SCALE} THEN 4
              WHEN monetary >= {2000 * M_SCALE} THEN 3 WHEN monetary >= {500 * M_SCALE} THEN 2 ELSE 1 END AS BIGINT) AS m_score
  FROM sc)"""
    cells = """
cells AS (
  SELECT c.region, p.category, SUM(f.sales) AS s, SUM(f.profit) AS p, CAST(SUM(f.sales) AS DOUBLE) AS sales, CAST(SUM(f.profit) AS DOUBLE) AS profit
  FROM fact f JOIN prod p ON f.l_partkey = p.p_partkey JOIN ord o ON f.l_orderkey = o.o_orderkey
  JOIN cust c ON o.o_custkey = c.c_custkey GROUP BY c.region, p.category),
cells2 AS (SELECT *, SUM(cells.p) OVER (PARTITION BY category) AS cat_profit,
                  CASE WHEN sales <> 0 THEN profit / sales END AS ratio FROM cells),
cum AS (
  SELECT region, category, sales, profit, ROUND(ratio, 6) AS profit_ratio,
         ROUND(SUM(ratio) OVER (PARTITION BY region ORDER BY cat_profit DESC, category
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS running_ratio,
         SUM(ratio) OVER (PARTITION BY region ORDER BY cat_profit DESC, category
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS unrounded
  FROM cells2)"""
    return {
        "yoy_year": with_star(OSALES + f""",
q AS (SELECT year, sales, LAG(sales) OVER (ORDER BY year) AS prev FROM y)
SELECT year, sales, {_r6("CASE WHEN prev <> 0 THEN (sales - prev) / abs(prev) END")} AS yoy_pct FROM q"""),
        "yoy12": with_star(OSALES + f""",
q AS (SELECT year, month, sales, LAG(sales, 12) OVER (ORDER BY year, month) AS prev FROM m)
SELECT year, month, sales, {_r6("CASE WHEN prev <> 0 THEN (sales - prev) / prev END")} AS yoy12 FROM q"""),
        "pct_diff_month": with_star(OSALES + f""",
q AS (SELECT year, month, sales, LAG(sales) OVER (ORDER BY year, month) AS prev FROM m)
SELECT year, month, sales, {_r6("CASE WHEN prev <> 0 THEN (sales - prev) / abs(prev) END")} AS pct_diff FROM q"""),
        "pct_diff_day": with_star(OSALES + f""",
d AS (SELECT order_date, CAST(SUM(sales) AS DOUBLE) AS sales FROM v GROUP BY order_date),
q AS (SELECT order_date, sales, LAG(sales) OVER (ORDER BY order_date) AS prev FROM d)
SELECT order_date, sales, {_r6("CASE WHEN prev <> 0 THEN (sales - prev) / abs(prev) END")} AS pct_diff FROM q"""),
        "sales_mavg": with_star(f"""
y AS (SELECT CAST(date_trunc('year', o.order_date) AS DATE) AS year_start, CAST(SUM(f.sales) AS DOUBLE) AS sales, COUNT(p.category) AS category_count
      FROM line f LEFT JOIN prod p ON f.l_partkey = p.p_partkey JOIN ord o ON f.l_orderkey = o.o_orderkey GROUP BY 1)
SELECT year_start, sales, category_count,
  {_r6("AVG(sales) OVER (ORDER BY year_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)")} AS mavg3,
  {_r6("AVG(sales) OVER (ORDER BY category_count, year_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)")} AS mavg3_by_count FROM y"""),
        "cagr2": with_star(OSALES + f""",
q AS (SELECT year, sales, LAG(sales, 2) OVER (ORDER BY year) AS prev FROM y)
SELECT year, sales, {_r6("CASE WHEN prev > 0 AND sales > 0 THEN pow(sales / prev, 1.0 / 2) - 1 END")} AS cagr2 FROM q"""),
        "sales_trends": with_star(OSALES + f""",
f AS (SELECT * FROM v WHERE order_year BETWEEN {lo} AND {hi} AND region IN {_in(REGIONS)}
      AND segment IN {_in(SEGMENTS)}),
g AS (
  SELECT 'quarter' AS grain, CAST(quarter(order_date) AS BIGINT) AS period, SUM(sales) AS s FROM f GROUP BY 1, 2
  UNION ALL SELECT 'month', order_month, SUM(sales) FROM f GROUP BY 1, 2
  UNION ALL SELECT 'year', order_year, SUM(sales) FROM f GROUP BY 1, 2)
SELECT grain, period, CAST(s AS DOUBLE) AS sales,
  {_r6("AVG(CAST(s AS DOUBLE)) OVER (PARTITION BY grain ORDER BY period ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)")} AS mavg3
FROM g"""),
        "sales_trends_categories": with_star(f"""
os AS (SELECT f.l_orderkey, SUM(f.sales) AS sales FROM fact f JOIN prod p ON f.l_partkey = p.p_partkey
       WHERE p.category IN {_in(CATEGORIES)} GROUP BY f.l_orderkey),
f AS (SELECT os.sales, o.* FROM os JOIN ord o ON os.l_orderkey = o.o_orderkey WHERE o.order_year BETWEEN {lo} AND {hi}),
g AS (
  SELECT 'quarter' AS grain, CAST(quarter(order_date) AS BIGINT) AS period, SUM(sales) AS s FROM f GROUP BY 1, 2
  UNION ALL SELECT 'month', order_month, SUM(sales) FROM f GROUP BY 1, 2
  UNION ALL SELECT 'year', order_year, SUM(sales) FROM f GROUP BY 1, 2)
SELECT grain, period, CAST(s AS DOUBLE) AS sales,
  {_r6("AVG(CAST(s AS DOUBLE)) OVER (PARTITION BY grain ORDER BY period ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)")} AS mavg3
FROM g"""),
        "cum_profit_ratio": with_star(cells + "\nSELECT * EXCLUDE (unrounded) FROM cum"),
        "profit_heatmap": with_star(cells + "\nSELECT * EXCLUDE (unrounded) FROM cum "
                                    "WHERE unrounded BETWEEN -0.22136745269143338 AND 0.56523045958457452"),
        "heatmap_pivot": with_star(cells + "\nSELECT region, " + ", ".join(
            f"SUM(profit) FILTER (category = '{c}') AS {c}" for c in CATEGORIES) + " FROM cells GROUP BY region"),
        "top_names": with_star(OSALES + """
SELECT customer_name, CAST(SUM(sales) AS DOUBLE) AS sales, CAST(SUM(profit) AS DOUBLE) AS profit
FROM v GROUP BY customer_name ORDER BY SUM(sales) DESC, customer_name LIMIT 10"""),
        "rfm_scores": with_star(OSALES + "," + rfm_lod + """
SELECT customer_key, last_order, recency, frequency, monetary, r_score, f_score, m_score,
       r_score * 100 + f_score * 10 + m_score AS rfm_code FROM rfm"""),
        "rfm_matrix": with_star(OSALES + "," + rfm_lod + f"""
SELECT r_score, f_score, CAST(ROUND(SUM(monetary), 2) AS DOUBLE) AS monetary, COUNT(*) AS customers
FROM rfm JOIN cust USING (customer_key)
WHERE segment IN {_in(SEGMENTS)} AND r_score * 100 + f_score * 10 + m_score BETWEEN 111 AND 123
GROUP BY r_score, f_score"""),
        "rfm_matrix_all": with_star(OSALES + "," + rfm_lod + """
SELECT r_score, f_score, CAST(ROUND(SUM(monetary), 2) AS DOUBLE) AS monetary, COUNT(*) AS customers
FROM rfm GROUP BY r_score, f_score"""),
        "state_city_rollup": with_star(OSALES + """
SELECT state, city, CAST(GROUPING_ID(state, city) AS BIGINT) AS level, CAST(SUM(sales) AS DOUBLE) AS sales
FROM v GROUP BY ROLLUP (state, city)"""),
        "discount_trend": with_star(f"""
y AS (SELECT o.order_year AS year, CAST(SUM(f.discount) AS DOUBLE) AS discount_sum, COUNT(p.category) AS category_count
      FROM line f JOIN prod p ON f.l_partkey = p.p_partkey JOIN ord o ON f.l_orderkey = o.o_orderkey
      GROUP BY o.order_year)
SELECT year, discount_sum, category_count,
  {_r6("AVG(discount_sum) OVER (ORDER BY year ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)")} AS mavg3 FROM y"""),
        "snapshot_years": with_star(f"""
s AS (SELECT f.l_orderkey, f.l_partkey, o.o_custkey, o.order_year FROM line f JOIN ord o ON f.l_orderkey = o.o_orderkey
      WHERE o.order_year BETWEEN {lo} AND {hi})
SELECT order_year AS year, COUNT(*) AS n_lines, COUNT(DISTINCT l_orderkey) AS n_orders,
       COUNT(DISTINCT o_custkey) AS n_customers, COUNT(DISTINCT l_partkey) AS n_products
FROM s GROUP BY order_year"""),
    }


def profile_sql() -> str:
    from .oracle_etl import single_batch_prefix, RAW_COLS
    from .operators.profile import MISSING_MARKERS, PROFILE_NUMERIC, PROFILE_TEXT

    markers = ", ".join("'" + m.replace("'", "''") + "'" for m in MISSING_MARKERS)
    cols = ", ".join(RAW_COLS)
    return single_batch_prefix() + f""",
lg AS (SELECT * FROM (SELECT {cols} FROM raw0) UNPIVOT INCLUDE NULLS (value FOR column_name IN ({cols}))),
x AS (
  SELECT column_name, value, (value IS NULL OR value IN ({markers})) AS missing,
         CASE WHEN value IS NULL OR value IN ({markers}) THEN NULL ELSE value END AS present
  FROM lg),
y AS (
  SELECT *, CASE WHEN column_name IN {_in(PROFILE_NUMERIC)}
                 THEN TRY_CAST(regexp_replace(present, '[$,]', '', 'g') AS DECIMAL(38,10)) END AS num
  FROM x)
SELECT column_name,
  CAST(SUM(CASE WHEN missing THEN 1 ELSE 0 END) AS BIGINT) AS nulls,
  COUNT(DISTINCT present) AS distinct_count,
  CAST(MAX(CASE WHEN column_name IN {_in(PROFILE_TEXT)} THEN length(present) END) AS BIGINT) AS maxlen,
  CAST(MIN(num) AS DOUBLE) AS min_value, CAST(MAX(num) AS DOUBLE) AS max_value,
  CAST(ROUND(AVG(num), 6) AS DOUBLE) AS mean_value,
  CAST(MAX(CASE WHEN num IS NOT NULL THEN length(regexp_extract(regexp_replace(present, '[$,]', '', 'g'),
       '\\.(\\d+)$', 1)) END) AS BIGINT) AS max_scale
FROM y GROUP BY column_name"""


def forecast_source_sql() -> str:
    return with_star("""
SELECT l.l_partkey AS product_id, p.product_key, p.category, o.order_date, CAST(l.sales AS DOUBLE) AS sales
FROM line l JOIN ord o ON l.l_orderkey = o.o_orderkey LEFT JOIN prod p ON l.l_partkey = p.p_partkey""")


def forecast_sql() -> str:
    return with_star("""
src AS (
  SELECT l.l_partkey AS product_id, p.product_key, p.category, o.order_date, l.sales
  FROM line l JOIN ord o ON l.l_orderkey = o.o_orderkey LEFT JOIN prod p ON l.l_partkey = p.p_partkey),
mo AS (
  SELECT product_id, product_key, category, CAST(date_trunc('month', order_date) AS DATE) AS month,
         SUM(sales) AS ms
  FROM src WHERE product_key IS NOT NULL AND category IS NOT NULL GROUP BY 1, 2, 3, 4),
fe AS (
  SELECT product_id, product_key, category, month, CAST(ms AS DOUBLE) AS monthly_sales,
    CAST(LAG(ms, 1) OVER w AS DOUBLE) AS lag_1, CAST(LAG(ms, 2) OVER w AS DOUBLE) AS lag_2,
    CAST(LAG(ms, 3) OVER w AS DOUBLE) AS lag_3,
    CAST(SUM(ms) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS DOUBLE)
      / CAST(COUNT(ms) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS DOUBLE) AS roll3_mean,
    CAST(SUM(ms) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE)
      / CAST(COUNT(ms) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE) AS prod_mean_sales,
    CAST(month(month) AS BIGINT) AS month_of_year,
    CAST(LEAD(ms, 1) OVER w AS DOUBLE) AS next_month
  FROM mo WINDOW w AS (PARTITION BY product_id ORDER BY month))
SELECT * FROM fe WHERE lag_1 IS NOT NULL AND next_month IS NOT NULL""")


def ridge_sql() -> dict[str, str]:
    """The forecast's model and scores: the normal equations in long form, solved by elimination, a pivot a step. The matrix has a
    positive definite block for all but the last unknown, so its order needs no exchange."""
    numeric = ["lag_1", "lag_2", "lag_3", "roll3_mean", "prod_mean_sales"]
    z = lambda c: f"(coalesce({c}, 0) - m_{c}) / s_{c}"
    stats = ", ".join(f"AVG(coalesce({c}, 0)) AS m_{c}, CASE WHEN STDDEV_POP(coalesce({c}, 0)) > 0 THEN STDDEV_POP(coalesce({c}, 0)) ELSE 1 END AS s_{c}"
                      for c in numeric)
    features = forecast_sql().rpartition("SELECT * FROM fe")[0]
    entries = " UNION ALL ".join([f"SELECT id, 'n_{c}' AS term, {z(c)} AS v, next_month AS y FROM tr, st" for c in numeric]
                                 + ["SELECT id, 'm_' || month_of_year, 1.0, next_month FROM tr", "SELECT id, 'c_' || category, 1.0, next_month FROM tr",
                                    "SELECT id, 'z', 1.0, next_month FROM tr"])
    kinds = "CASE t[1:1] WHEN 'n' THEN 1 WHEN 'm' THEN 2 WHEN 'c' THEN 3 ELSE 4 END"
    numbers = " + ".join(f"{z(c)} * coalesce((SELECT w FROM weight WHERE term = 'n_{c}'), 0)" for c in numeric)
    body = features.replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + f""",
ok AS (SELECT * FROM fe WHERE lag_1 IS NOT NULL AND next_month IS NOT NULL),
cut AS (SELECT MAX(month) AS last FROM ok),
tr AS (SELECT row_number() OVER () AS id, ok.* FROM ok, cut WHERE month < last),
te AS (SELECT ok.* FROM ok, cut WHERE month = last),
st AS (SELECT {stats} FROM tr),
x AS ({entries}),
ix AS (SELECT term, row_number() OVER (ORDER BY kind, term) AS i FROM (SELECT DISTINCT term, {kinds.replace("t[", "term[")} AS kind FROM x)),
size AS (SELECT COUNT(*) AS d FROM ix),
gram AS (SELECT a.term AS ta, b.term AS tb, SUM(a.v * b.v) AS v FROM x a JOIN x b ON a.id = b.id GROUP BY 1, 2),
eq AS (
  SELECT p.i, q.i AS j, coalesce(g.v, 0) + CASE WHEN p.i = q.i AND p.term <> 'z' THEN 1.0 ELSE 0 END AS v
  FROM ix p CROSS JOIN ix q LEFT JOIN gram g ON g.ta = p.term AND g.tb = q.term
  UNION ALL SELECT ix.i, size.d + 1, SUM(x.v * x.y) FROM x JOIN ix ON ix.term = x.term, size GROUP BY ix.i, size.d),
elim AS (
  SELECT 1 AS k, i, j, v FROM eq
  UNION ALL
  SELECT k + 1, i, j, CASE WHEN i = k THEN v / pv ELSE v - cv * rv / pv END
  FROM (SELECT k, i, j, v, MAX(CASE WHEN i = k AND j = k THEN v END) OVER () AS pv,
               MAX(CASE WHEN j = k THEN v END) OVER (PARTITION BY i) AS cv, MAX(CASE WHEN i = k THEN v END) OVER (PARTITION BY j) AS rv FROM elim), size
  WHERE k <= d),
weight AS (SELECT ix.term, e.v AS w FROM elim e JOIN ix ON ix.i = e.i, size WHERE e.k = size.d + 1 AND e.j = size.d + 1),
sc AS (
  SELECT te.*, {numbers} + coalesce(wm.w, 0) + coalesce(wc.w, 0) + (SELECT w FROM weight WHERE term = 'z') AS pred
  FROM te CROSS JOIN st LEFT JOIN weight wm ON wm.term = 'm_' || te.month_of_year LEFT JOIN weight wc ON wc.term = 'c_' || te.category)"""
    scores = body + """
SELECT product_id, product_key, month, monthly_sales, next_month, CAST(ROUND(pred, 2) AS DOUBLE) AS pred_next_month FROM sc"""
    metrics = body + """
SELECT COUNT(*) AS test_rows, CAST(ROUND(AVG(abs(next_month - pred)), 3) AS DOUBLE) AS mae,
       CAST(ROUND(sqrt(AVG((next_month - pred) * (next_month - pred))), 3) AS DOUBLE) AS rmse,
       CAST(ROUND(1 - SUM((next_month - pred) * (next_month - pred)) / NULLIF(VAR_POP(next_month) * COUNT(*), 0), 6) AS DOUBLE) AS r2 FROM sc"""
    return {"forecast_scores": scores, "forecast_stored_model": scores, "forecast_metrics": metrics}
