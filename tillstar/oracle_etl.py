"""Oracle SQL (DuckDB) for raw text, cleaning, staging and the two-batch warehouse load.

Written from the rules, not from the Spark code: surrogate ids are ``ROW_NUMBER`` over the
natural key (NULL parts first) after the previous maximum; survivors per key are the
smallest ``row_id``; NULL-safe location matching is ``IS NOT DISTINCT FROM``.
"""

from __future__ import annotations

GEO = """
geo AS (
  SELECT n.n_nationkey AS nationkey, n.n_name AS city, n.n_name AS state,
         CASE WHEN n.n_nationkey % 5 = 0 THEN NULL ELSE CAST(n.n_nationkey AS VARCHAR) END AS postal_code,
         r.r_name AS region
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"""


def _date_text(d: str, sel: str) -> str:
    return (f"CASE WHEN {sel} = 1 THEN strftime({d}, '%-m/%-d/%Y') WHEN {sel} = 2 THEN strftime({d}, '%m/%d/%Y') "
            f"ELSE strftime({d}, '%Y-%m-%d') END")


def raw_cte(b: str, batch: int | None, whole: bool = False) -> str:
    """Raw text rows (staging column names) of one batch, as CTE ``raw{b}``."""
    where = ""
    if batch == 1:
        where = "WHERE o.o_orderdate < TIMESTAMP '1999-01-01'"
    elif batch == 2:
        where = "WHERE o.o_orderdate >= TIMESTAMP '1998-01-01'" + (
            "" if whole else " AND (o.o_orderdate >= TIMESTAMP '1999-01-01' OR l.l_linenumber <= 3)")
    b2 = batch == 2
    cname = "c_name || ' II'" if b2 else "c_name"
    pname_base = "CASE WHEN v = 3 THEN '  ' || p_name || ' ' ELSE p_name END"
    pname = f"upper({pname_base})" if b2 else pname_base
    ship_mode = "lower(o_orderpriority)" if b2 else "o_orderpriority"
    noloc = "c_custkey % 4 = 0" if b2 else "FALSE"

    def loc(c):
        return f"CASE WHEN {noloc} THEN NULL ELSE {c} END"

    return f"""
src{b} AS (
  SELECT l.*, l.l_linenumber AS v, o.*, c.*, g.*, p.*,
         CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(3,2))) AS DECIMAL(12,4)) AS s
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN geo g ON c.c_nationkey = g.nationkey
  JOIN part p ON l.l_partkey = p.p_partkey {where}),
src2{b} AS (
  SELECT *, CAST(s - CAST(CAST(l_quantity AS INTEGER) AS DECIMAL(5,0)) * CAST(p_retailprice AS DECIMAL(12,2)) AS DECIMAL(12,4)) AS pr,
         CAST(l_discount AS DECIMAL(3,2)) AS dd
  FROM src{b}),
raw{b} AS (
  SELECT
    printf('%012d-%02d-%012d-%010d', l_orderkey, v, l_partkey, l_suppkey) AS row_id,
    CASE WHEN v = 2 THEN ' ' || CAST(l_orderkey AS VARCHAR) || '  ' ELSE CAST(l_orderkey AS VARCHAR) END AS order_key,
    CASE WHEN l_orderkey % 97 = 0 THEN 'zz' ELSE {_date_text('CAST(o_orderdate AS DATE)', 'l_orderkey % 3')} END AS order_date,
    {_date_text('CAST(l_shipdate AS DATE)', 'v % 3')} AS ship_date,
    {ship_mode} AS ship_mode,
    CAST(o_custkey AS VARCHAR) AS customer_key,
    {cname} AS customer_name,
    c_mktsegment AS segment,
    region AS country,
    {loc('city')} AS city, {loc('state')} AS state, {loc('postal_code')} AS postal_code, {loc('region')} AS region,
    CAST(l_partkey AS VARCHAR) AS product_key,
    p_type AS category, p_brand AS sub_category,
    {pname} AS product_name,
    CASE WHEN v = 1 THEN '$' || format('{{:,.4f}}', s) WHEN v = 3 THEN '  ' || CAST(s AS VARCHAR) || ' '
         WHEN v = 4 THEN format('{{:,.4f}}', s) WHEN v = 7 THEN 'n/a' ELSE CAST(s AS VARCHAR) END AS sales,
    CASE WHEN v = 4 THEN CAST(l_quantity AS VARCHAR) WHEN v = 5 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '.7'
         ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
    CASE WHEN v <= 3 THEN CAST(dd AS VARCHAR) WHEN v <= 5 THEN CAST(CAST(dd * 100 AS INTEGER) AS VARCHAR)
         WHEN v = 6 THEN CAST(CAST(dd * 100 AS DECIMAL(5,2)) AS VARCHAR) ELSE '' END AS discount,
    CASE WHEN v = 1 THEN '$' || format('{{:,.4f}}', pr) ELSE CAST(pr AS VARCHAR) END AS profit
  FROM src2{b})"""


RAW_COLS = ["row_id", "order_key", "order_date", "ship_date", "ship_mode", "customer_key",
            "customer_name", "segment", "country", "city", "state", "postal_code", "region",
            "product_key", "category", "sub_category", "product_name", "sales", "quantity",
            "discount", "profit"]


def _num(t: str) -> str:
    return f"TRY_CAST(regexp_replace({t}, '[$,]', '', 'g') AS DECIMAL(38,10))"


def _norm_disc(d: str) -> str:
    return f"ROUND(CASE WHEN {d} > 1 THEN {d} * 0.01 ELSE {d} END, 2)"


def extract_cte(b: str) -> str:
    """Trim, clean and fingerprint: raw staging ``rs{b}``."""
    trims = ",\n    ".join(f"trim({c}) AS {c}" for c in RAW_COLS)
    hash_expr = "sha256(concat_ws('|', " + ", ".join(f"coalesce({c}, '')" for c in RAW_COLS) + "))"
    text_cols = [c for c in RAW_COLS if c not in ("sales", "quantity", "discount", "profit")]
    return f"""
tr{b} AS (SELECT {trims} FROM raw{b}),
rs{b} AS (
  SELECT {', '.join(text_cols)},
    TRY_CAST(ROUND({_num('sales')}, 4) AS DECIMAL(38,10)) AS sales,
    TRY_CAST(trunc(TRY_CAST(TRY_CAST(quantity AS DECIMAL(38,10)) AS DECIMAL(18,4))) AS INTEGER) AS quantity,
    TRY_CAST({_norm_disc(_num('discount'))} AS DECIMAL(38,10)) AS discount,
    TRY_CAST(ROUND({_num('profit')}, 4) AS DECIMAL(38,10)) AS profit,
    {hash_expr} AS row_hash
  FROM tr{b})"""


PLAIN = r"^[+-]?\d+(\.\d+)?$"


def _guard(t: str, strip: bool = True) -> str:
    x = f"regexp_replace({t}, '[$,]', '', 'g')" if strip else t
    return f"CASE WHEN regexp_full_match({x}, '{PLAIN}') THEN TRY_CAST({x} AS DECIMAL(38,10)) END"


def _pdate(t: str) -> str:
    return f"CAST(coalesce(try_strptime({t}, '%m/%d/%Y'), try_strptime({t}, '%Y-%m-%d')) AS DATE)"


def stage_cte(b: str) -> str:
    """Second pass over raw staging as text, then the five staging tables."""
    text_cols = [c for c in RAW_COLS if c not in ("sales", "quantity", "discount", "profit",
                                                  "order_date", "ship_date")]
    return f"""
st{b} AS (
  SELECT {', '.join(f'trim({c}) AS {c}' for c in text_cols)},
    TRY_CAST(ROUND({_guard('trim(CAST(sales AS VARCHAR))')}, 4) AS DECIMAL(38,10)) AS sales,
    TRY_CAST(ROUND({_guard('trim(CAST(profit AS VARCHAR))')}, 4) AS DECIMAL(38,10)) AS profit,
    TRY_CAST({_norm_disc(_guard('trim(CAST(discount AS VARCHAR))'))} AS DECIMAL(38,10)) AS discount,
    TRY_CAST(trunc({_guard('trim(CAST(quantity AS VARCHAR))', strip=False)}) AS INTEGER) AS quantity,
    {_pdate('trim(order_date)')} AS order_date,
    {_pdate('trim(ship_date)')} AS ship_date
  FROM rs{b}),
stg_loc{b} AS (SELECT DISTINCT city, state, postal_code, region FROM st{b}),
stg_prod{b} AS (
  SELECT product_key, product_name, category, sub_category FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY product_key ORDER BY row_id, product_name NULLS FIRST, category NULLS FIRST, sub_category NULLS FIRST) AS rn FROM st{b}) WHERE rn = 1),
stg_cust{b} AS (
  SELECT customer_key, customer_name, segment, city, state, postal_code, region FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_key ORDER BY row_id, customer_name NULLS FIRST, segment NULLS FIRST, city NULLS FIRST, state NULLS FIRST, postal_code NULLS FIRST, region NULLS FIRST) AS rn FROM st{b}) WHERE rn = 1),
stg_ord{b} AS (
  SELECT order_key, order_date, ship_date, ship_mode, city, state, postal_code, region FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY order_key ORDER BY row_id, order_date NULLS FIRST, ship_date NULLS FIRST, ship_mode NULLS FIRST, city NULLS FIRST, state NULLS FIRST, postal_code NULLS FIRST, region NULLS FIRST) AS rn FROM st{b}) WHERE rn = 1),
stg_lines{b} AS (
  SELECT row_id, order_key, product_key, customer_key, quantity, sales, discount, profit FROM st{b})"""


LOC_ORDER = "city NULLS FIRST, state NULLS FIRST, postal_code NULLS FIRST, region NULLS FIRST"
LOC_MATCH = ("{a}.city IS NOT DISTINCT FROM {b}.city AND {a}.state IS NOT DISTINCT FROM {b}.state AND "
             "{a}.postal_code IS NOT DISTINCT FROM {b}.postal_code AND {a}.region IS NOT DISTINCT FROM {b}.region")


def _loc_match(a: str, b: str) -> str:
    return LOC_MATCH.format(a=a, b=b)


def _cal(d: str) -> str:
    return (f"year({d}) AS year, quarter({d}) AS quarter, month({d}) AS month, day({d}) AS day, "
            f"dayofweek({d}) AS day_of_week, dayofweek({d}) IN (0, 6) AS is_weekend, FALSE AS is_holiday")


def load1_cte() -> str:
    """Batch 1 into an empty star: ids are ranks of the natural key."""
    return f"""
dates1 AS (
  SELECT DISTINCT full_date FROM (SELECT order_date AS full_date FROM stg_ord1 UNION ALL SELECT ship_date FROM stg_ord1)
  WHERE full_date IS NOT NULL),
dim_date1 AS (SELECT ROW_NUMBER() OVER (ORDER BY full_date) AS date_id, full_date, {_cal('full_date')} FROM dates1),
dim_loc1 AS (
  SELECT ROW_NUMBER() OVER (ORDER BY {LOC_ORDER}) AS location_id, city, state, postal_code, region
  FROM stg_loc1 WHERE NOT (city IS NULL AND state IS NULL AND postal_code IS NULL AND region IS NULL)),
dim_prod1 AS (
  SELECT ROW_NUMBER() OVER (ORDER BY product_key) AS product_id, product_key, product_name, category, sub_category
  FROM stg_prod1 WHERE product_key IS NOT NULL),
dim_cust1 AS (
  SELECT ROW_NUMBER() OVER (ORDER BY s.customer_key) AS customer_id, s.customer_key, s.customer_name, s.segment,
         l.location_id
  FROM stg_cust1 s LEFT JOIN dim_loc1 l ON {_loc_match('s', 'l')} WHERE s.customer_key IS NOT NULL),
ordc1 AS (
  SELECT s.order_key, s.order_date, s.ship_date, s.ship_mode, d1.date_id AS order_date_id, d2.date_id AS ship_date_id,
         l.location_id, year(s.order_date) AS order_year, month(s.order_date) AS order_month
  FROM stg_ord1 s LEFT JOIN dim_date1 d1 ON s.order_date = d1.full_date
  LEFT JOIN dim_date1 d2 ON s.ship_date = d2.full_date
  LEFT JOIN dim_loc1 l ON {_loc_match('s', 'l')} WHERE s.order_key IS NOT NULL),
dim_ord1 AS (
  SELECT ROW_NUMBER() OVER (ORDER BY order_key) AS order_id, order_key, order_date_id, ship_date_id, ship_mode,
         location_id, order_year, order_month
  FROM ordc1 WHERE order_date_id IS NOT NULL AND ship_date_id IS NOT NULL),
{fact_cte('1', 'dim_ord1', 'dim_prod1', 'dim_cust1')},
fact1 AS (
  SELECT ROW_NUMBER() OVER (ORDER BY row_id, order_id NULLS FIRST, product_id NULLS FIRST, customer_id NULLS FIRST, location_id NULLS FIRST, quantity NULLS FIRST, sales NULLS FIRST, unit_price NULLS FIRST, discount NULLS FIRST, profit NULLS FIRST) AS sales_id, * EXCLUDE (reject_reason, row_id)
  FROM factc1 WHERE reject_reason IS NULL)"""


def fact_cte(b: str, ord_t: str, prod_t: str, cust_t: str) -> str:
    q = "l.quantity"
    # sales / quantity rounded half away from zero to 4 places, in exact integer arithmetic
    # (a double division would misround the many exact ties).
    scaled = "CAST(TRY_CAST(l.sales AS DECIMAL(12,4)) * 10000 AS HUGEINT)"
    unit = (f"CASE WHEN l.sales IS NULL OR {q} IS NULL OR {q} = 0 THEN NULL ELSE "
            f"TRY_CAST(CAST(sign({scaled}) * sign({q}) * ((abs({scaled}) * 2 + abs({q})) // (2 * abs({q}))) "
            f"AS DECIMAL(20,0)) * 0.0001 AS DECIMAL(12,4)) END")
    clamp = ("CASE WHEN l.discount IS NULL THEN NULL ELSE ROUND(GREATEST(0, LEAST(1, "
             "CASE WHEN l.discount > 1 THEN l.discount * 0.01 ELSE l.discount END)), 2) END")
    return f"""
factm{b} AS (
  SELECT l.row_id, o.order_id, p.product_id, c.customer_id, o.location_id, {q} AS quantity, l.sales AS staged_sales, l.profit AS staged_profit,
         TRY_CAST(ROUND(l.sales, 4) AS DECIMAL(12,4)) AS sales,
         TRY_CAST(ROUND(l.profit, 4) AS DECIMAL(12,4)) AS profit,
         coalesce(TRY_CAST({clamp} AS DECIMAL(3,2)), CAST(0 AS DECIMAL(3,2))) AS discount,
         {unit} AS unit_price
  FROM stg_lines{b} l LEFT JOIN {ord_t} o ON l.order_key = o.order_key
  LEFT JOIN {prod_t} p ON l.product_key = p.product_key
  LEFT JOIN {cust_t} c ON l.customer_key = c.customer_key),
factc{b} AS (
  SELECT *, CASE WHEN order_id IS NULL THEN 'missing_order' WHEN product_id IS NULL THEN 'missing_product'
    WHEN customer_id IS NULL THEN 'missing_customer' WHEN location_id IS NULL THEN 'missing_location'
    WHEN staged_sales IS NULL THEN 'missing_sales' WHEN sales IS NULL THEN 'sales_out_of_range'
    WHEN staged_profit IS NOT NULL AND profit IS NULL THEN 'profit_out_of_range'
    WHEN quantity IS NULL THEN 'missing_quantity'
    WHEN NOT coalesce(quantity > 0, FALSE) THEN 'quantity_not_positive'
    WHEN TRY_CAST(quantity AS SMALLINT) IS NULL THEN 'quantity_out_of_range'
    WHEN unit_price IS NULL THEN 'missing_unit_price' END AS reject_reason
  FROM factm{b})"""


def load2_cte() -> str:
    """Batch 2 upserted onto batch 1."""
    return f"""
dates2 AS (
  SELECT DISTINCT full_date FROM (SELECT order_date AS full_date FROM stg_ord2 UNION ALL SELECT ship_date FROM stg_ord2)
  WHERE full_date IS NOT NULL),
newdates2 AS (SELECT full_date FROM dates2 WHERE full_date NOT IN (SELECT full_date FROM dim_date1)),
dim_date2 AS (
  SELECT date_id, full_date, {_cal('full_date')} FROM dim_date1
  UNION ALL
  SELECT (SELECT max(date_id) FROM dim_date1) + ROW_NUMBER() OVER (ORDER BY full_date), full_date, {_cal('full_date')}
  FROM newdates2),
newloc2 AS (
  SELECT * FROM stg_loc2 s
  WHERE NOT (city IS NULL AND state IS NULL AND postal_code IS NULL AND region IS NULL)
    AND NOT EXISTS (SELECT 1 FROM dim_loc1 l WHERE {_loc_match('s', 'l')})),
dim_loc2 AS (
  SELECT * FROM dim_loc1
  UNION ALL
  SELECT (SELECT max(location_id) FROM dim_loc1) + ROW_NUMBER() OVER (ORDER BY {LOC_ORDER}), city, state, postal_code, region
  FROM newloc2),
inprod2 AS (SELECT * FROM stg_prod2 WHERE product_key IS NOT NULL),
dim_prod2 AS (
  SELECT e.product_id, e.product_key,
         CASE WHEN i.product_key IS NOT NULL THEN i.product_name ELSE e.product_name END AS product_name,
         CASE WHEN i.product_key IS NOT NULL THEN i.category ELSE e.category END AS category,
         CASE WHEN i.product_key IS NOT NULL THEN i.sub_category ELSE e.sub_category END AS sub_category
  FROM dim_prod1 e LEFT JOIN inprod2 i ON e.product_key = i.product_key
  UNION ALL
  SELECT (SELECT max(product_id) FROM dim_prod1) + ROW_NUMBER() OVER (ORDER BY product_key),
         product_key, product_name, category, sub_category
  FROM inprod2 WHERE product_key NOT IN (SELECT product_key FROM dim_prod1)),
incust2 AS (
  SELECT s.customer_key, s.customer_name, s.segment, l.location_id
  FROM stg_cust2 s LEFT JOIN dim_loc2 l ON {_loc_match('s', 'l')} WHERE s.customer_key IS NOT NULL),
dim_cust2 AS (
  SELECT e.customer_id, e.customer_key,
         CASE WHEN i.customer_key IS NOT NULL THEN i.customer_name ELSE e.customer_name END AS customer_name,
         CASE WHEN i.customer_key IS NOT NULL THEN i.segment ELSE e.segment END AS segment,
         coalesce(i.location_id, e.location_id) AS location_id
  FROM dim_cust1 e LEFT JOIN incust2 i ON e.customer_key = i.customer_key
  UNION ALL
  SELECT (SELECT max(customer_id) FROM dim_cust1) + ROW_NUMBER() OVER (ORDER BY customer_key),
         customer_key, customer_name, segment, location_id
  FROM incust2 WHERE customer_key NOT IN (SELECT customer_key FROM dim_cust1)),
ordc2 AS (
  SELECT s.order_key, s.order_date, s.ship_date, s.ship_mode, d1.date_id AS order_date_id, d2.date_id AS ship_date_id,
         l.location_id, year(s.order_date) AS order_year, month(s.order_date) AS order_month
  FROM stg_ord2 s LEFT JOIN dim_date2 d1 ON s.order_date = d1.full_date
  LEFT JOIN dim_date2 d2 ON s.ship_date = d2.full_date
  LEFT JOIN dim_loc2 l ON {_loc_match('s', 'l')} WHERE s.order_key IS NOT NULL),
inord2 AS (SELECT * FROM ordc2 WHERE order_date_id IS NOT NULL AND ship_date_id IS NOT NULL),
dim_ord2 AS (
  SELECT e.order_id, e.order_key,
         coalesce(i.order_date_id, e.order_date_id) AS order_date_id,
         coalesce(i.ship_date_id, e.ship_date_id) AS ship_date_id,
         CASE WHEN i.order_key IS NOT NULL THEN i.ship_mode ELSE e.ship_mode END AS ship_mode,
         coalesce(i.location_id, e.location_id) AS location_id,
         coalesce(i.order_year, e.order_year) AS order_year,
         coalesce(i.order_month, e.order_month) AS order_month
  FROM dim_ord1 e LEFT JOIN inord2 i ON e.order_key = i.order_key
  UNION ALL
  SELECT (SELECT max(order_id) FROM dim_ord1) + ROW_NUMBER() OVER (ORDER BY order_key), order_key,
         order_date_id, ship_date_id, ship_mode, location_id, order_year, order_month
  FROM inord2 WHERE order_key NOT IN (SELECT order_key FROM dim_ord1)),
{fact_cte('2', 'dim_ord2', 'dim_prod2', 'dim_cust2')},
newfact2 AS (
  SELECT (SELECT max(sales_id) FROM fact1) + ROW_NUMBER() OVER (ORDER BY row_id, order_id NULLS FIRST, product_id NULLS FIRST, customer_id NULLS FIRST, location_id NULLS FIRST, quantity NULLS FIRST, sales NULLS FIRST, unit_price NULLS FIRST, discount NULLS FIRST, profit NULLS FIRST) AS sales_id,
         * EXCLUDE (reject_reason, row_id)
  FROM factc2 WHERE reject_reason IS NULL),
fact2 AS (
  SELECT * FROM fact1 WHERE order_id NOT IN (SELECT order_id FROM newfact2)
  UNION ALL SELECT * FROM newfact2)"""


def pipeline(batches: str = "12", whole: bool = False) -> str:
    """WITH-prefix holding every CTE up to the final star of batch 2 (or batch 1)."""
    parts = [GEO.strip()]
    for b in batches:
        parts += [raw_cte(b, int(b), whole).strip(), extract_cte(b).strip(), stage_cte(b).strip()]
    parts.append(load1_cte().strip())
    if "2" in batches:
        parts.append(load2_cte().strip())
    return "WITH " + ",\n".join(parts) + "\n"


def single_batch_prefix() -> str:
    """Raw text over every line (no batching), extracted and staged, as ``raw0``/``rs0``/``st0``."""
    parts = [GEO.strip(), raw_cte("0", None).strip(), extract_cte("0").strip(), stage_cte("0").strip()]
    return "WITH " + ",\n".join(parts) + "\n"


def _dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def staged_checks_sql() -> str:
    from .schemas import STAGED_CHECKS

    tables = {"stg_sales_lines": "stg_lines0", "stg_orders": "stg_ord0", "stg_dim_location": "stg_loc0", "stg_dim_product": "stg_prod0"}
    parts = []
    for table, spec in STAGED_CHECKS.items():
        rules = [(f"not_null({c})", f"{c} IS NULL") for c in spec.get("not_null", [])]
        rules += [(f"range({c},{lo},{hi})", f"{c} < {lo}") for c, (lo, hi) in spec.get("range", {}).items()]
        rules += [(f"length({c})<={n}", f"length({c}) > {n}") for c, n in spec.get("length", {}).items()]
        rules += [(f"numeric({c},{p},{s})", f"{c} IS NOT NULL AND TRY_CAST(ROUND({c}, {s}) AS DECIMAL({p},{s})) IS NULL")
                  for c, (p, s) in spec.get("numeric", {}).items()]
        parts += [f"SELECT '{table}' AS table_name, '{name}' AS rule, COUNT(*) AS violations FROM {tables[table]} WHERE {cond}" for name, cond in rules]
        parts += [f"SELECT '{table}', 'unique({','.join(k)})', COUNT(*) FROM (SELECT 1 FROM {tables[table]} WHERE {' AND '.join(f'{c} IS NOT NULL' for c in k)} "
                  f"GROUP BY {', '.join(k)} HAVING COUNT(*) > 1)" for k in spec.get("unique", [])]
    return "\nUNION ALL ".join(parts)


def etl_sql() -> dict[str, str]:
    one = single_batch_prefix()
    two = pipeline("12")
    cal = ("full_date, CAST(year(full_date) AS BIGINT) AS year, CAST(quarter(full_date) AS BIGINT) AS quarter, "
           "CAST(month(full_date) AS BIGINT) AS month, CAST(day(full_date) AS BIGINT) AS day, "
           "CAST(dayofweek(full_date) AS BIGINT) AS day_of_week, dayofweek(full_date) IN (0, 6) AS is_weekend, "
           "FALSE AS is_holiday")
    q = {
        "clean_money": one + "SELECT row_id, " + ", ".join(
            f"{_dbl(_num(c))} AS {c}" for c in ("sales", "profit", "discount")) + " FROM tr0",
        "guarded_numeric": one + "SELECT row_id, " + ", ".join(
            f"{_dbl(_guard(c))} AS {c}" for c in ("sales", "profit", "discount"))
        + f", {_dbl(_guard('quantity', strip=False))} AS quantity FROM tr0",
        "norm_discount": one + f"SELECT row_id, {_dbl(_norm_disc(_num('discount')))} AS discount FROM tr0",
        "norm_discount_clamped": one + "SELECT row_id, " + _dbl(
            f"CASE WHEN {_num('discount')} IS NULL THEN NULL ELSE ROUND(GREATEST(0, LEAST(1, CASE WHEN "
            f"{_num('discount')} > 1 THEN {_num('discount')} * 0.01 ELSE {_num('discount')} END)), 2) END")
        + " AS discount FROM tr0",
        "parse_date": one + f"SELECT row_id, {_pdate('order_date')} AS order_date, {_pdate('ship_date')} AS ship_date FROM tr0",
        "to_qty": one + "SELECT row_id, CAST(TRY_CAST(trunc(TRY_CAST(TRY_CAST(quantity AS DECIMAL(38,10)) "
                        "AS DECIMAL(18,4))) AS INTEGER) AS BIGINT) AS quantity FROM tr0",
        "row_hash": one + "SELECT row_id, row_hash FROM rs0",
        "unit_price": one + "SELECT row_id, " + _dbl(
            "CASE WHEN sales IS NULL OR quantity IS NULL OR quantity = 0 THEN NULL ELSE "
            "CAST(sign(CAST(CAST(sales AS DECIMAL(12,4)) * 10000 AS HUGEINT)) * sign(quantity) * ((abs(CAST(CAST(sales AS DECIMAL(12,4)) * 10000 AS HUGEINT)) * 2 "
            "+ abs(quantity)) // (2 * abs(quantity))) AS DECIMAL(20,0)) * 0.0001 END") + " AS unit_price FROM rs0",
        "calendar_attrs": one + f"""SELECT {cal} FROM (
  SELECT DISTINCT full_date FROM (SELECT order_date AS full_date FROM stg_ord0 UNION ALL
  SELECT ship_date FROM stg_ord0) WHERE full_date IS NOT NULL)""",
        "conform": one + "SELECT " + ", ".join(
            c if c not in ("sales", "quantity", "discount", "profit") else
            (f"CAST({c} AS BIGINT) AS {c}" if c == "quantity" else f"{_dbl(c)} AS {c}")
            for c in RAW_COLS) + ", row_hash FROM rs0",
        "stg_location": one + "SELECT * FROM stg_loc0",
        "stg_product": one + "SELECT * FROM stg_prod0",
        "stg_customer": one + "SELECT * FROM stg_cust0",
        "stg_orders": one + "SELECT * FROM stg_ord0",
        "stg_sales_lines": one + "SELECT row_id, order_key, product_key, customer_key, CAST(quantity AS BIGINT) AS quantity, "
                                 f"{_dbl('sales')} AS sales, {_dbl('discount')} AS discount, {_dbl('profit')} AS profit "
                                 "FROM stg_lines0",
        "dim_date": two + f"SELECT date_id, {cal} FROM dim_date2",
        "upsert_location": two + "SELECT * FROM dim_loc2",
        "upsert_product": two + "SELECT * FROM dim_prod2",
        "upsert_customer": two + "SELECT * FROM dim_cust2",
        "upsert_order": two + "SELECT order_id, order_key, order_date_id, ship_date_id, ship_mode, location_id, "
                              "CAST(order_year AS BIGINT) AS order_year, CAST(order_month AS BIGINT) AS order_month "
                              "FROM dim_ord2",
        "fact_replace": two + "SELECT sales_id, order_id, product_id, customer_id, location_id, "
                              "CAST(quantity AS BIGINT) AS quantity, " + ", ".join(
            f"{_dbl(c)} AS {c}" for c in ("sales", "unit_price", "discount", "profit")) + " FROM fact2",
        "table_counts": two + "\nUNION ALL ".join(
            f"SELECT CAST({b} AS BIGINT) AS batch, '{name}' AS table_name, COUNT(*) AS n FROM {table.format(b=b)}" for b in (1, 2) for name, table in (
                ("stg_dim_location", "stg_loc{b}"), ("stg_dim_product", "stg_prod{b}"), ("stg_dim_customer", "stg_cust{b}"),
                ("stg_orders", "stg_ord{b}"), ("stg_sales_lines", "stg_lines{b}"), ("dim_date", "dim_date{b}"),
                ("dim_location", "dim_loc{b}"), ("dim_product", "dim_prod{b}"), ("dim_customer", "dim_cust{b}"),
                ("dim_order", "dim_ord{b}"), ("fact_sales", "fact{b}"),
                ("fact_rejects", "(SELECT * FROM factc{b} WHERE reject_reason IS NOT NULL)"),
                ("order_rejects", "(SELECT * FROM ordc{b} WHERE order_date_id IS NULL OR ship_date_id IS NULL)"))),
        "chk_staged": one + staged_checks_sql(),
        "fact_rejects": two + """SELECT batch, reject_reason, COUNT(*) AS n FROM (
  SELECT CAST(1 AS BIGINT) AS batch, reject_reason FROM factc1 WHERE reject_reason IS NOT NULL
  UNION ALL SELECT CAST(2 AS BIGINT), reject_reason FROM factc2 WHERE reject_reason IS NOT NULL)
GROUP BY batch, reject_reason""",
        "order_rejects": two + """
SELECT CAST(1 AS BIGINT) AS batch, order_key, order_date, ship_date FROM ordc1
WHERE order_date_id IS NULL OR ship_date_id IS NULL
UNION ALL
SELECT CAST(2 AS BIGINT), order_key, order_date, ship_date FROM ordc2
WHERE order_date_id IS NULL OR ship_date_id IS NULL""",
        "id_stability": two + " UNION ALL ".join(
            f"""SELECT '{t}' AS table_name, COUNT(a.{i}) AS keys_before, COUNT(*) AS keys_after,
  CAST(SUM(CASE WHEN a.{i} IS NOT NULL AND a.{i} <> b.{i} THEN 1 ELSE 0 END) AS BIGINT) AS changed,
  MAX(b.{i}) AS max_id
FROM {t2} b LEFT JOIN {t1} a ON a.{k} = b.{k}
""" for t, k, i, t1, t2 in [("dim_date", "full_date", "date_id", "dim_date1", "dim_date2"),
                             ("dim_product", "product_key", "product_id", "dim_prod1", "dim_prod2"),
                             ("dim_customer", "customer_key", "customer_id", "dim_cust1", "dim_cust2"),
                             ("dim_order", "order_key", "order_id", "dim_ord1", "dim_ord2")]),
    }
    return q


FINAL = {"dim_date": "dim_date2", "dim_location": "dim_loc2", "dim_customer": "dim_cust2",
         "dim_product": "dim_prod2", "dim_order": "dim_ord2", "fact_sales": "fact2"}


def checks_sql(kind: str) -> str:
    from .schemas import CONSTRAINTS

    parts = []
    for table, spec in CONSTRAINTS.items():
        if kind not in spec:
            continue
        t = FINAL[table]
        if kind == "not_null":
            for c in spec[kind]:
                parts.append(f"SELECT '{table}' AS table_name, 'not_null({c})' AS rule, "
                             f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS violations FROM {t}")
        elif kind == "range":
            for c, (lo, hi) in spec[kind].items():
                conds = [f"{c} >= {lo}" if lo is not None else None, f"{c} <= {hi}" if hi is not None else None]
                ok = " AND ".join(x for x in conds if x)
                parts.append(f"SELECT '{table}' AS table_name, 'range({c},{lo},{hi})' AS rule, "
                             f"CAST(COUNT(*) FILTER (WHERE {c} IS NOT NULL AND NOT ({ok})) AS BIGINT) AS violations FROM {t}")
        elif kind == "length":
            for c, n in spec[kind].items():
                parts.append(f"SELECT '{table}' AS table_name, 'length({c})<={n}' AS rule, "
                             f"CAST(COUNT(*) FILTER (WHERE length({c}) > {n}) AS BIGINT) AS violations FROM {t}")
        elif kind == "numeric":
            for c, (pr, sc) in spec[kind].items():
                parts.append(f"SELECT '{table}' AS table_name, 'numeric({c},{pr},{sc})' AS rule, "
                             f"CAST(COUNT(*) FILTER (WHERE {c} IS NOT NULL AND "
                             f"TRY_CAST(ROUND({c}, {sc}) AS DECIMAL({pr},{sc})) IS NULL) AS BIGINT) AS violations FROM {t}")
        elif kind == "unique":
            for keys in spec[kind]:
                k = ", ".join(keys)
                nn = " AND ".join(f"{x} IS NOT NULL" for x in keys)
                parts.append(f"SELECT '{table}' AS table_name, 'unique({','.join(keys)})' AS rule, CAST(COUNT(*) AS BIGINT) AS violations FROM "
                             f"(SELECT {k} FROM {t} WHERE {nn} GROUP BY {k} HAVING COUNT(*) > 1)")
        elif kind == "fk":
            for c, pt, pc in spec[kind]:
                parts.append(f"SELECT '{table}' AS table_name, 'fk({c}->{pt}.{pc})' AS rule, CAST(COUNT(*) AS BIGINT) AS violations FROM {t} "
                             f"WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {pc} FROM {FINAL[pt]} WHERE {pc} IS NOT NULL)")
    return pipeline("12", whole=True) + "\nUNION ALL\n".join(parts)


def roles_sql() -> dict[str, str]:
    two = pipeline("12", whole=True)
    return {
        "loc_lookup_nullsafe": two + f"""SELECT s.customer_key, s.postal_code, l.location_id
FROM (SELECT * FROM stg_cust1 UNION ALL SELECT * FROM stg_cust2) s LEFT JOIN dim_loc2 l ON {_loc_match('s', 'l')}""",
        "date_roles": two + """SELECT o.order_key, d1.full_date AS order_date, d2.full_date AS ship_date,
  CAST(d2.full_date - d1.full_date AS BIGINT) AS days_to_ship
FROM dim_ord2 o JOIN dim_date2 d1 ON o.order_date_id = d1.date_id JOIN dim_date2 d2 ON o.ship_date_id = d2.date_id""",
        "same_day_orders": two + """SELECT o.order_key, d.full_date, COUNT(f.sales) AS n_lines,
  CAST(SUM(f.sales) AS DOUBLE) AS sales
FROM dim_ord2 o JOIN dim_date2 d ON o.order_date_id = d.date_id AND o.ship_date_id = d.date_id
LEFT JOIN fact2 f ON f.order_id = o.order_id
GROUP BY o.order_key, d.full_date""",
        "location_roles": two + """SELECT ls.region AS ship_region, lh.region AS home_region, COUNT(*) AS n,
  CAST(SUM(f.sales) AS DOUBLE) AS sales
FROM fact2 f JOIN dim_loc2 ls ON f.location_id = ls.location_id
JOIN dim_cust2 c ON f.customer_id = c.customer_id
LEFT JOIN dim_loc2 lh ON c.location_id = lh.location_id
GROUP BY ls.region, lh.region""",
        **{f"chk_{k}": checks_sql(k) for k in ("not_null", "unique", "fk", "range", "length")},
        "chk_precision": checks_sql("numeric"),
        **star_reports_sql(),
    }


def star_reports_sql() -> dict[str, str]:
    """The five reports written the reference's way: facts joined to dimensions, then grouped."""
    two = pipeline("12", whole=True)
    facts = "SELECT sales_id, order_id, product_id, customer_id, location_id, CAST(quantity AS BIGINT) AS quantity, " + ", ".join(
        f"{_dbl(c)} AS {c}" for c in ("sales", "unit_price", "discount", "profit")) + " FROM fact2"
    reports = _star_reports(two)
    return reports | {
        "parts_facts": two + facts, "parts_customers": two + "SELECT customer_id, customer_key, customer_name, segment, location_id FROM dim_cust2",
        "agg_sales_by_region": reports["wh_sales_by_region"], "agg_monthly_trend": reports["wh_monthly_trend"],
        "wh_distinct_orders": two + """SELECT CAST(GROUPING(l.state, l.city) AS BIGINT) AS level, l.state, l.city, COUNT(DISTINCT f.order_id) AS orders
FROM fact2 f JOIN dim_loc2 l ON f.location_id = l.location_id GROUP BY ROLLUP (l.state, l.city)""",
    }


def _star_reports(two: str) -> dict[str, str]:
    return {
        "wh_sales_by_region": two + """SELECT l.region, COUNT(DISTINCT o.order_id) AS orders,
  CAST(SUM(f.quantity) AS BIGINT) AS total_qty, CAST(ROUND(SUM(f.sales), 2) AS DOUBLE) AS total_sales,
  CAST(ROUND(SUM(f.profit), 2) AS DOUBLE) AS total_profit,
  CAST(ROUND(100 * SUM(f.profit) / NULLIF(SUM(f.sales), 0), 2) AS DOUBLE) AS profit_margin_pct
FROM fact2 f JOIN dim_loc2 l ON f.location_id = l.location_id JOIN dim_ord2 o ON f.order_id = o.order_id
GROUP BY l.region ORDER BY total_sales DESC""",
        "wh_monthly_trend": two + """SELECT CAST(o.order_year AS BIGINT) AS order_year, CAST(o.order_month AS BIGINT) AS order_month,
  CAST(SUM(f.sales) AS DOUBLE) AS month_sales, CAST(SUM(f.profit) AS DOUBLE) AS month_profit,
  COUNT(DISTINCT o.order_id) AS orders_count
FROM fact2 f JOIN dim_ord2 o ON f.order_id = o.order_id GROUP BY 1, 2 ORDER BY 1, 2""",
        "wh_top_customers": two + """SELECT c.customer_key, c.customer_name, COUNT(DISTINCT o.order_id) AS orders_count,
  CAST(SUM(f.sales) AS DOUBLE) AS total_sales, CAST(SUM(f.profit) AS DOUBLE) AS total_profit
FROM fact2 f JOIN dim_cust2 c ON f.customer_id = c.customer_id JOIN dim_ord2 o ON f.order_id = o.order_id
GROUP BY c.customer_key, c.customer_name ORDER BY SUM(f.sales) DESC, c.customer_key LIMIT 10""",
        "wh_top_products": two + """SELECT p.product_key, p.product_name, p.category, p.sub_category,
  CAST(SUM(f.sales) AS DOUBLE) AS total_sales, CAST(SUM(f.profit) AS DOUBLE) AS total_profit,
  CAST(SUM(f.quantity) AS BIGINT) AS total_qty
FROM fact2 f JOIN dim_prod2 p ON f.product_id = p.product_id
GROUP BY p.product_key, p.product_name, p.category, p.sub_category
ORDER BY SUM(f.profit) DESC, p.product_key LIMIT 10""",
        "wh_by_ship_mode": two + """SELECT o.ship_mode, CAST(SUM(f.sales) AS DOUBLE) AS total_sales,
  CAST(SUM(f.profit) AS DOUBLE) AS total_profit,
  CAST(ROUND(SUM(f.discount) / COUNT(*), 6) AS DOUBLE) AS avg_discount,
  COUNT(DISTINCT o.order_id) AS orders_count
FROM fact2 f JOIN dim_ord2 o ON f.order_id = o.order_id GROUP BY o.ship_mode ORDER BY total_sales DESC""",
    }
