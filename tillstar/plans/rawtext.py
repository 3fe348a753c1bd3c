"""Raw order-line text derived from the source tables (stand-in for the CSV input).

One row per line item, 21 text columns under the CSV header names, built with the mix a
hand-kept export has: currency text, padded fields, three date layouts, percent discounts,
fractional quantities, unreadable values. Variants are chosen by the line number ``v``:

* Sales: v1 ``$1,234.5000``; v3 padded; v4 ``1,234.5000``; v7 ``n/a``; else plain
* Profit: v1 ``$``-formatted; else plain
* Discount: v1-3 fraction; v4-5 whole percent; v6 percent with 2 decimals; v7 empty
* Quantity: v4 ``23.0``; v5 ``23.7``; else ``23``
* Order Date layout by order key mod 3 (``M/d/yyyy``, ``MM/dd/yyyy``, ISO); ``zz`` when the
  order key is a multiple of 97. Ship Date layout by ``v`` mod 3.
* Order ID padded with blanks on v2; Product Name padded on v3.

``batch`` splits the input into two overlapping loads for the upsert tests: batch 1 holds
orders dated before 1999; batch 2 orders from 1998 on, where 1998 orders are re-sent with
only lines 1-3, customer names and product names are changed, ship modes change case, and
customers whose key is a multiple of 4 arrive without location. Together they cover every
line of the source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .star import SourceStar, profit_expr, sales_expr

BATCH1_BEFORE = "1999-01-01"
BATCH2_FROM = "1998-01-01"
BATCH2_OVERLAP_LINES = 3


def _pad(c: Column, width: int) -> Column:
    return F.lpad(c.cast("string"), width, "0")


def _date_text(d: Column, selector: Column) -> Column:
    """``M/d/yyyy``, ``MM/dd/yyyy`` or ISO text, assembled from date parts (string
    concatenation is far cheaper per row than a date formatter)."""
    y, m, day = _pad(F.year(d), 4), F.month(d).cast("string"), F.dayofmonth(d).cast("string")
    return (F.when(selector == 1, F.concat_ws("/", m, day, y))
            .when(selector == 2, F.concat_ws("/", _pad(m, 2), _pad(day, 2), y))
            .otherwise(d.cast("string")))


def raw_lines(star: SourceStar, batch: int | None = None, whole: bool = False) -> DataFrame:
    """Raw text of all lines, or of one batch; ``whole``: with every line of batch 2's orders."""
    li = star.t("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                "l_quantity", "l_extendedprice", "l_discount", "l_shipdate")
    o = star.t("orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = star.t("customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    p = star.t("part", "p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    geo = star.geography

    if batch == 1:
        o = o.filter(F.col("o_orderdate") < F.lit(BATCH1_BEFORE).cast("timestamp"))
    elif batch == 2:
        o = o.filter(F.col("o_orderdate") >= F.lit(BATCH2_FROM).cast("timestamp"))

    # Orders meet their customers before their lines do, so lines are shuffled by part and by order only. Dealt by order last,
    # which large tables are shuffled by in any case: the lines of an order stay together for the staging of orders.
    oc = o.join(c, o.o_custkey == c.c_custkey).join(geo, F.col("c_nationkey") == geo.nationkey)
    lp = li.join(p, li.l_partkey == p.p_partkey).repartition("l_orderkey")
    j = lp.join(oc, F.col("l_orderkey") == F.col("o_orderkey"))
    if batch == 2 and not whole:
        j = j.filter((F.col("o_orderdate") >= F.lit(BATCH1_BEFORE).cast("timestamp"))
                     | (F.col("l_linenumber") <= BATCH2_OVERLAP_LINES))

    # First projection: typed values, each computed once. The text projection below
    # refers to them as columns, so Catalyst keeps the two projections apart instead of
    # inlining (and repeating) the arithmetic into every CASE branch.
    sales0 = sales_expr(F.col("l_extendedprice"), F.col("l_discount"))
    j = j.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "o_orderpriority", "o_custkey",
        "c_custkey", "c_name", "c_mktsegment", "city", "state", "postal_code", "region",
        "p_name", "p_brand", "p_type",
        sales0.alias("_sales"),
        profit_expr(sales0, F.col("l_quantity"), F.col("p_retailprice")).alias("_profit"),
        F.col("l_discount").cast("decimal(3,2)").alias("_disc"),
        F.col("o_orderdate").cast("date").alias("_odate"),
        F.col("l_shipdate").cast("date").alias("_sdate"),
    )
    v = F.col("l_linenumber")
    sales = F.col("_sales")
    profit = F.col("_profit")
    disc = F.col("_disc")
    qty = F.col("l_quantity").cast("int")
    okey = F.col("l_orderkey")
    odate = F.col("_odate")
    sdate = F.col("_sdate")

    sales_txt = (F.when(v == 1, F.concat(F.lit("$"), F.format_number(sales, 4)))
                 .when(v == 3, F.concat(F.lit("  "), sales.cast("string"), F.lit(" ")))
                 .when(v == 4, F.format_number(sales, 4))
                 .when(v == 7, F.lit("n/a"))
                 .otherwise(sales.cast("string")))
    profit_txt = F.when(v == 1, F.concat(F.lit("$"), F.format_number(profit, 4))).otherwise(profit.cast("string"))
    disc_txt = (F.when(v <= 3, disc.cast("string"))
                .when(v <= 5, (disc * 100).cast("int").cast("string"))
                .when(v == 6, (disc * 100).cast("decimal(5,2)").cast("string"))
                .otherwise(F.lit("")))
    qty_txt = (F.when(v == 4, F.col("l_quantity").cast("string"))
               .when(v == 5, F.concat(qty.cast("string"), F.lit(".7")))
               .otherwise(qty.cast("string")))
    order_txt = F.when(okey % 97 == 0, F.lit("zz")).otherwise(_date_text(odate, okey % 3))
    ship_txt = _date_text(sdate, v % 3)
    okey_txt = F.when(v == 2, F.concat(F.lit(" "), okey.cast("string"), F.lit("  "))).otherwise(okey.cast("string"))
    pname = F.when(v == 3, F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))).otherwise(F.col("p_name"))

    cname = F.col("c_name")
    ship_mode = F.col("o_orderpriority")
    no_loc = F.lit(False)
    if batch == 2:
        cname = F.concat(cname, F.lit(" II"))
        pname = F.upper(pname)
        ship_mode = F.lower(ship_mode)
        no_loc = F.col("c_custkey") % 4 == 0

    def loc(colname: str) -> Column:
        return F.when(no_loc, F.lit(None).cast("string")).otherwise(F.col(colname))

    return j.select(
        F.concat_ws("-", _pad(okey, 12), _pad(v, 2), _pad(F.col("l_partkey"), 12),
                    _pad(F.col("l_suppkey"), 10)).alias("Row ID"),
        okey_txt.alias("Order ID"),
        order_txt.alias("Order Date"),
        ship_txt.alias("Ship Date"),
        ship_mode.alias("Ship Mode"),
        F.col("o_custkey").cast("string").alias("Customer ID"),
        cname.alias("Customer Name"),
        F.col("c_mktsegment").alias("Segment"),
        F.col("region").alias("Country"),
        loc("city").alias("City"),
        loc("state").alias("State"),
        loc("postal_code").alias("Postal Code"),
        loc("region").alias("Region"),
        F.col("l_partkey").cast("string").alias("Product ID"),
        F.col("p_type").alias("Category"),
        F.col("p_brand").alias("Sub-Category"),
        pname.alias("Product Name"),
        sales_txt.alias("Sales"),
        qty_txt.alias("Quantity"),
        disc_txt.alias("Discount"),
        profit_txt.alias("Profit"),
    )

