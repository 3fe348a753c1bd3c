"""The five sales reports over warehouse star tables (``fact_sales`` + ``dim_*``), as a
user of a loaded warehouse runs them.

Facts are summed to the grain of the dimension they are grouped by *before* the dimension
join, so each join sees one row per order / customer / product / location instead of one
per line. The fact load guarantees every key resolves, so the order dimension is joined
only where one of its attributes is reported; distinct orders are counted on the fact's own
``order_id`` (two-phase distinct aggregation, keyed by group and order).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import margin_pct


def _d(c, digits: int | None = None):
    return (F.round(c, digits) if digits is not None else c).cast("double")


def sales_by_region(t: dict[str, DataFrame]) -> DataFrame:
    """Q1 on the star: one scan of the facts, summed per (order, location) first."""
    per = t["fact_sales"].groupBy("order_id", "location_id").agg(
        F.sum("quantity").alias("q"), F.sum("sales").alias("s"), F.sum("profit").alias("p"))
    loc = t["dim_location"].select("location_id", "region")
    return (per.join(loc, "location_id")
            .groupBy("region")
            .agg(F.count_distinct("order_id").alias("orders"), F.sum("q").alias("q"),
                 F.sum("s").alias("s"), F.sum("p").alias("p"))
            .select("region", "orders", F.col("q").cast("long").alias("total_qty"),
                    _d(F.col("s"), 2).alias("total_sales"), _d(F.col("p"), 2).alias("total_profit"),
                    margin_pct(F.col("p"), F.col("s")).cast("double").alias("profit_margin_pct"))
            .orderBy(F.col("total_sales").desc_nulls_first(), "region"))


def monthly_trend(t: dict[str, DataFrame]) -> DataFrame:
    per_order = t["fact_sales"].groupBy("order_id").agg(F.sum("sales").alias("s"), F.sum("profit").alias("p"))
    o = t["dim_order"].select("order_id", "order_year", "order_month")
    return (per_order.join(o, "order_id")
            .groupBy("order_year", "order_month")
            .agg(_d(F.sum("s")).alias("month_sales"), _d(F.sum("p")).alias("month_profit"),
                 F.count(F.lit(1)).alias("orders_count"))
            .orderBy("order_year", "order_month"))


def top_customers(t: dict[str, DataFrame], n: int = 10) -> DataFrame:
    per_cust = t["fact_sales"].groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("orders_count"), F.sum("sales").alias("s"), F.sum("profit").alias("p"))
    c = t["dim_customer"].select("customer_id", "customer_key", "customer_name")
    ranked = per_cust.join(c, "customer_id").orderBy(F.col("s").desc(), "customer_key").limit(n)
    return ranked.select("customer_key", "customer_name", "orders_count",
                         _d(F.col("s")).alias("total_sales"), _d(F.col("p")).alias("total_profit"))


def top_products(t: dict[str, DataFrame], n: int = 10) -> DataFrame:
    per_prod = t["fact_sales"].groupBy("product_id").agg(
        F.sum("sales").alias("s"), F.sum("profit").alias("p"), F.sum("quantity").alias("q"))
    p = t["dim_product"].select("product_id", "product_key", "product_name", "category", "sub_category")
    ranked = per_prod.join(p, "product_id").orderBy(F.col("p").desc(), "product_key").limit(n)
    return ranked.select("product_key", "product_name", "category", "sub_category",
                         _d(F.col("s")).alias("total_sales"), _d(F.col("p")).alias("total_profit"),
                         F.col("q").cast("long").alias("total_qty"))


def by_ship_mode(t: dict[str, DataFrame]) -> DataFrame:
    per_order = t["fact_sales"].groupBy("order_id").agg(
        F.sum("sales").alias("s"), F.sum("profit").alias("p"), F.sum("discount").alias("d"),
        F.count(F.lit(1)).alias("n"))
    o = t["dim_order"].select("order_id", "ship_mode")
    return (per_order.join(o, "order_id")
            .groupBy("ship_mode")
            .agg(_d(F.sum("s")).alias("total_sales"), _d(F.sum("p")).alias("total_profit"),
                 F.round(F.sum("d") / F.sum("n"), 6).cast("double").alias("avg_discount"),
                 F.count(F.lit(1)).alias("orders_count"))
            .orderBy(F.col("total_sales").desc_nulls_first(), "ship_mode"))


REPORTS = {
    "sales_by_region": sales_by_region, "monthly_trend": monthly_trend,
    "top_customers": top_customers, "top_products": top_products, "by_ship_mode": by_ship_mode,
}
