"""The reporting star, derived from the TPC-H-like source tables.

Mapping (kept identical in the DuckDB oracle):

* order_key / product_key / customer_key = ``o_orderkey`` / ``p_partkey`` / ``c_custkey`` as text
* sales  = decimal(12,2) extended price x (1 - decimal(3,2) discount), stored as decimal(12,4)
* profit = sales - quantity x decimal(12,2) retail price, decimal(12,4)
* category / sub_category / product_name = ``p_type`` / ``p_brand`` / ``p_name``
* segment / customer_name = ``c_mktsegment`` / ``c_name``; ship_mode = ``o_orderpriority``
* region / state / city = region name / nation name / nation name, postal_code = nation key
  as text, NULL when the nation key is a multiple of 5 (gives NULL key parts)
* order_date = ``o_orderdate``; ship_date = earliest ``l_shipdate`` of the order

Every source foreign key resolves (TPC-H guarantees it; ``chk_fk`` checks the built star),
so a report joins only the roles whose attributes it needs. Nation and region are the only
broadcast sides (bounded count); customer, part and orders scale with the data and are
left to the planner / AQE.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..sources.tables import read_table

PRICE = DecimalType(12, 2)
RATE = DecimalType(3, 2)
MONEY = DecimalType(12, 4)
QTY_DEC = DecimalType(5, 0)


def sales_expr(price: Column, discount: Column) -> Column:
    return (price.cast(PRICE) * (F.lit(1) - discount.cast(RATE))).cast(MONEY)


def profit_expr(sales: Column, quantity: Column, retail_price: Column) -> Column:
    return (sales - quantity.cast(QTY_DEC) * retail_price.cast(PRICE)).cast(MONEY)


def postal_code_expr(nationkey: Column) -> Column:
    return F.when(nationkey % 5 == 0, F.lit(None).cast("string")).otherwise(nationkey.cast("string"))


class SourceStar:
    """Lazy accessors for star roles over one source folder."""

    def __init__(self, spark: SparkSession, base_dir: str):
        self.spark = spark
        self.base_dir = base_dir

    def t(self, name: str, *cols: str) -> DataFrame:
        return read_table(self.spark, self.base_dir, name, *cols)

    @cached_property
    def geography(self) -> DataFrame:
        """nation x region -> location attributes; 25 rows, which the planner broadcasts by their size."""
        n = self.t("nation", "n_nationkey", "n_name", "n_regionkey")
        r = self.t("region", "r_regionkey", "r_name")
        return n.join(r, n.n_regionkey == r.r_regionkey).select(
            F.col("n_nationkey").alias("nationkey"),
            F.col("n_name").alias("city"),
            F.col("n_name").alias("state"),
            postal_code_expr(F.col("n_nationkey")).alias("postal_code"),
            F.col("r_name").alias("region"),
        )

    def customers(self) -> DataFrame:
        """customer role: c_custkey, customer_key, customer_name, segment, location columns."""
        c = self.t("customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
        return c.join(self.geography, c.c_nationkey == self.geography.nationkey).select(
            "c_custkey",
            F.col("c_custkey").cast("string").alias("customer_key"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("segment"),
            "city", "state", "postal_code", "region",
        )

    def orders(self, years: tuple[int, int] | None = None) -> DataFrame:
        """order role without customer attributes; ``years`` keeps orders dated in that
        inclusive year range, written as a range on the stored column so Parquet can skip
        row groups (a filter on ``year(...)`` could not be pushed into the scan)."""
        o = self.t("orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
        if years is not None:
            lo, hi = years
            o = o.filter((F.col("o_orderdate") >= F.lit(f"{lo:04d}-01-01").cast("timestamp"))
                         & (F.col("o_orderdate") < F.lit(f"{hi + 1:04d}-01-01").cast("timestamp")))
        d = F.col("o_orderdate").cast("date")
        return o.select(
            "o_orderkey", "o_custkey",
            F.col("o_orderkey").cast("string").alias("order_key"),
            F.col("o_custkey").cast("string").alias("customer_key"),
            d.alias("order_date"),
            F.col("o_orderpriority").alias("ship_mode"),
            F.year(d).cast("long").alias("order_year"),
            F.month(d).cast("long").alias("order_month"),
        )

    def orders_located(self) -> DataFrame:
        """order role with the (customer's) location, as the reporting star stores it."""
        c = self.customers().select("c_custkey", "customer_name", "segment",
                                    "city", "state", "postal_code", "region")
        o = self.orders()
        return o.join(c, o.o_custkey == c.c_custkey).drop("c_custkey")

    def products(self) -> DataFrame:
        p = self.t("part", "p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
        return p.select(
            "p_partkey",
            F.col("p_partkey").cast("string").alias("product_key"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("sub_category"),
            F.col("p_retailprice").cast(PRICE).alias("retail_price"),
        )

    def lines(self) -> DataFrame:
        """Fact grain without profit: one row per order line."""
        li = self.t("lineitem", "l_orderkey", "l_partkey", "l_quantity",
                    "l_extendedprice", "l_discount", "l_shipdate")
        return li.select(
            "l_orderkey", "l_partkey",
            F.col("l_quantity").cast("int").alias("quantity"),
            sales_expr(F.col("l_extendedprice"), F.col("l_discount")).alias("sales"),
            F.col("l_discount").cast(RATE).alias("discount"),
            F.col("l_shipdate").cast("date").alias("ship_date"),
        )

    def lines_with_profit(self) -> DataFrame:
        """Fact grain with profit, which needs the part's retail price."""
        p = self.t("part", "p_partkey", "p_retailprice", "p_type")
        li = self.lines()
        return li.join(p, li.l_partkey == p.p_partkey).select(
            "l_orderkey", "l_partkey", "quantity", "sales", "discount", "ship_date", F.col("p_type").alias("category"),
            profit_expr(F.col("sales"), F.col("quantity"), F.col("p_retailprice")).alias("profit"),
        )

    def order_totals(self) -> DataFrame:
        """Lines pre-aggregated to order grain.

        Every order-grain report groups by order attributes, so summing lines per order
        *before* the join to the order role cuts the join and the report aggregate to one
        row per order (about a quarter of the lines), and turns ``count(distinct order)``
        into a plain count. The aggregate's output is hash-partitioned on the order key,
        which the following join reuses.
        """
        return self.lines_with_profit().groupBy("l_orderkey").agg(
            F.sum("quantity").alias("qty"),
            F.sum("sales").alias("sales"),
            F.sum("profit").alias("profit"),
            F.sum("discount").alias("discount_sum"),
            F.count(F.lit(1)).alias("n_lines"),
            F.min("ship_date").alias("ship_date"),
        )

    def customer_totals(self, *order_cols: str) -> DataFrame:
        """Order totals rolled up to customer grain (optionally also by order attributes).

        Region, segment, state and city are customer attributes, so reports grouped by them
        aggregate to the customer key *before* joining the customer role: the customer join
        then sees one row per customer (not per order), and the orders table is shuffled
        once, on its own key. ``n_orders`` stays exact because an order has one customer.
        """
        per_order = self.order_totals()
        o = self.orders().select("o_orderkey", "o_custkey", *order_cols)
        return (per_order.join(o, per_order.l_orderkey == o.o_orderkey)
                .groupBy("o_custkey", *order_cols)
                .agg(F.sum("qty").alias("qty"), F.sum("sales").alias("sales"), F.sum("profit").alias("profit"),
                     F.sum("discount_sum").alias("discount_sum"), F.sum("n_lines").alias("n_lines"),
                     F.count(F.lit(1)).alias("n_orders")))
