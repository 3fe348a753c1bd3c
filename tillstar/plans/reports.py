"""Named reports (Q1-Q10): the five sales reports, their four routed variants and the
question router over a table of questions.

Plan shape, chosen for large data:

* order-grain reports (region, month, ship mode, customer) start from
  ``SourceStar.order_totals`` (lines summed per order before any join), then join the order
  role once; ``count(distinct order)`` becomes a count because each row is one order;
  reports by customer attributes (region) roll up to customer grain before joining customers;
* the product report sums lines per part *before* joining part: profit is
  ``sum(sales) - sum(quantity) x price`` because the price is constant per part, which is
  exact in decimal arithmetic;
* top-k is ``orderBy(...).limit(k)`` (TakeOrderedAndProject) with a key tie-break; names are
  joined to the k winners only, the k-row side broadcast (size proven by the limit).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.intent import detect_intent
from ..parameters import QUESTIONS
from .star import QTY_DEC, SourceStar


def _money(c, digits: int | None = None):
    """Decimal sum -> output double, optionally rounded (half-up) first."""
    return (F.round(c, digits) if digits is not None else c).cast("double")


def _margin_pct(profit, sales):
    return F.round(F.lit(100) * profit / F.nullif(sales, F.lit(0)), 2).cast("double")


def sales_by_region(star: SourceStar, limit: int | None = None) -> DataFrame:
    """Q1 (and Q6 with ``limit=50``)."""
    per_cust = star.customer_totals()
    c = star.customers().select("c_custkey", "region")
    out = (
        per_cust.join(c, per_cust.o_custkey == c.c_custkey)
        .groupBy("region")
        .agg(
            F.sum("n_orders").alias("orders"),
            F.sum("qty").alias("total_qty"),
            F.sum("sales").alias("_s"),
            F.sum("profit").alias("_p"),
        )
        .select(
            "region", "orders", "total_qty",
            _money(F.col("_s"), 2).alias("total_sales"),
            _money(F.col("_p"), 2).alias("total_profit"),
            _margin_pct(F.col("_p"), F.col("_s")).alias("profit_margin_pct"),
        )
        .orderBy(F.col("total_sales").desc_nulls_first(), F.col("region").asc_nulls_last())
    )
    return out.limit(limit) if limit else out


def monthly_trend(star: SourceStar, round_digits: int | None = None,
                  limit: int | None = None) -> DataFrame:
    """Q2 (and Q7 with measures rounded to 2 and ``limit=200``)."""
    per_order = star.order_totals()
    o = star.orders().select("o_orderkey", "order_year", "order_month")
    out = (
        per_order.join(o, per_order.l_orderkey == o.o_orderkey)
        .groupBy("order_year", "order_month")
        .agg(
            F.sum("sales").alias("_s"),
            F.sum("profit").alias("_p"),
            F.count(F.lit(1)).alias("orders_count"),
        )
        .select(
            "order_year", "order_month",
            _money(F.col("_s"), round_digits).alias("month_sales"),
            _money(F.col("_p"), round_digits).alias("month_profit"),
            "orders_count",
        )
        .orderBy(F.col("order_year").asc_nulls_last(), F.col("order_month").asc_nulls_last())
    )
    return out.limit(limit) if limit else out


def top_customers(star: SourceStar, n: int = 10, round_digits: int | None = None) -> DataFrame:
    """Q3 (and Q8 with measures rounded to 2): top customers by lifetime sales."""
    per_order = star.order_totals()
    o = star.orders().select("o_orderkey", "o_custkey", "customer_key")
    ranked = (
        per_order.join(o, per_order.l_orderkey == o.o_orderkey)
        .groupBy("o_custkey", "customer_key")
        .agg(
            F.count(F.lit(1)).alias("orders_count"),
            F.sum("sales").alias("_s"),
            F.sum("profit").alias("_p"),
        )
        .orderBy(F.col("_s").desc_nulls_first(), F.col("customer_key").asc())
        .limit(n)
    )
    names = star.t("customer", "c_custkey", "c_name")
    return (
        names.join(F.broadcast(ranked), names.c_custkey == ranked.o_custkey)
        .select(
            "customer_key",
            F.col("c_name").alias("customer_name"),
            "orders_count",
            _money(F.col("_s"), round_digits).alias("total_sales"),
            _money(F.col("_p"), round_digits).alias("total_profit"),
        )
        .orderBy(F.col("total_sales").desc_nulls_first(), F.col("customer_key").asc())
    )


def top_products(star: SourceStar, n: int = 10, round_digits: int | None = None) -> DataFrame:
    """Q4 (and Q9 with measures rounded to 2): top products by profit."""
    per_part = star.lines().groupBy("l_partkey").agg(
        F.sum("sales").alias("_s"),
        F.sum("quantity").cast("long").alias("total_qty"),
        F.sum(F.col("quantity").cast(QTY_DEC)).alias("_q"),
    )
    p = star.products()
    return (
        per_part.join(p, per_part.l_partkey == p.p_partkey)
        .select(
            "product_key", "product_name", "category", "sub_category",
            F.col("_s"), (F.col("_s") - F.col("_q") * F.col("retail_price")).alias("_p"),
            "total_qty",
        )
        .orderBy(F.col("_p").desc_nulls_first(), F.col("product_key").asc())
        .limit(n)
        .select(
            "product_key", "product_name", "category", "sub_category",
            _money(F.col("_s"), round_digits).alias("total_sales"),
            _money(F.col("_p"), round_digits).alias("total_profit"),
            "total_qty",
        )
    )


def by_ship_mode(star: SourceStar) -> DataFrame:
    """Q5: sales, profit, average line discount and orders per ship mode."""
    per_order = star.order_totals()
    o = star.orders().select("o_orderkey", "ship_mode")
    return (
        per_order.join(o, per_order.l_orderkey == o.o_orderkey)
        .groupBy("ship_mode")
        .agg(
            F.sum("sales").alias("_s"),
            F.sum("profit").alias("_p"),
            F.sum("discount_sum").alias("_d"),
            F.sum("n_lines").alias("_n"),
            F.count(F.lit(1)).alias("orders_count"),
        )
        .select(
            "ship_mode",
            _money(F.col("_s")).alias("total_sales"),
            _money(F.col("_p")).alias("total_profit"),
            F.round(F.col("_d") / F.col("_n"), 6).cast("double").alias("avg_discount"),
            "orders_count",
        )
        .orderBy(F.col("total_sales").desc_nulls_first(), F.col("ship_mode").asc())
    )


# Routed report variants (Q6-Q9), keyed by the router's intent names.
def chat_report(star: SourceStar, intent: str) -> DataFrame:
    if intent == "sales_by_region":
        return sales_by_region(star, limit=50)
    if intent == "monthly_trend":
        return monthly_trend(star, round_digits=2, limit=200)
    if intent == "top_customers":
        return top_customers(star, round_digits=2)
    if intent == "top_products":
        return top_products(star, round_digits=2)
    raise ValueError(f"no report for intent {intent!r}")


def route_questions(questions: DataFrame, text_col: str = "text") -> DataFrame:
    """Q10: route every question and count per report (NULL = not routed)."""
    return (
        questions.select(detect_intent(F.col(text_col)).alias("intent"))
        .groupBy("intent")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def route_rendered(turns: DataFrame) -> DataFrame:
    """Q10 over rendered questions: each turn's text behind one of ``QUESTIONS``, which hit every rule,
    their order and the word edges. Counts per question and intent."""
    at = F.pmod(F.col("conv_id") * 7 + F.col("turn"), F.lit(len(QUESTIONS))).cast("int")
    asked = turns.select(F.get(F.array(*map(F.lit, QUESTIONS)), at).alias("question"), "text")
    routed = asked.select("question", detect_intent(F.concat("question", F.lit(" "), F.coalesce("text", F.lit("")))).alias("intent"))
    return routed.groupBy("question", "intent").agg(F.count(F.lit(1)).alias("n"))


def rows_json(df: DataFrame, order_cols: list, n: int = 8) -> DataFrame:
    """The first ``n`` rows of a report, in report order, as one JSON array string.
    The window numbering runs over at most ``n`` rows (after the limit)."""
    top = df.orderBy(*order_cols).limit(n)
    pos = F.row_number().over(Window.orderBy(*order_cols))
    rows = top.select(pos.alias("_pos"), F.struct(*df.columns).alias("row"))
    return rows.agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "row"))),
                                          lambda x: x["row"])).alias("json"))


def report_json(star: SourceStar) -> DataFrame:
    """The routed region report's payload: its first 8 rows as JSON, amounts in plain notation."""
    report = sales_by_region(star, limit=50)
    amounts = {c: F.col(c).cast("decimal(20,2)") for c in ("total_sales", "total_profit", "profit_margin_pct")}
    return rows_json(report.withColumns(amounts),
                     [F.col("total_sales").desc_nulls_first(), F.col("region").asc_nulls_last()])
