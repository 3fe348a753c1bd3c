"""Dashboard sheets and calculations.

Evaluation order follows the workbook: per-customer level-of-detail aggregates first,
then dimension filters, then the view aggregate, then table calculations, then filters on
table calculations.

Plans aggregate as early as possible: line sales are summed per order before the order
role is joined, and every table calculation runs over the (small) aggregated view.
Reference filter members (four US regions, three segments, years 2014-2018) do not occur in
the source data, so members and bounds are parameters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import metrics
from ..functions.calendar import quarter_of_month, year_start
from ..operators import windows as W
from ..parameters import CATEGORIES
from .star import SourceStar

# --- fixed values: the workbook's own filter settings and cut-offs ---
DEFAULT_YEARS = (2014, 2018)
DEFAULT_RUNNING_RATIO = (-0.22136745269143338, 0.56523045958457452)
DEFAULT_RFM_CODES = (111, 123)
TOP_N = 10
# --- end of fixed values ---


def _d(c: str, digits: int = 6):
    return F.round(F.col(c), digits).cast("double")


def order_sales(star: SourceStar, with_profit: bool = False, categories: list[str] | None = None) -> DataFrame:
    """Line measures summed per order, optionally only lines of some categories."""
    lines = star.lines_with_profit() if with_profit else star.lines()
    if categories is not None:
        p = star.t("part", "p_partkey", "p_type").filter(F.col("p_type").isin(categories))
        lines = lines.join(p, lines.l_partkey == p.p_partkey, "left_semi")
    aggs = [F.sum("sales").alias("sales")]
    if with_profit:
        aggs.append(F.sum("profit").alias("profit"))
    return lines.groupBy("l_orderkey").agg(*aggs)


def orders_view(star: SourceStar, years=None, categories=None, with_profit: bool = False) -> DataFrame:
    """Per-order sales joined to the order role, with the order-level filters applied."""
    o = star.orders(years)
    s = order_sales(star, with_profit, categories)
    return s.join(o, s.l_orderkey == o.o_orderkey)


def customers_where(star: SourceStar, regions=None, segments=None) -> DataFrame:
    """Customer keys passing the region (C9) and segment (C10) filters."""
    c = star.customers()
    if regions is not None:
        c = c.filter(F.col("region").isin(regions))
    if segments is not None:
        c = c.filter(F.col("segment").isin(segments))
    return c.select("c_custkey")


def yearly_sales(star: SourceStar) -> DataFrame:
    return orders_view(star).groupBy("order_year").agg(F.sum("sales").cast("double").alias("sales"))


def monthly_sales(star: SourceStar) -> DataFrame:
    return (orders_view(star).groupBy("order_year", "order_month")
            .agg(F.sum("sales").cast("double").alias("sales")))


def yoy_year(star: SourceStar) -> DataFrame:
    """Yearly sales and percent difference from the previous year."""
    y = yearly_sales(star)
    return y.select(F.col("order_year").alias("year"), "sales",
                    W.pct_diff("sales", ["order_year"]).alias("yoy_pct")).select("year", "sales", _d("yoy_pct").alias("yoy_pct"))


def yoy12(star: SourceStar) -> DataFrame:
    """monthly sales vs the month 12 rows earlier."""
    m = monthly_sales(star)
    order = ["order_year", "order_month"]
    return m.select(F.col("order_year").alias("year"), F.col("order_month").alias("month"), "sales",
                    W.change_vs_offset("sales", order, 12).alias("yoy12")).select(
        "year", "month", "sales", _d("yoy12").alias("yoy12"))


def pct_diff_month(star: SourceStar) -> DataFrame:
    """monthly percent difference from the previous month."""
    m = monthly_sales(star)
    order = ["order_year", "order_month"]
    return m.select(F.col("order_year").alias("year"), F.col("order_month").alias("month"), "sales",
                    _d_expr(W.pct_diff("sales", order)).alias("pct_diff"))


def pct_diff_day(star: SourceStar) -> DataFrame:
    """F10 by day: percent difference of an order date's sales from those of the order date before. The window over
    all days is one task, of a row a day."""
    d = orders_view(star).groupBy("order_date").agg(F.sum("sales").cast("double").alias("sales"))
    return d.select("order_date", "sales", _d_expr(W.pct_diff("sales", ["order_date"])).alias("pct_diff"))


def sales_mavg(star: SourceStar) -> DataFrame:
    """F8 for sales, B27: yearly sales by the year's first day, with 3-row moving averages in the order of the years, and in
    the order of how many lines with a category they have (ties by year)."""
    p = star.t("part", "p_partkey", "p_type")
    lines = star.lines()
    per_order = (lines.join(p, lines.l_partkey == p.p_partkey, "left")
                 .groupBy("l_orderkey").agg(F.sum("sales").alias("sales"), F.count("p_type").alias("n")))
    o = star.orders().select("o_orderkey", "order_date")
    y = (per_order.join(o, per_order.l_orderkey == o.o_orderkey).groupBy(year_start(F.col("order_date")).alias("year_start"))
         .agg(F.sum("sales").cast("double").alias("sales"), F.sum("n").alias("category_count")))
    return y.select("year_start", "sales", "category_count", _d_expr(W.moving_avg("sales", ["year_start"], 3)).alias("mavg3"),
                    _d_expr(W.moving_avg("sales", ["category_count", "year_start"], 3)).alias("mavg3_by_count"))


def _d_expr(c, digits: int = 6):
    return F.round(c, digits).cast("double")


def cagr2(star: SourceStar) -> DataFrame:
    """compounded yearly growth over two years."""
    y = yearly_sales(star)
    return y.select(F.col("order_year").alias("year"), "sales",
                    _d_expr(W.compound_rate("sales", ["order_year"], 2)).alias("cagr2"))


def sales_trends(star: SourceStar, years=DEFAULT_YEARS, regions=None, segments=None,
                 categories=None) -> DataFrame:
    """Q12: three grains (quarter of year, month of year, year), each with a 3-row moving
    average, under the year / category / region / segment filters."""
    v = orders_view(star, years=years, categories=categories)
    # Customer filters apply at customer-month grain (one row per customer and month, not
    # per order), as a semi join on the customer key; then one small year-month frame from
    # which the three grains are re-aggregated (decimal sums, so regrouping is exact).
    per_cust = v.groupBy("o_custkey", "order_year", "order_month").agg(F.sum("sales").alias("s"))
    if regions is not None or segments is not None:
        keep = customers_where(star, regions, segments)
        per_cust = per_cust.join(keep, per_cust.o_custkey == keep.c_custkey, "left_semi")
    ym = per_cust.groupBy("order_year", "order_month").agg(F.sum("s").alias("s"))

    def grain(name, period):
        return ym.groupBy(F.lit(name).alias("grain"), period.cast("long").alias("period")).agg(F.sum("s").alias("s"))

    grains = (grain("quarter", quarter_of_month(F.col("order_month")))
              .unionByName(grain("month", F.col("order_month")))
              .unionByName(grain("year", F.col("order_year")))
              ).select("grain", "period", F.col("s").cast("double").alias("sales"))
    return grains.select("grain", "period", "sales",
                         _d_expr(W.moving_avg("sales", ["period"], 3, partition=["grain"])).alias("mavg3"))


def heatmap_cells(star: SourceStar) -> DataFrame:
    """Region x category sales and profit (the heat map's view aggregate)."""
    # One join with part gives price and category; sums stay decimals up to the cell.
    per_cat_order = (star.lines_with_profit().groupBy("l_orderkey", "category")
                     .agg(F.sum("sales").alias("sales"), F.sum("profit").alias("profit")))
    o = star.orders().select("o_orderkey", "o_custkey")
    per_cust = (per_cat_order.join(o, per_cat_order.l_orderkey == o.o_orderkey)
                .groupBy("o_custkey", "category")
                .agg(F.sum("sales").alias("sales"), F.sum("profit").alias("profit")))
    c = star.customers().select("c_custkey", "region")
    return (per_cust.join(c, per_cust.o_custkey == c.c_custkey)
            .groupBy("region", "category")
            .agg(F.sum("sales").alias("sales"), F.sum("profit").alias("profit")))


def cum_profit_ratio(star: SourceStar) -> DataFrame:
    """F9 + G6 + B21: heat-map cells with the profit ratio and its running total across the table:
    the total starts anew in every row (region) and runs over categories by total profit."""
    return rounded_ratios(running_ratios(star))


def running_ratios(star: SourceStar) -> DataFrame:
    cells = heatmap_cells(star).withColumn("cat_profit", W.member_total("profit", "category"))
    cells = cells.withColumns({"sales": F.col("sales").cast("double"), "profit": F.col("profit").cast("double")})
    order = [F.col("cat_profit").desc(), F.col("category").asc()]
    cells = cells.withColumn("profit_ratio", metrics.profit_ratio(F.col("profit"), F.col("sales")))
    return cells.select("region", "category", "sales", "profit", "profit_ratio",
                        W.running_sum("profit_ratio", order, ["region"]).alias("running_ratio"))


def rounded_ratios(cells: DataFrame) -> DataFrame:
    return cells.select("region", "category", "sales", "profit", _d("profit_ratio").alias("profit_ratio"),
                        _d("running_ratio").alias("running_ratio"))


def profit_heatmap(star: SourceStar, running_bounds=DEFAULT_RUNNING_RATIO) -> DataFrame:
    """Q13: cells whose running profit ratio, before rounding, lies within the bounds (filter
    applied after the table calculation, C11)."""
    return rounded_ratios(running_ratios(star).filter(F.col("running_ratio").between(*running_bounds)))


def heatmap_pivot(star: SourceStar) -> DataFrame:
    """G8 registered: the heat map's profit, a row per region and a column per category listed."""
    cells = heatmap_cells(star).withColumn("profit", F.col("profit").cast("double"))
    return pivot_heatmap(cells, CATEGORIES)


def pivot_heatmap(cells: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """Wide form, one column per category (listing the values avoids an extra pass)."""
    return cells.groupBy("region").pivot("category", categories).agg(F.sum("profit"))


def top_names(star: SourceStar, n: int = TOP_N) -> DataFrame:
    """Q14: top customers by sales, grouped by *name* (namesakes merge, as drawn)."""
    v = orders_view(star, with_profit=True)
    names = star.t("customer", "c_custkey", "c_name")
    per_cust = v.groupBy("o_custkey").agg(F.sum("sales").alias("sales"), F.sum("profit").alias("profit"))
    per_name = (per_cust.join(names, per_cust.o_custkey == names.c_custkey)
                .groupBy(F.col("c_name").alias("customer_name"))
                .agg(F.sum("sales").alias("s"), F.sum("profit").alias("p")))
    return (W.top_n(per_name, [F.col("s").desc(), F.col("customer_name").asc()], n)
            .select("customer_name", F.col("s").cast("double").alias("sales"), F.col("p").cast("double").alias("profit")))


def customer_lod(star: SourceStar) -> DataFrame:
    """Per customer, independent of the view: last order date, distinct orders, sales."""
    v = orders_view(star)
    return v.groupBy("o_custkey", "customer_key").agg(
        F.max("order_date").alias("last_order"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum("sales").alias("monetary"),
    )


def max_order_date(star: SourceStar) -> DataFrame:
    """As-of date for recency: the latest order date, one row from a scan of one column."""
    return star.t("orders", "o_orderdate").agg(F.max(F.col("o_orderdate").cast("date")).alias("as_of"))


def rfm_scores(star: SourceStar, as_of=None, r_cuts=metrics.RECENCY_DAYS_MAX, f_cuts=metrics.FREQUENCY_MIN,
               m_cuts=metrics.MONETARY_MIN) -> DataFrame:
    """B22-B26 over E7: recency, frequency, monetary, their scores and the RFM code."""
    lod = customer_lod(star)
    if as_of is None:
        lod = lod.join(F.broadcast(max_order_date(star)), F.lit(True))  # one row
    else:
        lod = lod.withColumn("as_of", F.lit(as_of).cast("date"))
    rec = metrics.recency_days(F.col("last_order"), F.col("as_of"))
    scored = lod.select(
        "customer_key", "last_order", rec.cast("long").alias("recency"), "frequency",
        F.col("monetary").cast("double").alias("monetary"),
        metrics.r_score(rec, r_cuts).cast("long").alias("r_score"),
        metrics.f_score(F.col("frequency"), f_cuts).cast("long").alias("f_score"),
        metrics.m_score(F.col("monetary"), m_cuts).cast("long").alias("m_score"),
    )
    return scored.withColumn("rfm_code", metrics.rfm_code(F.col("r_score"), F.col("f_score"), F.col("m_score")))


def rfm_matrix(star: SourceStar, segments=None, codes=DEFAULT_RFM_CODES, **score_args) -> DataFrame:
    """R x F matrix of monetary value and customer counts, after the segment
    filter (C10) and the RFM code range (C12)."""
    s = rfm_scores(star, **score_args)
    if segments is not None:
        seg = star.t("customer", "c_custkey", "c_mktsegment").filter(F.col("c_mktsegment").isin(segments))
        s = s.join(seg.select(F.col("c_custkey").cast("string").alias("customer_key")), "customer_key", "left_semi")
    s = s.filter(F.col("rfm_code").between(*codes))
    return s.groupBy("r_score", "f_score").agg(F.sum("monetary").alias("monetary"),
                                               F.count(F.lit(1)).alias("customers")).select(
        "r_score", "f_score", _d("monetary", 2).alias("monetary"), "customers")


def state_city_rollup(star: SourceStar) -> DataFrame:
    """State -> city drill path with subtotals (``level`` = grouping id)."""
    v = orders_view(star)
    per_cust = v.groupBy("o_custkey").agg(F.sum("sales").alias("s"))
    c = star.customers().select("c_custkey", "state", "city")
    return (per_cust.join(c, per_cust.o_custkey == c.c_custkey)
            .rollup("state", "city")
            .agg(F.grouping_id().cast("long").alias("level"), F.sum("s").cast("double").alias("sales")))


def snapshot(star: SourceStar, years=DEFAULT_YEARS) -> DataFrame:
    """A10: the star's lines with order attributes, restricted to a year range."""
    lines = star.lines()
    o = star.orders(years)
    return lines.join(o, lines.l_orderkey == o.o_orderkey)


def write_snapshot(df: DataFrame, path: str) -> None:
    """A10 sink: Parquet partitioned by year; rewriting a year replaces only that year."""
    df.write.mode("overwrite").partitionBy("order_year").parquet(path)


def snapshot_years(star: SourceStar, years=DEFAULT_YEARS) -> DataFrame:
    """Row and member counts per year of the snapshot."""
    s = snapshot(star, years)
    return s.groupBy(F.col("order_year").alias("year")).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_distinct("l_orderkey").alias("n_orders"),
        F.count_distinct("o_custkey").alias("n_customers"),
        F.count_distinct("l_partkey").alias("n_products"),
    )


def discount_trend(star: SourceStar) -> DataFrame:
    """E18 + F8: yearly sum of discount and count of category members (lines with a
    category), with the 3-row moving average of the discount sum ordered by year."""
    lines = star.lines()
    p = star.t("part", "p_partkey", "p_type")
    per_order = (lines.join(p, lines.l_partkey == p.p_partkey)
                 .groupBy("l_orderkey").agg(F.sum("discount").alias("d"), F.count("p_type").alias("n")))
    o = star.orders().select("o_orderkey", "order_year")
    y = (per_order.join(o, per_order.l_orderkey == o.o_orderkey)
         .groupBy(F.col("order_year").alias("year"))
         .agg(F.sum("d").cast("double").alias("discount_sum"), F.sum("n").alias("category_count")))
    return y.select("year", "discount_sum", "category_count",
                    _d_expr(W.moving_avg("discount_sum", ["year"], 3)).alias("mavg3"))
