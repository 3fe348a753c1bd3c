"""Business measures (B20-B26): margin, profit ratio, recency and RFM scoring."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: RFM cut-offs (score, bound), tried from the top score down ---
RECENCY_DAYS_MAX = [(5, 30), (4, 60), (3, 120), (2, 365)]  # days <= bound
FREQUENCY_MIN = [(5, 50), (4, 20), (3, 10), (2, 2)]        # orders >= bound
MONETARY_MIN = [(5, 10000), (4, 5000), (3, 2000), (2, 500)]  # sales >= bound
# --- end of fixed values ---


def margin_pct(profit: Column, sales: Column) -> Column:
    """100 x profit / sales rounded to 2; NULL when sales is 0."""
    return F.round(F.lit(100) * profit / F.nullif(sales, F.lit(0)), 2)


def profit_ratio(profit: Column, sales: Column) -> Column:
    """Profit / sales, NULL when sales is 0."""
    return F.when(sales != 0, profit / sales)


def recency_days(last: Column, as_of: Column) -> Column:
    """Days from the last order to the as-of date."""
    return F.datediff(as_of, last)


def _score(value: Column, cuts, at_most: bool) -> Column:
    expr = None
    for score, bound in cuts:
        cond = value <= bound if at_most else value >= bound
        expr = F.when(cond, F.lit(score)) if expr is None else expr.when(cond, F.lit(score))
    return expr.otherwise(F.lit(1))


def r_score(days: Column, cuts=RECENCY_DAYS_MAX) -> Column:
    """B23."""
    return _score(days, cuts, at_most=True)


def f_score(orders: Column, cuts=FREQUENCY_MIN) -> Column:
    """B24."""
    return _score(orders, cuts, at_most=False)


def m_score(sales: Column, cuts=MONETARY_MIN) -> Column:
    """B25."""
    return _score(sales, cuts, at_most=False)


def rfm_code(r: Column, f: Column, m: Column) -> Column:
    """R x 100 + F x 10 + M."""
    return r * 100 + f * 10 + m


def scale_cuts(cuts, factor: float):
    """Scale bounds of a cut list (the source data's prices are far above the defaults)."""
    return [(s, b * factor) for s, b in cuts]
