"""Table calculations as window expressions.

All of them run *after* aggregation, on frames whose size is bounded by the number of
periods or cells (years, months, region x category). A window without ``partitionBy`` puts
its rows in one task, which is only acceptable for such bounded frames; per-entity series
(the forecast's product months) always pass ``partition``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _w(order, partition=None):
    w = Window.orderBy(*order) if partition is None else Window.partitionBy(*partition).orderBy(*order)
    return w


def lag_value(value: str, order, offset: int = 1, partition=None) -> Column:
    """value ``offset`` rows back (rows, not calendar periods)."""
    return F.lag(value, offset).over(_w(order, partition))


def lead_value(value: str, order, offset: int = 1, partition=None) -> Column:
    """value ``offset`` rows ahead."""
    return F.lead(value, offset).over(_w(order, partition))


def prior_mean(value: str, order, rows: int | None, partition=None) -> Column:
    """Mean of the previous ``rows`` rows (current excluded); all previous rows when
    ``rows`` is None. NULL on the first row.

    Computed as double(sum) / count: with a decimal input the sum is exact, so the mean is
    one correctly rounded division whatever order the frame is summed in."""
    start = Window.unboundedPreceding if rows is None else -rows
    w = _w(order, partition).rowsBetween(start, -1)
    n = F.count(value).over(w)
    return F.when(n > 0, F.sum(value).over(w).cast("double") / n.cast("double"))


def pct_diff(value: str, order, offset: int = 1, partition=None) -> Column:
    """(current - previous) / |previous|; NULL without a previous row or when it
    is 0."""
    prev = F.lag(value, offset).over(_w(order, partition))
    return F.when(prev != 0, (F.col(value) - prev) / F.abs(prev))


def change_vs_offset(value: str, order, offset: int = 12, partition=None) -> Column:
    """(current - value ``offset`` rows back) / that value, guarded against a zero base."""
    prev = F.lag(value, offset).over(_w(order, partition))
    return F.when(prev != 0, (F.col(value) - prev) / prev)


def moving_avg(value: str, order, rows: int = 3, partition=None) -> Column:
    """Mean of the current and ``rows - 1`` previous rows."""
    return F.avg(value).over(_w(order, partition).rowsBetween(-(rows - 1), 0))


def running_sum(value: str, order, partition=None) -> Column:
    """running total along the table order."""
    return F.sum(value).over(_w(order, partition).rowsBetween(Window.unboundedPreceding, 0))


def compound_rate(value: str, order, periods: int = 2, partition=None) -> Column:
    """(current / value ``periods`` rows back) ^ (1/periods) - 1; NULL unless both are
    positive."""
    prev = F.lag(value, periods).over(_w(order, partition))
    return F.when((prev > 0) & (F.col(value) > 0), F.pow(F.col(value) / prev, 1.0 / periods) - 1)


def top_n(df: DataFrame, order, n: int) -> DataFrame:
    """F12 (filter form): the first ``n`` rows by ``order`` (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)


def member_total(value: str, member: str) -> Column:
    """A member's total across the table, used as a sort key."""
    return F.sum(value).over(Window.partitionBy(member))
