"""Calendar attributes and date parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of_week_sunday0(d: Column) -> Column:
    """Day of week with Sunday = 0 .. Saturday = 6 (Spark's ``dayofweek`` is Sunday = 1)."""
    return F.dayofweek(d) - 1


def calendar_columns(d: Column) -> dict[str, Column]:
    """The calendar attributes stored on ``dim_date``."""
    dow = day_of_week_sunday0(d)
    return {
        "year": F.year(d).cast("short"),
        "quarter": F.quarter(d).cast("short"),
        "month": F.month(d).cast("short"),
        "day": F.dayofmonth(d).cast("short"),
        "day_of_week": dow.cast("short"),
        "is_weekend": dow.isin(0, 6),
        "is_holiday": F.lit(False),
    }


def month_start(d: Column) -> Column:
    """First day of the month."""
    return F.trunc(d, "MM")


def year_start(d: Column) -> Column:
    """First day of the year."""
    return F.trunc(d, "YEAR")


def quarter_of_month(m: Column) -> Column:
    """Quarter from a month number."""
    return F.floor((m - 1) / 3).cast("int") + 1
