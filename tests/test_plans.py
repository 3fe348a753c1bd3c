"""Plan properties that matter at scale: pushdown, pruning, partial aggregation."""

from helpers import SF_SMALL
from tillstar.plans import dashboard, reports
from tillstar.plans.star import SourceStar


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_year_filter_reaches_orders_scan(spark):
    df = dashboard.snapshot_years(SourceStar(spark, SF_SMALL), years=(1996, 2000))
    text = plan_text(df)
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text


def test_report_scans_read_only_needed_columns(spark, capsys):
    reports.sales_by_region(SourceStar(spark, SF_SMALL)).explain("formatted")
    text = capsys.readouterr().out
    assert ("ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,"
            "l_extendedprice:double,l_discount:double>") in text
    assert "l_returnflag" not in text and "l_tax" not in text
    # lines are summed per order with a map-side partial aggregate before any shuffle of lines
    assert "partial_sum" in text
