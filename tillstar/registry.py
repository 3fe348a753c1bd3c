"""Registry of named queries: name -> callable(spark, base_dir) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import ByteType, DecimalType, IntegerType, ShortType

from .functions import metrics
from .parameters import CATEGORIES, F_CUTS, M_SCALE, REGIONS, SEGMENTS, YEARS
from .operators.profile import PROFILE_NUMERIC, PROFILE_TEXT, profile_columns
from .operators.profile_state import StoredProfile
from .plans import dashboard, etl, forecast, maintained, reports, ridge, roles, star_reports
from .plans.warehouse import parts_run, read_snapshot, two_batch_run
from .plans.star import SourceStar
from .session import cut_lineage, ensure_checkpoint_dir
from .sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]


def _star(fn):
    return lambda spark, base: fn(SourceStar(spark, base))


def _report_queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "sales_by_region": _star(reports.sales_by_region),
        "monthly_trend": _star(reports.monthly_trend),
        "top_customers": _star(reports.top_customers),
        "top_products": _star(reports.top_products),
        "by_ship_mode": _star(reports.by_ship_mode),
    }
    for intent in ("sales_by_region", "monthly_trend", "top_customers", "top_products"):
        q[f"chat_{intent}"] = _star(lambda s, i=intent: reports.chat_report(s, i))
    q["report_json"] = _star(reports.report_json)
    q["route_questions"] = lambda spark, base: reports.route_questions(
        read_table(spark, base, "conversations", "text"))
    q["route_rendered"] = lambda spark, base: reports.route_rendered(
        read_table(spark, base, "conversations", "conv_id", "turn", "text"))
    return q


def normalize_output(df: DataFrame) -> DataFrame:
    """Registered outputs use long for integers and double for decimals, so both the
    Spark and the oracle side agree on types."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (ByteType, ShortType, IntegerType)):
            c = c.cast("long")
        elif isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(cols)


def _norm(fn):
    return lambda spark, base: normalize_output(fn(SourceStar(spark, base)))


def _etl_queries() -> dict[str, Query]:
    names = {
        "clean_money": etl.q_clean_money, "guarded_numeric": etl.q_guarded_numeric,
        "norm_discount": etl.q_norm_discount, "norm_discount_clamped": etl.q_norm_discount_clamped,
        "parse_date": etl.q_parse_date, "to_qty": etl.q_to_qty, "row_hash": etl.q_row_hash,
        "csv_ranges": etl.q_csv_ranges, "unit_price": etl.q_unit_price, "calendar_attrs": etl.q_calendar_attrs, "conform": etl.q_conform,
        "stg_location": etl.q_stage("stg_dim_location"), "stg_product": etl.q_stage("stg_dim_product"),
        "stg_customer": etl.q_stage("stg_dim_customer"), "stg_orders": etl.q_stage("stg_orders"),
        "stg_sales_lines": etl.q_stage("stg_sales_lines"),
        "dim_date": etl.q_dim_date, "upsert_location": etl.q_upsert_location,
        "upsert_product": etl.q_upsert_product, "upsert_customer": etl.q_upsert_customer,
        "upsert_order": etl.q_upsert_order, "fact_replace": etl.q_fact_replace,
        "fact_rejects": etl.q_fact_rejects, "order_rejects": etl.q_order_rejects,
        "id_stability": etl.q_id_stability, "table_counts": etl.q_table_counts, "chk_staged": etl.q_chk_staged,
        "loc_lookup_nullsafe": roles.q_loc_lookup_nullsafe, "date_roles": roles.q_date_roles,
        "same_day_orders": roles.q_same_day_orders, "location_roles": roles.q_location_roles,
        **{f"chk_{k}": roles.q_check(k) for k in ("not_null", "unique", "fk", "range", "length")},
        "chk_precision": roles.q_check("numeric"),
        "wh_distinct_orders": lambda star: maintained.distinct_orders(two_batch_run(star, whole=True)[1].tables),
        "parts_facts": lambda star: read_snapshot(star.spark, parts_run(star)).tables["fact_sales"].drop("created_at"),
        "parts_customers": lambda star: read_snapshot(star.spark, parts_run(star)).tables["dim_customer"],
        "agg_sales_by_region": lambda star: maintained.sales_by_region(
            maintained.read(star.spark, parts_run(star)), read_snapshot(star.spark, parts_run(star)).tables["dim_location"]),
        "agg_monthly_trend": lambda star: maintained.monthly_trend(maintained.read(star.spark, parts_run(star))),
        **{f"wh_{k}": (lambda star, f=f: f(two_batch_run(star, whole=True)[1].tables)) for k, f in star_reports.REPORTS.items()},
    }
    return {k: _norm(v) for k, v in names.items()}


def _dash_queries() -> dict[str, Query]:
    d = dashboard
    m_cuts = metrics.scale_cuts(metrics.MONETARY_MIN, M_SCALE)
    names = {
        "yoy_year": d.yoy_year, "yoy12": d.yoy12, "pct_diff_month": d.pct_diff_month, "cagr2": d.cagr2,
        "pct_diff_day": d.pct_diff_day, "sales_mavg": d.sales_mavg,
        "sales_trends": lambda s: d.sales_trends(s, years=YEARS, regions=REGIONS, segments=SEGMENTS),
        "cum_profit_ratio": d.cum_profit_ratio, "profit_heatmap": d.profit_heatmap,
        "top_names": d.top_names,
        "rfm_scores": lambda s: d.rfm_scores(s, f_cuts=F_CUTS, m_cuts=m_cuts),
        "rfm_matrix": lambda s: d.rfm_matrix(s, segments=SEGMENTS, f_cuts=F_CUTS, m_cuts=m_cuts),
        "rfm_matrix_all": lambda s: d.rfm_matrix(s, codes=(111, 555), f_cuts=F_CUTS, m_cuts=m_cuts),
        "state_city_rollup": d.state_city_rollup,
        "snapshot_years": lambda s: d.snapshot_years(s, years=YEARS),
        "discount_trend": d.discount_trend, "heatmap_pivot": d.heatmap_pivot,
        "sales_trends_categories": lambda s: d.sales_trends(s, years=YEARS, categories=CATEGORIES),
    }
    return {k: _norm(v) for k, v in names.items()}


def _profile(star: SourceStar) -> DataFrame:
    return profile_columns(etl.raw_text_untrimmed(star), PROFILE_TEXT, PROFILE_NUMERIC)


def _profile_stored(star: SourceStar) -> DataFrame:
    """The profile of two raw files added one after the other: the lines of the years to 1994, and the others."""
    raw = etl.raw_text_untrimmed(star)
    early = F.coalesce(F.regexp_extract("order_date", r"(\d{4})", 1).try_cast("int") <= 1994, F.lit(False))
    kept = StoredProfile(star.spark, f"{ensure_checkpoint_dir(star.spark)}/profile-{uuid.uuid4().hex}", PROFILE_TEXT, PROFILE_NUMERIC)
    kept.add("early", raw.where(early))
    kept.add("late", raw.where(~early))
    return kept.profile()


def _scores(star: SourceStar) -> DataFrame:
    """One result for the queries on it, stored once per session."""
    return etl._memo(star, "forecast_scores", lambda: cut_lineage(ridge.run(star)))


def _forecast_scores(star: SourceStar) -> DataFrame:
    return ridge.rounded(_scores(star))


def _forecast_metrics(star: SourceStar) -> DataFrame:
    found = forecast.metrics(_scores(star))
    return found.select("test_rows", *(F.round(c, d).alias(c) for c, d in (("mae", 3), ("rmse", 3), ("r2", 6))))


def _forecast_stored_model(star: SourceStar) -> DataFrame:
    """Scores by a model that was stored and read again."""
    return ridge.rounded(ridge.run(star, through=f"{ensure_checkpoint_dir(star.spark)}/model-{uuid.uuid4().hex}"))


def _model_queries() -> dict[str, Query]:
    names = {
        "profile_columns": _profile,
        "profile_stored": _profile_stored,
        "forecast_source": forecast.source_rows,
        "forecast_features": forecast.features,
        "forecast_scores": _forecast_scores,
        "forecast_metrics": _forecast_metrics,
        "forecast_stored_model": _forecast_stored_model,
        "sql_source": forecast.sql_source,
    }
    return {k: _norm(v) for k, v in names.items()}


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    out.update(_report_queries())
    out.update(_etl_queries())
    out.update(_dash_queries())
    out.update(_model_queries())
    return out
