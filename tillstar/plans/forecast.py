"""Next-month sales forecast per product.

Features are built with one window specification (partition by product, order by month),
so Catalyst plans a single shuffle and sort for all lags and means. After the product-month
aggregate each product has at most one row per month, so even a product holding a third of
all sales lines is a short series in its window partition.

Model: impute numeric features with 0 and standardise them with the training set's mean and
population standard deviation (baked into a SQL stage so the fitted pipeline saves and
loads whole), one-hot month of year and category keeping every trained level (unseen ->
all zeros), then ridge regression solved by the normal equations. MLlib scales the penalty
by the label's standard deviation, so ``regParam = alpha * stddev_pop(y) / n`` reproduces
the usual ``||y - Xw||^2 + alpha ||w||^2`` objective.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import month_start
from ..operators import windows as W
from ..session import cut_lineage
from ..sources.tables import register_views
from .star import SourceStar

NUMERIC = ["lag_1", "lag_2", "lag_3", "roll3_mean", "prod_mean_sales"]
CATEGORICAL = ["month_of_year", "category"]
# --- fixed values: model settings ---
ALPHA = 1.0
MISSING_LEVEL = "[MISSING]"
# --- end of fixed values ---


def source_rows(star: SourceStar) -> DataFrame:
    """Q17: fact lines with order date and (left-joined) product key and category."""
    lines = star.lines()
    o = star.orders().select("o_orderkey", "order_date")
    p = star.products().select("p_partkey", "product_key", "category")
    j = lines.join(o, lines.l_orderkey == o.o_orderkey).join(p, lines.l_partkey == p.p_partkey, "left")
    return j.select(F.col("l_partkey").alias("product_id"), "product_key", "category", "order_date",
                    F.col("sales"))


def monthly(star: SourceStar) -> DataFrame:
    """Product-month sales; rows with a NULL key are dropped (as a grouped sum would)."""
    s = source_rows(star).filter(F.col("product_key").isNotNull() & F.col("category").isNotNull())
    return s.groupBy("product_id", "product_key", "category", month_start(F.col("order_date")).alias("month")).agg(
        F.sum("sales").alias("monthly_sales"))


def features(star: SourceStar) -> DataFrame:
    """M1: lags, prior means, month of year and next month's sales; rows without a
    previous month or without a next month are dropped (C4, C5)."""
    m = monthly(star)  # monthly_sales stays an exact decimal through the windows
    order, part = ["month"], ["product_id"]
    d = "double"
    return (m.select(
        "product_id", "product_key", "category", "month",
        F.col("monthly_sales").cast(d).alias("monthly_sales"),
        W.lag_value("monthly_sales", order, 1, part).cast(d).alias("lag_1"),
        W.lag_value("monthly_sales", order, 2, part).cast(d).alias("lag_2"),
        W.lag_value("monthly_sales", order, 3, part).cast(d).alias("lag_3"),
        W.prior_mean("monthly_sales", order, 3, part).alias("roll3_mean"),
        W.prior_mean("monthly_sales", order, None, part).alias("prod_mean_sales"),
        F.month("month").cast("long").alias("month_of_year"),
        W.lead_value("monthly_sales", order, 1, part).cast(d).alias("next_month"),
    ).filter(F.col("lag_1").isNotNull() & F.col("next_month").isNotNull()))


def split_last_month(data: DataFrame) -> tuple[DataFrame, DataFrame]:
    """C6 + E9: test = the latest month, train = every earlier month."""
    last = data.agg(F.max("month")).first()[0]
    return data.filter(F.col("month") < F.lit(last)), data.filter(F.col("month") == F.lit(last))


def _prep_statement(train: DataFrame) -> str:
    """M2 + M3 + M4: impute 0, standardise with train mean / population sd (sd 0 -> 1)."""
    filled = train.select([F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in NUMERIC])
    stats = filled.agg(*[F.avg(c).alias(f"m_{c}") for c in NUMERIC],
                       *[F.stddev_pop(c).alias(f"s_{c}") for c in NUMERIC]).first()
    parts = []
    for c in NUMERIC:
        mean, sd = stats[f"m_{c}"] or 0.0, stats[f"s_{c}"] or 0.0
        sd = sd if sd > 0 else 1.0
        parts.append(f"(coalesce({c}, 0D) - ({mean!r}D)) / ({sd!r}D) AS {c}_z")
    return ("SELECT *, " + ", ".join(parts) + ", cast(month_of_year AS string) AS month_of_year_s, "
            f"coalesce(category, '{MISSING_LEVEL}') AS category_s FROM __THIS__")


def fit(train: DataFrame, alpha: float = ALPHA) -> PipelineModel:
    """M5-M7: the whole preprocessing + ridge pipeline, fitted on ``train``."""
    y = train.agg(F.stddev_pop("next_month").alias("sd"), F.count(F.lit(1)).alias("n")).first()
    reg = alpha * (y["sd"] or 0.0) / max(int(y["n"]), 1)
    stages = [
        SQLTransformer(statement=_prep_statement(train)),
        StringIndexer(inputCols=["month_of_year_s", "category_s"], outputCols=["moy_idx", "cat_idx"],
                      handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=["moy_idx", "cat_idx"], outputCols=["moy_vec", "cat_vec"], dropLast=True),
        VectorAssembler(inputCols=[f"{c}_z" for c in NUMERIC] + ["moy_vec", "cat_vec"], outputCol="features"),
        LinearRegression(featuresCol="features", labelCol="next_month", predictionCol="pred_next_month",
                         regParam=reg, elasticNetParam=0.0, standardization=False, solver="normal",
                         fitIntercept=True),
    ]
    return Pipeline(stages=stages).fit(train)


def scores(model: PipelineModel, test: DataFrame) -> DataFrame:
    """M8 / M9: predictions beside actuals."""
    return model.transform(test).select("product_id", "product_key", "month", "monthly_sales", "next_month",
                                        "pred_next_month")


def metrics(scored: DataFrame) -> DataFrame:
    """MAE, RMSE and R^2 as plain aggregates in one pass; R^2 is NULL if the labels do not vary."""
    e = F.col("next_month") - F.col("pred_next_month")
    agg = scored.agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.sum(e * e).alias("sse"),
        F.var_pop("next_month").alias("var_y"),
    )
    return agg.select("test_rows", "mae", "rmse",
                      (F.lit(1.0) - F.try_divide("sse", F.col("var_y") * F.col("test_rows"))).alias("r2"))


def sql_source(star: SourceStar) -> DataFrame:
    """The source rows by a query over registered views, as the reference asks a database for them."""
    register_views(star.spark, star.base_dir, ("lineitem", "orders", "part"))
    return star.spark.sql("""
        SELECT l.l_partkey AS product_id, concat('P-', p.p_partkey) AS product_ref, p.p_type AS category, CAST(o.o_orderdate AS date) AS order_date,
               l.l_quantity AS quantity
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey LEFT JOIN part p ON l.l_partkey = p.p_partkey""")


def run(star: SourceStar) -> tuple[PipelineModel, DataFrame]:
    # The feature table is read by several passes (split, scaling statistics, indexers,
    # the solver); materialise it once instead of re-running the joins for each.
    train, test = split_last_month(cut_lineage(features(star)))
    model = fit(train)
    return model, scores(model, test)


def save_model(model: PipelineModel, path: str) -> None:
    """Persist the fitted pipeline (shared storage on a cluster)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
