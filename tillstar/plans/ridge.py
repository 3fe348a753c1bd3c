"""Forecast in closed form (M2-M9, A7, E17): ridge regression from one grouped aggregate.

The model is that of ``forecast.fit``: five numeric features, missing as 0, standardised with the training rows' mean and population
standard deviation; month of year and category one-hot with every level kept; a free intercept; the objective
||y - Xw - b||^2 + alpha ||w||^2. A training row has only eight entries that are not 0, so the normal equations need no row
twice: one aggregate by (month, category) gives the counts, the sums and cross products of the numeric features, and their products
with the label. Its rows, as many as pairs of levels, give the Gram matrix, which numpy solves on the driver (its size is the
number of levels, plus six). Standardising afterwards is exact algebra on the sums.

A model is a table of its terms and can be stored, read again and applied (``save``, ``load``, ``score``). A level that training did not
see has no weight. Without training rows there is no model (ValueError).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import forecast
from .forecast import ALPHA, MISSING_LEVEL, NUMERIC
from .star import SourceStar

TERMS = "term string, level string, weight double, mean double, sd double"
MONTH, CATEGORY, INTERCEPT = "month_of_year", "category", "intercept"


def _filled(data: DataFrame) -> DataFrame:
    return data.select(F.col(MONTH).cast("string").alias(MONTH), F.coalesce(CATEGORY, F.lit(MISSING_LEVEL)).alias(CATEGORY),
                       *(F.coalesce(c, F.lit(0.0)).alias(c) for c in NUMERIC), F.col("next_month").alias("y"))


def moments(train: DataFrame) -> DataFrame:
    """A row for each (month, category): count, sums, cross products and products with the label."""
    names = [*NUMERIC, "y"]
    sums = [F.sum(c).alias(f"s_{c}") for c in names]
    products = [F.sum(F.col(a) * F.col(b)).alias(f"p_{a}_{b}") for k, a in enumerate(NUMERIC) for b in [*NUMERIC[k:], "y"]]
    return _filled(train).groupBy(MONTH, CATEGORY).agg(F.count(F.lit(1)).alias("n"), *sums, *products)


def solve(rows: list, alpha: float = ALPHA) -> list[tuple]:
    """The model's terms from the rows of ``moments``."""
    if not rows:
        raise ValueError("no training rows")
    k = len(NUMERIC)
    total = lambda name: sum(r[name] for r in rows)
    n = total("n")
    mean = np.array([total(f"s_{c}") for c in NUMERIC]) / n
    cross = np.zeros((k, k))
    for i, a in enumerate(NUMERIC):
        for j in range(i, k):
            cross[i, j] = cross[j, i] = total(f"p_{a}_{NUMERIC[j]}")
    centred = cross - n * np.outer(mean, mean)
    spread = np.diag(centred).copy()
    spread[spread <= 1e-13 * np.diag(cross)] = 0.0  # a constant, up to rounding
    sd = np.where(spread > 0, np.sqrt(np.maximum(spread, 0) / n), 1.0)
    levels = [(term, level) for term in (MONTH, CATEGORY) for level in sorted({r[term] for r in rows})]
    at = {key: k + i for i, key in enumerate(levels)}
    last = k + len(levels)
    gram, right = np.zeros((last + 1, last + 1)), np.zeros(last + 1)
    gram[:k, :k] = centred / np.outer(sd, sd)
    y = total("s_y")
    right[:k] = (np.array([total(f"p_{c}_y") for c in NUMERIC]) - mean * y) / sd
    for r in rows:
        own = [at[MONTH, r[MONTH]], at[CATEGORY, r[CATEGORY]], last]
        z = (np.array([r[f"s_{c}"] for c in NUMERIC]) - r["n"] * mean) / sd
        for i in own:
            gram[:k, i] += z
            right[i] += r["s_y"]
            for j in own:
                gram[i, j] += r["n"]
    gram[k:, :k] = gram[:k, k:].T
    gram[:k, last] = gram[last, :k] = 0.0  # standardised features sum to nothing
    gram[np.arange(last), np.arange(last)] += alpha  # the intercept is free
    w = np.linalg.solve(gram, right).tolist()
    out = [(c, None, w[i], float(mean[i]), float(sd[i])) for i, c in enumerate(NUMERIC)]
    out += [(term, level, w[at[term, level]], None, None) for term, level in levels]
    return [*out, (INTERCEPT, None, w[last], None, None)]


def fit(train: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """The model's terms as a small table."""
    rows = moments(train).collect()  # a row for each pair of levels
    return train.sparkSession.createDataFrame(solve(rows, alpha), TERMS)


def save(model: DataFrame, path: str) -> None:
    model.coalesce(1).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TERMS).parquet(path)


def score(model: DataFrame, data: DataFrame) -> DataFrame:
    """M8, M9: predictions beside actuals, in one projection; the terms (a row for each level) become its constants."""
    terms = model.collect()
    pred = F.lit(next(r["weight"] for r in terms if r["term"] == INTERCEPT))
    for r in terms:
        if r["mean"] is not None:
            pred = pred + F.lit(r["weight"]) * (F.coalesce(r["term"], F.lit(0.0)) - F.lit(r["mean"])) / F.lit(r["sd"])
    for term, value in ((MONTH, F.col(MONTH).cast("string")), (CATEGORY, F.coalesce(CATEGORY, F.lit(MISSING_LEVEL)))):
        own = [x for r in terms if r["term"] == term for x in (F.lit(r["level"]), F.lit(r["weight"]))]
        pred = pred + F.coalesce(F.try_element_at(F.create_map(*own), value), F.lit(0.0))
    return data.select("product_id", "product_key", "month", "monthly_sales", "next_month", pred.alias("pred_next_month"))


def run(star: SourceStar, through: str | None = None) -> DataFrame:
    """Scores of the latest month by a model of all earlier ones; the model goes through a stored table if a path is given."""
    train, test = forecast.split_last_month(cut_lineage(forecast.features(star)))
    model = fit(train)
    if through is not None:
        save(model, through)
        model = load(star.spark, through)
    return score(model, test)


def rounded(scores: DataFrame) -> DataFrame:
    """As reported: predictions to cents."""
    return scores.withColumn("pred_next_month", F.round("pred_next_month", 2))
