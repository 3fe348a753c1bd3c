"""Operator 2: quality by a regularised quadratic discriminant.

Each text becomes a vector of transformed statistics (logarithms of counts, square roots of shares).
Each class has a mean and a covariance, shrunk first towards the pooled covariance and then towards
a multiple of the identity. The score is the posterior of class 1: the difference of the two Gaussian
log densities - a Mahalanobis distance by the class's Cholesky factor, and its log determinant - and
of the log priors, through the logistic function. Factors are computed once and kept with the model.

Null and empty texts have the statistics of no words (all zero) and are scored like any other. Rows
without a label, or labelled other than 0 or 1, are not learned from. With only one class the score is
that class; with no labelled rows it is 0.5. Repeated rows get equal scores.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_worker, ship, slices
from .quality_rules import BLANKS, char_classes, repeat_words

STATISTICS = ("log words", "log mean word length", "distinct words", "upper", "digits", "punctuation", "symbols",
              "short words", "words without letters", "commonest word", "repeated lines", "repeated windows",
              "log words a line", "words ending in a stop", "capitalised words", "length spread")


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of a text, in the order of ``STATISTICS``."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    classes = char_classes(raw)
    total = max(1, int(classes.sum()))
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [line for line in raw.split(b"\n") if line.strip(BLANKS.encode())]
    if len(counts) < n:
        number = {w: i for i, w in enumerate(counts)}
        repeated = repeat_words(np.fromiter(map(number.__getitem__, words), np.int64, n))
    else:
        repeated = 0
    bare = sum(k for w, k in counts.items() if not any(b >= 128 or 65 <= b <= 90 or 97 <= b <= 122 for b in w))
    stops = sum(k for w, k in counts.items() if w[-1] in b".,;!?")
    capital = sum(k for w, k in counts.items() if 65 <= w[0] <= 90 or w[:2].decode("utf-8", "ignore")[:1].isupper())
    share = np.sqrt([classes[1] / total, classes[3] / total, classes[4] / total, classes[5] / total,
                     (lengths <= 3).mean(), bare / n, counts.most_common(1)[0][1] / n, 1 - len(set(lines)) / max(1, len(lines)),
                     repeated / n])
    return [float(np.log1p(n)), float(np.log1p(lengths.mean())), float(np.sqrt(len(counts) / n)), *share.tolist(),
            float(np.log1p(n / max(1, len(lines)))), float(np.sqrt(stops / n)), float(np.sqrt(capital / n)),
            float(np.log1p(lengths.std()))]


def add_statistics(df: DataFrame, text_col: str = "text", out: str = "stats") -> DataFrame:
    """Add ``out``: array<double> of the text's statistics. A column of that name is replaced."""
    ship(df.sparkSession)

    def measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([statistics(t) for part in slices(texts) for t in part.to_pylist()], pa.list_(pa.float64()))

    return df.withColumn(out, F.arrow_udf(measured, "array<double>")(F.col(text_col)))


class Discriminant(NamedTuple):
    priors: np.ndarray  # of classes 0 and 1
    means: np.ndarray
    whiten: np.ndarray  # inverse Cholesky factor of each class
    log_det: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Posterior of class 1 for each row of ``x``."""
        if not self.priors.all():
            return np.full(len(x), self.priors[1] if self.priors.sum() else 0.5)
        density = [np.log(self.priors[c]) - self.log_det[c] / 2
                   - (((x - self.means[c]) @ self.whiten[c].T) ** 2).sum(1) / 2 for c in (0, 1)]
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def fit(rows: DataFrame, stats_col: str = "stats", label_col: str = "label", pool: float = 0.1,
        ridge: float = 0.005) -> Discriminant:
    """Fit on all rows labelled 0 or 1. Spark sums the moments; one row a class reaches the driver."""
    d = len(STATISTICS)
    x = [F.col(stats_col)[i] for i in range(d)]
    pairs = [(i, j) for i in range(d) for j in range(i + 1)]
    sums = (rows.where(F.col(label_col).isin(0, 1)).groupBy(F.col(label_col).cast("int").alias("label"))
            .agg(F.count("*").alias("n"), F.array(*(F.sum(c) for c in x)).alias("s"),
                 F.array(*(F.sum(x[i] * x[j]) for i, j in pairs)).alias("p")).collect())
    n, means, scatter = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
    for r in sums:
        c = r["label"]
        n[c] = r["n"]
        means[c] = np.array(r["s"]) / n[c]
        for (i, j), v in zip(pairs, r["p"]):
            scatter[c, i, j] = scatter[c, j, i] = v
        scatter[c] -= n[c] * np.outer(means[c], means[c])
    pooled = scatter.sum(0) / max(1.0, n.sum())
    whiten, log_det = np.zeros((2, d, d)), np.zeros(2)
    for c in (0, 1):
        cov = (1 - pool) * scatter[c] / max(1.0, n[c]) + pool * pooled
        cov = (1 - ridge) * cov + ridge * max(np.trace(cov) / d, 1e-6) * np.eye(d)
        factor = np.linalg.cholesky(cov)
        whiten[c], log_det[c] = np.linalg.inv(factor), 2 * np.log(np.diag(factor)).sum()
    return Discriminant(n / max(1.0, n.sum()), means, whiten, log_det)


def score(df: DataFrame, model: Discriminant, stats_col: str = "stats", out: str = "score") -> DataFrame:
    """Add ``out``: the posterior of class 1. A column of that name is replaced."""
    spark = ship(df.sparkSession)
    shared, key = spark.sparkContext.broadcast(tuple(model)), uuid.uuid4().hex  # a few kilobytes

    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        one = per_worker(f"discriminant-{key}", lambda: Discriminant(*shared.value))
        for stats in batches:
            yield pa.array(one.score(stats.flatten().to_numpy(zero_copy_only=False).reshape(len(stats), -1)))

    return df.withColumn(out, F.arrow_udf(scored, "double")(F.col(stats_col)))
