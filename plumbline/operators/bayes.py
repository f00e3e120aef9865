"""Gaussian naive Bayes from one grouped aggregation.

Counts, means and variances per fold and class are merged into the training
statistics of every fold, so the whole smoothing grid over all folds needs one
aggregation to fit and one scan to score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.blocks import matrix


@dataclass
class BayesModel:
    """Priors, means and smoothed variances per class; classes in ascending order."""

    classes: np.ndarray
    prior: np.ndarray
    mean: np.ndarray
    var: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        score = np.empty((len(x), len(self.classes)))
        for c in range(len(self.classes)):
            v = self.var[c]
            score[:, c] = np.log(self.prior[c]) - 0.5 * (
                np.log(2 * np.pi * v).sum() + ((x - self.mean[c]) ** 2 / v).sum(axis=1))
        return self.classes[np.argmax(score, axis=1)]

    def table(self, spark) -> DataFrame:
        rows = [(float(c), float(p), m.tolist(), v.tolist())
                for c, p, m, v in zip(self.classes, self.prior, self.mean, self.var, strict=True)]
        return spark.createDataFrame(rows, "label double, prior double, mean array<double>, var array<double>")


@dataclass
class GroupMoments:
    """Rows, means and population variances per (fold, class)."""

    folds: np.ndarray
    labels: np.ndarray
    n: np.ndarray
    mean: np.ndarray
    var: np.ndarray

    def without(self, fold: int | None) -> GroupMoments:
        keep = np.ones(len(self.n), dtype=bool) if fold is None else self.folds != fold
        return GroupMoments(*(a[keep] for a in (self.folds, self.labels, self.n, self.mean, self.var)))


def class_moments(df: DataFrame, dims: int, label: str = "label", fold: str | None = None) -> GroupMoments:
    f = F.col(fold) if fold else F.lit(0)
    aggs = [a for i in range(dims) for a in (F.avg(F.col("x")[i]).alias(f"m{i}"), F.var_pop(F.col("x")[i]).alias(f"v{i}"))]
    rows = df.groupBy(f.alias("f"), F.col(label).alias("y")).agg(F.count(F.lit(1)).alias("n"), *aggs).collect()
    rows.sort(key=lambda r: (r["f"], r["y"]))
    return GroupMoments(np.array([r["f"] for r in rows]), np.array([r["y"] for r in rows]),
                        np.array([r["n"] for r in rows], dtype=float),
                        np.array([[r[f"m{i}"] for i in range(dims)] for r in rows]),
                        np.array([[r[f"v{i}"] for i in range(dims)] for r in rows]))


def _merge(n: np.ndarray, mean: np.ndarray, var: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    total = n.sum()
    m = (n[:, None] * mean).sum(axis=0) / total
    return total, m, (n[:, None] * (var + (mean - m) ** 2)).sum(axis=0) / total


def fit_bayes(moments: GroupMoments, smoothing: float) -> BayesModel:
    """Smoothing adds that share of the largest overall feature variance to every variance."""
    _, _, overall = _merge(moments.n, moments.mean, moments.var)
    classes = np.unique(moments.labels)
    parts = [_merge(*(a[moments.labels == c] for a in (moments.n, moments.mean, moments.var))) for c in classes]
    n = np.array([p[0] for p in parts])
    return BayesModel(classes, n / n.sum(), np.array([p[1] for p in parts]),
                      np.array([p[2] for p in parts]) + smoothing * overall.max())


def predict_bayes(df: DataFrame, model: BayesModel, out: str = "prediction") -> DataFrame:
    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.predict(matrix(x)).astype(float))

    return df.withColumn(out, score("x"))


def bayes_grid(df: DataFrame, dims: int, smoothings: list[float], folds: int, label: str = "label") -> DataFrame:
    """``(fold, acc_0, acc_1, ...)``: accuracy of every smoothing on every validation fold."""
    moments = class_moments(df, dims, label, "fold")
    models = [[fit_bayes(moments.without(f), s) for s in smoothings] for f in range(folds)]

    @F.pandas_udf("array<double>")
    def score(x: pd.Series, fold: pd.Series) -> pd.Series:
        m, f = matrix(x), fold.to_numpy()
        found = np.empty((len(f), len(smoothings)))
        for k in np.unique(f):
            for j, model in enumerate(models[k]):
                found[f == k, j] = model.predict(m[f == k])
        return pd.Series(list(found))

    scored = df.select("fold", F.col(label).alias("y"), score("x", "fold").alias("p"))
    hits = [F.avg(F.when(F.col("p")[j] == F.col("y"), 1.0).otherwise(0.0)).alias(f"acc_{j}") for j in range(len(smoothings))]
    return scored.groupBy("fold").agg(*hits)
