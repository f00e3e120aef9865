"""Principal components of the assembled features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MAX_COMPONENTS = 10


@dataclass
class Components:
    """Loadings (features x components, largest entry of each positive) and variance ratios."""

    loadings: np.ndarray
    explained: np.ndarray

    def table(self, spark) -> DataFrame:
        rows = [(i + 1, float(e), self.loadings[:, i].tolist()) for i, e in enumerate(self.explained)]
        return spark.createDataFrame(rows, "component int, explained double, loading array<double>")

    @staticmethod
    def from_table(table: DataFrame) -> Components:
        rows = sorted(table.collect(), key=lambda r: r["component"])  # one row per component
        return Components(np.array([r["loading"] for r in rows]).T, np.array([r["explained"] for r in rows]))


def fit_pca(points: DataFrame, dims: int, rows: int) -> Components:
    """The first min(dims, rows, 10) principal components of ``points(x, features)``.

    Spark reduces the rows to a features x features matrix; only that matrix is
    decomposed on the driver.
    """
    spread = points.agg(*[F.stddev_samp(F.col("x")[i]).alias(f"s{i}") for i in range(dims)]).first()
    std = np.array([spread[f"s{i}"] or 0.0 for i in range(dims)])
    if dims > 1:
        corr = np.nan_to_num(Correlation.corr(points.select("features"), "features").first()[0].toArray())
    else:
        corr = np.ones((1, 1))
    cov = corr * std[:, None] * std[None, :]
    np.fill_diagonal(cov, std * std)
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(values)[::-1][:min(dims, rows, MAX_COMPONENTS)]
    pc = vectors[:, order]
    pc = pc * np.where(pc[np.abs(pc).argmax(axis=0), np.arange(pc.shape[1])] < 0, -1.0, 1.0)
    return Components(pc, np.maximum(values[order], 0.0) / values.sum())


def pca_report(spark, ratios: list[float]) -> DataFrame:
    """Explained and cumulative variance ratio per component."""
    parts = spark.createDataFrame([(i + 1, float(r)) for i, r in enumerate(ratios)], "component int, explained double")
    running = W.orderBy("component").rowsBetween(W.unboundedPreceding, W.currentRow)
    return parts.withColumn("cumulative", F.sum("explained").over(running))


def plane(points: DataFrame, model: Components) -> DataFrame:
    """``(row_id, pc1, pc2)`` of ``points(row_id, x)``; pc2 is 0 when there is one component."""
    pc = model.loadings

    def score(j):
        if j >= pc.shape[1]:
            return F.lit(0.0)
        loading = F.array(*[F.lit(float(v)) for v in pc[:, j]])
        return F.aggregate(F.zip_with("x", loading, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)

    return points.select("row_id", score(0).alias("pc1"), score(1).alias("pc2"))
