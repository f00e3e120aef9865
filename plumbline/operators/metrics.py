"""Holdout metrics as single aggregations over prediction tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import unit


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """R2, MAE and RMSE from one scan."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    sums = df.agg(F.count(F.lit(1)).alias("n"), F.var_pop(y).alias("v"),
                  F.avg((y - p) * (y - p)).alias("mse"), F.avg(F.abs(y - p)).alias("mae"))
    return sums.select((1 - F.col("mse") / F.nullif(F.col("v"), F.lit(0.0))).alias("r2"),
                       "mae", F.sqrt("mse").alias("rmse"))


def r2_of(label: Column, prediction: Column) -> Column:
    return 1 - F.avg((label - prediction) * (label - prediction)) / F.nullif(F.var_pop(label), F.lit(0.0))


def accuracy_of(label: Column, prediction: Column) -> Column:
    return F.avg(unit(label == prediction))


def class_scores(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per class: support, predicted count, hits and F1 (0 where undefined).

    The confusion counts are the only shuffle; everything after works on them.
    """
    cells = df.groupBy(F.col(label).alias("y"), F.col(prediction).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sides = cells.select(F.explode(F.array(
        F.struct(F.col("y").alias("c"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"),
                 F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).cast("bigint").alias("hits")),
        F.struct(F.col("p").alias("c"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"),
                 F.lit(0).cast("bigint").alias("hits")),
    )).alias("e")).select("e.*")
    per_class = sides.groupBy("c").agg(*[F.sum(x).alias(x) for x in ("support", "predicted", "hits")])
    f1 = F.coalesce(2.0 * F.col("hits") / F.nullif(F.col("support") + F.col("predicted"), F.lit(0)), F.lit(0.0))
    return per_class.withColumn("f1", f1)


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and support-weighted F1."""
    s = class_scores(df, label, prediction)
    total = F.sum("support")
    return s.agg((F.sum("hits") / total).alias("accuracy"),
                 (F.sum(F.col("f1") * F.col("support")) / total).alias("f1"))


def inertia(df: DataFrame, cluster: str, dims: int, x: str = "x") -> DataFrame:
    """Sum of squared distances to the cluster mean, without a join to the means.

    Per cluster that sum is the row count times the population variances, so one
    aggregation with running moments gives it.
    """
    spread = sum((F.var_pop(F.col(x)[i]) for i in range(1, dims)), F.var_pop(F.col(x)[0]))
    per = df.groupBy(cluster).agg((F.count(F.lit(1)) * spread).alias("s"))
    return per.agg(F.sum("s").alias("inertia"))


def cluster_sizes(labels: DataFrame) -> DataFrame:
    """Rows per algorithm and cluster of ``(row_id, algo, cluster)``."""
    return labels.groupBy("algo", "cluster").agg(F.count(F.lit(1)).alias("n"))
