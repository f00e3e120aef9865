"""Model families: parameter grids and how each family fits and predicts on Spark.

A fitted model adds a ``prediction`` column to rows with ``row_id, x, features``.
Class labels are indexes into the sorted classes.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import bayes as B
from plumbline.operators import neighbors as N
from plumbline.operators import newton as O
from plumbline.operators import trees as D
from plumbline.operators.blocks import matrix

# The parameter grids to search, per family, in the order families are tried.
REGRESSION_GRIDS = {
    "LinearRegression": {"fit_intercept": [True, False]},
    "DecisionTreeRegressor": {"max_depth": [None, 3, 5, 10], "min_samples_split": [2, 5, 10]},
    "RandomForestRegressor": {"n_estimators": [50, 100, 200], "max_depth": [None, 5, 10], "min_samples_split": [2, 5]},
    "KNeighborsRegressor": {"n_neighbors": [3, 5, 7, 10], "weights": ["uniform", "distance"], "p": [1, 2]},
}
CLASSIFICATION_GRIDS = {
    "LogisticRegression": {"C": [0.01, 0.1, 1, 10], "solver": ["lbfgs", "liblinear"]},
    "DecisionTreeClassifier": {"max_depth": [None, 3, 5, 10], "criterion": ["gini", "entropy"]},
    "RandomForestClassifier": {"n_estimators": [50, 100, 200], "max_depth": [None, 5, 10], "criterion": ["gini", "entropy"]},
    "NaiveBayes": {"var_smoothing": [1e-9, 1e-8, 1e-7]},
    "SVM": {"C": [0.1, 1, 10], "kernel": ["rbf", "linear"], "gamma": ["scale", "auto"]},
    "KNeighborsClassifier": {"n_neighbors": [3, 5, 7, 10], "weights": ["uniform", "distance"], "p": [1, 2]},
}

# Reduced grids for smoke runs; families that score their whole grid in one job keep it.
SMALL_GRIDS = {
    "LinearRegression": {"fit_intercept": [True]},
    "DecisionTreeRegressor": {"max_depth": [5], "min_samples_split": [2]},
    "RandomForestRegressor": {"n_estimators": [10], "max_depth": [5], "min_samples_split": [2]},
    "LogisticRegression": {"C": [1], "solver": ["lbfgs"]},
    "DecisionTreeClassifier": {"max_depth": [3], "criterion": ["gini"]},
    "RandomForestClassifier": {"n_estimators": [10], "max_depth": [5], "criterion": ["gini"]},
    "SVM": {"C": [1], "kernel": ["linear"], "gamma": ["scale"]},
}



def candidates(grid: dict[str, list]) -> list[dict]:
    """All combinations, parameters in name order; ties in score go to the earlier one."""
    names = sorted(grid)
    return [dict(zip(names, values, strict=True)) for values in itertools.product(*(grid[n] for n in names))]


@dataclass
class FitContext:
    """What a fit needs to know about its training rows."""

    rows: int
    dims: int
    classes: int
    spread: float  # variance of all feature entries
    seed: int = 42


def context(train: DataFrame, dims: int, classes: int, seed: int) -> FitContext:
    """Context of a fit on all rows of ``train``."""
    return fold_contexts(train.withColumn("fold", F.lit(0)), 0, dims, classes, seed)[-1]


def fold_contexts(train: DataFrame, folds: int, dims: int, classes: int, seed: int) -> list[FitContext]:
    """Contexts of the fits that leave out each fold, and last of the fit on all rows, from one scan."""
    total = F.aggregate("x", F.lit(0.0), lambda s, v: s + v)
    squares = F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)
    parts = {r["fold"]: np.array([r["n"], r["t"], r["q"]]) for r in train.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.sum(total).alias("t"), F.sum(squares).alias("q")).collect()}
    every = sum(parts.values())
    out = []
    for n, t, q in [every - parts[f] for f in range(folds)] + [every]:
        entries = n * dims
        out.append(FitContext(int(n), dims, classes, q / entries - (t / entries) ** 2, seed))
    return out


@dataclass
class SparkModel:
    """A Spark ML model."""

    model: object
    kind: str = "spark"

    def predict(self, df: DataFrame) -> DataFrame:
        out = self.model.transform(df)
        return out.select(*df.columns, F.col("prediction").cast("double").alias("prediction"))

    def save(self, spark: SparkSession, path: str) -> dict:
        PipelineModel([self.model]).write().overwrite().save(f"{path}/model")
        return {}

    @staticmethod
    def load(spark: SparkSession, path: str, facts: dict) -> SparkModel:
        return SparkModel(PipelineModel.load(f"{path}/model").stages[0])


@dataclass
class LinearScores:
    """One linear score per class, or a single one that separates class 1 from class 0."""

    weights: list[list[float]]
    intercepts: list[float]
    kind: str = "linear"

    def predict(self, df: DataFrame) -> DataFrame:
        w, b = np.array(self.weights), np.array(self.intercepts)

        @F.pandas_udf("double")
        def score(x: pd.Series) -> pd.Series:
            s = matrix(x) @ w.T + b
            return pd.Series((s[:, 0] > 0 if len(b) == 1 else s.argmax(axis=1)).astype(float))

        return df.withColumn("prediction", score("x"))

    def save(self, spark: SparkSession, path: str) -> dict:
        return {"weights": self.weights, "intercepts": self.intercepts}

    @staticmethod
    def load(spark: SparkSession, path: str, facts: dict) -> LinearScores:
        return LinearScores(facts["weights"], facts["intercepts"])


@dataclass
class BayesScores:
    model: B.BayesModel
    kind: str = "bayes"

    def predict(self, df: DataFrame) -> DataFrame:
        return B.predict_bayes(df, self.model)

    def save(self, spark: SparkSession, path: str) -> dict:
        self.model.table(spark).write.mode("overwrite").parquet(f"{path}/model")
        return {}

    @staticmethod
    def load(spark: SparkSession, path: str, facts: dict) -> BayesScores:
        rows = sorted(spark.read.parquet(f"{path}/model").collect(), key=lambda r: r["label"])  # one row per class
        return BayesScores(B.BayesModel(*(np.array([r[c] for r in rows]) for c in ("label", "prior", "mean", "var"))))


@dataclass
class NeighbourVotes:
    """The training rows are the model."""

    train: DataFrame
    classify: bool
    k: int
    weights: str
    p: int
    dims: int
    kind: str = "neighbours"

    def predict(self, df: DataFrame) -> DataFrame:
        near = N.neighbours(df, self.train, self.k, (self.p,), self.dims)
        voted = N.neighbour_predictions(near, self.classify, (self.k,), (self.weights,)).select(
            "row_id", F.col(f"pred_{self.k}_{self.weights}").alias("prediction"))
        return df.join(voted, "row_id")

    def save(self, spark: SparkSession, path: str) -> dict:
        self.train.select("row_id", "x", "target").write.mode("overwrite").parquet(f"{path}/model")
        return {"classify": self.classify, "k": self.k, "weights": self.weights, "p": self.p, "dims": self.dims}

    @staticmethod
    def load(spark: SparkSession, path: str, facts: dict) -> NeighbourVotes:
        return NeighbourVotes(spark.read.parquet(f"{path}/model"), **facts)


MODEL_KINDS = {"spark": SparkModel, "linear": LinearScores, "bayes": BayesScores, "neighbours": NeighbourVotes,
               "forest": D.Forest, "decision": O.Decision}


def _linear_regression(train: DataFrame, params: dict, ctx: FitContext):
    return SparkModel(LinearRegression(regParam=0.0, solver="normal", fitIntercept=params["fit_intercept"]).fit(train))


def growth(params: dict, ctx: FitContext) -> D.Growth:
    """How the trees of a candidate grow; limits of depth and rows apply when the trees are read."""
    forest, classes = "n_estimators" in params, max(ctx.classes, 2) if "criterion" in params else 0
    features = max(1, math.isqrt(ctx.dims)) if forest and classes else ctx.dims
    return D.Growth(classes, params.get("criterion", "variance"), params.get("n_estimators", 1), forest, features, ctx.dims, ctx.seed)


def stop_of(params: dict) -> tuple[int | None, int]:
    """The greatest depth and the least rows of a split."""
    return params["max_depth"], params.get("min_samples_split", 2)


def _trees(train: DataFrame, params: dict, ctx: FitContext):
    grown = growth(params, ctx)
    return D.Forest(grown, D.fit_trees(train, grown), *stop_of(params), grown.trees)


def problems(params: dict, ctx: FitContext, fold: int | None, kernel: int | None = None) -> list[O.Fit]:
    """The fits that make up one candidate's model on the rows outside ``fold``."""
    classes = max(ctx.classes, 2)
    if "kernel" in params:
        pairs = [(1, 0)] if classes == 2 else list(itertools.combinations(range(classes), 2))
        return [O.Fit("hinge", params["C"], fold, a, b, kernel=kernel) for a, b in pairs]
    if params["solver"] == "lbfgs":
        return [O.Fit("softmax", params["C"], fold, outputs=classes) if classes > 2 else O.Fit("logistic", params["C"], fold)]
    return [O.Fit("logistic", params["C"], fold, c, intercept=True) for c in ([1] if classes == 2 else range(classes))]


def kernel_width(params: dict, ctx: FitContext) -> float | None:
    """The factor of the squared distance in a Gaussian kernel."""
    if params.get("kernel") != "rbf":
        return None
    return 1.0 / (ctx.dims * (ctx.spread or 1.0)) if params["gamma"] == "scale" else 1.0 / ctx.dims


def too_wide(params: dict, ctx: FitContext) -> bool:
    """Whether a linear fit has more parameters than one matrix of curvatures may."""
    outputs = ctx.classes if params.get("solver") == "lbfgs" and ctx.classes > 2 else 1
    return params.get("kernel") != "rbf" and outputs * (ctx.dims + 1) > O.WIDEST


def _newton(train: DataFrame, params: dict, ctx: FitContext):
    if too_wide(params, ctx) and "solver" in params:
        return _logistic(train, params, ctx)
    width = kernel_width(params, ctx)
    rows = train.select("row_id", "x", "label", F.lit(0).alias("fold")).persist()
    kernels = [] if width is None else [O.fit_kernel(rows, width, None)]
    fits = O.solve(rows, problems(params, ctx, None, 0 if kernels else None), kernels, ctx.dims)
    rows.unpersist()
    return O.Decision(fits, kernels, max(ctx.classes, 2))


def _logistic(train: DataFrame, params: dict, ctx: FitContext):
    """Fits of very many features, by Spark's own solver."""
    # a penalty on the mean loss equals one on the summed loss scaled by C and the rows
    penalty = 1.0 / (params["C"] * ctx.rows)
    if params["solver"] == "lbfgs":
        return SparkModel(LogisticRegression(maxIter=1000, regParam=penalty, elasticNetParam=0.0,
                                             standardization=False).fit(train))
    targets = [1] if ctx.classes <= 2 else range(ctx.classes)
    fits = [_penalised_intercept(train, c, penalty) for c in targets]
    return LinearScores([w for w, _ in fits], [b for _, b in fits])


def _penalised_intercept(train: DataFrame, positive: int, penalty: float) -> tuple[list[float], float]:
    """Logistic fit of one class against the rest whose intercept is penalised like a weight.

    The intercept becomes the weight of an extra feature. A constant one would be
    ignored, so about half of the rows are mirrored: features, constant and label
    flip, which leaves the loss unchanged. Which rows is decided by a hash of the id;
    the first and the last id differ by rule, so that both signs always occur.
    """
    ends = train.agg(F.min("row_id").alias("first"), F.max("row_id").alias("last")).first()
    y = F.when(F.col("label") == positive, 1.0).otherwise(0.0)
    sign = (F.when(F.col("row_id") == ends["first"], 1.0).when(F.col("row_id") == ends["last"], -1.0)
            .when(F.pmod(F.xxhash64("row_id"), F.lit(2)) == 1, -1.0).otherwise(1.0))
    mirrored = train.select(
        array_to_vector(F.transform(F.concat("x", F.array(F.lit(1.0))), lambda v: v * sign)).alias("features"),
        F.when(sign < 0, 1.0 - y).otherwise(y).alias("label"))
    model = LogisticRegression(maxIter=1000, regParam=penalty, elasticNetParam=0.0, standardization=False,
                               fitIntercept=False).fit(mirrored)
    w = model.coefficients.toArray()
    return w[:-1].tolist(), float(w[-1])


def _bayes(train: DataFrame, params: dict, ctx: FitContext):
    return BayesScores(B.fit_bayes(B.class_moments(train, ctx.dims), params["var_smoothing"]))


def _neighbours(classify: bool):
    def fit(train: DataFrame, params: dict, ctx: FitContext):
        rows = train.select("row_id", "x", F.col("label").alias("target"))
        return NeighbourVotes(rows, classify, params["n_neighbors"], params["weights"], params["p"], ctx.dims)
    return fit


@dataclass
class Family:
    name: str
    grid: dict[str, list]
    fit: Callable
    whole_grid: str | None = None  # families that score their grid in one job
    ignored: Callable[[dict], dict] = field(default=lambda p: p)


def without_unused_gamma(params: dict) -> dict:
    """A linear kernel has no width, so its candidates with different widths are one model."""
    return {**params, "gamma": None} if params["kernel"] == "linear" else params


_FITTERS = {
    "LinearRegression": (_linear_regression, None),
    "DecisionTreeRegressor": (_trees, "trees"),
    "RandomForestRegressor": (_trees, "trees"),
    "KNeighborsRegressor": (_neighbours(False), "neighbours"),
    "LogisticRegression": (_newton, "newton"),
    "DecisionTreeClassifier": (_trees, "trees"),
    "RandomForestClassifier": (_trees, "trees"),
    "NaiveBayes": (_bayes, "bayes"),
    "SVM": (_newton, "newton"),
    "KNeighborsClassifier": (_neighbours(True), "neighbours"),
}


def families(task: str, grid: str = "full") -> list[Family]:
    """Families of a task in the order they are tried; ``grid`` is ``full`` or ``small``."""
    if grid not in ("full", "small"):
        raise ValueError("grid is full or small")
    grids = CLASSIFICATION_GRIDS if task == "classification" else REGRESSION_GRIDS
    if grid == "small":
        grids = {n: SMALL_GRIDS.get(n, g) for n, g in grids.items()}
    return [Family(n, g, *_FITTERS[n], *((without_unused_gamma,) if n == "SVM" else ())) for n, g in grids.items()]
