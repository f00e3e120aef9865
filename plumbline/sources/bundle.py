"""Saved runs: everything needed to prepare and score new rows, as Spark tables and models."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.columns import nan_to_null, with_plain_names
from plumbline.operators.learners import MODEL_KINDS
from plumbline.operators.kmeans import KMeansRun, kmeans_labels
from plumbline.operators.mixture import MixtureModel, mixture_labels
from plumbline.operators.prepare import FeatureRecipe, Preparation
from plumbline.operators.reduce import Components, plane


def _write_facts(spark: SparkSession, path: str, facts: dict) -> None:
    spark.createDataFrame([(json.dumps(facts),)], "facts string").write.mode("overwrite").parquet(f"{path}/facts")


def _read_facts(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.parquet(f"{path}/facts").first()["facts"])


def _write_preparation(path: str, preparation: Preparation) -> dict:
    if preparation.codes is not None:
        preparation.codes.write.mode("overwrite").parquet(f"{path}/codes")
    return {"features": preparation.to_records(), "rows": preparation.rows, "codes": preparation.codes is not None}


def _read_preparation(spark: SparkSession, path: str, facts: dict) -> Preparation:
    codes = spark.read.parquet(f"{path}/codes") if facts["codes"] else None
    return Preparation([FeatureRecipe(**f) for f in facts["features"]], codes, facts["rows"])


def save_model_bundle(spark: SparkSession, folder: str, result, target: str) -> str:
    """Write the winner of a supervised run under ``folder/best_model_<name>``."""
    path = f"{folder}/best_model_{result.best_name}"
    facts = {
        "model_name": result.best_name, "task": result.task, "target": target, "classes": result.classes,
        "kind": result.best_model.kind, "model": result.best_model.save(spark, path),
        "preparation": _write_preparation(path, result.preparation)}
    _write_facts(spark, path, facts)
    return path


@dataclass
class ModelBundle:
    model_name: str
    task: str
    target: str
    classes: list
    preparation: Preparation
    model: object

    def score(self, df: DataFrame) -> DataFrame:
        """``(row_id, prediction)`` for new rows with the feature columns and a ``row_id``.

        Missing and NaN values are filled as in the fit; a category that the fit has
        not seen counts as missing. Ids have to be unique.
        """
        ready = self.preparation.transform(nan_to_null(with_plain_names(df)), ["row_id"])
        scored = self.model.predict(ready).select("row_id", "prediction")
        if self.task == "regression":
            return scored
        names = F.array(*[F.lit(c) for c in self.classes])
        return scored.select("row_id", names[F.col("prediction").cast("int")].alias("prediction"))


def load_model_bundle(spark: SparkSession, path: str) -> ModelBundle:
    facts = _read_facts(spark, path)
    model = MODEL_KINDS[facts["kind"]].load(spark, path, facts["model"])
    return ModelBundle(facts["model_name"], facts["task"], facts["target"], facts["classes"],
                       _read_preparation(spark, path, facts["preparation"]), model)


def save_cluster_bundle(spark: SparkSession, folder: str, result) -> str:
    """Write models, labels, rules and the choice of an unsupervised run."""
    path = f"{folder}/unsupervised_models"
    result.labels.write.mode("overwrite").partitionBy("algo").parquet(f"{path}/labels")
    result.kmeans.table(spark).write.mode("overwrite").parquet(f"{path}/kmeans")
    result.pca.table(spark).write.mode("overwrite").parquet(f"{path}/pca")
    result.merge_tree.write.mode("overwrite").parquet(f"{path}/merge_tree")
    result.itemsets.write.mode("overwrite").parquet(f"{path}/itemsets")
    result.rules.write.mode("overwrite").parquet(f"{path}/rules")
    result.mixture.table(spark).write.mode("overwrite").parquet(f"{path}/mixture")
    _write_facts(spark, path, {"best_k": result.best_k, "best_model": result.best_model,
                               "scores": result.scores, "preparation": _write_preparation(path, result.preparation)})
    return path


@dataclass
class ClusterBundle:
    """A saved unsupervised run: its facts and tables, and the fitted models for new rows."""

    facts: dict
    tables: dict[str, DataFrame]
    preparation: Preparation
    kmeans: KMeansRun
    pca: Components
    mixture: MixtureModel

    def assign(self, df: DataFrame) -> DataFrame:
        """``(row_id, kmeans, mixture, pc1, pc2)`` for new rows with the feature columns and a ``row_id``."""
        ready = self.preparation.transform(nan_to_null(with_plain_names(df)), ["row_id"])
        near = kmeans_labels(ready.select("row_id", "x"), {self.kmeans.k: self.kmeans}).select(
            "row_id", F.col(f"km_{self.kmeans.k}").alias("kmeans"))
        blend = mixture_labels(ready, self.mixture).withColumnRenamed("cluster", "mixture")
        return near.join(blend, "row_id").join(plane(ready, self.pca), "row_id")


def load_cluster_bundle(spark: SparkSession, path: str) -> ClusterBundle:
    facts = _read_facts(spark, path)
    tables = {n: spark.read.parquet(f"{path}/{n}") for n in ("labels", "kmeans", "pca", "merge_tree", "itemsets", "rules")}
    preparation = _read_preparation(spark, path, facts.pop("preparation"))
    return ClusterBundle(facts, tables, preparation, KMeansRun.from_table(tables["kmeans"]), Components.from_table(tables["pca"]),
                         MixtureModel.from_table(spark.read.parquet(f"{path}/mixture")))
