import numpy as np
import pandas as pd
import pytest

from plumbline.plans.supervised import run_supervised
from plumbline.plans.unsupervised import choose_clustering, run_unsupervised, sampled_scatter
from plumbline.sources.bundle import load_cluster_bundle, load_model_bundle


def people(n=120, seed=4):
    rng = np.random.default_rng(seed)
    group = rng.integers(0, 3, n)
    return pd.DataFrame({
        "age": rng.integers(5, 85, n), "fever": np.where(rng.random(n) < 0.1, np.nan, 98 + group * 2 + rng.normal(size=n)),
        "city": np.array(["Delhi", "Mumbai", "Kolkata"])[group], "cough": np.where(rng.random(n) < 0.6, "Mild", "Strong"),
        "sick": np.where(group + rng.normal(size=n) * 0.4 > 1, "Yes", "No")})


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "people.csv"
    people().to_csv(path, index=False)
    return str(path)


def test_classification_run_and_bundle(spark, csv, tmp_path):
    run = run_supervised(spark, csv, "sick", grid="small", cv=3, save_to=str(tmp_path / "out"))
    assert run.task == "classification" and run.classes == ["No", "Yes"]
    table = run.results.toPandas()
    assert list(table["model"]) == ["LogisticRegression", "DecisionTreeClassifier", "RandomForestClassifier",
                                    "NaiveBayes", "SVM", "KNeighborsClassifier"]
    assert table["accuracy"].between(0, 1).all() and table["accuracy"].max() >= 0.7
    assert run.best_name == table.loc[table["accuracy"].idxmax(), "model"]
    bundle = load_model_bundle(spark, run.bundle)
    new = spark.createDataFrame(people(20, 9).reset_index(names="row_id")).replace(float("nan"), None)
    before = run.best_model.predict(run.preparation.transform(new, ["row_id"])).select("row_id", "prediction")
    after = {r["row_id"]: r["prediction"] for r in bundle.score(new).collect()}
    assert after == {r["row_id"]: run.classes[int(r["prediction"])] for r in before.collect()}


def test_regression_run(spark, tmp_path):
    pdf = people(90)
    pdf["fever"] = pdf["fever"].fillna(100) + np.arange(90) * 1e-3
    df = spark.createDataFrame(pdf.reset_index(names="id"))
    run = run_supervised(spark, df, "fever", "id", grid="small", cv=3, corr_threshold=0.0, fit_on="train",
                         save_to=str(tmp_path / "out"))
    assert run.task == "regression"
    assert run.results.columns == ["model", "r2_score", "mae", "rmse", "cv_r2", "best_params"]
    assert run.results.agg({"r2_score": "max"}).first()[0] > 0.4
    scored = load_model_bundle(spark, run.bundle).score(df.withColumnRenamed("id", "row_id"))
    assert scored.count() == 90


def test_rows_without_target_are_left_out(spark):
    pdf = people(80)
    pdf.loc[:9, "sick"] = None
    df = spark.createDataFrame(pdf.reset_index(names="id"))
    run = run_supervised(spark, df, "sick", "id", grid="small", cv=3)
    assert (run.rows, run.rows_without_target) == (70, 10)


def test_bad_arguments(spark, csv):
    with pytest.raises(ValueError):
        run_supervised(spark, csv, "nothing")
    with pytest.raises(ValueError):
        run_supervised(spark, csv, "sick", grid="huge")
    with pytest.raises(ValueError):
        run_unsupervised(spark, csv, metric="cosine")


def test_unsupervised_run_and_bundle(spark, csv, tmp_path):
    run = run_unsupervised(spark, csv, max_k=4, dbscan_eps=1.0, restarts=3, save_to=str(tmp_path / "out"))
    assert list(run.scores) == ["KMeans", "Hierarchical", "DBSCAN", "GMM"]
    assert run.best_model == choose_clustering(run.scores)
    assert run.k_sweep.count() == 3
    assert run.labels.count() == 4 * 120
    expected = {"elbow", "silhouette_by_k", "scatter_kmeans", "scatter_hierarchical", "scatter_dbscan", "scatter_gmm",
                "merge_tree", "variance_table", "cluster_size_table", "cluster_model_table", "top10_rules"}
    assert set(run.tables) == expected
    assert run.tables["scatter_gmm"].count() == 120 and run.merge_tree.count() == 119
    assert sampled_scatter(run.tables["scatter_gmm"], 1).count() == 120
    back = load_cluster_bundle(spark, run.bundle)
    new = spark.createDataFrame(people(30, 9).reset_index(names="row_id"))
    assert back.assign(new).where("kmeans IS NOT NULL AND mixture IS NOT NULL AND pc1 IS NOT NULL").count() == 30
    assert back.facts["best_model"] == run.best_model and back.facts["best_k"] == run.best_k
    assert back.tables["labels"].count() == 480 and back.tables["rules"].count() == run.rules.count()
    assert np.allclose(back.kmeans.centers, run.kmeans.centers) and np.allclose(back.pca.loadings, run.pca.loadings)


def test_numeric_table_uses_median_items_and_squared_scores(spark):
    pdf = people(60)[["age", "fever"]].fillna(100)
    run = run_unsupervised(spark, spark.createDataFrame(pdf), max_k=3, restarts=2, metric="squared", min_support=0.1)
    assert run.metric == "squared"
    items = {i for r in run.itemsets.collect() for i in r["items"]}
    assert items <= {"age_high", "fever_high"}


def test_later_clustering_wins_a_tie():
    assert choose_clustering({"KMeans": 0.5, "Hierarchical": None, "DBSCAN": -1.0, "GMM": 0.5}) == "GMM"
