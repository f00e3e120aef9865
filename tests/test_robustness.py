"""Inputs that tables really have: odd ids, repeated ids, gaps in truth columns, dotted names, unseen categories, many classes."""

import numpy as np
import pandas as pd
import pytest

from plumbline.functions.columns import with_plain_names, with_row_id
from plumbline.operators import kmeans as K
from plumbline.operators import learners as L
from plumbline.operators import rules as A
from plumbline.operators.mixture import fit_mixture
from plumbline.plans.supervised import run_supervised, with_label
from plumbline.plans.unsupervised import run_unsupervised
from plumbline.sources.bundle import ModelBundle
from plumbline.sources.text import read_table
from plumbline.operators.prepare import fit_preparation
from test_learners import family, frame, newton


@pytest.mark.parametrize("ids", ["even", "odd", "spread"])
def test_penalised_intercept_for_any_ids(spark, make_points, ids):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(160, 3))
    y = (x[:, 0] + 0.8 + rng.normal(size=160) > 0).astype(float)
    step, first = {"even": (2, 0), "odd": (2, 1), "spread": (1009, 7)}[ids]
    df = frame(make_points, x, y).selectExpr(f"row_id * {step} + {first} AS row_id", "x", "features", "label")
    fit = family("classification", "LogisticRegression").fit(df, {"C": 1, "solver": "liblinear"}, L.context(df, 3, 2, 42))
    assert np.allclose([*fit.weights[0], fit.intercepts[0]], newton(x, y, 1, True), atol=1e-4)


def test_ids_must_be_unique_and_present(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.7), (2, 0.1)], "id bigint, v double")
    with pytest.raises(ValueError, match="repeat"):
        with_row_id(df, "id")
    with pytest.raises(ValueError, match="no id"):
        with_row_id(df.selectExpr("CASE WHEN id = 2 THEN id END AS id", "v"), "id")
    with pytest.raises(ValueError, match="repeat"):
        run_unsupervised(spark, df, "id")
    assert with_row_id(df).select("row_id").distinct().count() == 3


def people(n=90, seed=1):
    rng = np.random.default_rng(seed)
    member = rng.random(n) < 0.5
    return pd.DataFrame({"id": np.arange(n) * 2, "age": rng.normal(40, 9, n) + 12 * member,
                         "member": [None if rng.random() < 0.2 else bool(m) for m in member],
                         "town.name": np.where(member, "Aa", "Bb"), "sick.now": np.where(member ^ (rng.random(n) < 0.1), "yes", "no")})


SCHEMA = "id bigint, age double, member boolean, `town.name` string, `sick.now` string"


def test_truth_column_with_gaps_and_dotted_names(spark, monkeypatch):
    monkeypatch.setattr("plumbline.plans.supervised.families", lambda task, grid: [f for f in L.families(task) if f.name == "NaiveBayes"])
    df = spark.createDataFrame(people(), SCHEMA)
    run = run_supervised(spark, df, "sick.now", "id", cv=3)
    roles = {f.column: (f.role, f.fill) for f in run.preparation.features}
    assert roles["member"][0] == "categorical" and roles["member"][1] in ("True", "False") and "town_name" in roles
    new = spark.createDataFrame([(1, float("nan"), None, "Zz", None), (2, 50.0, True, None, None)], SCHEMA).withColumnRenamed("id", "row_id")
    bundle = ModelBundle("NaiveBayes", run.task, "sick_now", run.classes, run.preparation, run.best_model)
    ready = run.preparation.transform(with_plain_names(new), ["row_id"])
    assert ready.where("exists(x, v -> v IS NULL)").count() == 0
    assert {r.prediction for r in bundle.score(new).collect()} <= {"yes", "no"}


def test_unseen_category_counts_as_missing(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0), (3, "b", 3.0)], "row_id bigint, c string, v double")
    prepared = fit_preparation(df, ["c", "v"])
    rows = spark.createDataFrame([(1, "zebra", None), (2, None, None), (3, "a", 2.0)], "row_id bigint, c string, v double")
    assert len({tuple(r.x) for r in prepared.transform(rows, ["row_id"]).collect()}) == 1


def test_headers_with_dots(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a.b,c,a_b\n1,x,2\nNA,y,3\n")
    df = read_table(spark, str(tmp_path / "t.csv"))
    assert df.columns == ["a_b_", "c", "a_b"] and dict(df.dtypes)["a_b_"] == "double" and df.where("a_b_ IS NULL").count() == 1


def test_more_than_a_hundred_classes(spark):
    df = spark.createDataFrame([(i, f"c{i % 120:03}", float(i % 120)) for i in range(720)], "row_id bigint, y string, v double")
    classes = [f"c{i:03}" for i in range(120)]
    labelled = with_label(df, "y", "classification", classes)
    ready = fit_preparation(df, ["v"]).transform(labelled, ["row_id", "label"])
    ctx = L.context(ready, 1, 120, 42)
    for name, params in (("DecisionTreeClassifier", {"max_depth": None, "criterion": "gini"}),
                         ("RandomForestClassifier", {"max_depth": None, "criterion": "gini", "n_estimators": 5})):
        model = family("classification", name).fit(ready, params, ctx)
        predicted = model.predict(ready)
        assert predicted.where("prediction = label").count() > 600, name


def test_starts_see_a_small_far_cluster(spark):
    """Three rows in thirty thousand, far away, get a centre of their own at k = 3."""
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 1, (15_000, 2)), rng.normal(12, 1, (14_997, 2)), rng.normal(4000, 1, (3, 2))])
    points = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "row_id bigint, x array<double>").persist()
    run = K.fit_kmeans(points, [3], len(x), restarts=2)[3]
    assert np.abs(run.centers - 4000).max(axis=1).min() < 10 and run.inertia < 4 * len(x)
    points.unpersist()


def test_rules_of_a_long_itemset(spark):
    """Thirty items that always come together: only strong rules are made, level by level."""
    items = [f"i{n:02}" for n in range(12)]
    sets = [(items[:n], 10, 0.5) for n in range(1, 13)] + [([i], 10, 0.5) for i in items[1:]]
    frame_ = spark.createDataFrame(sets, "items array<string>, freq bigint, support double")
    rules = A.association_rules(frame_, 0.9)
    assert rules.where("confidence < 0.9").count() == 0 and rules.count() > 0


def test_mixture_returns_its_last_step(spark, make_points):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(-3, 1, (200, 1)), rng.normal(3, 1, (200, 1))])
    points = make_points(x).persist()
    one = fit_mixture(points, np.array([[-1.0], [1.0]]), 400, max_iter=1, tol=1e9)
    none = fit_mixture(points, np.array([[-1.0], [1.0]]), 400, max_iter=0)
    assert not np.allclose(one.means, none.means)
