"""Reports on learners, cross-validated search, ranking and the supervised run."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from plumbline.catalogue.registry import make_registry
from plumbline.catalogue.tables import DOCS_DS, EMB_DIMS, docs_ds, emb_ds, load, part_ds, r6
from plumbline.operators import bayes as B
from plumbline.operators import metrics as M
from plumbline.operators import neighbors as N
from plumbline.operators import split as S
from plumbline.operators.learners import context, families, fold_contexts
from plumbline.operators.search import cross_validate
from plumbline.operators.prepare import fit_preparation
from plumbline.plans.supervised import SupervisedResult, prepare_rows, run_supervised
from plumbline.session import scratch_folder
from plumbline.sources.bundle import load_model_bundle, save_model_bundle

REPORTS, SQL, report = make_registry()


@report("""SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
  round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept,
  round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem""")
def ols_one_feature(spark, sf_dir):
    df = load(spark, sf_dir, "lineitem").select("l_quantity", F.col("l_extendedprice").alias("label"))
    rows = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(df)
    model = LinearRegression(regParam=0.0, solver="normal").fit(rows)
    slope, intercept = float(model.coefficients[0]), float(model.intercept)
    fitted = F.lit(intercept) + F.lit(slope) * F.col("l_quantity")
    return df.agg(M.r2_of(F.col("label"), fitted).alias("r2")).select(
        r6(F.lit(slope), 4).alias("slope"), r6(F.lit(intercept), 3).alias("intercept"), r6("r2").alias("r2"))


@report("""WITH c AS (SELECT var_samp(l_quantity) AS s11, var_samp(l_discount) AS s22, covar_samp(l_quantity, l_discount) AS s12,
  covar_samp(l_quantity, l_extendedprice) AS s1, covar_samp(l_discount, l_extendedprice) AS s2, avg(l_quantity) AS m1,
  avg(l_discount) AS m2, avg(l_extendedprice) AS my FROM lineitem),
b AS (SELECT *, (s22 * s1 - s12 * s2) / (s11 * s22 - s12 * s12) AS b1, (s11 * s2 - s12 * s1) / (s11 * s22 - s12 * s12) AS b2
  FROM c)
SELECT round(b1, 3) AS quantity, round(b2, 2) AS discount, round(my - b1 * m1 - b2 * m2, 2) AS intercept FROM b""")
def ols_two_features(spark, sf_dir):
    df = load(spark, sf_dir, "lineitem").select("l_quantity", "l_discount", F.col("l_extendedprice").alias("label"))
    rows = VectorAssembler(inputCols=["l_quantity", "l_discount"], outputCol="features").transform(df)
    family = next(f for f in families("regression") if f.name == "LinearRegression")
    model = family.fit(rows, {"fit_intercept": True}, None).model
    return spark.createDataFrame([(*[float(c) for c in model.coefficients], float(model.intercept))],
                                 "quantity double, discount double, intercept double").select(
        r6("quantity", 3).alias("quantity"), r6("discount", 2).alias("discount"), r6("intercept", 2).alias("intercept"))


_DOC_X = ["n_chars", "n_lines", "n_words"]


def _docs_x(spark, sf_dir):
    df = docs_ds(spark, sf_dir)
    return df.select("row_id", F.array(*[F.log1p(F.col(c)) for c in _DOC_X]).alias("x"),
                     F.col("quality").cast("double").alias("label"))


_NB_SQL = f"""WITH {DOCS_DS}, v AS (
  SELECT row_id, quality AS y, ln(1 + n_chars) AS a, ln(1 + n_lines) AS b, ln(1 + n_words) AS c FROM docs_ds),
e AS (SELECT 1e-9 * greatest(var_pop(a), var_pop(b), var_pop(c)) AS eps FROM v),
m AS (SELECT y, count(*) / (SELECT count(*) FROM v) AS pr, avg(a) AS ma, avg(b) AS mb, avg(c) AS mc,
        var_pop(a) + max(eps) AS va, var_pop(b) + max(eps) AS vb, var_pop(c) + max(eps) AS vc
      FROM v, e GROUP BY y)"""


@report(_NB_SQL + """
SELECT CAST(y AS DOUBLE) AS label, round(pr, 6) AS prior, round(ma, 6) AS m_chars, round(mb, 6) AS m_lines,
       round(mc, 6) AS m_words, round(va, 6) AS v_chars, round(vb, 6) AS v_lines, round(vc, 6) AS v_words FROM m""")
def gaussian_nb_params(spark, sf_dir):
    model = B.fit_bayes(B.class_moments(_docs_x(spark, sf_dir), 3), 1e-9)
    names = ["chars", "lines", "words"]
    return model.table(spark).select(
        "label", r6("prior").alias("prior"), *[r6(F.col("mean")[i]).alias(f"m_{n}") for i, n in enumerate(names)],
        *[r6(F.col("var")[i]).alias(f"v_{n}") for i, n in enumerate(names)])


@report(_NB_SQL + """, s AS (
  SELECT row_id, m.y, ln(pr) - 0.5 * (ln(2 * pi() * va) + ln(2 * pi() * vb) + ln(2 * pi() * vc)
    + (a - ma) * (a - ma) / va + (b - mb) * (b - mb) / vb + (c - mc) * (c - mc) / vc) AS ll FROM v, m)
SELECT row_id, CAST(y AS DOUBLE) AS prediction FROM (
  SELECT row_id, y, row_number() OVER (PARTITION BY row_id ORDER BY ll DESC, y) AS rn FROM s) WHERE rn = 1""")
def gaussian_nb_predict(spark, sf_dir):
    df = _docs_x(spark, sf_dir)
    model = B.fit_bayes(B.class_moments(df, 3), 1e-9)
    return B.predict_bayes(df, model).select("row_id", "prediction")


@report(f"""WITH {DOCS_DS}, v AS (
  SELECT row_id, quality AS y, ln(1 + n_chars) AS a, ln(1 + n_lines) AS b, ln(1 + n_words) AS c,
    ntile(5) OVER (ORDER BY md5('42-' || row_id)) - 1 AS fold FROM docs_ds),
t AS (SELECT f.fold AS vf, v.* FROM v, (SELECT DISTINCT fold FROM v) f WHERE v.fold <> f.fold),
g AS (SELECT unnest([0.01, 0.1, 1.0]) AS vs),
e AS (SELECT vf, greatest(var_pop(a), var_pop(b), var_pop(c)) AS mx, count(*) AS n FROM t GROUP BY vf),
m AS (SELECT t.vf, vs, y, count(*) / max(n) AS pr, avg(a) AS ma, avg(b) AS mb, avg(c) AS mc,
        var_pop(a) + max(mx * vs) AS va, var_pop(b) + max(mx * vs) AS vb, var_pop(c) + max(mx * vs) AS vc
      FROM t JOIN e ON e.vf = t.vf, g GROUP BY t.vf, vs, y),
s AS (SELECT v.row_id, v.fold, vs, v.y AS truth, m.y,
    ln(pr) - 0.5 * (ln(2 * pi() * va) + ln(2 * pi() * vb) + ln(2 * pi() * vc)
    + (a - ma) * (a - ma) / va + (b - mb) * (b - mb) / vb + (c - mc) * (c - mc) / vc) AS ll
    FROM v JOIN m ON m.vf = v.fold),
p AS (SELECT fold, vs, truth, y, row_number() OVER (PARTITION BY row_id, vs ORDER BY ll DESC, y) AS rn FROM s)
SELECT CAST(fold AS INT) AS fold, CAST(vs AS DOUBLE) AS smoothing,
       round(avg(CASE WHEN y = truth THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM p WHERE rn = 1 GROUP BY fold, vs""")
def grid_search_nb(spark, sf_dir):
    df = _docs_x(spark, sf_dir).withColumn("order_key", S.order_key("row_id", 42))
    folded = S.contiguous_folds(df)
    grid = [0.01, 0.1, 1.0]
    wide = B.bayes_grid(folded, 3, grid, 5)
    cells = F.array(*[F.struct(F.lit(g).alias("smoothing"), r6(f"acc_{i}").alias("accuracy")) for i, g in enumerate(grid)])
    return wide.select("fold", F.explode(cells).alias("e")).select("fold", "e.*")


def _emb_split(spark, sf_dir):
    df = S.holdout_split(emb_ds(spark, sf_dir).withColumnRenamed("label", "target"))
    return df.where("is_test"), df.where("NOT is_test")


_L2 = "list_distance(CAST(q.embedding AS DOUBLE[]), CAST(t.embedding AS DOUBLE[]))"
_L1 = "list_sum([abs(CAST(q.embedding[i] AS DOUBLE) - CAST(t.embedding[i] AS DOUBLE)) for i in range(1, 65)])"


def _knn_sql(distance: str) -> str:
    return f"""WITH e AS (
  SELECT *, row_number() OVER (ORDER BY md5('42-' || vec_id)) <= ceil(0.2 * count(*) OVER ()) AS is_test FROM embeddings),
n AS (SELECT q.vec_id AS row_id, t.label, row_number() OVER (PARTITION BY q.vec_id ORDER BY {distance}, t.vec_id) AS rn
  FROM e q JOIN e t ON q.is_test AND NOT t.is_test),
v AS (SELECT row_id, label, count(*) AS c FROM n WHERE rn <= 7 GROUP BY 1, 2)
SELECT row_id, CAST(label AS DOUBLE) AS prediction FROM (
  SELECT row_id, label, row_number() OVER (PARTITION BY row_id ORDER BY c DESC, label) AS rn FROM v) WHERE rn = 1"""


def _knn_classify(spark, sf_dir, p):
    test, train = _emb_split(spark, sf_dir)
    near = N.neighbours(test, train, 7, (p,), EMB_DIMS)
    return N.neighbour_predictions(near, True, (7,), ("uniform",)).select(
        "row_id", F.col("pred_7_uniform").alias("prediction"))


@report(_knn_sql(_L1))
def knn_classify_l1(spark, sf_dir):
    return _knn_classify(spark, sf_dir, 1)


@report(_knn_sql(_L2))
def knn_classify_l2(spark, sf_dir):
    return _knn_classify(spark, sf_dir, 2)


@report("""WITH e AS (
  SELECT p_partkey AS row_id, CAST(p_size AS DOUBLE) AS s, ln(1 + p_partkey) AS k, p_retailprice AS y,
    row_number() OVER (ORDER BY md5('42-' || p_partkey)) <= ceil(0.2 * count(*) OVER ()) AS is_test FROM part),
n AS (SELECT q.row_id, t.y, sqrt((q.s - t.s) * (q.s - t.s) + (q.k - t.k) * (q.k - t.k)) AS d, t.row_id AS tid
  FROM e q JOIN e t ON q.is_test AND NOT t.is_test),
r AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY d, tid) AS rn FROM n)
SELECT row_id, round(avg(y), 4) AS uniform,
  round(CASE WHEN min(d) = 0 THEN avg(y) FILTER (WHERE d = 0) ELSE sum(y / d) / sum(1 / d) END, 4) AS distance
FROM r WHERE rn <= 5 GROUP BY row_id""")
def knn_regress(spark, sf_dir):
    df = part_ds(spark, sf_dir).select(
        "row_id", F.array(F.col("p_size").cast("double"), F.log1p("row_id")).alias("x"),
        F.col("p_retailprice").alias("target"))
    split = S.holdout_split(df)
    near = N.neighbours(split.where("is_test"), split.where("NOT is_test"), 5, (2,), 2)
    out = N.neighbour_predictions(near, False, (5,), ("uniform", "distance"))
    return out.select("row_id", r6("pred_5_uniform", 4).alias("uniform"), r6("pred_5_distance", 4).alias("distance"))


def _classified_docs(spark, sf_dir):
    return docs_ds(spark, sf_dir).drop("toxic")


def _rows_for(spark, df, target, columns, task):
    return prepare_rows(df, target, columns, task, df.count(), None, 0.2, 5, 42, "all")


def _fit_one(spark, sf_dir, name, params, task="classification"):
    """Holdout metrics of one family with given parameters."""
    if task == "classification":
        df, target, columns = _classified_docs(spark, sf_dir), "quality", ["n_chars", "n_lines", "lang", "source"]
    else:
        df, target, columns = part_ds(spark, sf_dir), "p_retailprice", ["p_size", "p_brand", "p_type"]
    _, classes, train, test = _rows_for(spark, df, target, columns, task)
    family = next(f for f in families(task) if f.name == name)
    model = family.fit(train, params, context(train, len(columns), len(classes), 42))
    predicted = model.predict(test)
    if task == "classification":
        return M.classification_metrics(predicted)
    return M.regression_metrics(predicted)


@report()
def tree_regression(spark, sf_dir):
    return _fit_one(spark, sf_dir, "DecisionTreeRegressor", {"max_depth": 5, "min_samples_split": 5}, "regression")


@report()
def forest_regression(spark, sf_dir):
    return _fit_one(spark, sf_dir, "RandomForestRegressor",
                    {"max_depth": 5, "min_samples_split": 5, "n_estimators": 50}, "regression")


@report()
def tree_classification(spark, sf_dir):
    return _fit_one(spark, sf_dir, "DecisionTreeClassifier", {"max_depth": 5, "criterion": "entropy"})


@report()
def forest_classification(spark, sf_dir):
    return _fit_one(spark, sf_dir, "RandomForestClassifier", {"max_depth": 5, "criterion": "gini", "n_estimators": 50})


@report()
def logreg_lbfgs(spark, sf_dir):
    return _fit_one(spark, sf_dir, "LogisticRegression", {"C": 1, "solver": "lbfgs"})


@report()
def logreg_liblinear(spark, sf_dir):
    return _fit_one(spark, sf_dir, "LogisticRegression", {"C": 1, "solver": "liblinear"})


@report()
def svm_linear(spark, sf_dir):
    return _fit_one(spark, sf_dir, "SVM", {"C": 1, "kernel": "linear", "gamma": "scale"})


@report()
def svm_rbf(spark, sf_dir):
    return _fit_one(spark, sf_dir, "SVM", {"C": 1, "kernel": "rbf", "gamma": "scale"})


_GRID_SQL = """WITH e AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x, ntile(5) OVER (ORDER BY md5('42-' || vec_id)) - 1 AS fold
  FROM embeddings),
d AS (SELECT q.vec_id AS q, q.fold, q.label AS truth, t.vec_id AS t, t.label, list_distance(q.x, t.x) AS l2,
        list_sum([abs(q.x[i] - t.x[i]) for i in range(1, 65)]) AS l1 FROM e q JOIN e t ON q.fold <> t.fold),
u AS (SELECT q, fold, truth, t, label, 1 AS p, l1 AS d FROM d UNION ALL SELECT q, fold, truth, t, label, 2, l2 FROM d),
n AS (SELECT *, row_number() OVER (PARTITION BY q, p ORDER BY d, t) AS rn FROM u),
c AS (SELECT unnest([3, 5, 7, 10]) AS k),
v AS (SELECT k, p, q, fold, truth, label, count(*) AS uniform, sum(1 / d) AS distance FROM n, c
  WHERE rn <= k GROUP BY ALL),
w AS (SELECT *, row_number() OVER (PARTITION BY k, p, q ORDER BY uniform DESC, label) AS ru,
        row_number() OVER (PARTITION BY k, p, q ORDER BY distance DESC, label) AS rd FROM v),
f AS (SELECT k, p, fold, 'uniform' AS weights, avg(CASE WHEN truth = label THEN 1.0 ELSE 0.0 END) AS a FROM w WHERE ru = 1
      GROUP BY ALL
      UNION ALL SELECT k, p, fold, 'distance', avg(CASE WHEN truth = label THEN 1.0 ELSE 0.0 END) FROM w WHERE rd = 1
      GROUP BY ALL)
SELECT k, p, weights, round(avg(a), 6) AS score FROM f GROUP BY ALL"""


@report(_GRID_SQL)
def cv_score(spark, sf_dir):
    """Mean validation accuracy of every neighbour candidate."""
    df = emb_ds(spark, sf_dir).withColumn("label", F.col("label").cast("double"))
    train = S.contiguous_folds(df.withColumn("order_key", S.order_key("row_id", 42))).persist()
    family = next(f for f in families("classification") if f.name == "KNeighborsClassifier")
    contexts = fold_contexts(train, 5, EMB_DIMS, 10, 42)
    scores = cross_validate(family, train, "classification", 5, contexts)
    return spark.createDataFrame([(p["n_neighbors"], p["p"], p["weights"], s) for p, s in scores],
                                 "k int, p int, weights string, score double").withColumn("score", r6("score"))


_RUNS: dict = {}


def _searched(spark, sf_dir: str, task: str) -> SupervisedResult:
    """The full search over parts (regression) or documents, once for a session and folder."""
    key = spark.sparkContext.applicationId, sf_dir, task
    if key not in _RUNS:
        if task == "regression":
            _RUNS[key] = run_supervised(spark, part_ds(spark, sf_dir), "p_retailprice", "row_id", corr_threshold=0.0, parallelism=8)
        else:
            _RUNS[key] = run_supervised(spark, _classified_docs(spark, sf_dir), "quality", "row_id", parallelism=8)
    return _RUNS[key]


@report()
def refit_winner(spark, sf_dir):
    """Predictions for every document by the winner refitted on all of them."""
    run = _searched(spark, sf_dir, "classification")
    df = _classified_docs(spark, sf_dir)
    ready = run.preparation.transform(df, ["row_id"])
    return run.best_model.predict(ready).select("row_id", "prediction")


@report()
def model_comparison(spark, sf_dir):
    return _searched(spark, sf_dir, "regression").results


@report()
def best_model(spark, sf_dir):
    run = _searched(spark, sf_dir, "regression")
    return run.results.where(F.col("model") == run.best_name).select("model", F.col("r2_score").alias("score"))


@report("""WITH s AS (SELECT regr_slope(p_retailprice, p_size) AS b, regr_intercept(p_retailprice, p_size) AS a FROM part)
SELECT p_partkey AS row_id, round(a + b * p_size, 3) AS prediction FROM part, s""")
def bundle_roundtrip(spark, sf_dir):
    """Predictions for every part by a saved and reloaded least-squares model."""
    df = part_ds(spark, sf_dir)
    preparation = fit_preparation(df, ["p_size"])
    train = preparation.transform(df, ["row_id", F.col("p_retailprice").alias("label")])
    model = next(f for f in families("regression") if f.name == "LinearRegression").fit(train, {"fit_intercept": True}, None)
    run = SupervisedResult(None, "LinearRegression", model, "regression", None, None, None, preparation)
    path = save_model_bundle(spark, scratch_folder(spark, "bundle"), run, "p_retailprice")
    return load_model_bundle(spark, path).score(df).select("row_id", r6("prediction", 3).alias("prediction"))


@report()
def supervised_run(spark, sf_dir):
    return _searched(spark, sf_dir, "classification").results
