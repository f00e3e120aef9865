"""Learners and clusterings on inputs small enough in columns that SQL can compute the same optimum."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.catalogue.clustering import _DBSCAN_SQL, _PLANE_COLUMNS, _users
from plumbline.catalogue.registry import make_registry
from plumbline.catalogue.tables import USERS_DS, load, r6, users_ds
from plumbline.functions.columns import truth_as_text
from plumbline.operators import kmeans as K
from plumbline.operators import ward
from plumbline.operators.learners import context, families
from plumbline.operators.prepare import fit_preparation
from plumbline.session import scratch_folder

REPORTS, SQL, report = make_registry()


def _fit(task: str, name: str, train: DataFrame, params: dict, classes: int = 0):
    family = next(f for f in families(task) if f.name == name)
    return family.fit(train, params, context(train, 1, classes, 42))


def _one_feature(df: DataFrame, x, label) -> DataFrame:
    return df.select("row_id", F.array(x.cast("double")).alias("x"), label.cast("double").alias("label")).withColumn(
        "features", array_to_vector("x")).persist()


# ---------------------------------------------------------------- trees of one split

_STUMP_REGRESSION = """WITH g AS (SELECT p_size AS x, count(*) AS n, sum(p_retailprice) AS s FROM part GROUP BY p_size),
c AS (SELECT x, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER () AS n, sum(s) OVER () AS s FROM g WINDOW w AS (ORDER BY x)),
b AS (SELECT x FROM c WHERE nl < n ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC, x LIMIT 1)
SELECT p_partkey AS row_id, round(avg(p_retailprice) OVER (PARTITION BY p_size <= (SELECT x FROM b)), 4) AS prediction FROM part"""


def _part_prices(spark, sf_dir):
    part = load(spark, sf_dir, "part").withColumnRenamed("p_partkey", "row_id")
    return _one_feature(part, F.col("p_size"), F.col("p_retailprice"))


@report(_STUMP_REGRESSION)
def tree_stump_regression(spark, sf_dir):
    rows = _part_prices(spark, sf_dir)
    model = _fit("regression", "DecisionTreeRegressor", rows, {"max_depth": 1, "min_samples_split": 2})
    return model.predict(rows).select("row_id", r6("prediction", 4).alias("prediction"))


def _stump_classes(impurity: str) -> str:
    """Best split by an impurity of two classes, each side predicting its larger class."""
    return f"""WITH v AS (SELECT p_partkey AS row_id, p_size AS x,
    CASE WHEN (p_partkey % 5 < 3) = (p_size <= 20) THEN 1 ELSE 0 END AS y FROM part),
g AS (SELECT x, count(*) AS n, sum(y) AS s FROM v GROUP BY x),
c AS (SELECT x, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER () AS n, sum(s) OVER () AS s FROM g WINDOW w AS (ORDER BY x)),
f AS (SELECT x, nl, n - nl AS nr, sl / nl AS pl, (s - sl) / (n - nl) AS pr FROM c WHERE nl < n),
b AS (SELECT x FROM f ORDER BY nl * ({impurity.replace('@', 'pl')}) + nr * ({impurity.replace('@', 'pr')}), x LIMIT 1)
SELECT row_id, CAST(avg(y) OVER (PARTITION BY x <= (SELECT x FROM b)) > 0.5 AS INT)::DOUBLE AS prediction FROM v"""


def _part_classes(spark, sf_dir):
    part = load(spark, sf_dir, "part").withColumnRenamed("p_partkey", "row_id")
    return _one_feature(part, F.col("p_size"), F.when((F.col("row_id") % 5 < 3) == (F.col("p_size") <= 20), 1).otherwise(0))


@report(_stump_classes("2 * @ * (1 - @)"))
def tree_stump_gini(spark, sf_dir):
    rows = _part_classes(spark, sf_dir)
    model = _fit("classification", "DecisionTreeClassifier", rows, {"max_depth": 1, "criterion": "gini"}, 2)
    return model.predict(rows).select("row_id", "prediction")


@report(_stump_classes("CASE WHEN @ IN (0, 1) THEN 0 ELSE -(@ * ln(@) + (1 - @) * ln(1 - @)) END"))
def tree_stump_entropy(spark, sf_dir):
    rows = _part_classes(spark, sf_dir)
    model = _fit("classification", "DecisionTreeClassifier", rows, {"max_depth": 1, "criterion": "entropy"}, 2)
    return model.predict(rows).select("row_id", "prediction")


# ---------------------------------------------------------------- logistic regression by Newton's method

def _newton(intercept_penalty: int) -> str:
    return f"""WITH RECURSIVE v AS (SELECT (p_size - 25) / 10.0 AS x, CASE WHEN (p_partkey % 5 < 3) = (p_size <= 20) THEN 1 ELSE 0 END AS y FROM part),
t(i, w, b) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)
  UNION ALL
  SELECT i + 1, w - (h22 * g1 - h12 * g2) / (h11 * h22 - h12 * h12), b - (h11 * g2 - h12 * g1) / (h11 * h22 - h12 * h12)
  FROM (SELECT i, w, b, sum((p - y) * x) + w AS g1, sum(p - y) + {intercept_penalty} * b AS g2, sum(p * (1 - p) * x * x) + 1 AS h11,
               sum(p * (1 - p) * x) AS h12, sum(p * (1 - p)) + {intercept_penalty} AS h22
        FROM (SELECT i, w, b, x, y, 1 / (1 + exp(-(w * x + b))) AS p FROM t, v) GROUP BY i, w, b) WHERE i < 25)
SELECT round(w, 3) AS weight, round(b, 3) AS intercept FROM t WHERE i = 25"""


def _logistic_rows(spark, sf_dir):
    part = load(spark, sf_dir, "part").withColumnRenamed("p_partkey", "row_id")
    y = F.when((F.col("row_id") % 5 < 3) == (F.col("p_size") <= 20), 1).otherwise(0)
    return _one_feature(part, (F.col("p_size") - 25) / 10.0, y)


@report(_newton(0))
def logreg_lbfgs_newton(spark, sf_dir):
    model = _fit("classification", "LogisticRegression", _logistic_rows(spark, sf_dir), {"C": 1, "solver": "lbfgs"}, 2)
    return spark.createDataFrame([(round(model.weights[0][0], 3), round(model.intercepts[0], 3))], "weight double, intercept double")


@report(_newton(1))
def logreg_liblinear_newton(spark, sf_dir):
    model = _fit("classification", "LogisticRegression", _logistic_rows(spark, sf_dir), {"C": 1, "solver": "liblinear"}, 2)
    return spark.createDataFrame([(round(model.weights[0][0], 3), round(model.intercepts[0], 3))], "weight double, intercept double")


# ---------------------------------------------------------------- clusterings

@report(f"""WITH {USERS_DS}, o AS (
  SELECT avg_value AS x, row_number() OVER w AS k, sum(avg_value) OVER w AS sl, sum(avg_value) OVER () AS s, count(*) OVER () AS n
  FROM users_ds WINDOW w AS (ORDER BY avg_value, row_id ROWS UNBOUNDED PRECEDING)),
b AS (SELECT x, k FROM o WHERE k < n ORDER BY sl * sl / k + (s - sl) * (s - sl) / (n - k) DESC, k LIMIT 1),
l AS (SELECT avg_value AS x, avg_value > (SELECT x FROM b) AS high FROM users_ds)
SELECT CAST(high AS INT) AS cluster, count(*) AS n, round(avg(x), 4) AS center FROM l GROUP BY high""")
def kmeans_two_means(spark, sf_dir):
    """On one column the best two clusters are a cut of the order, which SQL finds by trying all."""
    points = users_ds(spark, sf_dir).select("row_id", F.array("avg_value").alias("x")).persist()
    runs = K.fit_kmeans(points, [2], points.count())
    labelled = K.kmeans_labels(points, runs)
    low = int(runs[2].centers[:, 0].argmin())
    return labelled.groupBy((F.col("km_2") != low).cast("int").alias("cluster")).agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg(F.col("x")[0]), 4).alias("center"))


@report(f"""WITH {USERS_DS}, o AS (
  SELECT avg_value AS x, row_number() OVER w AS k, sum(avg_value) OVER w AS sl, sum(avg_value) OVER () AS s, count(*) OVER () AS n
  FROM users_ds WINDOW w AS (ORDER BY avg_value, row_id ROWS UNBOUNDED PRECEDING)),
b AS (SELECT x, k FROM o WHERE k < n ORDER BY sl * sl / k + (s - sl) * (s - sl) / (n - k) DESC, k LIMIT 1)
SELECT row_id, CAST(avg_value > (SELECT x FROM b) AS INT) AS cluster FROM users_ds""")
def kmeans_reloaded_labels(spark, sf_dir):
    """Labels by a clustering that was saved as a table and read again."""
    points = users_ds(spark, sf_dir).select("row_id", F.array("avg_value").alias("x")).persist()
    path = scratch_folder(spark, "kmeans")
    K.fit_kmeans(points, [2], points.count())[2].table(spark).write.parquet(path)
    model = K.KMeansRun.from_table(spark.read.parquet(path))
    low = int(model.centers[:, 0].argmin())
    return K.kmeans_labels(points, {2: model}).select("row_id", (F.col("km_2") != low).cast("int").alias("cluster"))


_PLANE_SQL = _DBSCAN_SQL[:_DBSCAN_SQL.index("near AS (")].rstrip().rstrip(",")


@report(_PLANE_SQL + """, f AS (SELECT a, b FROM p ORDER BY row_id LIMIT 200)
SELECT count(*) - 1 AS merges, round(sum((a - ma) * (a - ma) + (b - mb) * (b - mb)), 4) AS spread
FROM f, (SELECT avg(a) AS ma, avg(b) AS mb FROM f)""")
def ward_tree_spread(spark, sf_dir):
    """Half the squared merge distances of a whole Ward tree add up to the sum of squares."""
    tree = ward.merge_tree(_users(spark, sf_dir, _PLANE_COLUMNS))
    return tree.agg(F.count(F.lit(1)).alias("merges"), r6(F.sum(F.col("distance") * F.col("distance")) / 2, 4).alias("spread"))


# ---------------------------------------------------------------- truth columns with gaps

@report("""WITH v AS (SELECT o_orderkey AS row_id, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus = 'O' END AS flag FROM orders),
m AS (SELECT count(*) FILTER (WHERE flag) > count(*) FILTER (WHERE NOT flag) AS mode FROM v)
SELECT row_id, CASE WHEN coalesce(flag, mode) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS flag FROM v, m""")
def truth_gap_encode(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("row_id"), F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus") == "O").alias("flag"))
    df = truth_as_text(orders)
    return fit_preparation(df, ["flag"]).unscaled(df).select("row_id", "flag")
