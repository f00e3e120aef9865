"""Reports on clusterings, their scores, projections and the unsupervised run."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from plumbline.catalogue.registry import make_registry
from plumbline.catalogue.tables import (EMB_DIMS, USERS_DS, USERS_FEATURES, emb_ds, load, r6, users_ds)
from plumbline.operators import dbscan as D
from plumbline.operators import kmeans as K
from plumbline.operators import metrics as M
from plumbline.operators import mixture as G
from plumbline.operators import reduce as R
from plumbline.operators import ward
from plumbline.operators.prepare import fit_preparation
from plumbline.operators.silhouette import silhouettes
from plumbline.plans.unsupervised import choose_clustering, run_unsupervised

REPORTS, SQL, report = make_registry()


@report("""WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
n AS (SELECT label, count(*) AS n FROM e GROUP BY label),
d AS (SELECT a.vec_id, a.label AS own, b.label AS other, sum(list_distance(a.x, b.x)) AS s
      FROM e a JOIN e b ON a.vec_id <> b.vec_id GROUP BY ALL),
m AS (SELECT vec_id, own, max(CASE WHEN own = other AND n > 1 THEN s / (n - 1) END) AS a,
        min(CASE WHEN own <> other THEN s / n END) AS b
      FROM d JOIN n ON n.label = d.other GROUP BY vec_id, own)
SELECT round(sum(coalesce((b - a) / greatest(a, b), 0)) / (SELECT count(*) FROM e), 6) AS silhouette FROM m""")
def silhouette_given_labels(spark, sf_dir):
    points = emb_ds(spark, sf_dir)
    return spark.createDataFrame([(silhouettes(points, ["label"])["label"],)], "silhouette double").select(
        r6("silhouette").alias("silhouette"))


@report("""WITH u AS (SELECT label, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
c AS (SELECT label, i, avg(v) AS m FROM u GROUP BY 1, 2)
SELECT round(sum((v - m) * (v - m)), 5) AS inertia FROM u JOIN c USING (label, i)""")
def inertia_given_labels(spark, sf_dir):
    return M.inertia(emb_ds(spark, sf_dir), "label", EMB_DIMS).select(r6("inertia", 5).alias("inertia"))


def _users(spark, sf_dir, columns=USERS_FEATURES):
    """Prepared user rows ``(row_id, x, features)``."""
    df = users_ds(spark, sf_dir)
    return fit_preparation(df, columns).transform(df, ["row_id"]).persist()


_PLANE_COLUMNS = ["n_click", "avg_value"]
_EPS, _MIN_SAMPLES = 0.4, 5
_DBSCAN_SQL = f"""WITH RECURSIVE {USERS_DS}, g AS (
  SELECT skewness(n_click) AS ga, min(n_click) AS la, skewness(avg_value) AS gb, min(avg_value) AS lb FROM users_ds),
l AS (SELECT row_id, CASE WHEN abs(ga) > 0.75 AND la >= 0 THEN ln(1 + n_click) ELSE n_click END AS a,
        CASE WHEN abs(gb) > 0.75 AND lb >= 0 THEN ln(1 + avg_value) ELSE avg_value END AS b FROM users_ds, g),
s AS (SELECT avg(a) AS ma, stddev_pop(a) AS sa, avg(b) AS mb, stddev_pop(b) AS sb FROM l),
p AS (SELECT row_id, (a - ma) / sa AS a, (b - mb) / sb AS b FROM l, s),
near AS (SELECT x.row_id AS u, y.row_id AS v FROM p x JOIN p y
  ON sqrt((x.a - y.a) * (x.a - y.a) + (x.b - y.b) * (x.b - y.b)) <= {_EPS}),
core AS (SELECT u AS id FROM near GROUP BY u HAVING count(*) >= {_MIN_SAMPLES}),
links AS (SELECT u, v FROM near JOIN core a ON a.id = u JOIN core b ON b.id = v),
walk(a, b) AS (SELECT id, id FROM core UNION SELECT w.a, l.v FROM walk w JOIN links l ON l.u = w.b),
root AS (SELECT a AS id, min(b) AS r FROM walk GROUP BY a),
num AS (SELECT id, dense_rank() OVER (ORDER BY r) - 1 AS cluster FROM root),
border AS (SELECT u AS id, min(cluster) AS cluster FROM near JOIN num ON num.id = v
  WHERE u NOT IN (SELECT id FROM core) GROUP BY u),
labels AS (SELECT row_id, coalesce(n.cluster, b.cluster, -1) AS cluster FROM p LEFT JOIN num n ON n.id = row_id
  LEFT JOIN border b ON b.id = row_id)"""


def _dbscan(spark, sf_dir):
    return D.dbscan(_users(spark, sf_dir, _PLANE_COLUMNS), _EPS, _MIN_SAMPLES, 2)


@report(_DBSCAN_SQL + " SELECT row_id, cluster FROM labels")
def dbscan_labels(spark, sf_dir):
    return _dbscan(spark, sf_dir)


@report(_DBSCAN_SQL + """
SELECT count(DISTINCT CASE WHEN cluster <> -1 THEN cluster END) AS n_clusters,
       count(*) FILTER (WHERE cluster = -1) AS n_noise FROM labels""")
def dbscan_summary(spark, sf_dir):
    return D.dbscan_summary(_dbscan(spark, sf_dir))


@report()
def ward_tree(spark, sf_dir):
    return ward.merge_tree(_users(spark, sf_dir))


@report()
def ward_labels(spark, sf_dir):
    return ward.ward_labels(_users(spark, sf_dir), 3, len(USERS_FEATURES))


def _sweep(spark, sf_dir, max_k=10):
    points = _users(spark, sf_dir)
    ks = list(range(2, max_k + 1))
    runs = K.fit_kmeans(points, ks, points.count())
    labelled = K.kmeans_labels(points.select("row_id", "x"), runs)
    scores = silhouettes(labelled, [f"km_{k}" for k in ks])
    return labelled, runs, {k: scores[f"km_{k}"] for k in ks}


@report()
def k_sweep(spark, sf_dir):
    _, runs, scores = _sweep(spark, sf_dir)
    return spark.createDataFrame([(k, r.inertia, scores[k]) for k, r in runs.items()],
                                 "k int, inertia double, silhouette double")


@report()
def kmeans_labels(spark, sf_dir):
    labelled, _, scores = _sweep(spark, sf_dir)
    return labelled.select("row_id", F.col(f"km_{K.best_k(scores)}").alias("cluster"))


@report()
def gmm_labels(spark, sf_dir):
    points = _users(spark, sf_dir)
    rows = points.count()
    start = K.fit_kmeans(points, [3], rows)[3]
    return G.mixture_labels(points, G.fit_mixture(points, start.centers, rows))


def _emb_features(spark, sf_dir):
    return emb_ds(spark, sf_dir).withColumn("features", array_to_vector("x"))


@report()
def pca_report(spark, sf_dir):
    points = _emb_features(spark, sf_dir)
    model = R.fit_pca(points, EMB_DIMS, points.count())
    return R.pca_report(spark, list(model.explained))


@report()
def pca_scatter(spark, sf_dir):
    points = _users(spark, sf_dir)
    return R.plane(points, R.fit_pca(points, len(USERS_FEATURES), points.count()))


@report(f"""WITH {USERS_DS}, v AS (
  """ + " UNION ALL ".join(f"SELECT {i + 1} AS component, var_samp({c}) AS v FROM users_ds"
                           for i, c in enumerate(USERS_FEATURES)) + """),
r AS (SELECT component, v / sum(v) OVER () AS e FROM v)
SELECT CAST(component AS INT) AS component, round(e, 6) AS explained,
       round(sum(e) OVER (ORDER BY component ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS cumulative FROM r""")
def cumulative_variance(spark, sf_dir):
    row = users_ds(spark, sf_dir).agg(*[F.var_samp(c).alias(c) for c in USERS_FEATURES]).first()
    total = sum(row)
    out = R.pca_report(spark, [v / total for v in row])
    return out.select("component", r6("explained").alias("explained"), r6("cumulative").alias("cumulative"))


@report("""SELECT 'label' AS algo, CAST(label AS BIGINT) AS cluster, count(*) AS n FROM embeddings GROUP BY label
UNION ALL SELECT 'parity', CAST(label % 2 AS BIGINT), count(*) FROM embeddings GROUP BY label % 2""")
def cluster_sizes(spark, sf_dir):
    e = load(spark, sf_dir, "embeddings")
    one = e.select(F.lit("label").alias("algo"), F.col("label").cast("bigint").alias("cluster"))
    two = e.select(F.lit("parity").alias("algo"), (F.col("label") % 2).cast("bigint").alias("cluster"))
    return M.cluster_sizes(one.unionByName(two))


_SCALED_SQL = _DBSCAN_SQL.split("near AS")[0].replace("WITH RECURSIVE", "WITH").rstrip().rstrip(",")


@report(_SCALED_SQL + """, r AS (SELECT corr(a, b) AS r FROM p), e AS (
  SELECT 1 AS component, (1 + abs(r)) / 2 AS e FROM r UNION ALL SELECT 2, (1 - abs(r)) / 2 FROM r)
SELECT component, round(e, 6) AS explained, round(sum(e) OVER (ORDER BY component), 6) AS cumulative FROM e""")
def pca_two_features(spark, sf_dir):
    points = _users(spark, sf_dir, _PLANE_COLUMNS)
    out = R.pca_report(spark, list(R.fit_pca(points, 2, points.count()).explained))
    return out.select("component", r6("explained").alias("explained"), r6("cumulative").alias("cumulative"))


@report(_SCALED_SQL + """, r AS (SELECT corr(a, b) AS r FROM p)
SELECT row_id, round(CASE WHEN r >= 0 THEN abs(a + b) ELSE abs(a - b) END / sqrt(2), 5) AS size1,
       round(CASE WHEN r >= 0 THEN abs(a - b) ELSE abs(a + b) END / sqrt(2), 5) AS size2 FROM p, r""")
def pca_two_scores(spark, sf_dir):
    points = _users(spark, sf_dir, _PLANE_COLUMNS)
    plane = R.plane(points, R.fit_pca(points, 2, points.count()))
    return plane.select("row_id", r6(F.abs("pc1"), 5).alias("size1"), r6(F.abs("pc2"), 5).alias("size2"))


@report(_SCALED_SQL + """, f AS (SELECT *, row_number() OVER (ORDER BY row_id) - 1 AS i FROM p ORDER BY row_id LIMIT 200),
d AS (SELECT x.i AS "left", y.i AS "right", sqrt((x.a - y.a) * (x.a - y.a) + (x.b - y.b) * (x.b - y.b)) AS d
  FROM f x JOIN f y ON x.i < y.i)
SELECT 0 AS step, "left", "right", round(d, 6) AS distance, CAST(2 AS BIGINT) AS size FROM d ORDER BY d LIMIT 1""")
def ward_first_merge(spark, sf_dir):
    tree = ward.merge_tree(_users(spark, sf_dir, _PLANE_COLUMNS))
    return tree.where("step = 0").withColumn("distance", r6("distance"))


@report("""WITH s AS (SELECT label AS c, label % 2 AS h, CAST(embedding AS DOUBLE[]) AS x, vec_id FROM embeddings),
l AS (SELECT 'KMeans' AS algo, 0 AS pos, vec_id, x, c FROM s UNION ALL SELECT 'Hierarchical', 1, vec_id, x, h FROM s),
n AS (SELECT algo, c, count(*) AS n FROM l GROUP BY ALL),
d AS (SELECT a.algo, a.pos, a.vec_id, a.c AS own, b.c AS other, sum(list_distance(a.x, b.x)) AS s
      FROM l a JOIN l b ON a.algo = b.algo AND a.vec_id <> b.vec_id GROUP BY ALL),
m AS (SELECT d.algo, pos, vec_id, own, max(CASE WHEN own = other AND n > 1 THEN s / (n - 1) END) AS a,
        min(CASE WHEN own <> other THEN s / n END) AS b FROM d JOIN n ON n.algo = d.algo AND n.c = d.other GROUP BY ALL),
r AS (SELECT algo, pos, avg(coalesce((b - a) / greatest(a, b), 0)) AS score FROM m GROUP BY ALL)
SELECT algo, round(score, 6) + 0.0 AS score FROM r ORDER BY score DESC, pos DESC LIMIT 1""")
def best_cluster_model(spark, sf_dir):
    points = emb_ds(spark, sf_dir).select("row_id", "x", F.col("label").alias("KMeans"),
                                          (F.col("label") % 2).alias("Hierarchical"))
    scores = silhouettes(points, ["KMeans", "Hierarchical"])
    best = choose_clustering(scores)
    return spark.createDataFrame([(best, scores[best])], "algo string, score double").withColumn("score", r6("score") + 0.0)


_RUNS: dict = {}


def _run(spark, sf_dir):
    """One unsupervised run per session and folder; its charts are tables of that run."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RUNS:
        _RUNS.clear()
        _RUNS[key] = run_unsupervised(spark, users_ds(spark, sf_dir), "row_id", dbscan_eps=1.0)
    return _RUNS[key]


@report()
def unsupervised_run(spark, sf_dir):
    return _run(spark, sf_dir).tables["cluster_model_table"]


def _chart(name):
    def chart(spark, sf_dir):
        return _run(spark, sf_dir).tables[name]
    chart.__name__ = name
    return report()(chart)


elbow, silhouette_by_k = _chart("elbow"), _chart("silhouette_by_k")
scatter_kmeans, scatter_hierarchical = _chart("scatter_kmeans"), _chart("scatter_hierarchical")
scatter_dbscan, scatter_gmm = _chart("scatter_dbscan"), _chart("scatter_gmm")
variance_table, cluster_size_table = _chart("variance_table"), _chart("cluster_size_table")
merge_tree, cluster_model_table = _chart("merge_tree"), _chart("cluster_model_table")
