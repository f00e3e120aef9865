"""The unsupervised run: filter, prepare, choose k, cluster four ways, project, mine rules, rank."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.columns import check_column_types, nan_to_null, plain_name, text_columns, truth_as_text, with_row_id
from plumbline.operators import dbscan as D
from plumbline.operators import kmeans as K
from plumbline.operators import metrics as M
from plumbline.operators import mixture as G
from plumbline.operators import profile as P
from plumbline.operators import reduce as R
from plumbline.operators import rules as A
from plumbline.operators import ward
from plumbline.operators.prepare import Preparation, fit_preparation
from plumbline.operators.silhouette import silhouettes, squared_silhouette
from plumbline.session import cut_lineage
from plumbline.sources.bundle import save_cluster_bundle
from plumbline.sources.text import read_table

ALGORITHMS = ["KMeans", "Hierarchical", "DBSCAN", "GMM"]


@dataclass
class UnsupervisedResult:
    best_model: str
    best_k: int
    scores: dict[str, float | None]
    metric: str
    labels: DataFrame
    k_sweep: DataFrame
    kmeans: K.KMeansRun
    mixture: G.MixtureModel
    pca: R.Components
    plane: DataFrame
    merge_tree: DataFrame
    itemsets: DataFrame
    rules: DataFrame
    feature_report: DataFrame
    preparation: Preparation
    bundle: str | None = None
    tables: dict[str, DataFrame] = field(default_factory=dict)


def choose_clustering(scores: dict[str, float | None]) -> str:
    """Highest silhouette; the later algorithm wins a tie and a missing score loses."""
    best, best_score = None, None
    for name, score in scores.items():
        if score is not None and (best_score is None or score >= best_score):
            best, best_score = name, score
    return best


def score_labelings(points: DataFrame, names: list[str], metric: str) -> dict[str, float | None]:
    if metric == "euclidean":
        return silhouettes(points, names)
    return {n: squared_silhouette(points, n) for n in names}


def sweep(points: DataFrame, max_k: int, rows: int, seed: int, restarts: int, metric: str):
    """K-means for every k up to ``max_k`` with inertia and silhouette of each."""
    ks = list(range(2, max_k + 1))
    runs = K.fit_kmeans(points.select("row_id", "x"), ks, rows, seed, restarts)
    labelled = K.kmeans_labels(points.select("row_id", "x"), runs).persist()
    found = score_labelings(labelled, [f"km_{k}" for k in ks], metric)
    return runs, labelled, {k: found[f"km_{k}"] for k in ks}


def long_labels(wide: DataFrame) -> DataFrame:
    """``(row_id, algo, cluster)`` from one column per algorithm."""
    cells = F.array(*[F.struct(F.lit(a).alias("algo"), F.col(a).cast("bigint").alias("cluster")) for a in ALGORITHMS])
    return wide.select("row_id", F.explode(cells).alias("e")).select("row_id", "e.*")


def mine(df: DataFrame, prepared: DataFrame, columns: list[str], min_support: float, min_confidence: float, rows: int):
    """Itemsets and rules over the text columns, or over above-median flags without any."""
    texts = text_columns(df, ("row_id",))
    baskets = A.category_items(df, texts) if texts else A.median_items(prepared, columns, rows)
    itemsets = cut_lineage(A.frequent_itemsets(baskets, min_support, rows))
    return itemsets, cut_lineage(A.association_rules(itemsets, min_confidence))


def report_tables(spark: SparkSession, result: UnsupervisedResult) -> dict[str, DataFrame]:
    """The data behind every chart of the run."""
    plane, labels = result.plane.persist(), result.labels
    scatter = {f"scatter_{a.lower()}": plane.join(labels.where(F.col("algo") == a).drop("algo"), "row_id")
               for a in ALGORITHMS}
    spread = R.pca_report(spark, list(result.pca.explained))
    scores = spark.createDataFrame(
        [(a, i, s, result.metric, a == result.best_model) for i, (a, s) in enumerate(result.scores.items())],
        "algo string, pos int, score double, metric string, is_best boolean")
    return {
        "elbow": result.k_sweep.select("k", "inertia"),
        "silhouette_by_k": result.k_sweep.select("k", "silhouette", (F.col("k") == result.best_k).alias("is_best")),
        **scatter,
        "merge_tree": result.merge_tree,
        "variance_table": spread.select("component", (F.col("explained") * 100).alias("explained_percent"),
                                        (F.col("cumulative") * 100).alias("cumulative_percent")),
        "cluster_size_table": M.cluster_sizes(labels),
        "cluster_model_table": scores,
        "top10_rules": A.rule_chart(result.rules),
    }


def sampled_scatter(scatter: DataFrame, one_in: int) -> DataFrame:
    """About one in ``one_in`` points, chosen by a hash of the row id, for drawing."""
    return scatter.where(F.pmod(F.xxhash64("row_id"), F.lit(one_in)) == 0)


def run_unsupervised(spark: SparkSession, source: DataFrame | str, id_col: str | None = None, max_k: int = 10,
                     dbscan_eps: float = 0.5, dbscan_min_samples: int = 5, min_support: float = 0.2,
                     min_confidence: float = 0.5, random_state: int = 42, restarts: int = 10,
                     metric: str = "euclidean", parallelism: int = 4,
                     save_to: str | None = None) -> UnsupervisedResult:
    """Cluster a table four ways and rank the clusterings by silhouette.

    ``metric`` is the distance of the silhouette: ``euclidean`` compares all rows,
    ``squared`` is linear in the rows but a different score.
    """
    if metric not in ("euclidean", "squared"):
        raise ValueError("metric is euclidean or squared")
    df = truth_as_text(with_row_id(nan_to_null(read_table(spark, source)), id_col and plain_name(id_col)), ("row_id",))
    check_column_types(df, ("row_id",))
    filtered = P.filter_unsupervised(df, exclude=("row_id",))
    rows = filtered.rows
    kept = df.select("row_id", *filtered.kept)
    preparation = fit_preparation(kept, filtered.kept, rows, filtered.medians)
    unscaled = preparation.unscaled(kept)
    points = preparation.transform(kept, ["row_id"]).persist()
    dims = len(preparation.features)

    runs, labelled, by_k = sweep(points, max_k, rows, random_state, restarts, metric)
    k = K.best_k(by_k)
    plain = points.select("row_id", "x")
    # these need only the prepared rows and k, so they share the cluster
    with ThreadPoolExecutor(parallelism) as pool:
        tree = pool.submit(ward.ward_labels, plain, k, dims)
        dense = pool.submit(D.dbscan, plain, dbscan_eps, dbscan_min_samples, dims)
        blend = pool.submit(G.fit_mixture, points, runs[k].centers, rows)
        mined = pool.submit(mine, kept, unscaled, preparation.names, min_support, min_confidence, rows)
        axes = pool.submit(R.fit_pca, points, dims, rows)
        linkage = pool.submit(ward.merge_tree, points)
        mixture, pca, (itemsets, rules) = blend.result(), axes.result(), mined.result()
        wide = (labelled.select("row_id", "x", F.col(f"km_{k}").alias("KMeans"))
                .join(tree.result().withColumnRenamed("cluster", "Hierarchical"), "row_id")
                .join(dense.result().withColumnRenamed("cluster", "DBSCAN"), "row_id")
                .join(G.mixture_labels(points, mixture).withColumnRenamed("cluster", "GMM"), "row_id"))
        merges = linkage.result()
    wide = cut_lineage(wide)
    labelled.unpersist()
    live = wide.withColumn("DBSCAN", F.when(F.col("DBSCAN") >= 0, F.col("DBSCAN")))
    found = score_labelings(live, ALGORITHMS[1:], metric)
    scores = {"KMeans": by_k[k], "Hierarchical": found["Hierarchical"],
              "DBSCAN": -1.0 if found["DBSCAN"] is None else found["DBSCAN"], "GMM": found["GMM"]}
    result = UnsupervisedResult(
        choose_clustering(scores), k, scores, metric, long_labels(wide),
        spark.createDataFrame([(i, r.inertia, by_k[i]) for i, r in sorted(runs.items())],
                              "k int, inertia double, silhouette double"),
        runs[k], mixture, pca, R.plane(points, pca), merges, itemsets, rules,
        filtered.report(spark), preparation)
    result.tables = report_tables(spark, result)
    if save_to:
        result.bundle = save_cluster_bundle(spark, save_to, result)
    return result
