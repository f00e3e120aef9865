import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector

from plumbline.operators import dbscan as D
from plumbline.operators import kmeans as K
from plumbline.operators import mixture as G
from plumbline.operators import reduce as R
from plumbline.operators import ward
from plumbline.operators.components import connected_components
from plumbline.operators.metrics import cluster_sizes, inertia


def blobs(n, dims, seed, copies=False):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims)) * 0.5 + rng.integers(0, 4, size=(n, 1)) * 2.5
    if copies:
        x[: n // 3] = x[0]
    return x


def labels_of(df, n):
    got = {r["row_id"]: r["cluster"] for r in df.collect()}
    return [got[i] for i in range(n)]


def brute_dbscan(x, eps, m):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    near = d <= eps
    core = near.sum(axis=1) >= m
    label = np.full(len(x), -1)
    current = 0
    for i in range(len(x)):
        if label[i] != -1 or not core[i]:
            continue
        stack = [i]
        label[i] = current
        while stack:
            j = stack.pop()
            if not core[j]:
                continue
            for k in np.flatnonzero(near[j] & (label == -1)):
                label[k] = current
                stack.append(k)
        current += 1
    return label.tolist()


@pytest.mark.parametrize("dims,eps,copies,block_rows", [
    (2, 0.3, False, 4096), (2, 0.3, True, 16), (3, 0.6, False, 16), (2, 0.12, False, 10), (1, 0.02, True, 8), (2, 5.0, False, 16)])
def test_dbscan_equals_brute_force(make_points, dims, eps, copies, block_rows):
    x = blobs(160, dims, 11, copies)
    got = labels_of(D.dbscan(make_points(x), eps, 5, dims, block_rows), 160)
    assert got == brute_dbscan(x, eps, 5)


def test_border_row_takes_the_lowest_cluster(make_points):
    x = np.array([[0.0], [0.1], [0.2], [1.0], [1.8], [1.9], [2.0]])
    got = labels_of(D.dbscan(make_points(x), 0.8, 4, 1), 7)
    assert got == brute_dbscan(x, 0.8, 4)
    all_noise = D.dbscan(make_points(x), 0.01, 3, 1)
    assert labels_of(all_noise, 7) == [-1] * 7
    assert tuple(D.dbscan_summary(all_noise).first()) == (0, 7)


def test_components_of_random_graphs(spark):
    rng = np.random.default_rng(5)
    for n, m in ((40, 25), (60, 200), (50, 49)):
        pairs = rng.integers(0, n, size=(m, 2)).tolist() if m != 49 else [[i, i + 1] for i in range(49)]
        low = list(range(n))
        for _ in range(n):
            for a, b in pairs:
                low[a] = low[b] = min(low[a], low[b])
        got = {r["id"]: r["component"] for r in connected_components(
            spark.createDataFrame([tuple(map(int, p)) for p in pairs], "a bigint, b bigint")).collect()}
        assert got == {i: low[i] for i in {v for p in pairs if p[0] != p[1] for v in p}}
    hub = spark.range(1, 300).selectExpr("id as a", "0L as b")
    assert {r["component"] for r in connected_components(hub).collect()} == {0}


def brute_ward(x):
    groups = {i: [i] for i in range(len(x))}
    heights = []
    while len(groups) > 1:
        best = min((np.sqrt(2 * len(a) * len(b) / (len(a) + len(b))) * np.linalg.norm(x[a].mean(0) - x[b].mean(0)), i, j)
                   for i, a in groups.items() for j, b in groups.items() if i < j)
        heights.append(best[0])
        groups[best[1]] = groups[best[1]] + groups.pop(best[2])
        yield heights[-1], {i: sorted(g) for i, g in groups.items()}


def brute_cut(x, k):
    groups = {i: [i] for i in range(len(x))}
    for _, g in brute_ward(x):
        if len(groups) == k:
            break
        groups = g
    out = [0] * len(x)
    for c, g in enumerate(sorted(groups.values(), key=min)):
        for i in g:
            out[i] = c
    return out


def test_merge_tree_is_the_sequential_tree(make_points):
    x = blobs(40, 3, 3)
    tree = ward.merge_tree(make_points(x), 30).orderBy("step").collect()
    assert [r["distance"] for r in tree] == pytest.approx([h for h, _ in brute_ward(x[:30])])
    assert tree[-1]["size"] == 30 and len(tree) == 29
    used = [v for r in tree for v in (r["left"], r["right"])]
    assert sorted(used) == list(range(58))


@pytest.mark.parametrize("finish_rows,block_rows", [(2048, 4096), (12, 4096), (4, 16)])
def test_ward_labels(make_points, finish_rows, block_rows):
    x = blobs(70, 3, 9)
    x[60:] = x[3]
    for k in (1, 4):
        got = labels_of(ward.ward_labels(make_points(x), k, 3, finish_rows, block_rows), 70)
        assert got == brute_cut(x, k)


def test_kmeans_sweep(spark, make_points):
    x = blobs(200, 2, 7)
    points = make_points(x).persist()
    runs = K.fit_kmeans(points, [2, 3, 4], 200, restarts=4)
    assert runs[2].inertia > runs[3].inertia > runs[4].inertia
    labelled = K.kmeans_labels(points, runs)
    for k in (2, 4):
        assert inertia(labelled, f"km_{k}", 2).first()["inertia"] == pytest.approx(runs[k].inertia, rel=1e-3)
        label = np.array(labels_of(labelled.withColumnRenamed(f"km_{k}", "cluster"), 200))
        near = ((x[:, None] - runs[k].centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        assert (label == near).all()
    again = K.fit_kmeans(points.repartition(5), [3], 200, restarts=4)
    assert again[3].inertia == pytest.approx(runs[3].inertia)


def test_best_k_prefers_the_smaller():
    assert K.best_k({2: 0.5, 3: 0.5, 4: None}) == 2
    with pytest.raises(ValueError):
        K.best_k({2: None})


def test_components_match_numpy(spark, make_points):
    x = blobs(80, 4, 1) @ np.diag([1, 2, 0.5, 0.0])
    points = make_points(x).withColumn("features", array_to_vector("x"))
    model = R.fit_pca(points, 4, 80)
    values = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    assert model.explained == pytest.approx(values / values.sum())
    report = R.pca_report(spark, list(model.explained)).orderBy("component").collect()
    assert report[-1]["cumulative"] == pytest.approx(1.0)
    plane = np.array([[r["pc1"], r["pc2"]] for r in R.plane(points, model).orderBy("row_id").collect()])
    assert plane.var(axis=0, ddof=1) == pytest.approx(values[:2])
    one = make_points(x[:, :1]).withColumn("features", array_to_vector("x"))
    assert {r["pc2"] for r in R.plane(one, R.fit_pca(one, 1, 80)).collect()} == {0.0}


def test_cluster_sizes(spark):
    labels = spark.createDataFrame([(1, "a", 0), (2, "a", 0), (3, "a", -1)], "row_id bigint, algo string, cluster bigint")
    assert {(r["cluster"], r["n"]) for r in cluster_sizes(labels).collect()} == {(0, 2), (-1, 1)}


def test_mixture_finds_the_blobs(spark, make_points):
    rng = np.random.default_rng(2)
    truth = np.arange(240) % 2
    x = rng.normal(size=(240, 2)) @ np.diag([0.3, 1.0]) + np.outer(truth, [4.0, 1.0])
    points = make_points(x).persist()
    model = G.fit_mixture(points, x[:2], 240)
    label = np.array(labels_of(G.mixture_labels(points, model), 240))
    assert (label == truth).all() or (label == 1 - truth).all()
    c = label[0]
    assert model.weights.sum() == pytest.approx(1.0)
    assert model.means[c] == pytest.approx(x[truth == 0].mean(axis=0), abs=1e-3)
    assert np.allclose(model.covariances[c], np.cov(x[truth == 0].T, ddof=0) + 1e-6 * np.eye(2), atol=1e-2)
    again = G.MixtureModel.from_table(model.table(spark))
    assert np.allclose(again.covariances, model.covariances)


def test_kmeans_in_tasks_equals_scans(make_points, monkeypatch):
    from plumbline.operators import kmeans
    rng = np.random.default_rng(12)
    points = make_points(np.concatenate([rng.normal(m, 0.6, size=(60, 3)) for m in (0, 2, 5)])).persist()
    small = kmeans.fit_kmeans(points, [2, 3, 4], 180, restarts=3)
    monkeypatch.setattr(kmeans, "ROWS_PER_TASK", 1)
    scanned = kmeans.fit_kmeans(points, [2, 3, 4], 180, restarts=3)
    for k in (2, 3, 4):
        assert small[k].inertia == pytest.approx(scanned[k].inertia, rel=1e-9) and np.allclose(small[k].centers, scanned[k].centers)


@pytest.mark.parametrize("kind", ["plain", "ties", "near copies", "far off", "too large", "equal", "one"])
def test_nearest_cluster_of_a_block_is_that_of_plain_distances(kind):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4))
    x = {"plain": x, "ties": np.round(x), "near copies": 1 + x * 1e-9, "far off": 1e8 + x, "too large": x * 1e200, "equal": np.full_like(x, 0.3), "one": x[:1]}[kind]
    size, ids = rng.integers(1, 9, len(x)).astype(float), np.arange(len(x)) * 3
    with np.errstate(all="ignore"):
        dist, place = ward._nearest(ids, x, size, ids, x, size)
        for i in range(len(x)):
            d = ward._ward(x[i], size[i], x, size)
            d[i] = np.inf
            j = int(np.argmin(d))
            assert (dist[i], place[i]) == ((d[j], j) if np.isfinite(d[j]) else (np.inf, -1))


def test_clusters_visit_only_regions_that_may_hold_a_nearer_one(make_points, monkeypatch):
    x = np.random.default_rng(4).normal(size=(600, 2))
    df = make_points(x).selectExpr("row_id AS cid", "x", "1L AS size")
    monkeypatch.setattr(ward, "LEAF_ROWS", 16)
    seen = []
    monkeypatch.setattr(ward, "cut_lineage", lambda df: seen.append(df.localCheckpoint()) or seen[-1])
    got = {r["cid"]: (r["dist"], r["lo"], r["hi"]) for r in ward.nearest_cluster(df, 600, 2).collect()}
    copies = sum(len(r["visits"]) for r in seen[0].collect())
    assert 0 < copies < 6 * 600  # all regions within the width of a region before
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    for i, (dist, lo, hi) in got.items():
        j = int(d[i].argmin())
        assert (lo, hi) == (min(i, j), max(i, j)) and dist == pytest.approx(d[i, j])


def test_ward_where_boxes_rule_out_nothing(make_points):
    x = np.random.default_rng(6).normal(size=(90, 24))
    df = make_points(x).selectExpr("row_id AS cid", "x", "1L AS size")
    got = {r["cid"]: r["lo"] + r["hi"] - r["cid"] for r in ward.nearest_cluster(df, 90, 24, block_rows=8).collect()}
    d = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    np.fill_diagonal(d, np.inf)
    assert got == {i: int(d[i].argmin()) for i in range(90)}


@pytest.mark.parametrize("kind", ["plain", "on the edge", "near copies", "far off", "too large"])
def test_near_pairs_are_those_of_plain_distances(kind):
    x = np.random.default_rng(8).normal(size=(300, 3))
    x = {"plain": x, "on the edge": np.round(x), "near copies": 1 + x * 1e-9, "far off": 1e8 + np.round(x), "too large": x * 1e200}[kind]
    d = np.zeros((180, 170))
    with np.errstate(all="ignore"):
        for f in range(3):
            gap = x[:180, f, None] - x[None, 130:, f]
            d += gap * gap
        for eps in (1.0, 3 ** 0.5, 1e-9):
            got = np.concatenate(list(D.within_chunks(pd.DataFrame({"x": list(x[:180])}), pd.DataFrame({"x": list(x[130:])}), eps)))
            assert (got == (np.sqrt(d) <= eps)).all()
