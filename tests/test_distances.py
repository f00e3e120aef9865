import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from plumbline.operators import bayes as B
from plumbline.operators import neighbors as N
from plumbline.operators import silhouette
from plumbline.operators.silhouette import silhouettes, squared_silhouette


def clustered(n, dims, seed, copies=True):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims)) * 0.6 + rng.integers(0, 4, size=(n, 1)) * 3
    if copies:
        x[: n // 3] = x[0]  # one value holds a third of the rows
    return x


def distances(a, b, p):
    gap = np.abs(a[:, None, :] - b[None, :, :])
    return gap.sum(axis=2) if p == 1 else np.sqrt((gap ** 2).sum(axis=2))


@pytest.mark.parametrize("block_rows", [4096, 16])
def test_neighbours_equal_brute_force(make_points, block_rows):
    train, ask = clustered(150, 3, 0), clustered(60, 3, 1)
    y = np.arange(150) % 7
    got = N.neighbours(make_points(ask), make_points(train, target=[float(v) for v in y]), 5, (1, 2), 3,
                       block_rows=block_rows).collect()
    assert len(got) == 60 * 2 * 5
    for p in (1, 2):
        d = distances(ask, train, p)
        order = np.lexsort((np.broadcast_to(np.arange(150), d.shape), d))
        want = {(i, k + 1): order[i, k] for i in range(60) for k in range(5)}
        assert {(r["row_id"], r["rn"]): r["tid"] for r in got if r["p"] == p} == want
        assert all(r["target"] == y[r["tid"]] for r in got)


@pytest.mark.parametrize("block_rows", [4096, 16])
def test_neighbours_outside_the_fold(make_points, block_rows):
    x = clustered(90, 2, 2)
    fold = [i % 3 for i in range(90)]
    rows = make_points(x, fold=fold, target=[0.0] * 90)
    got = N.neighbours(rows, rows, 4, (2,), 2, folds=True, block_rows=block_rows).collect()
    d = distances(x, x, 2)
    d[np.equal.outer(fold, fold)] = np.inf
    order = np.lexsort((np.broadcast_to(np.arange(90), d.shape), d))
    assert {(r["row_id"], r["rn"]): r["tid"] for r in got} == {(i, k + 1): order[i, k] for i in range(90) for k in range(4)}


def test_rows_that_boxes_cannot_part_are_dealt_in_large_tiles(make_points, monkeypatch):
    x = np.random.default_rng(5).normal(size=(500, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    met, pair_blocks = [], N.pair_blocks
    monkeypatch.setattr(N, "pair_blocks", lambda left, right, *a, **b: met.append((left.blocks.sum(), right.blocks.sum())) or pair_blocks(left, right, *a, **b))
    got = N.neighbours(make_points(x[:100]), make_points(x[100:], target=[0.0] * 400), 5, (2,), 24, block_rows=16).collect()
    assert met[0][1] <= 400 / (N.TILE_BLOCKS * 16) + 1  # a block of 16 rows each before, so four times the copies of a query
    d = distances(x[:100], x[100:], 2)
    order = np.argsort(d, axis=1, kind="stable")
    assert {(r["row_id"], r["rn"]): r["tid"] for r in got} == {(i, k + 1): order[i, k] for i in range(100) for k in range(5)}


@pytest.mark.parametrize("kind", ["ties", "near copies", "far off", "too large", "equal"])
def test_nearest_rows_are_those_of_plain_distances(kind):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(700, 3))
    x = {"ties": np.round(x * 2), "near copies": 1 + x * 1e-9, "far off": 1e8 + x, "too large": x * 1e200, "equal": np.full_like(x, 0.3)}[kind]
    q = pd.DataFrame({"qid": np.arange(40), "x": list(x[:40]), "fold": np.arange(40) % 3})
    t = pd.DataFrame({"tid": np.arange(660), "x": list(x[40:]), "target": 0.0, "fold": np.arange(660) % 3})
    for p in (1, 2):
        with np.errstate(all="ignore"):
            d = np.zeros((40, 660))
            for f in range(3):
                gap = np.abs(x[:40, f, None] - x[None, 40:, f])
                d += gap if p == 1 else gap * gap
            d = d if p == 1 else np.sqrt(d)
            d[q["fold"].to_numpy()[:, None] == t["fold"].to_numpy()[None, :]] = np.inf
            got = N.nearest_in_block(q, t, 6, (p,), True)
        order = np.argsort(d, axis=1, kind="stable")[:, :6]
        want = [(i, j, d[i, j]) for i in range(40) for j in order[i] if np.isfinite(d[i, j])]
        assert list(zip(got["qid"], got["tid"], got["dist"], strict=True)) == want


def test_votes(spark):
    rows = [(1, 2, 1, 0.0, 5, 3.0), (1, 2, 2, 1.0, 6, 1.0), (1, 2, 3, 2.0, 7, 1.0),
            (2, 2, 1, 1.0, 5, 3.0), (2, 2, 2, 2.0, 6, 1.0), (2, 2, 3, 4.0, 7, 2.0)]
    near = spark.createDataFrame(rows, "row_id bigint, p int, rn int, dist double, tid bigint, target double")
    votes = {r["row_id"]: r for r in N.neighbour_predictions(near, True, (2, 3), ("uniform", "distance")).collect()}
    assert votes[1]["pred_3_uniform"] == 1.0 and votes[1]["pred_3_distance"] == 3.0
    assert votes[2]["pred_3_uniform"] == 1.0 and votes[2]["pred_2_distance"] == 3.0
    means = {r["row_id"]: r for r in N.neighbour_predictions(near, False, (3,), ("uniform", "distance")).collect()}
    assert means[1]["pred_3_distance"] == 3.0
    assert means[2]["pred_3_distance"] == pytest.approx((3 + 0.5 + 0.5) / 1.75)


def brute_silhouette(x, labels):
    labels = np.asarray(labels)
    keep = labels >= 0
    x, labels = x[keep], labels[keep]
    d = distances(x, x, 2)
    total = []
    for i in range(len(x)):
        own = labels == labels[i]
        if own.sum() == 1:
            total.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, labels == c].mean() for c in set(labels) - {labels[i]})
        total.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return float(np.mean(total))


@pytest.mark.parametrize("block_rows,per_pass", [(4096, 512), (13, 512), (13, 3)])
def test_silhouettes(spark, make_points, block_rows, per_pass):
    x = clustered(100, 3, 4)
    a = [int(v) for v in (x[:, 0] > 2).astype(int) + (x[:, 0] > 5)]
    noisy = [-1 if i % 9 == 0 else i % 4 for i in range(100)]
    lonely = [7] + [i % 2 for i in range(99)]
    points = make_points(x, a=a, noisy=noisy, lonely=lonely, one=[0] * 100, every=list(range(100)))
    points = points.selectExpr("row_id", "x", "a", "nullif(noisy, -1) as noisy", "lonely", "one", "every")
    got = silhouettes(points, ["a", "noisy", "lonely", "one", "every"], block_rows, per_pass)
    assert got["one"] is None and got["every"] is None
    for name, labels in (("a", a), ("noisy", noisy), ("lonely", lonely)):
        assert got[name] == pytest.approx(brute_silhouette(x, labels), abs=1e-7)


def test_squared_silhouette_needs_two_clusters(make_points):
    points = make_points(clustered(30, 2, 5), a=[0] * 30, b=[i % 2 for i in range(30)])
    assert squared_silhouette(points, "a") is None
    assert -1 <= squared_silhouette(points, "b") <= 1


def test_bayes_grid_matches_numpy(make_points):
    x = clustered(120, 3, 6, copies=False)
    y = np.array([float(i % 3) for i in range(120)])
    x += y[:, None]
    fold = np.arange(120) % 4
    df = make_points(x, fold=[int(f) for f in fold], label=y.tolist())
    smoothings = [1e-9, 0.5]
    got = {r["fold"]: r for r in B.bayes_grid(df, 3, smoothings, 4).collect()}
    for f in range(4):
        t = fold != f
        for j, s in enumerate(smoothings):
            eps = s * x[t].var(axis=0).max()
            score = np.stack([np.log((y[t] == c).mean()) - 0.5 * (
                np.log(2 * np.pi * (x[t][y[t] == c].var(axis=0) + eps))
                + (x[~t] - x[t][y[t] == c].mean(axis=0)) ** 2 / (x[t][y[t] == c].var(axis=0) + eps)).sum(axis=1)
                for c in range(3)], axis=1)
            assert got[f][f"acc_{j}"] == pytest.approx((score.argmax(axis=1) == y[~t]).mean())


def test_tiles_grow_with_the_root_of_the_tasks():
    from plumbline.operators.silhouette import tiles_for
    assert tiles_for(150, 54, 8) == 1 and tiles_for(10_000, 54, 8) == 3
    assert tiles_for(1_000_000, 54, 8) == 16 and tiles_for(1_000_000, 512, 8) == 64
    assert tiles_for(10 ** 7, 54, 2000) == 153 and tiles_for(10 ** 6, 54, 2000) == 64


def test_silhouette_pieces_equal_brute_force(spark, make_points, monkeypatch):
    from plumbline.operators import silhouette as S
    monkeypatch.setattr(S, "PIECE_ROWS", 7)
    rng = np.random.default_rng(5)
    x, label = rng.normal(size=(90, 3)), rng.integers(0, 30, 90)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    scores = []
    for i in range(90):
        own = label == label[i]
        if own.sum() == 1:
            scores.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, label == c].mean() for c in set(label) - {label[i]})
        scores.append((b - a) / max(a, b))
    points = make_points(x, label=[float(v) for v in label])
    for rows in (None, 25, 90):
        assert S.silhouettes(points, ["label"], rows)["label"] == pytest.approx(np.mean(scores))


@pytest.mark.parametrize("tile", [16, 4096])
def test_silhouette_of_many_clusters(make_points, tile):
    """More clusters than columns: whole clusters in tiles, large ones spread, rows that repeat."""
    rng = np.random.default_rng(11)
    x = np.round(rng.normal(size=(260, 3)), 1)
    x[200:] = x[:60]
    labels = np.concatenate([rng.integers(0, 70, 200), np.full(60, 3)])
    labels[:30] = 3
    points = make_points(x, a=labels.tolist())
    assert silhouettes(points, ["a"], tile, 8)["a"] == pytest.approx(brute_silhouette(x, labels), abs=1e-7)


def test_products_of_silhouettes_are_as_narrow_as_the_kinds_of_rows():
    at = np.array([[0, 3], [0, 3], [0, 4], [1, -1], [-1, -1]])
    weights, d = np.array([1.0, 2.0, 1.0, 5.0, 7.0]), np.random.default_rng(1).random((3, 5))
    want = np.zeros((5, 6))
    for row, columns in enumerate(at):
        want[row, columns[columns >= 0]] = weights[row]
    parts = silhouette._members(at, weights, 6)
    assert [p.shape for p in parts] == [(5, 4), (4, 6)]
    assert np.allclose(silhouette._summed(d, parts), d @ want)
    assert np.allclose(silhouette._members(np.arange(5)[:, None], weights, 5)[0], np.diag(weights))


def test_a_tile_goes_in_and_out_without_an_object_for_each_row():
    rows = pa.table({"row_id": [5, 6, 7, 8], "x": pa.array([[0.0, 1.0], [2.0, 3.0], [4.0, 5.0], [6.0, 7.0]]), "w": [1.0, 2.0, 1.0, 3.0],
                     "a": pa.array([9, None, 4, 9], pa.int64()), "b": pa.array([1, 2, 3, 1], pa.int64())})
    ids, x, w, at = silhouette._tile(rows, ["a", "b"], {"a": {4: 0, 9: 1}, "b": {1: 2, 2: 3}})
    got = {i: (v, n, c) for i, v, n, c in zip(ids.tolist(), x.tolist(), w.tolist(), at.tolist(), strict=True)}
    assert got == {5: ([0, 1], 1, [1, 2]), 6: ([2, 3], 2, [-1, 3]), 7: ([4, 5], 1, [0, -1]), 8: ([6, 7], 3, [1, 2])}
    assert abs(ids.tolist().index(5) - ids.tolist().index(8)) == 1
    sums = np.arange(12.0).reshape(4, 3)
    out = silhouette._sums_table([(ids, sums)], 3)
    assert out.column("sums").chunk(0).values.buffers()[1].address == sums.ctypes.data
    assert out.column("sums").to_pylist() == sums.tolist()


def test_queries_visit_only_blocks_within_their_own_bound(make_points, monkeypatch):
    x = np.random.default_rng(9).normal(size=(800, 2))
    fold = [i % 3 for i in range(800)]
    rows = make_points(x, fold=fold, target=[0.0] * 800)
    seen = []
    monkeypatch.setattr(N, "cut_lineage", lambda df: seen.append(df.localCheckpoint()) or seen[-1])
    got = N.neighbours(rows, rows, 4, (1, 2), 2, folds=True, block_rows=32).collect()
    assert sum(len(r["visits"] or range(32)) for r in seen[0].collect()) < 8 * 800  # all blocks of the regions around before
    for p in (1, 2):
        d = distances(x, x, p)
        d[np.equal.outer(fold, fold)] = np.inf
        order = np.argsort(d, axis=1, kind="stable")
        assert {(r["row_id"], r["rn"]): r["tid"] for r in got if r["p"] == p} == {(i, n + 1): order[i, n] for i in range(800) for n in range(4)}


@pytest.mark.parametrize("dims", [2, 16])
def test_queries_and_rows_of_one_table(make_points, dims):
    x = np.random.default_rng(10).normal(size=(400, dims))
    rows = make_points(x, target=[0.0] * 400)
    got = N.neighbours(rows.where("row_id < 100").select("row_id", "x"), rows.where("row_id >= 100"), 3, (2,), dims, block_rows=32).collect()
    order = np.argsort(distances(x[:100], x[100:], 2), axis=1, kind="stable") + 100
    assert {(r["row_id"], r["rn"]): r["tid"] for r in got} == {(i, n + 1): order[i, n] for i in range(100) for n in range(3)}
