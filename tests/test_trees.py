import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import learners as L
from plumbline.operators import trees as T


def cells(rng, n, dims, values):
    return rng.integers(0, values, (n, dims)).astype(float)


class Plain:
    """One tree by recursion over lists."""

    def __init__(self, growth, tree):
        self.g, self.tree = growth, tree

    def impurity(self, y, w):
        if not self.g.classes:
            return (w * (y - np.average(y, weights=w)) ** 2).sum()
        p = np.array([w[y == c].sum() for c in range(self.g.classes)]) / w.sum()
        return w.sum() * (1 - (p * p).sum() if self.g.criterion == "gini" else -(p[p > 0] * np.log(p[p > 0])).sum())

    def value(self, y, w):
        return [np.average(y, weights=w)] if not self.g.classes else [w[y == c].sum() / w.sum() for c in range(self.g.classes)]

    def grow(self, x, y, w, path=""):
        node = {"rows": len(y), "value": self.value(y, w), "depth": len(path), "cut": None}
        if len(set(y)) < 2:
            return node
        ranks = T._ranks(self.g, np.array([T._node_code(self.g.seed, self.tree, path)]))[0] if self.g.features < self.g.dims else np.zeros(self.g.dims)
        found = []
        for f in range(self.g.dims):
            values = sorted(set(x[:, f]))
            for a, b in zip(values, values[1:]):
                low = x[:, f] <= a
                scale = self.impurity(y, w) if not self.g.classes else w.sum()
                loss = (self.impurity(y[low], w[low]) + self.impurity(y[~low], w[~low])) / scale
                inside = ranks[f] < self.g.features
                found.append((not inside, 0 if inside else ranks[f], round(loss, 8), f, a, (a + b) / 2))
        if found:
            *_, f, a, middle = min(found)
            low = x[:, f] <= a
            node["cut"] = f, middle, self.grow(x[low], y[low], w[low], path + "0"), self.grow(x[~low], y[~low], w[~low], path + "1")
        return node

    def read(self, node, row, deepest, least):
        while node["cut"] and node["rows"] >= least and node["depth"] != deepest:
            f, middle, low, high = node["cut"]
            node = low if row[f] <= middle else high
        return node["value"]


CASES = [T.Growth(0, "variance", 1, False, 3, 3, 1), T.Growth(0, "variance", 3, True, 3, 3, 5), T.Growth(2, "gini", 1, False, 3, 3, 1),
         T.Growth(3, "entropy", 2, True, 1, 3, 4), T.Growth(3, "gini", 2, True, 2, 3, 4)]
STOPS = [(None, 2), (None, 7), (2, 2), (3, 5), (0, 2)]


def table(spark, make_points, growth, n=90, seed=3):
    rng = np.random.default_rng(seed)
    x = cells(rng, n, 3, 12)
    x[:, 2] = x[:, 2] > 5
    y = np.round(x[:, 0] * 2 + (x[:, 1] > 4) * 9 + rng.integers(0, 4, n)) if not growth.classes else (x[:, 0] + x[:, 1] + rng.integers(0, 6, n)) // 9 % growth.classes
    fold = rng.integers(0, 3, n)
    return x, y.astype(float), fold, make_points(x, label=[float(v) for v in y], fold=[int(f) for f in fold]).persist()


def weights(spark, df, growth, folds=0):
    out = {}
    for r in T.pairs(df, growth, folds).select("tree", "row_id", "w").collect():
        out.setdefault(r["tree"], {})[r["row_id"]] = r["w"]
    return out


@pytest.mark.parametrize("node_rows", [100_000, 12])
@pytest.mark.parametrize("growth", CASES)
def test_fitted_trees_are_those_of_a_recursion(spark, make_points, growth, node_rows):
    x, y, _, df = table(spark, make_points, growth)
    nodes = T.fit_trees(df, growth, node_rows)
    bags = weights(spark, df.withColumn("fold", df["fold"] * 0), growth)
    plain = []
    for tree in range(growth.trees):
        w = np.array([bags[tree].get(i, 0.0) for i in range(len(y))])
        made = Plain(growth, tree)
        plain.append((made, made.grow(x[w > 0], y[w > 0], w[w > 0])))
    for deepest, least in STOPS:
        got = {r["row_id"]: list(r["votes"]) for r in T.Forest(growth, nodes, deepest, least, growth.trees).votes(df.select("row_id", "x")).collect()}
        for i in range(len(y)):
            assert np.allclose(got[i], np.sum([m.read(root, x[i], deepest, least) for m, root in plain], axis=0)), (i, deepest, least)


@pytest.mark.parametrize("node_rows", [100_000, 15])
@pytest.mark.parametrize("growth", CASES[1:4:2])
def test_left_out_rows_ride_along(spark, make_points, growth, node_rows):
    x, y, fold, df = table(spark, make_points, growth, 70, 8)
    sizes = [1, growth.trees]
    got = {(r["row_id"], r["stop"], r["size"]): list(r["votes"]) for r in T.ride(df, growth, 3, STOPS, sizes, node_rows).collect()}
    assert len(got) == 70 * len(STOPS) * len(sizes)
    bags = weights(spark, df, growth, 3)
    for f in range(3):
        plain = []
        for k in range(growth.trees):
            w = np.array([bags[f * growth.trees + k].get(i, 0.0) for i in range(70)])
            made = Plain(growth, f * growth.trees + k)
            plain.append((made, made.grow(x[w > 0], y[w > 0], w[w > 0])))
        for i in np.flatnonzero(fold == f):
            for s, (deepest, least) in enumerate(STOPS):
                for k, size in enumerate(sizes):
                    want = np.sum([m.read(root, x[i], deepest, least) for m, root in plain[:size]], axis=0)
                    assert np.allclose(got[int(i), s, k], want), (i, s, k)


def test_every_distinct_value_can_split(spark, make_points):
    n = 10_000
    x = np.arange(n, dtype=float)[:, None]
    y = (np.arange(n) % 2).astype(float)
    ctx = L.FitContext(n, 1, 0, 1.0)
    df = make_points(x, label=y.tolist())
    fit = next(f for f in L.families("regression") if f.name == "DecisionTreeRegressor").fit
    whole = fit(df, {"max_depth": None, "min_samples_split": 2}, ctx)
    assert whole.predict(df).where("prediction <> label").count() == 0
    assert whole.table.selectExpr("sum(size(left)) AS n").first()["n"] == 2 * n - 1


def test_least_rows_of_a_split_are_not_a_leaf_bound(spark, make_points):
    x, y = np.arange(6.0)[:, None], np.array([9.0, 0, 0, 0, 0, 0])
    df = make_points(x, label=y.tolist())
    fit = next(f for f in L.families("regression") if f.name == "DecisionTreeRegressor").fit
    model = fit(df, {"max_depth": None, "min_samples_split": 5}, L.FitContext(6, 1, 0, 1.0))
    assert [r["prediction"] for r in model.predict(df).orderBy("row_id").collect()] == y.tolist()  # a leaf of one row


def test_parts_of_a_model_add_up(spark, make_points, monkeypatch):
    growth = CASES[1]
    _, _, _, df = table(spark, make_points, growth)
    nodes = T.fit_trees(df, growth, 20)
    whole = sorted(T.Forest(growth, nodes, None, 2, 3).votes(df.select("row_id", "x")).select("row_id", "votes").collect())
    monkeypatch.setattr(T, "NODES_HELD", 40)
    parts = sorted(T.Forest(growth, nodes, None, 2, 3).votes(df.select("row_id", "x")).select("row_id", "votes").collect())
    assert [r["row_id"] for r in whole] == [r["row_id"] for r in parts]
    assert np.allclose([r["votes"] for r in whole], [r["votes"] for r in parts])


def test_parts_of_a_model_hold_the_nodes_that_are_read(spark, make_points, monkeypatch):
    growth = CASES[1]
    _, _, _, df = table(spark, make_points, growth)
    nodes = T.fit_trees(df, growth, 20)
    said = sorted(T.Forest(growth, nodes, 2, 2, 3).votes(df.select("row_id", "x")).select("row_id", "votes").collect())
    whole = [p.value for p in T.Forest(growth, nodes, None, 2, 3)._parts(spark)]
    read = [p.value for p in T.Forest(growth, nodes, 2, 2, 3)._parts(spark)]
    assert len(whole) == len(read) == 1
    assert len(read[0]["left"]) == (whole[0]["depth"] <= 2).sum() < len(whole[0]["left"])
    monkeypatch.setattr(T, "NODES_HELD", 4)
    assert len(list(T.Forest(growth, nodes, 2, 2, 3)._parts(spark))) > 1
    parts = sorted(T.Forest(growth, nodes, 2, 2, 3).votes(df.select("row_id", "x")).select("row_id", "votes").collect())
    assert [r["row_id"] for r in said] == [r["row_id"] for r in parts]
    assert np.allclose([r["votes"] for r in said], [r["votes"] for r in parts])


def test_pairs_of_a_table_in_one_partition_are_many_tasks_work(spark, make_points, monkeypatch):
    rng = np.random.default_rng(5)
    x = cells(rng, 400, 2, 9)
    rows = make_points(x, label=(x[:, 0] + rng.integers(0, 2, 400)).tolist()).coalesce(1)
    growth = T.Growth(0, "variance", 3, True, 2, 2, 1)

    def said():
        return sorted(map(tuple, T.Forest(growth, T.fit_trees(rows, growth, 60), 3, 2, 3).predict(rows).select("row_id", "prediction").collect()))

    whole, seen = said(), []
    monkeypatch.setattr(T, "CHUNK_ROWS", 100)
    split_large = T.split_large
    monkeypatch.setattr(T, "split_large", lambda growth, live, *a: seen.append(live.select(F.spark_partition_id()).distinct().count()) or split_large(growth, live, *a))
    again = said()
    assert min(seen) > 1
    assert [r[0] for r in again] == [r[0] for r in whole] and np.allclose([r[1] for r in again], [r[1] for r in whole])


def test_hash_of_a_pair_is_taken_once(spark, make_points):
    growth = CASES[1]
    _, _, _, df = table(spark, make_points, growth)
    plan = T.pairs(df, growth, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1  # one for each threshold before, in the filter and in the weight


def test_trees_over_few_rows_have_no_large_nodes_to_look_for(spark, make_points, monkeypatch):
    growth = CASES[1]
    _, _, _, df = table(spark, make_points, growth)
    cuts = []
    monkeypatch.setattr(T, "cut_lineage", lambda df: cuts.append(df) or df)
    T.fit_trees(df, growth)
    assert not cuts  # all pairs were made and counted before


def test_narrow_tables_are_split_by_spark_less_often(spark, make_points, monkeypatch):
    growth = CASES[1]
    _, _, _, df = table(spark, make_points, growth)
    monkeypatch.setattr(T, "NODE_ROWS", 12)
    split, before = [], T.split_large
    monkeypatch.setattr(T, "split_large", lambda *a: split.append(a[3]) or before(*a))
    T.fit_trees(df, growth)
    assert split == [500_000] and T.largest_node(T.Growth(0, "variance", 1, False, 900_000, 900_000, 1)) == 12
