import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from plumbline.operators import learners as L
from plumbline.operators import metrics as M
from plumbline.operators import newton as O
from plumbline.operators import search as S


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(160, 3))
    return x, (x @ [1.0, -2.0, 0.5] + 0.3 + rng.normal(size=160) > 0).astype(float)


def frame(make_points, x, y, fold=None):
    extra = {"label": [float(v) for v in y]}
    if fold is not None:
        extra["fold"] = [int(f) for f in fold]
    return make_points(x, **extra).withColumn("features", array_to_vector("x"))


def family(task, name, grid="full"):
    return next(f for f in L.families(task, grid) if f.name == name)


def newton(x, y, c, penalise_intercept):
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    ridge = np.eye(a.shape[1]) / c
    if not penalise_intercept:
        ridge[-1, -1] = 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-a @ w))
        w -= np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + ridge, a.T @ (p - y) + ridge @ w)
    return w


def test_grid_sizes_and_order():
    assert sum(len(L.candidates(f.grid)) for f in L.families("regression")) == 48
    assert sum(len(L.candidates(f.grid)) for f in L.families("classification")) == 65
    assert L.candidates({"b": [1, 2], "a": [3]}) == [{"a": 3, "b": 1}, {"a": 3, "b": 2}]


def test_least_squares(make_points, sample):
    x, _ = sample
    y = x @ [2.0, 0.0, -1.0] + 4 + x[:, 0] ** 2
    df = frame(make_points, x, y)
    for intercept in (True, False):
        a = np.hstack([x, np.ones((len(x), 1))]) if intercept else x
        want = a @ np.linalg.lstsq(a, y, rcond=None)[0]
        model = family("regression", "LinearRegression").fit(df, {"fit_intercept": intercept}, None)
        got = [r["prediction"] for r in model.predict(df).orderBy("row_id").collect()]
        assert np.allclose(got, want, atol=1e-6)


@pytest.mark.parametrize("c", [0.01, 1, 10])
def test_logistic_solvers(make_points, sample, c):
    x, y = sample
    df = frame(make_points, x, y)
    ctx = L.context(df, 3, 2, 42)
    assert ctx.rows == 160 and ctx.spread == pytest.approx(x.var())
    fit = family("classification", "LogisticRegression").fit
    plain = fit(df, {"C": c, "solver": "lbfgs"}, ctx)
    assert np.allclose([*plain.weights[0], plain.intercepts[0]], newton(x, y, c, False), atol=1e-4)
    other = fit(df, {"C": c, "solver": "liblinear"}, ctx)
    assert np.allclose([*other.weights[0], other.intercepts[0]], newton(x, y, c, True), atol=1e-4)
    predicted = [r["prediction"] for r in other.predict(df).orderBy("row_id").collect()]
    assert predicted == (np.hstack([x, np.ones((160, 1))]) @ newton(x, y, c, True) > 0).astype(float).tolist()


def test_many_classes(make_points, sample):
    x, _ = sample
    y = np.digitize(x[:, 0], [-0.5, 0.5]).astype(float)
    df = frame(make_points, x, y)
    ctx = L.context(df, 3, 3, 42)
    for name, params in (("LogisticRegression", {"C": 10, "solver": "liblinear"}),
                         ("LogisticRegression", {"C": 10, "solver": "lbfgs"}),
                         ("SVM", {"C": 10, "kernel": "rbf", "gamma": "scale"}),
                         ("DecisionTreeClassifier", {"max_depth": None, "criterion": "entropy"})):
        model = family("classification", name).fit(df, params, ctx)
        assert M.classification_metrics(model.predict(df)).first()["accuracy"] > 0.75, name


def exact_svm(k, y, c, rounds=4000):
    """Dual of a machine with a free intercept, by steps on the pair that violates optimality most."""
    a, g = np.zeros(len(y)), -np.ones(len(y))
    for _ in range(rounds):
        up = np.where(((y > 0) & (a < c)) | ((y < 0) & (a > 0)), -y * g, -np.inf)
        low = np.where(((y < 0) & (a < c)) | ((y > 0) & (a > 0)), -y * g, np.inf)
        i, j = int(np.argmax(up)), int(np.argmin(low))
        if up[i] - low[j] < 1e-6:
            break
        step = (up[i] - low[j]) / max(k[i, i] + k[j, j] - 2 * k[i, j], 1e-12)
        step = min(step, c - a[i] if y[i] > 0 else a[i], a[j] if y[j] > 0 else c - a[j])
        a[i] += y[i] * step
        a[j] -= y[j] * step
        g += y * (k[:, i] - k[:, j]) * step
    return a, (up[i] + low[j]) / 2, a.sum() - 0.5 * (a * y) @ k @ (a * y)


@pytest.mark.parametrize("c", [0.1, 1, 10])
def test_linear_machine_reaches_its_optimum(make_points, sample, c):
    x, y = sample
    df = frame(make_points, x, y)
    model = family("classification", "SVM").fit(df, {"C": c, "kernel": "linear", "gamma": "scale"}, L.context(df, 3, 2, 42))
    _, _, best = exact_svm(x @ x.T, 2 * y - 1, c)
    fit = model.fits[0]
    assert abs(fit.gap) <= 1e-3 * fit.objective and best - 1e-3 * best <= fit.objective <= best * (1 + 2e-3)


def test_gaussian_machine_votes_like_an_exact_one(make_points):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(700, 4))
    y = np.digitize((x[:, :2] ** 2).sum(axis=1) + 0.3 * rng.normal(size=700), [0.8, 2.2]).astype(float)
    train, test = np.arange(700) < 500, np.arange(700) >= 500
    df = frame(make_points, x[train], y[train])
    ctx = L.context(df, 4, 3, 42)
    model = family("classification", "SVM").fit(df, {"C": 1, "kernel": "rbf", "gamma": "scale"}, ctx)
    got = O.decided(model.fits, model.kernels, x[test], 3)
    gamma, votes = 1 / (4 * x[train].var()), np.zeros((200, 3))
    for a, b in ((0, 1), (0, 2), (1, 2)):
        rows = np.flatnonzero(train)[np.isin(y[train], [a, b])]
        sign = np.where(y[rows] == a, 1.0, -1.0)
        alpha, shift, _ = exact_svm(O.gaussian(x[rows], x[rows], gamma), sign, 1.0)
        score = O.gaussian(x[test], x[rows], gamma) @ (alpha * sign) + shift
        votes[np.arange(200), np.where(score > 0, a, b)] += 1
    want = votes.argmax(axis=1)
    assert abs((got == y[test]).mean() - (want == y[test]).mean()) <= 0.01 and (got == want).mean() > 0.98


def test_softmax_is_stationary(make_points, sample):
    x, _ = sample
    y = np.digitize(x[:, 0] + 0.5 * x[:, 1], [-0.5, 0.5]).astype(float)
    df = frame(make_points, x, y)
    model = family("classification", "LogisticRegression").fit(df, {"C": 2, "solver": "lbfgs"}, L.context(df, 3, 3, 42))
    w, b = np.array(model.weights), np.array(model.intercepts)
    p = np.exp(x @ w.T + b)
    p /= p.sum(axis=1, keepdims=True)
    assert np.abs(w + 2 * (p - np.eye(3)[y.astype(int)]).T @ x).max() < 1e-3 and np.abs((p - np.eye(3)[y.astype(int)]).sum(axis=0)).max() < 1e-3


def test_scans_and_tasks_agree(make_points, sample, monkeypatch):
    """A table for one task and one that is scanned for every step end at the same weights."""
    x, _ = sample
    y = np.digitize(x[:, 0] - x[:, 1], [-0.8, 0.8]).astype(float)
    df = frame(make_points, x, y, np.arange(160) % 2).persist()
    def fits():
        return [O.Fit("hinge", 0.5, 0, 0, 1), O.Fit("logistic", 2.0, 1, 2, intercept=True), O.Fit("softmax", 1.0, None, outputs=3), O.Fit("hinge", 1.0, 9, 1, 2, kernel=0)]
    kernels = [O.fit_kernel(df, 0.3, None)]
    small = O.solve(df, fits(), kernels, 3)
    monkeypatch.setattr(O, "ROWS_PER_TASK", 0)
    for a, b in zip(small, O.solve(df, fits(), kernels, 3), strict=True):
        assert a.objective == pytest.approx(b.objective, rel=1e-5) and np.allclose(a.weights, b.weights, atol=1e-2)


def test_shared_scans_equal_single_fits(make_points, sample):
    x, y = sample
    fold = np.arange(160) % 2
    df = frame(make_points, x, y, fold).persist()
    contexts = L.fold_contexts(df, 2, 3, 2, 42)
    for name, grid in (("LogisticRegression", {"C": [0.1, 10], "solver": ["lbfgs"]}), ("SVM", {"C": [1], "kernel": ["rbf", "linear"], "gamma": ["auto"]})):
        f = family("classification", name)
        f.grid = grid
        for params, got in S.cross_validate(f, df, "classification", 2, contexts[:2]):
            single = []
            for k in range(2):
                model = f.fit(df.where(f"fold <> {k}").drop("fold"), params, contexts[k])
                single.append(M.classification_metrics(model.predict(df.where(f"fold = {k}"))).first()["accuracy"])
            assert got == pytest.approx(np.mean(single), abs=1e-9), (name, params)


def test_neighbour_search_equals_single_fits(make_points, sample):
    x, y = sample
    fold = np.arange(160) % 4
    df = frame(make_points, x, y, fold).persist()
    f = family("classification", "KNeighborsClassifier")
    ctx = L.context(df, 3, 2, 42)
    scores = S.cross_validate(f, df, "classification", 4, [ctx] * 4)
    assert [p for p, _ in scores] == L.candidates(f.grid)
    for params, got in (scores[0], scores[7]):
        single = []
        for k in range(4):
            model = f.fit(df.where(f"fold <> {k}"), params, ctx)
            single.append(M.classification_metrics(model.predict(df.where(f"fold = {k}"))).first()["accuracy"])
        assert got == pytest.approx(np.mean(single))


def test_linear_kernel_is_fitted_once(make_points, sample, monkeypatch):
    x, y = sample
    df = frame(make_points, x, y, np.arange(160) % 2).persist()
    f = family("classification", "SVM")
    calls = []
    real = O.solve
    monkeypatch.setattr(O, "solve", lambda rows, fits, *rest: calls.extend(fits) or real(rows, fits, *rest))
    f.grid = {"C": [1], "kernel": ["linear"], "gamma": ["scale", "auto"]}
    ctx = L.context(df, 3, 2, 42)
    scores = S.cross_validate(f, df, "classification", 2, [ctx] * 2)
    assert len(scores) == 2 and len(calls) == 2 and scores[0][1] == scores[1][1]


def test_winner_rules():
    rows = [{"accuracy": 0.9}, {"accuracy": 0.95}, {"accuracy": 0.95}]
    assert S.choose(rows, "classification") == 1
    assert S.choose([{"r2_score": None}, {"r2_score": -3.0}], "regression") == 1


def test_metrics_against_numpy(spark):
    rng = np.random.default_rng(0)
    y, p = rng.normal(size=50), rng.normal(size=50)
    m = M.regression_metrics(spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "label double, prediction double")).first()
    assert m["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert m["mae"] == pytest.approx(np.abs(y - p).mean()) and m["rmse"] == pytest.approx(np.sqrt(((y - p) ** 2).mean()))
    truth, guess = rng.integers(0, 3, 60), rng.integers(0, 4, 60)
    f1 = 0.0
    for c in range(4):
        hits = ((truth == c) & (guess == c)).sum()
        total = (truth == c).sum() + (guess == c).sum()
        f1 += (2 * hits / total if total else 0) * (truth == c).sum() / 60
    m = M.classification_metrics(spark.createDataFrame([(int(a), int(b)) for a, b in zip(truth, guess)], "label int, prediction int")).first()
    assert m["accuracy"] == pytest.approx((truth == guess).mean()) and m["f1"] == pytest.approx(f1)
