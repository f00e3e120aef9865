"""Logistic regressions and support vector machines of a whole search, fitted by shared scans.

All fits (every penalty, fold, class or pair of classes, and kernel) take their Newton steps
together: one scan adds up the gradients and curvatures of all, a second the losses at a few step
lengths. The hinge loss is smoothed at its corner and the smoothing reduced until the gap between
the hinge objective and its dual is small: the slopes of the smoothed losses are the dual variables.

The Gaussian kernel is replaced by its values at landmarks (Nystrom). Landmarks are pivots of a
Cholesky factorisation, each the row that those before explain least, and as many as the mean
unexplained part of the rows asks for.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.limits import ROWS_PER_TASK
from plumbline.operators.blocks import matrix

#: Parameters of one fit up to which its curvature is a matrix on the driver.
WIDEST = 2000
#: Gap of objective and dual, as a share of the objective, at which a machine is done; steps of one smoothing at most.
GAP, STEPS = 9e-4, 60
#: Rows from which landmarks are taken at a time, landmarks at most, and the mean unexplained part at which they suffice.
POOL_ROWS, LANDMARKS, UNEXPLAINED = 2000, 256, 1e-3

_LENGTHS = 0.6 ** np.arange(30.0)


@dataclass(frozen=True)
class Kernel:
    """Features ``k(x, landmarks) @ whiten`` of a Gaussian kernel."""

    gamma: float
    landmarks: np.ndarray
    whiten: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        return gaussian(x, self.landmarks, self.gamma) @ self.whiten


def gaussian(a: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
    near = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * a @ b.T
    return np.exp(-gamma * np.maximum(near, 0.0))


@dataclass
class Fit:
    """One problem: ``c`` times the losses plus half the squared weights.

    ``loss`` is hinge, logistic or softmax. The first two set ``positive`` against ``negative`` (None
    for all others); ``intercept`` says whether the intercept is penalised; rows of ``fold`` are left out.
    """

    loss: str
    c: float
    fold: int | None
    positive: int = 1
    negative: int | None = None
    intercept: bool = False
    outputs: int = 1
    kernel: int | None = None
    weights: np.ndarray = field(default=None, repr=False)
    smooth: float = 2.0  # all rows lie on the smoothed corner at first
    done: bool = False
    gap: float | None = None
    balance: float = 0.0  # signed sum of the dual variables, which is 0 at the optimum, over their sum
    objective: float | None = None


def _problem(fit: Fit, label: np.ndarray, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a fit, and their signs (classes for softmax)."""
    rows = np.ones(len(label), bool) if fit.fold is None else fold != fit.fold
    if fit.loss == "softmax":
        return np.flatnonzero(rows), label.astype(np.int64)
    if fit.negative is not None:
        rows &= (label == fit.positive) | (label == fit.negative)
    return np.flatnonzero(rows), np.where(label == fit.positive, 1.0, -1.0)


def _losses(fit: Fit, z: np.ndarray) -> np.ndarray:
    """Loss at signed scores ``z``."""
    if fit.loss == "hinge":
        short = 1 - z
        return np.where(short <= 0, 0.0, np.where(short < fit.smooth, short * short / (2 * fit.smooth), short - fit.smooth / 2))
    return np.logaddexp(0.0, -z)


def _log_softmax(scores: np.ndarray) -> np.ndarray:
    top = scores.max(axis=1, keepdims=True)
    return scores - top - np.log(np.exp(scores - top).sum(axis=1, keepdims=True))


def _terms(fit: Fit, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Loss, hinge loss, sum of dual variables, gradient and curvature of some rows, in one array."""
    if fit.loss == "softmax":
        w = fit.weights.reshape(fit.outputs, -1)
        logs = _log_softmax(x @ w.T)
        p = np.exp(logs)
        gradient = ((p - np.eye(fit.outputs)[y]).T @ x).ravel()
        size = x.shape[1]
        curve = np.empty((fit.outputs * size,) * 2)
        for a, b in itertools.combinations_with_replacement(range(fit.outputs), 2):
            h = p[:, a] * ((a == b) - p[:, b])
            block = (x * h[:, None]).T @ x
            curve[a * size:(a + 1) * size, b * size:(b + 1) * size] = block
            curve[b * size:(b + 1) * size, a * size:(a + 1) * size] = block.T
        return np.concatenate([[-logs[np.arange(len(y)), y].sum(), 0.0, 0.0], gradient, curve.ravel()])
    z = y * (x @ fit.weights)
    if fit.loss == "hinge":
        slope = np.clip((1 - z) / fit.smooth, 0.0, 1.0)
        bend = np.where((slope > 0) & (slope < 1), 1 / fit.smooth, 0.0)
        extra = np.maximum(1 - z, 0.0).sum(), slope.sum()
    else:
        slope = np.exp(-np.logaddexp(0.0, z))
        bend = slope * (1 - slope)
        extra = 0.0, 0.0
    used = np.flatnonzero(bend)
    curve = (x[used] * bend[used, None]).T @ x[used]
    return np.concatenate([[_losses(fit, z).sum(), *extra], -(y * slope) @ x, curve.ravel()])


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, np.ones((len(x), 1))])


def _scan(rows: DataFrame, fits: list[Fit], kernels: list[Kernel], each) -> dict[int, np.ndarray]:
    """``each(number, fit, x, label signs)`` of all fits, added up over all rows, in two steps."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(([vars(f) for f in fits], [vars(k) for k in kernels]))
    groups = max(1, int(rows.rdd.getNumPartitions() ** 0.5))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, maps = [Fit(**f) for f in shared.value[0]], [Kernel(**k) for k in shared.value[1]]
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            label, fold = batch.column(1).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False)
            seen = {None: _with_one(x)}
            for number, fit in enumerate(mine):
                if fit.kernel not in seen:
                    seen = {None: seen[None], fit.kernel: _with_one(maps[fit.kernel].features(x))}
                own, sign = _problem(fit, label, fold)
                if len(own):
                    part = each(number, fit, seen[fit.kernel][own], sign[own])
                    sums[number] = sums[number] + part if number in sums else part
        numbers = list(sums)
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array([n % groups for n in numbers], pa.int32()),
                                          pa.array([sums[n].tobytes() for n in numbers], pa.binary())], ["fit", "part", "sums"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(s) for s in table.column("sums").to_pylist())
        return pa.table([table.column("fit").slice(0, 1), table.column("part").slice(0, 1), pa.array([total.tobytes()], pa.binary())], ["fit", "part", "sums"])

    kind = "fit int, part int, sums binary"
    parts = rows.select("x", "label", F.coalesce("fold", F.lit(-1)).alias("fold")).mapInArrow(run, kind)
    if groups > 1:
        parts = parts.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(groups))).groupBy("fit", "part").applyInArrow(add, kind)
    out: dict[int, np.ndarray] = {}
    for number, _, sums in parts.collect():
        out[number] = out.get(number, 0.0) + np.frombuffer(sums)
    shared.destroy()
    return out


def _penalty(fit: Fit, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Half the squared weights, its gradient and its diagonal curvature."""
    mask = np.ones((fit.outputs, len(w) // fit.outputs))
    mask[:, -1] = float(fit.intercept)
    mask = mask.ravel()
    return 0.5 * float((mask * w * w).sum()), mask * w, mask


def _judge(fit: Fit, sums: np.ndarray) -> float:
    """The smoothed objective at the weights; notes the objective and, for a machine, the gap to its dual."""
    p = len(fit.weights)
    half, _, _ = _penalty(fit, fit.weights)
    value = fit.objective = half + fit.c * sums[0]
    if fit.loss == "hinge":
        dual_w = -fit.c * sums[3:3 + p]
        fit.objective = half + fit.c * sums[1]
        fit.gap = fit.objective - fit.c * sums[2] + _penalty(fit, dual_w)[0]
        fit.balance = abs(dual_w[-1]) / max(fit.c * sums[2], 1e-300)
    return value


def _step(fit: Fit, sums: np.ndarray, value: float) -> np.ndarray | None:
    """The Newton step, or None where the fit has reached the optimum of its losses."""
    p = len(fit.weights)
    _, slope, diagonal = _penalty(fit, fit.weights)
    g = slope + fit.c * sums[3:3 + p]
    h = np.diag(diagonal) + fit.c * sums[3 + p:].reshape(p, p)
    h[np.diag_indices(p)] += 1e-9 * (1 + np.trace(h) / p)
    if fit.loss == "hinge":  # where no row bends the loss, nothing else holds the intercept
        h[-1, -1] += 1e-3 * (1 + abs(g[-1])) * (h[-1, -1] < 1e-3)
    step = -np.linalg.solve(h, g)
    return None if -(g @ step) < (1e-8 if fit.loss == "hinge" else 1e-11) * (1e-9 + abs(value)) else step


def solve(rows: DataFrame, fits: list[Fit], kernels: list[Kernel], dims: int) -> list[Fit]:
    """All fits brought to their optimum; ``rows`` is cached and has ``x, label, fold``.

    A table that one task holds goes to a few tasks, each with some of the fits; of a larger one every
    step is a scan.
    """
    for fit in fits:
        size = (dims if fit.kernel is None else kernels[fit.kernel].whiten.shape[1]) + 1
        fit.weights = np.zeros(size * fit.outputs)
    if rows.count() <= ROWS_PER_TASK:
        _solve_in_tasks(rows, fits, kernels)
    else:
        _descend(fits, lambda live, each: _scan(rows, live, kernels, each))
    return fits


def _solve_in_tasks(rows: DataFrame, fits: list[Fit], kernels: list[Kernel]) -> None:
    spark = rows.sparkSession
    order = sorted(range(len(fits)), key=lambda i: (fits[i].kernel is not None, fits[i].kernel))
    parts = max(1, min(len(fits), 2 * spark.sparkContext.defaultParallelism))
    shared = spark.sparkContext.broadcast(([(i, vars(fits[i])) for i in order], [vars(k) for k in kernels]))

    def run(table: pa.Table) -> pa.Table:
        every, maps = shared.value[0], [Kernel(**k) for k in shared.value[1]]
        mine = every[table.column("part")[0].as_py()::parts]
        own = [Fit(**f) for _, f in mine]
        x = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)
        label, fold = table.column("label").to_numpy(), table.column("fold").to_numpy()
        seen = {k: _with_one(x if k is None else maps[k].features(x)) for k in {f.kernel for f in own}}

        def scan(live: list[Fit], each) -> dict[int, np.ndarray]:
            out = {}
            for n, fit in enumerate(live):
                at, sign = _problem(fit, label, fold)
                if len(at):
                    out[n] = each(n, fit, seen[fit.kernel][at], sign[at])
            return out

        _descend(own, scan)
        facts = [(i, f.weights.tobytes(), f.objective, f.gap, f.balance) for (i, _), f in zip(mine, own, strict=True)]
        kinds = pa.int32(), pa.binary(), pa.float64(), pa.float64(), pa.float64()
        return pa.table([pa.array([r[c] for r in facts], kind) for c, kind in enumerate(kinds)], ["fit", "weights", "objective", "gap", "balance"])

    dealt = rows.select("x", "label", F.coalesce("fold", F.lit(-1)).cast("int").alias("fold"),
                        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")).repartition(parts, "part")
    solved = dealt.groupBy("part").applyInArrow(run, "fit int, weights binary, objective double, gap double, balance double")
    for r in solved.collect():
        fit = fits[r["fit"]]
        fit.weights, fit.objective, fit.gap, fit.balance, fit.done = np.frombuffer(r["weights"]), r["objective"], r["gap"], r["balance"], True
    shared.destroy()


def _descend(fits: list[Fit], scan) -> None:
    """Newton steps of all fits until they are done; ``scan(fits, each)`` adds up ``each`` over the rows.

    One scan serves the full steps of all fits; only fits that a full step would make worse take part
    in a second one, over step lengths.
    """
    order = sorted(range(len(fits)), key=lambda i: (fits[i].kernel is not None, fits[i].kernel))
    steps, before = dict.fromkeys(order, 0), {}  # before: value, weights, step and slope of a fit that tries a full step
    while live := [i for i in order if not fits[i].done]:
        sums = scan([fits[i] for i in live], lambda n, fit, x, y: _terms(fit, x, y))
        short = {}
        for n, i in enumerate(live):
            fit = fits[i]
            if n not in sums:  # no rows
                fit.done = True
                continue
            value = _judge(fit, sums[n])
            if i in before and value > before[i][0] + 1e-4 * before[i][3]:
                short[n] = before.pop(i)
                fit.weights = short[n][1]
                continue
            step = _step(fit, sums[n], value)
            steps[i] += 1
            if step is None or steps[i] > STEPS:
                _settled(fit)
                steps[i] = 0
                before.pop(i, None)
            else:
                p = len(step)
                slope = float((_penalty(fit, fit.weights)[1] + fit.c * sums[n][3:3 + p]) @ step)
                before[i] = value, fit.weights, step, slope
                fit.weights = fit.weights + step
        if not short:
            continue
        tried = _tried([fits[i] for i in live], {n: s[2] for n, s in short.items()}, scan)
        for n, (_, weights, step, _) in short.items():
            fit = fits[live[n]]
            values = [_penalty(fit, weights + t * step)[0] + fit.c * v for t, v in zip([0.0, *_LENGTHS], tried[n], strict=True)]
            best = int(np.argmin(values))
            if best:
                fit.weights = weights + _LENGTHS[best - 1] * step
            else:
                _settled(fit)
                steps[live[n]] = 0


def _settled(fit: Fit) -> None:
    """The smoothed problem is solved: the fit is done, or goes on with less smoothing."""
    if fit.loss != "hinge" or (abs(fit.gap) <= GAP * max(fit.objective, 1e-300) and fit.balance < 1e-3) or fit.smooth < 1e-7:
        fit.done = True
    else:
        fit.smooth *= 0.25


def _tried(fits: list[Fit], moves: dict[int, np.ndarray], scan) -> dict[int, np.ndarray]:
    """Losses at the present weights and at all step lengths."""
    going = list(moves)

    def losses(n: int, fit: Fit, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        lengths = np.concatenate([[0.0], _LENGTHS])
        if fit.loss == "softmax":
            here, there = (x @ w.reshape(fit.outputs, -1).T for w in (fit.weights, moves[going[n]]))
            return np.array([-_log_softmax(here + t * there)[np.arange(len(y)), y].sum() for t in lengths])
        here, there = y * (x @ fit.weights), y * (x @ moves[going[n]])
        return np.array([_losses(fit, here + t * there).sum() for t in lengths])

    found = scan([fits[n] for n in going], losses)
    return {n: found[i] for i, n in enumerate(going)}


# ---------------------------------------------------------------- landmarks

def _pivots(x: np.ndarray, gamma: float, start: list[int]) -> tuple[list[int], np.ndarray]:
    """Places of landmarks in ``x``, the row explained least first, and what stays unexplained of each row."""
    rest, factor, chosen = np.ones(len(x)), np.zeros((LANDMARKS, len(x))), []
    while len(chosen) < min(LANDMARKS, len(x)) and (len(chosen) < len(start) or rest.mean() > UNEXPLAINED / 2):
        at = start[len(chosen)] if len(chosen) < len(start) else int(np.argmax(rest))
        if rest[at] < 1e-10:
            break
        k = len(chosen)
        factor[k] = (gaussian(x[at:at + 1], x, gamma)[0] - factor[:k, at] @ factor[:k]) / np.sqrt(rest[at])
        rest = np.maximum(rest - factor[k] ** 2, 0.0)
        chosen.append(at)
    return chosen, rest


def fit_kernel(rows: DataFrame, gamma: float, fold: int | None) -> Kernel:
    """Landmarks of the rows not in ``fold``, from a pool that takes in the rows explained least until few are."""
    own = rows if fold is None else rows.where(F.col("fold") != fold)
    pool = matrix(own.orderBy(F.xxhash64("row_id"), "row_id").limit(POOL_ROWS).select("x").toPandas()["x"])
    chosen: list[int] = []
    while True:
        chosen, _ = _pivots(pool, gamma, chosen)
        marks = pool[chosen]
        kernel = Kernel(gamma, marks, np.linalg.inv(np.linalg.cholesky(gaussian(marks, marks, gamma) + 1e-10 * np.eye(len(marks)))).T)
        if len(chosen) >= LANDMARKS or len(pool) < POOL_ROWS:
            return kernel
        mean, worst = _unexplained(own, kernel)
        if mean <= UNEXPLAINED or not len(worst):
            return kernel
        pool = np.concatenate([pool, worst])


def _unexplained(rows: DataFrame, kernel: Kernel) -> tuple[float, np.ndarray]:
    @F.pandas_udf("double")
    def rest(x: pd.Series) -> pd.Series:
        return pd.Series(1 - (kernel.features(matrix(x)) ** 2).sum(axis=1))

    left = rows.select("x", rest("x").alias("rest"))
    worst = left.where(F.col("rest") > UNEXPLAINED).orderBy(F.desc("rest")).limit(LANDMARKS).toPandas()
    return left.agg(F.avg("rest")).first()[0] or 0.0, matrix(worst["x"])


# ---------------------------------------------------------------- models of many fits

def decided(fits: list[Fit], kernels: list[Kernel], x: np.ndarray, classes: int) -> np.ndarray:
    """Classes by the fits of one model: the sign of one, the largest of one a class, or the votes of pairs."""
    seen = {None: _with_one(x)}
    scores = []
    for fit in fits:
        if fit.kernel not in seen:
            seen[fit.kernel] = _with_one(kernels[fit.kernel].features(x))
        scores.append(seen[fit.kernel] @ fit.weights.reshape(fit.outputs, -1).T)
    if fits[0].loss == "softmax":
        return scores[0].argmax(axis=1)
    flat = np.concatenate(scores, axis=1)
    if fits[0].negative is None:
        return (flat[:, 0] > 0).astype(int) if len(fits) == 1 else flat.argmax(axis=1)
    votes = np.zeros((len(x), max(classes, 2)))
    for k, fit in enumerate(fits):
        votes[np.arange(len(x)), np.where(flat[:, k] > 0, fit.positive, fit.negative)] += 1
    return votes.argmax(axis=1)


@dataclass
class Decision:
    """A fitted model of this module, which predicts a class."""

    fits: list[Fit]
    kernels: list[Kernel]
    classes: int
    kind: str = "decision"

    @property
    def weights(self) -> list[list[float]]:
        """Weights of each score, without the intercepts."""
        return [row[:-1].tolist() for f in self.fits for row in f.weights.reshape(f.outputs, -1)]

    @property
    def intercepts(self) -> list[float]:
        return [float(row[-1]) for f in self.fits for row in f.weights.reshape(f.outputs, -1)]

    def predict(self, df: DataFrame) -> DataFrame:
        facts, classes = _plain(self.fits, self.kernels), self.classes

        @F.pandas_udf("double")
        def predicted(x: pd.Series) -> pd.Series:
            return pd.Series(decided(*_read(facts), matrix(x), classes).astype(float) if len(x) else [], dtype=float)

        return df.withColumn("prediction", predicted("x"))

    def save(self, spark: SparkSession, path: str) -> dict:
        return {"facts": _plain(self.fits, self.kernels), "classes": self.classes}

    @staticmethod
    def load(spark: SparkSession, path: str, facts: dict) -> Decision:
        return Decision(*_read(facts["facts"]), facts["classes"])


def _plain(fits: list[Fit], kernels: list[Kernel]) -> dict:
    """Fits and kernels as plain values, kernels that no fit uses left out."""
    return {"fits": [{**vars(f), "weights": f.weights.tolist()} for f in fits],
            "kernels": [{"gamma": k.gamma, "landmarks": k.landmarks.tolist(), "whiten": k.whiten.tolist()} if any(f.kernel == i for f in fits)
                        else None for i, k in enumerate(kernels)]}


def _read(facts: dict) -> tuple[list[Fit], list[Kernel]]:
    return ([Fit(**{**f, "weights": np.array(f["weights"])}) for f in facts["fits"]],
            [k and Kernel(k["gamma"], np.array(k["landmarks"]), np.array(k["whiten"])) for k in facts["kernels"]])


def right_counts(rows: DataFrame, models: list[tuple[list[Fit], int]], kernels: list[Kernel], classes: int) -> dict[tuple[int, int], float]:
    """Share of right classes of every model on the fold it left out, by ``(model, fold)``."""
    shared = rows.sparkSession.sparkContext.broadcast([([vars(f) for f in fits], fold) for fits, fold in models])
    maps = rows.sparkSession.sparkContext.broadcast([vars(k) for k in kernels])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [([Fit(**f) for f in fits], fold) for fits, fold in shared.value]
        kept = [Kernel(**k) for k in maps.value]
        sums = np.zeros((len(own), 2))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            label, folds = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for m, (fits, fold) in enumerate(own):
                at = folds == fold
                if at.any():
                    sums[m] += (decided(fits, kept, x[at], classes) == label[at]).sum(), at.sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(own), dtype=np.int32)), pa.array(sums[:, 0]), pa.array(sums[:, 1])], ["m", "right", "n"])

    found = rows.select("x", "label", "fold").mapInArrow(run, "m int, right double, n double").groupBy("m").agg(F.sum("right"), F.sum("n")).collect()
    return {(m, models[m][1]): right / n if n else 0.0 for m, right, n in found}
