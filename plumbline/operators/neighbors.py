"""Exact k nearest neighbours, and classification and regression from them.

Equal training rows are reduced to their k lowest ids and equal queries to one,
which loses nothing: only those can appear in an answer, ordered by (distance, id).
A query looks into its own region first, then into those whose boxes may hold a row
within the k-th distance found there. Where boxes rule out little, as in
many dimensions, rows are dealt by id into larger tiles, so that they are copied less.
"""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.limits import BLOCK_ROWS
from plumbline.operators.blocks import Side, matrix, measure_side, pair_blocks, split_tree, with_region
from plumbline.session import cut_lineage

NEIGHBOUR_SCHEMA = "qid bigint, p int, dist double, tid bigint, target double"

#: Blocks on a side of a tile where boxes prune little, and the part of a block of queries that is worth a task.
TILE_BLOCKS, LEAST_PART = 4, 4
#: Rows of a region that one box bounds, regions at most, and queries whose distances to all boxes are held at a time.
LEAF_ROWS, LEAVES, VISIT_ROWS = 512, 4096, 128
#: Dimensions above which some queries, about so many, first try whether boxes rule out enough.
FEW_DIMS, ASKED_FIRST = 12, 4096
#: Distances that are held at a time, and rows and columns whose sums stay in a processor's cache.
CELLS, CACHED = 4_000_000, (64, 1024)
#: Distances of which the least stands for all when a bound is looked for.
GROUP = 16


def neighbours(queries: DataFrame, train: DataFrame, k: int, powers: tuple[int, ...] = (2,), dims: int | None = None,
               folds: bool = False, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(row_id, p, rn, dist, tid, target)``: the k nearest training rows of every query.

    ``queries`` has ``row_id, x`` and ``train`` has ``row_id, x, target``. With
    ``folds`` both also have ``fold``, and rows of a query's own fold do not count.
    """
    fold = ["fold"] if folds else []
    if dims is None:
        dims = len(train.select("x").first()["x"])
    asked = queries.groupBy("x", *fold).agg(F.min("row_id").alias("qid")).persist()
    copies = W.partitionBy("x", *fold).orderBy("row_id")
    kept = (train.withColumn("_c", F.row_number().over(copies)).where(F.col("_c") <= k)
            .select(F.col("row_id").alias("tid"), "x", F.col("target").cast("double").alias("target"), *fold)).persist()
    rows = kept.count()
    tree = split_tree(kept, rows, min(LEAF_ROWS, block_rows) if rows > block_rows else block_rows, LEAVES)
    left = measure_side(with_region(asked, tree), tree, dims, block_rows)
    right = measure_side(with_region(kept, tree), tree, dims, block_rows, at_most=rows)

    def kernel(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        return nearest_in_block(q, t, k, powers, folds)

    partial = _visited(left, right, k, powers, folds) if tree.depth else None
    if partial is None:
        partial = pair_blocks(*_tiles(left, right, block_rows), np.ones((1, 1), dtype=bool), "qid", "tid").applyInPandas(kernel, NEIGHBOUR_SCHEMA)
    best = W.partitionBy("qid", "p").orderBy("dist", "tid")
    top = partial.withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= k)
    keys = asked.select("qid", "x", *fold)
    back = queries.select("row_id", "x", *fold).join(keys, ["x", *fold]).select("row_id", "qid")
    return back.join(top, "qid").select("row_id", "p", "rn", "dist", "tid", "target")


def _visited(left: Side, right: Side, k: int, powers: tuple[int, ...], folds: bool) -> DataFrame | None:
    """The nearest rows of each block that a query visits, as far as they are no farther than what its own block guarantees.

    None where the boxes rule out little, so that queries would meet half of all rows or more.
    """
    fold = ["fold"] if folds else []
    blocks = np.maximum(1, right.blocks)
    offsets, of = np.cumsum(blocks) - blocks, np.repeat(np.arange(len(blocks)), blocks)
    lo, hi, sizes = right.lo[of], right.hi[of], right.counts[of] // blocks[of]

    @F.pandas_udf("int")
    def block_of(region: pd.Series, row: pd.Series) -> pd.Series:
        return (offsets[region] + row % blocks[region]).astype("int32")

    there = right.df.withColumn("block", block_of("region", "tid")).drop("region")
    there = there.select([F.col(c).alias(c) for c in there.columns])  # fresh names keep two sides made from one table apart
    home = left.df.withColumn("block", block_of("region", "qid")).drop("region")

    def bounds(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        if q.empty:
            return pd.DataFrame({c: pd.Series([], dtype=object) for c in ["qid", "x", *fold, "reach", "met", "visits"]})
        found, reach = nearest_in_block(q, t, k, powers, folds), np.full((len(q), len(powers)), np.inf)
        place = pd.Series(np.arange(len(q)), q["qid"].to_numpy())
        for n, p in enumerate(powers):
            # sorted by distance for every query, so the k-th is the last
            last = found[found["p"] == p].groupby("qid")["dist"].agg(["size", "last"])
            last = last[last["size"] == k]
            reach[place[last.index].to_numpy(), n] = last["last"].to_numpy()
        visits = _visits(matrix(q["x"]), reach, powers, lo, hi, sizes, int(q["block"].iloc[0]))
        met = [int(sizes[v].sum()) for v in visits]
        # a query that visits most blocks names none and visits all
        visits = pd.Series([v if 2 * len(v) <= len(of) else None for v in visits], dtype=object)
        return pd.DataFrame({"qid": q["qid"], "x": q["x"], **{f: q[f] for f in fold}, "reach": list(reach), "met": met, "visits": visits})

    names = "qid bigint, x array<double>, " + ("fold int, " if folds else "") + "reach array<double>, met bigint, visits array<int>"
    asked, rows = int(left.counts.sum()), int(right.counts.sum())

    def seen_by(queries: DataFrame) -> DataFrame:
        return queries.groupBy("block").cogroup(there.groupBy("block")).applyInPandas(bounds, names)

    def little(seen: DataFrame) -> bool:
        n, met = seen.agg(F.count(F.lit(1)), F.sum("met")).first()
        return 2 * (met or 0) > n * rows

    # in many dimensions a few queries tell whether the boxes rule out enough; the answers never depend on it
    if len(lo[0]) > FEW_DIMS and little(seen_by(home.where(F.pmod(F.xxhash64("qid"), F.lit(max(1, asked // ASKED_FIRST))) == 0))):
        return None
    seen = cut_lineage(seen_by(home))
    if little(seen):
        return None
    everywhere = F.sequence(F.lit(0), F.lit(len(of) - 1))
    asked = seen.select("qid", "x", *fold, "reach", F.explode(F.coalesce("visits", everywhere)).alias("block"))

    def near(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        found = nearest_in_block(q, t, k, powers, folds)
        if not len(found):
            return found
        reach = pd.DataFrame(np.stack(q["reach"].to_numpy()), q["qid"].to_numpy(), list(powers))
        keep = np.zeros(len(found), dtype=bool)
        for p in powers:
            own = (found["p"] == p).to_numpy()
            keep[own] = found["dist"].to_numpy()[own] <= reach[p].loc[found["qid"].to_numpy()[own]].to_numpy()
        return found[keep]

    return asked.groupBy("block").cogroup(there.groupBy("block")).applyInPandas(near, NEIGHBOUR_SCHEMA)


def _visits(x: np.ndarray, reach: np.ndarray, powers: tuple[int, ...], lo: np.ndarray, hi: np.ndarray, sizes: np.ndarray, home: int) -> list[np.ndarray]:
    """For each query the blocks whose boxes may hold a row within ``reach``, its own among them."""
    out, full = [], sizes > 0
    for i in range(0, len(x), VISIT_ROWS):
        a, may = x[i:i + VISIT_ROWS], np.zeros((len(x[i:i + VISIT_ROWS]), len(lo)), dtype=bool)
        for n, p in enumerate(powers):
            near = np.zeros(may.shape)
            for f in range(x.shape[1]):
                gap = np.maximum(np.maximum(lo[None, :, f] - a[:, None, f], a[:, None, f] - hi[None, :, f]), 0.0)
                near += gap if p == 1 else gap * gap
            far = reach[i:i + VISIT_ROWS, n, None] * (1 + 1e-9)
            may |= near <= (far if p == 1 else far * far)
        may &= full
        may[:, home] = True
        out += [np.flatnonzero(row) for row in may]
    return out


def _tiles(left: Side, right: Side, block_rows: int) -> tuple[Side, Side]:
    """Both sides as one region of large blocks: as few as a task can hold, but enough queries' blocks for all task slots."""
    many, rows, asked = TILE_BLOCKS * block_rows, int(right.counts.sum()), int(left.counts.sum())
    slots = 2 * right.df.sparkSession.sparkContext.defaultParallelism
    wanted = min(-(-slots // -(-rows // many)), -(-asked * LEAST_PART // block_rows))
    per_block = min(many, -(-asked // wanted))

    def whole(side: Side, n: int, size: int) -> Side:
        return replace(side, df=side.df.withColumn("region", F.lit(0)), counts=np.array([n]), lo=side.lo[:1], hi=side.hi[:1], block_rows=size)

    return whole(left, asked, per_block), whole(right, rows, many)


def nearest_in_block(q: pd.DataFrame, t: pd.DataFrame, k: int, powers: tuple[int, ...], folds: bool) -> pd.DataFrame:
    """The k nearest rows of one block for every query of another, per distance power."""
    if q.empty or t.empty:
        return pd.DataFrame({"qid": [], "p": [], "dist": [], "tid": [], "target": []})
    t = t.sort_values("tid", ignore_index=True)
    a, b = matrix(q["x"]), matrix(t["x"])
    qid, tid, target = q["qid"].to_numpy(), t["tid"].to_numpy(), t["target"].to_numpy()
    columns, middle = np.ascontiguousarray(b.T), b.mean(axis=0)
    centered = b - middle
    squares = (centered * centered).sum(axis=1)
    step = max(1, CELLS // len(b))
    out = []
    for start in range(0, len(a), step):
        part = a[start:start + step]
        barred = q["fold"].to_numpy()[start:start + step, None] == t["fold"].to_numpy()[None, :] if folds else None
        for p in powers:
            i, j = _near_pairs(part, columns, centered, squares, middle, k, barred) if p == 2 else (None, None)
            if i is None:
                d = _distances(part, columns, p)
                if folds:
                    d[barred] = np.inf
                i, j = np.nonzero(d <= _bound(d, k)[:, None])
                dist = d[i, j]
            else:
                dist = np.zeros(len(i))
                for f in range(len(columns)):
                    gap = part[i, f] - columns[f][j]
                    dist += gap * gap
                dist = np.sqrt(dist)
            real = np.isfinite(dist)
            i, j, dist = i[real], j[real], dist[real]
            order = np.lexsort((j, dist, i))
            i, j, dist = i[order], j[order], dist[order]
            first = np.arange(len(i)) - np.searchsorted(i, i) < k
            out.append(pd.DataFrame({"qid": qid[start + i[first]], "p": p, "dist": dist[first], "tid": tid[j[first]], "target": target[j[first]]}))
    return pd.concat(out, ignore_index=True)


def _bound(d: np.ndarray, k: int) -> np.ndarray:
    """A number per row that at least k of its distances do not exceed; infinite if there are fewer."""
    groups = d.shape[1] // GROUP
    if groups >= 2 * k:
        d = d[:, :groups * GROUP].reshape(len(d), GROUP, groups).min(axis=1)
    return np.partition(d, k - 1, axis=1)[:, k - 1] if d.shape[1] > k else np.full(len(d), np.inf)


def _near_pairs(a: np.ndarray, columns: np.ndarray, centered: np.ndarray, squares: np.ndarray, middle: np.ndarray, k: int,
                barred: np.ndarray | None) -> tuple:
    """Pairs among which are the k nearest rows of every row of ``a``, and all that are as near as these.

    They are found by squared distances from a matrix product, widened by more than its rounding
    and that of the distances themselves; None for numbers too large for that.
    """
    own = a - middle
    norms = (own * own).sum(axis=1)
    error = 8 * (len(columns) + 8) * np.finfo(float).eps * (np.sqrt(norms) + np.sqrt(squares.max())) ** 2
    if not np.isfinite(error).all():
        return None, None
    d = own @ centered.T
    d *= -2.0
    d += norms[:, None]
    d += squares[None, :]
    if barred is not None:
        d[barred] = np.inf
    near = d <= (_bound(d, k) + error)[:, None]
    if barred is not None:
        near &= ~barred
    return np.nonzero(near)


def _distances(a: np.ndarray, columns: np.ndarray, p: int) -> np.ndarray:
    """Distances of all rows to all columns, summed up a piece of cached size at a time."""
    out = np.zeros((len(a), columns.shape[1]))
    for r in range(0, len(a), CACHED[0]):
        for c in range(0, columns.shape[1], CACHED[1]):
            part, rows, cols = np.zeros_like(out[r:r + CACHED[0], c:c + CACHED[1]]), a[r:r + CACHED[0]], columns[:, c:c + CACHED[1]]
            gap = np.empty_like(part)
            for f in range(len(columns)):
                np.subtract(rows[:, f, None], cols[f][None, :], out=gap)
                np.abs(gap, out=gap) if p == 1 else np.multiply(gap, gap, out=gap)
                part += gap
            out[r:r + CACHED[0], c:c + CACHED[1]] = part
    return out if p == 1 else np.sqrt(out, out=out)


def candidate_name(k: int, weights: str, p: int) -> str:
    return f"k{k}_{weights}_p{p}"


def _weight(weights: str):
    if weights == "uniform":
        return F.lit(1.0)
    # rows at distance zero take all the weight
    return F.when(F.col("_zero"), F.when(F.col("dist") == 0, 1.0).otherwise(0.0)).otherwise(1.0 / F.nullif("dist", F.lit(0.0)))


def neighbour_predictions(near: DataFrame, classify: bool, ks: tuple[int, ...], weights: tuple[str, ...]) -> DataFrame:
    """``(row_id, p, pred_<k>_<weights> ...)``: every candidate from one neighbour list."""
    # sorted by distance, so some row is at zero exactly when the nearest is
    nearest = F.min("dist").over(W.partitionBy("row_id", "p"))
    zeroed = near.withColumn("_zero", nearest == 0)
    names = [(k, w, f"{k}_{w}") for k in ks for w in weights]

    def inside(k, value):
        return F.sum(F.when(F.col("rn") <= k, value).otherwise(0.0))

    if not classify:
        return zeroed.groupBy("row_id", "p").agg(*[
            (inside(k, _weight(w) * F.col("target")) / inside(k, _weight(w))).alias(f"pred_{n}") for k, w, n in names])
    votes = zeroed.groupBy("row_id", "p", "target").agg(*[inside(k, _weight(w)).alias(f"v_{n}") for k, w, n in names])
    return votes.groupBy("row_id", "p").agg(*[
        F.max_by("target", F.struct(F.col(f"v_{n}"), -F.col("target"))).alias(f"pred_{n}") for _, _, n in names])
